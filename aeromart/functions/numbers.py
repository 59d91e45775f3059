"""Numbers out of values whose type varies from row to row or from file to file."""

from collections import ChainMap

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def types_by_path(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType]:
    """The type of every field, nested ones under their dotted paths."""
    own = {prefix + f.name: f.dataType for f in schema}
    nested = [types_by_path(t, name + ".") for name, t in own.items() if isinstance(t, T.StructType)]
    return dict(ChainMap(own, *nested))


def field_type(schema: T.StructType, path: str):
    """Type of the dotted `path` in `schema`; None where any part is missing."""
    return types_by_path(schema).get(path)


def _quoted(path: str) -> str:
    return ".".join(f"`{part}`" for part in path.split("."))


def number_in(text: Column) -> Column:
    """Text to double; text that is not a number becomes NULL.

    A cast that fails costs a Java exception, some ten times the cast: text without a digit, `inf` or `nan` is left out.
    """
    return F.when(text.rlike("[0-9]|(?i:inf|nan)"), text.try_cast("double"))


def _double(value: Column, kind: T.DataType) -> Column:
    return number_in(value) if isinstance(kind, T.StringType) else value.try_cast("double")


def resolve_num(col) -> Column:
    """Number held in a text column; text that is not a number becomes NULL."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("double")


def resolve_choice(name: str, schema: T.StructType, branches=("double", "int")) -> Column:
    """Number in the possibly nested field `name`, whatever shape the schema gives it.

    A struct holding one value in several types gives its first non-NULL branch,
    a plain field is cast, a missing field is NULL.
    """
    kind = field_type(schema, name)
    if kind is None:
        return F.lit(None).cast("double")
    value = F.col(_quoted(name))
    if not isinstance(kind, T.StructType):
        return _double(value, kind)
    present = [value.getField(b).try_cast("double") for b in branches if b in kind.fieldNames()]
    return F.coalesce(*present) if present else F.lit(None).cast("double")


def resolve_variant(value: Column, path: str = "$", branches=("double", "int")) -> Column:
    """`resolve_choice` for a VARIANT: the number at `path`, a plain one or the first branch of an object of types.

    Text that holds a number counts as one; anything else is NULL, as is a missing field.
    """
    inside = [F.try_variant_get(value, f"{path}.{b}", "double") for b in branches]
    return F.coalesce(F.try_variant_get(value, path, "double"), *inside)


def clean_numeric(name: str, schema: T.StructType) -> Column:
    """Top-level column to double: the double branch of a struct, else a cast; bad text is NULL."""
    value, kind = F.col(f"`{name}`"), schema[name].dataType
    if isinstance(kind, T.StructType):
        value, kind = value.getField("double"), kind["double"].dataType
    return _double(value, kind)


def strip_thousands(col: Column) -> Column:
    """`1,012` to 1012.0."""
    return number_in(F.regexp_replace(col.cast("string"), ",", ""))
