"""Aggregate expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(col: Column) -> Column:
    """Two decimals, half up.

    A mean that lies on half a cent may come out a hair below it, depending on the order
    of summation. Rounding to 8 decimals first makes the answer independent of that order.
    """
    return F.round(F.round(col, 8), 2)


def mean2(col) -> Column:
    """Mean of the non-NULL values to two decimals."""
    return round2(F.avg(col))


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; 0, not NULL, if there are none."""
    return F.count_if(condition)


def distinct_count(col) -> Column:
    """Exact number of distinct non-NULL values."""
    return F.countDistinct(col)


#: Default size of a sketch: 2 to this power registers.
LG_K = 12


def distinct_sketch(col, lg_k: int = LG_K) -> Column:
    """A mergeable HyperLogLog sketch of the distinct non-NULL values."""
    return F.hll_sketch_agg(col, F.lit(lg_k))


def merge_sketches(col) -> Column:
    """Estimated number of distinct values over sketches of equal size; see `sketch_error`."""
    return F.hll_sketch_estimate(F.hll_union_agg(col))


def sketch_error(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate: 1.04 over the root of the registers."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_text(col, expected) -> Column:
    """Those of the expected values that occur, sorted and comma-joined.

    The answer is one cell. What is gathered is bounded by what is expected, whatever the column
    holds; `unexpected_values` returns the rest as rows.
    """
    value = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.array_sort(F.collect_set(F.when(value.isin(*expected), value))), ",")


def pct(part: Column, total: Column) -> Column:
    """Percentage to two decimals; 0 for an empty total."""
    return F.when(total > 0, F.round(F.try_divide(part, total) * 100, 2)).otherwise(F.lit(0.0))


def most_frequent(col, count) -> Column:
    """Over rows that carry a count per value: the value counted most, the smallest on a tie."""
    value = F.col(col) if isinstance(col, str) else col
    return F.min(F.struct((-count).alias("rank"), value.alias("value"))).getField("value")
