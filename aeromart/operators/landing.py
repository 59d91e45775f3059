"""Raw API responses as a table: city, body text and the timestamp at which it was taken in.

The columns are `city`, `body` and `ingested_at` unless other names are given. A request that got
no answer has a NULL body.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bronze_key, count_where, ingestion_id, parse_slug_list


def normalise_slugs(df: DataFrame, col: str = "city") -> DataFrame:
    """One row per usable city of the comma list in `col`; empty entries are dropped."""
    return df.withColumn(col, F.explode(parse_slug_list(F.col(col))))


def _is_object(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "map<string,variant>").isNotNull()


def _text_or_na(document: Column, path: str) -> Column:
    """Field as text; `N/A` where it is absent, NULL where it is an explicit null."""
    value = F.try_variant_get(document, path, "variant")
    return F.when(value.isNull(), "N/A").otherwise(F.try_variant_get(document, path, "string"))


def ingest_outcomes(
    responses: DataFrame, city: str = "city", body: str = "body", at: str = "ingested_at"
) -> DataFrame:
    """Outcome of every response, one row each.

    `network`: no answer. `api_status`: not JSON, or a status other than ok. `unknown`: ok, but
    without a `data` or a `data.time` object. Otherwise `success`, with the station, the reading
    and the storage key.
    """
    # The document is parsed inside the generator: what a generator yields is never inlined
    # into the many expressions over it, so a body is parsed once.
    document = F.try_parse_json(body)
    pairs = F.transform(
        parse_slug_list(F.col(city)),
        lambda slug: F.struct(slug.alias("city"), document.alias("doc")),
    )
    parsed = responses.select(
        F.explode(pairs).alias("_pair"), F.col(body).alias("body"), F.col(at).alias("ingested_at")
    ).withColumns({"city": F.col("_pair.city"), "_doc": F.col("_pair.doc")})
    doc = F.col("_doc")
    status = F.try_variant_get(doc, "$.status", "string")
    # What has `data.time` has `data`, and what has a status is an object: the many good bodies are told by two look-ups.
    good = F.coalesce(status == "ok", F.lit(False)) & _is_object(doc, "$.data.time")
    outcome = (
        F.when(good, "success")
        .when(F.col("body").isNull(), "network")
        .when(doc.isNull(), "api_status")
        .when(~_is_object(doc, "$"), "unknown")
        .when(status.isNull() | (status != "ok"), "api_status")
        .otherwise("unknown")
    )

    def on_success(col):
        return F.when(F.col("outcome") == "success", col)

    return parsed.withColumns({"outcome": outcome, "_status": status}).select(
        "city",
        "body",
        "ingested_at",
        ingestion_id(F.col("ingested_at")).alias("ingestion_id"),
        "outcome",
        on_success(_text_or_na(doc, "$.data.idx")).alias("idx"),
        on_success(_text_or_na(doc, "$.data.aqi")).alias("aqi"),
        on_success(_text_or_na(doc, "$.data.time.iso")).alias("measured_at"),
        on_success(bronze_key(F.col("city"), F.col("ingested_at"))).alias("s3_key"),
        F.when(
            F.col("outcome") == "api_status",
            F.concat(F.lit("status: "), F.coalesce(F.col("_status"), F.lit("none"))),
        )
        .when(F.col("outcome") == "network", "no answer")
        .when(F.col("outcome") == "unknown", "no data.time")
        .alias("error"),
    )


def landable(responses: DataFrame, **columns: str) -> DataFrame:
    """The responses that are kept as raw documents: the successful ones."""
    return ingest_outcomes(responses, **columns).filter(F.col("outcome") == "success")


def ingest_summary(responses: DataFrame, **columns: str) -> DataFrame:
    """Totals per ingestion run. Blank entries of the city list are not counted."""
    outcome = F.col("outcome")
    return (
        ingest_outcomes(responses, **columns)
        .groupBy("ingestion_id")
        .agg(
            F.count("*").alias("cities"),
            count_where(outcome == "success").alias("success"),
            count_where(outcome != "success").alias("failed"),
            count_where(outcome == "network").alias("failed_network"),
            count_where(outcome == "api_status").alias("failed_api_status"),
            count_where(outcome == "unknown").alias("failed_unknown"),
        )
    )
