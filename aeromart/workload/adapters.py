"""The benchmark tables seen as sensor data.

Joins carry no broadcast hints: the small tables are broadcast by their size, and a large
customer or supplier table becomes a shuffled join whose skewed partitions AQE splits.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import FACT_SCHEMA
from ..functions import year_month

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark, sf_dir) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", F.col("r_name").alias("queried_city")
    )


def _instant(col: str):
    return F.col(col).cast("timestamp")


def _as_fact(df: DataFrame) -> DataFrame:
    year, month = year_month(F.col("measured_at"))
    full = df.withColumns({"year": year, "month": month})
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA])


def events_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, customer = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    return (
        events.join(customer, events.user_id == customer.c_custkey)
        .join(_places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("at", _instant("ts"))
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    )


def fact_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants within one month; a user is a station, a region is a city."""
    return _as_fact(
        events_with_place(spark, sf_dir).select(
            F.col("user_id").alias("waqi_idx"),
            F.col("at").alias("measured_at"),
            F.col("value").alias("aqi"),
            F.col("event_type").alias("dominant_pollutant"),
            F.col("k").alias("pm25"),
            (F.col("value") / 4).alias("pm10"),
            F.lit(None).alias("co"),
            F.lit(None).alias("no2"),
            F.lit(None).alias("o3"),
            F.lit(None).alias("so2"),
            F.when(F.col("k") > 9, F.col("k")).alias("humidity"),
            (F.col("value") - F.col("k")).alias("temperature"),
            F.lit(None).alias("pressure"),
            F.lit(None).alias("wind"),
            F.when(F.col("event_type") == "view", "kaggle").otherwise("api").alias("source"),
            F.date_format("at", ISO_SECONDS).alias("ingested_at"),
            "queried_city",
        )
    )


def _lineitem_with_place(spark, sf_dir) -> DataFrame:
    lineitem, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey).join(
        _places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )


def fact_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days over several years, with duplicate readings; a supplier is a station."""
    return _as_fact(
        _lineitem_with_place(spark, sf_dir).select(
            F.col("l_suppkey").alias("waqi_idx"),
            _instant("l_shipdate").alias("measured_at"),
            (F.col("l_quantity") * 10).alias("aqi"),
            F.col("l_returnflag").alias("dominant_pollutant"),
            (F.col("l_extendedprice") / 1000).alias("pm25"),
            (F.col("l_discount") * 1000).alias("pm10"),
            F.lit(None).alias("co"),
            F.lit(None).alias("no2"),
            F.lit(None).alias("o3"),
            F.lit(None).alias("so2"),
            F.when(F.col("l_tax") > 0, F.col("l_tax") * 1000).alias("humidity"),
            F.col("l_linenumber").alias("temperature"),
            F.lit(None).alias("pressure"),
            F.lit(None).alias("wind"),
            F.when(F.col("l_linestatus") == "F", "kaggle").otherwise("api").alias("source"),
            F.concat(
                F.date_format(_instant("l_shipdate"), "yyyy-MM-dd'T'"),
                F.lit("0"),
                F.col("l_linenumber"),
                F.lit(":00:00"),
            ).alias("ingested_at"),
            "queried_city",
        )
    )


def hourly_fact_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with hours: three per line number after midnight UTC, so that some local days are the next."""
    fact = fact_from_lineitem(spark, sf_dir)
    hours = F.make_dt_interval(F.lit(0), F.col("temperature").cast("int") * 3)
    return _as_fact(fact.withColumn("measured_at", F.col("measured_at") + hours))


def documents_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One indented API document per supplier, with the folders it belongs to."""
    document = F.concat(
        F.lit('{\n  "status": "ok",\n  "data": {\n    "idx": '),
        F.col("s_suppkey"),
        F.lit(',\n    "aqi": '),
        F.when(F.col("s_acctbal") < 0, '"-"').otherwise(F.col("s_suppkey").cast("string")),
        F.lit(',\n    "dominentpol": "pm25",\n    "city": {\n      "name": "'),
        F.col("s_name"),
        F.lit('"\n    },\n    "time": {\n      "iso": "2024-01-02T03:00:00+07:00"\n    }\n  }\n}'),
    )
    day = (F.col("s_suppkey") % 3 + 1).cast("string")
    return table(spark, sf_dir, "supplier").select(
        document.alias("value"),
        F.concat(F.lit("city-"), F.col("s_nationkey") % 5).alias("queried_city"),
        F.lit("2024").alias("year"),
        F.lit("01").alias("month"),
        F.lpad(day, 2, "0").alias("day"),
    )


def dim_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(
        _places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("s_suppkey").cast("int").alias("waqi_idx"),
        F.col("s_name").alias("station_name"),
        "queried_city",
        (F.col("s_nationkey") + F.lit(0.5)).alias("lat"),
        (F.lit(100.0) + F.col("s_nationkey")).alias("lon"),
        F.concat(F.lit("station/"), F.col("s_suppkey")).alias("url"),
        F.lit("api").alias("source"),
    )


def dim_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("c_custkey").cast("int").alias("waqi_idx"),
        F.col("c_name").alias("station_name"),
        "queried_city",
        (F.col("c_nationkey") + F.lit(0.5)).alias("lat"),
        (F.lit(100.0) + F.col("c_nationkey")).alias("lon"),
        F.concat(F.lit("station/"), F.col("c_custkey")).alias("url"),
        F.lit("api").alias("source"),
    )


def sightings_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension columns as reported with each reading; a station changes its name over time."""
    return _lineitem_with_place(spark, sf_dir).select(
        F.col("l_suppkey").cast("int").alias("waqi_idx"),
        F.concat_ws(" ", "s_name", "l_linestatus").alias("station_name"),
        "queried_city",
        (F.col("s_nationkey") + F.lit(0.5)).alias("lat"),
        (F.lit(100.0) + F.col("l_linenumber")).alias("lon"),
        F.concat(F.lit("station/"), F.col("l_suppkey")).alias("url"),
        F.lit("api").alias("source"),
        _instant("l_shipdate").alias("measured_at"),
    )


def responses_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw API responses: indented JSON with the faults that the real feed shows.

    No answer, errors instead of data, bodies that are not JSON, a missing time, a dash for the AQI of an
    offline station, half a position, and readings that are whole, fractional or absent.
    """
    value, k, kind = F.col("value"), F.col("k"), F.col("event_type")
    geo = F.concat(
        F.col("c_nationkey") + F.lit(0.5),
        F.when(k >= 10, F.concat(F.lit(", "), F.lit(100.0) + F.col("c_nationkey"))).otherwise(""),
    )
    local = F.date_format(F.col("at") + F.expr("INTERVAL 7 HOURS"), ISO_SECONDS)
    document = F.concat(
        F.lit('{\n  "status": "ok",\n  "data": {\n    "idx": '),
        F.col("user_id"),
        F.lit(',\n    "aqi": '),
        F.when(value < 1, '"-"').otherwise(value.cast("string")),
        F.lit(',\n    "dominentpol": "'),
        kind,
        F.lit('",\n    "city": {"name": "'),
        F.col("c_name"),
        F.lit('", "url": "station/'),
        F.col("user_id"),
        F.lit('", "geo": ['),
        geo,
        F.lit("]},\n"),
        F.when(k > 0, F.concat(F.lit('    "time": {"iso": "'), local, F.lit('+07:00"},\n')))
        .otherwise(""),
        F.lit('    "iaqi": {"pm25": {"v": '),
        k,
        F.lit('}, "pm10": {"v": '),
        value / 2,
        F.when(kind != "click", F.concat(F.lit('}, "h": {"v": '), k + 1)).otherwise(""),
        F.lit('}, "p": {"v": "1013"}}\n  }\n}'),
    )
    body = (
        F.when(kind == "error", '{"status": "error", "data": "Unknown station"}')
        .when(value > 250, None)
        .when(value > 150, "<html>busy</html>")
        .otherwise(document)
    )
    # The table is few files, and each event becomes a document: its rows are spread before they grow.
    spread = events_with_place(spark, sf_dir).repartition(4 * spark.sparkContext.defaultParallelism, "event_id")
    return spread.select(
        F.concat(F.lit(" "), F.translate("queried_city", " ", "-"), F.lit(" ,")).alias("city"),
        body.alias("body"),
        F.col("at").alias("ingested_at"),
    )


CSV_NAMES = {
    "1-URGENT": "Trạm Hà Nội",
    "2-HIGH": "Ho Chi Minh US Consulate",
    "3-MEDIUM": "Đà Nẵng park",
    "4-NOT SPECIFIED": "Gia Lai and Da Nang",
    "5-LOW": "hanoi lower case",
}


def csv_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21 dirty text columns of the historical CSV; a customer is a station."""
    price, status, priority = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
    name = F.create_map(*[F.lit(x) for pair in CSV_NAMES.items() for x in pair])[priority]
    at, rest = _instant("o_orderdate"), F.col("o_orderkey") % 13
    text = {
        # Ids that are no whole number in range: their rows are to be dropped, not merged.
        "Station ID": F.when(rest == 0, F.concat(F.lit("A"), F.col("o_custkey")))
        .when(rest == 1, F.concat(F.col("o_custkey"), F.lit(".0")))
        .when(rest == 2, (F.col("o_custkey") + F.lit(3_000_000_000)).cast("string"))
        .otherwise(F.col("o_custkey").cast("string")),
        "AQI index": F.when(price > 400000, "-").otherwise((price / 1000).cast("string")),
        "Location": F.when(
            priority == "2-HIGH", (F.length(name) + F.lit(0.5)).cast("string")
        ).otherwise(F.concat((F.length(name) + F.lit(0.5)).cast("string"), F.lit(", 105.8"))),
        "Station Name": F.when(price >= 5000, name),
        "Url": F.concat(F.lit("station/"), F.col("o_custkey")),
        "Dominent pollutant": F.when(status == "P", "#NAME?")
        .when(price < 20000, "aqi")
        .otherwise(F.lower(status)),
        "Co": F.lit("N/A"),
        "Dew": F.lit("12.5"),
        "Humidity": F.when(status == "F", "-").otherwise(F.length(name).cast("string")),
        "No2": F.lit(""),
        "O3": price / 2000,
        "Pressure": F.format_number(price, 2),
        "Pm10": price / 3000,
        "PM2.5": price / 4000,
        "So2": F.lit(None),
        "Temperature": F.length(priority),
        "Wind": F.lit("#NAME?"),
        "Data Time S": F.date_format(at, "yyyy-MM-dd HH:mm:ss"),
        "Data Time Tz": F.when(price < 450000, "+07:00"),
        "Status": F.lit("active"),
        "Alert_level": F.lit("none"),
    }
    return table(spark, sf_dir, "orders").select(
        *[c.cast("string").alias(n) for n, c in text.items()]
    )
