"""SQL for DuckDB that answers the registered queries independently of the operators.

A mean is rounded through DECIMAL(38,8), so that half a cent does not depend on the order of
summation. Instants are read as UTC.
"""

MEASURES = ("pm25", "pm10", "humidity", "temperature")

FACT_COLUMNS = (
    "waqi_idx, measured_at, aqi, dominant_pollutant, pm25, pm10, co, no2, o3, so2, humidity, "
    "temperature, pressure, wind, source, ingested_at, queried_city, year, month"
)

PLACES = """
places AS (
  SELECT n_nationkey, r_name AS queried_city
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

EVENTS = (
    PLACES
    + """,
placed AS (
  SELECT e.event_id, e.ts AS arrived, e.user_id, e.event_type, e.value,
         CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS k,
         c_name, c_nationkey, queried_city
  FROM events e JOIN customer ON e.user_id = c_custkey
  JOIN places ON c_nationkey = n_nationkey
)"""
)

_ABSENT = "CAST(NULL AS DOUBLE)"

EVENTS_FACT = (
    EVENTS
    + f""",
fact AS (
  SELECT CAST(user_id AS INTEGER) AS waqi_idx, arrived AS measured_at, value AS aqi,
         event_type AS dominant_pollutant, CAST(k AS DOUBLE) AS pm25, value / 4 AS pm10,
         {_ABSENT} AS co, {_ABSENT} AS no2, {_ABSENT} AS o3, {_ABSENT} AS so2,
         CASE WHEN k > 9 THEN CAST(k AS DOUBLE) END AS humidity, value - k AS temperature,
         {_ABSENT} AS pressure, {_ABSENT} AS wind,
         CASE WHEN event_type = 'view' THEN 'kaggle' ELSE 'api' END AS source,
         strftime(arrived, '%Y-%m-%dT%H:%M:%S') AS ingested_at, queried_city,
         strftime(arrived, '%Y') AS year, strftime(arrived, '%m') AS month
  FROM placed
)"""
)

SHIPPED = (
    PLACES
    + """,
shipped AS (
  SELECT lineitem.*, supplier.*, queried_city
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN places ON s_nationkey = n_nationkey
)"""
)

LINEITEM_FACT = (
    SHIPPED
    + f""",
fact AS (
  SELECT CAST(l_suppkey AS INTEGER) AS waqi_idx, l_shipdate AS measured_at,
         l_quantity * 10 AS aqi, l_returnflag AS dominant_pollutant,
         l_extendedprice / 1000 AS pm25, l_discount * 1000 AS pm10,
         {_ABSENT} AS co, {_ABSENT} AS no2, {_ABSENT} AS o3, {_ABSENT} AS so2,
         CASE WHEN l_tax > 0 THEN l_tax * 1000 END AS humidity,
         CAST(l_linenumber AS DOUBLE) AS temperature,
         {_ABSENT} AS pressure, {_ABSENT} AS wind,
         CASE WHEN l_linestatus = 'F' THEN 'kaggle' ELSE 'api' END AS source,
         strftime(l_shipdate, '%Y-%m-%dT') || '0' || l_linenumber || ':00:00' AS ingested_at,
         queried_city, strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month
  FROM shipped
)"""
)

_DIM = """
  SELECT CAST({key} AS INTEGER) AS waqi_idx, {name} AS station_name, queried_city,
         {nation} + CAST(0.5 AS DOUBLE) AS lat, CAST(100 AS DOUBLE) + {nation} AS lon,
         'station/' || {key} AS url, 'api' AS source
  FROM {table} JOIN places ON {nation} = n_nationkey"""

SUPPLIER_DIM = (
    "dim AS ("
    + _DIM.format(key="s_suppkey", name="s_name", nation="s_nationkey", table="supplier")
    + ")"
)
CUSTOMER_DIM = (
    "dim AS ("
    + _DIM.format(key="c_custkey", name="c_name", nation="c_nationkey", table="customer")
    + ")"
)


def mean(col: str) -> str:
    return f"CAST(round(CAST(avg({col}) AS DECIMAL(38,8)), 2) AS DOUBLE)"


def band(col: str) -> str:
    return (
        f"CASE WHEN {col} <= 50 THEN 'Good' WHEN {col} <= 100 THEN 'Moderate' "
        f"WHEN {col} <= 150 THEN 'Unhealthy for Sensitive Groups' "
        f"WHEN {col} <= 200 THEN 'Unhealthy' WHEN {col} <= 300 THEN 'Very Unhealthy' "
        "ELSE 'Hazardous' END"
    )


def mode(keys: str, source: str = "fact") -> str:
    return (
        f"SELECT {keys}, dominant_pollutant FROM (SELECT {keys}, dominant_pollutant, "
        f"row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, "
        f"dominant_pollutant ASC NULLS FIRST) AS place FROM {source} "
        f"GROUP BY {keys}, dominant_pollutant) WHERE place = 1"
    )


def metrics(measures=MEASURES) -> str:
    means = ", ".join(f"{mean(m)} AS avg_{m}" for m in measures)
    return f"{mean('aqi')} AS avg_aqi, max(aqi) AS max_aqi, min(aqi) AS min_aqi, {means}"


def _day_counts(level: str = "pollution_level") -> str:
    names = (
        ("Good", "good"),
        ("Moderate", "moderate"),
        ("Unhealthy for Sensitive Groups", "sensitive"),
        ("Unhealthy", "unhealthy"),
        ("Very Unhealthy", "very_unhealthy"),
        ("Hazardous", "hazardous"),
    )
    return ", ".join(f"count(*) FILTER ({level} = '{name}') AS days_{c}" for name, c in names)


def _daily_ctes(zone_hours: int = 0) -> str:
    day = f"CAST(measured_at + INTERVAL {zone_hours} HOUR AS DATE)"
    return f"""
dated AS (SELECT *, {day} AS date FROM fact),
daily_metrics AS (
  SELECT queried_city, date, {metrics()},
         count(DISTINCT waqi_idx) AS station_count, count(*) AS record_count
  FROM dated GROUP BY queried_city, date
),
daily_modes AS ({mode("queried_city, date", "dated")}),
daily AS (
  SELECT m.*, o.dominant_pollutant, {band("max_aqi")} AS pollution_level,
         strftime(m.date, '%Y') AS year, strftime(m.date, '%m') AS month
  FROM daily_metrics m LEFT JOIN daily_modes o
    ON m.queried_city = o.queried_city AND m.date = o.date
)"""


MONTHLY = f"""
monthly AS (
  SELECT queried_city, year, month, {mean("avg_aqi")} AS avg_aqi, max(max_aqi) AS max_aqi,
         min(min_aqi) AS min_aqi, {mean("avg_pm25")} AS avg_pm25, {mean("avg_pm10")} AS avg_pm10,
         CAST(sum(record_count) AS BIGINT) AS record_count, {_day_counts()}
  FROM daily GROUP BY queried_city, year, month
)"""

RANKING = f"""
ranking AS (
  SELECT m.*, o.dominant_pollutant, {band("avg_aqi")} AS pollution_level,
         CAST(dense_rank() OVER (PARTITION BY m.year, m.month
              ORDER BY avg_aqi DESC NULLS LAST) AS INTEGER) AS aqi_rank,
         CAST(dense_rank() OVER (PARTITION BY m.year, m.month
              ORDER BY avg_pm25 DESC NULLS LAST) AS INTEGER) AS pm25_rank
  FROM monthly m LEFT JOIN ({mode("queried_city, year, month")}) o
    ON m.queried_city = o.queried_city AND m.year = o.year AND m.month = o.month
)"""

STATIONS = f"""
joined AS (
  SELECT fact.*, station_name, lat, lon
  FROM fact LEFT JOIN (SELECT waqi_idx, station_name, lat, lon FROM dim) USING (waqi_idx)
),
station_metrics AS (
  SELECT waqi_idx, station_name, queried_city, lat, lon, year, month, {metrics()},
         count(*) AS record_count
  FROM joined GROUP BY waqi_idx, station_name, queried_city, lat, lon, year, month
),
station_months AS (
  SELECT s.*, o.dominant_pollutant
  FROM station_metrics s LEFT JOIN ({mode("waqi_idx, year, month")}) o
    ON s.waqi_idx = o.waqi_idx AND s.year = o.year AND s.month = o.month
)"""

STATION_RANKED = f"""
SELECT *, {band("avg_aqi")} AS pollution_level,
       CAST(dense_rank() OVER (PARTITION BY queried_city, year, month
            ORDER BY avg_aqi DESC NULLS LAST) AS INTEGER) AS rank_in_city
FROM station_months"""


def _first(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}) AS place FROM {source}) WHERE place = 1"
    )


def _others(columns: str, taken) -> str:
    names = [c.strip() for c in columns.split(",")]
    return ", ".join(f"{c} ASC NULLS FIRST" for c in names if c not in taken)


DEDUP_FACT = _first(
    "fact",
    "waqi_idx, measured_at",
    "ingested_at DESC NULLS LAST, "
    + _others(FACT_COLUMNS, ("waqi_idx", "measured_at", "ingested_at")),
)

# --- Raw responses ------------------------------------------------------------

STAMP = "2024-01-31T00:00:00+00:00"

RESPONSES = (
    EVENTS
    + """,
responses AS (
  SELECT *, lower(replace(queried_city, ' ', '-')) AS city,
         CASE WHEN event_type <> 'error' AND value > 250 THEN 'network'
              WHEN event_type = 'error' OR value > 150 THEN 'api_status'
              WHEN k = 0 THEN 'unknown' ELSE 'success' END AS outcome
  FROM placed
)"""
)

FLAT_COLUMNS = (
    "waqi_idx, station_name, url, lat, lon, queried_city, measured_at, aqi, dominant_pollutant, "
    "pm25, pm10, co, no2, o3, so2, humidity, temperature, pressure, wind, source, ingested_at"
)

FLAT = (
    RESPONSES
    + f""",
flat AS (
  SELECT CAST(user_id AS INTEGER) AS waqi_idx, c_name AS station_name,
         'station/' || user_id AS url, c_nationkey + CAST(0.5 AS DOUBLE) AS lat,
         CASE WHEN k >= 10 THEN CAST(100 AS DOUBLE) + c_nationkey END AS lon,
         city AS queried_city,
         CASE WHEN k > 0 THEN date_trunc('second', arrived) END AS measured_at,
         CASE WHEN value >= 1 THEN value END AS aqi, event_type AS dominant_pollutant,
         CAST(k AS DOUBLE) AS pm25, value / 2 AS pm10,
         {_ABSENT} AS co, {_ABSENT} AS no2, {_ABSENT} AS o3, {_ABSENT} AS so2,
         CASE WHEN event_type <> 'click' THEN CAST(k + 1 AS DOUBLE) END AS humidity,
         {_ABSENT} AS temperature, CAST(1013 AS DOUBLE) AS pressure, {_ABSENT} AS wind,
         'api' AS source, '{STAMP}' AS ingested_at, arrived, outcome
  FROM responses WHERE outcome NOT IN ('network', 'api_status')
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, city, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL, NULL, NULL, 'api', '{STAMP}', arrived, outcome
  FROM responses WHERE outcome IN ('network', 'api_status')
)"""
)

# as_of 2024-01-31 less 480 hours.
FRESH = """
fresh AS (
  SELECT * FROM flat
  WHERE measured_at >= TIMESTAMP '2024-01-11' AND aqi IS NOT NULL
    AND dominant_pollutant IS NOT NULL
)"""

_READING_ORDER = "ingested_at DESC NULLS LAST, " + _others(
    FLAT_COLUMNS, ("waqi_idx", "measured_at", "ingested_at")
)
_DIM_COLUMNS = "waqi_idx, station_name, queried_city, lat, lon, url, source"
_DIM_ORDER = "seen DESC NULLS LAST, " + _others(_DIM_COLUMNS, ("waqi_idx",))


def _latest_dim(source: str) -> str:
    grouped = (
        f"(SELECT {_DIM_COLUMNS}, max(measured_at) AS seen FROM {source} GROUP BY {_DIM_COLUMNS})"
    )
    return f"SELECT {_DIM_COLUMNS} FROM ({_first(grouped, 'waqi_idx', _DIM_ORDER)})"


_FACT_SELECT = FACT_COLUMNS.replace(
    "year, month", "strftime(measured_at, '%Y') AS year, strftime(measured_at, '%m') AS month"
)

READINGS = f"""
readings AS (
  {_first("fresh", "waqi_idx, measured_at", _READING_ORDER)}
)"""

READINGS_BY_HALF = f"""
early AS ({_first(
    "(SELECT * FROM fresh WHERE arrived < TIMESTAMP '2024-01-16')",
    "waqi_idx, measured_at",
    _READING_ORDER,
)}),
early_dim AS ({_latest_dim("early")}),
all_dim AS ({_latest_dim("readings")})"""

# --- Historical CSV -----------------------------------------------------------

CSV_COLUMNS = (
    "waqi_idx, queried_city, station_name, url, lat, lon, measured_at, aqi, dominant_pollutant, "
    "pm25, pm10, co, no2, o3, so2, humidity, temperature, pressure, wind, source, ingested_at"
)

CSV_CLEAN = f"""
named AS (
  SELECT *, CASE o_orderpriority
      WHEN '1-URGENT' THEN 'Trạm Hà Nội' WHEN '2-HIGH' THEN 'Ho Chi Minh US Consulate'
      WHEN '3-MEDIUM' THEN 'Đà Nẵng park' WHEN '4-NOT SPECIFIED' THEN 'Gia Lai and Da Nang'
      END AS station_name,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN 'ha-noi' WHEN '2-HIGH' THEN 'ho-chi-minh-city'
      WHEN '3-MEDIUM' THEN 'da-nang' WHEN '4-NOT SPECIFIED' THEN 'da-nang' END AS queried_city
  FROM orders WHERE o_totalprice >= 5000 AND o_orderkey % 13 > 2
),
clean AS (
  SELECT CAST(o_custkey AS INTEGER) AS waqi_idx, queried_city, station_name,
         'station/' || o_custkey AS url,
         length(station_name) + CAST(0.5 AS DOUBLE) AS lat,
         CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(105.8 AS DOUBLE) END AS lon,
         CASE WHEN o_totalprice < 450000 THEN o_orderdate - INTERVAL 7 HOUR END AS measured_at,
         CASE WHEN o_totalprice <= 400000 THEN o_totalprice / 1000 END AS aqi,
         CASE WHEN o_orderstatus <> 'P' AND o_totalprice >= 20000
              THEN lower(o_orderstatus) END AS dominant_pollutant,
         o_totalprice / 4000 AS pm25, o_totalprice / 3000 AS pm10,
         {_ABSENT} AS co, {_ABSENT} AS no2, o_totalprice / 2000 AS o3, {_ABSENT} AS so2,
         CASE WHEN o_orderstatus <> 'F'
              THEN CAST(length(station_name) AS DOUBLE) END AS humidity,
         CAST(length(o_orderpriority) AS DOUBLE) AS temperature,
         CAST(round(o_totalprice, 2) AS DOUBLE) AS pressure, {_ABSENT} AS wind,
         'kaggle' AS source, '{STAMP}' AS ingested_at
  FROM named WHERE queried_city IS NOT NULL
)"""

CSV_FACT = f"""
valid AS (
  SELECT * FROM clean
  WHERE measured_at IS NOT NULL AND aqi IS NOT NULL AND dominant_pollutant IS NOT NULL
)
SELECT {_FACT_SELECT} FROM ({_first(
    "valid",
    "waqi_idx, measured_at",
    "ingested_at DESC NULLS LAST, "
    + _others(CSV_COLUMNS, ("waqi_idx", "measured_at", "ingested_at")),
)})"""

# --- Quality ------------------------------------------------------------------


def _listing(items: str) -> str:
    return f"'[' || array_to_string(list_transform({items}, lambda x: '''' || x || ''''), ', ') || ']'"


def _report_row(check, table, column, value, threshold, passed, message) -> str:
    column = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", {column} AS \"column\", "
        f"CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold, "
        f"{passed} AS passed, {message} AS message"
    )


_EXPECTED = "['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST']"


def _coverage(check, table, source, present, absent) -> str:
    missing = (
        f"(SELECT list_sort(list_filter({_EXPECTED}, lambda x: NOT list_contains("
        f"coalesce(list(DISTINCT queried_city), []), x))) FROM {source})"
    )
    return _report_row(
        check,
        table,
        "queried_city",
        f"len({missing})",
        0,
        f"len({missing}) = 0",
        f"CASE WHEN len({missing}) = 0 THEN '{present}' "
        f"ELSE '{absent}' || {_listing(missing)} END",
    )


def _share(condition: str, source: str) -> str:
    return (
        f"(SELECT CASE WHEN count(*) > 0 THEN round(CAST(count(*) FILTER ({condition}) AS DOUBLE)"
        f" / count(*) * 100, 2) ELSE CAST(0 AS DOUBLE) END FROM {source})"
    )


def _fact_report(cutoff: str, source: str = "fact", sampled: str | None = None) -> list[str]:
    rows = f"(SELECT {sampled or 'count(*)'} FROM {source})"
    fresh = f"(SELECT count(*) FROM {source} WHERE ingested_at >= '{cutoff}')"
    outside = f"(SELECT count(*) FROM {source} WHERE aqi < 0 OR aqi > 500)"
    invalid = (
        "(SELECT list_sort(coalesce(list(DISTINCT source) FILTER "
        f"(source NOT IN ('kaggle', 'api')), [])) FROM {source})"
    )
    report = [
        _report_row(
            "row_count", "fact_aqi", None, rows, 10, f"{rows} >= 10",
            f"'fact_aqi row count: ' || {rows} || ' (min: 10)'",
        )
    ]
    for name in ("aqi", "measured_at", "dominant_pollutant", "queried_city"):
        share = _share(f"{name} IS NULL", source)
        report.append(
            _report_row(
                "null_pct", "fact_aqi", name, share, 5, f"{share} <= 5",
                f"'fact_aqi.{name} null%: ' || {share} || '% (max: 5.0%)'",
            )
        )
    return report + [
        _report_row(
            "aqi_range", "fact_aqi", "aqi", outside, 0, f"{outside} = 0",
            f"'AQI out of range [0-500]: ' || {outside} || ' records'",
        ),
        _coverage(
            "city_coverage", "fact_aqi", source, "All 5 cities present", "Missing cities: "
        ),
        _report_row(
            "source_validity", "fact_aqi", "source", f"len({invalid})", 0, f"len({invalid}) = 0",
            f"CASE WHEN len({invalid}) = 0 THEN 'All sources valid' "
            f"ELSE 'Invalid sources: ' || len({invalid}) END",
        ),
        _report_row(
            "freshness", "fact_aqi", "ingested_at", fresh, 1, f"{fresh} > 0",
            f"CASE WHEN {fresh} > 0 THEN {fresh} || ' rows ingested since {cutoff}' "
            f"ELSE 'No fresh data since {cutoff} (48h window)' END",
        ),
    ]


def _dim_report(source: str = "dim") -> list[str]:
    stations = f"(SELECT count(*) FROM {source})"
    return [
        _report_row(
            "dim_station_row_count", "dim_station", None, stations, 1, f"{stations} > 0",
            f"'dim_station: ' || {stations} || ' stations'",
        ),
        _coverage(
            "dim_station_city_coverage", "dim_station", source,
            "All 5 cities have stations", "Stations missing for cities: ",
        ),
    ]


def _with(*parts: str) -> str:
    *ctes, query = parts
    return "WITH " + ", ".join(ctes) + "\n" + query


def _union(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


JANUARY = "2024-01-29T00:00:00"

DAMAGED = """
damaged AS (
  SELECT * REPLACE (
    CASE WHEN dominant_pollutant <> 'error'
         THEN CASE WHEN aqi < 1 THEN -aqi ELSE aqi * 2 END END AS aqi,
    CASE WHEN dominant_pollutant = 'signup' THEN ''
         WHEN dominant_pollutant = 'click' THEN 'null'
         WHEN dominant_pollutant = 'purchase' THEN 'a,b'
         WHEN dominant_pollutant <> 'view' THEN source END AS source,
    replace(queried_city, 'ASIA', 'OCEANIA') AS queried_city)
  FROM fact
)"""

ORACLES = {
    "daily_summary": _with(EVENTS_FACT, _daily_ctes(), "SELECT * FROM daily"),
    "daily_summary_long": _with(LINEITEM_FACT, _daily_ctes(), "SELECT * FROM daily"),
    "daily_summary_local_days": _with(EVENTS_FACT, _daily_ctes(7), "SELECT * FROM daily"),
    "city_ranking": _with(
        LINEITEM_FACT, _daily_ctes(), MONTHLY, RANKING, "SELECT * FROM ranking"
    ),
    "station_summary": _with(LINEITEM_FACT, SUPPLIER_DIM, STATIONS, STATION_RANKED),
    "daily_metrics": _with(LINEITEM_FACT, _daily_ctes(), "SELECT * FROM daily_metrics"),
    "monthly_from_daily": _with(
        LINEITEM_FACT, _daily_ctes(), MONTHLY, "SELECT * FROM monthly"
    ),
    "station_monthly": _with(
        EVENTS_FACT, CUSTOMER_DIM, STATIONS, "SELECT * FROM station_months"
    ),
    "mode_daily": _with(LINEITEM_FACT, _daily_ctes(), "SELECT * FROM daily_modes"),
    "mode_monthly": _with(LINEITEM_FACT, mode("queried_city, year, month")),
    "mode_station": _with(LINEITEM_FACT, mode("waqi_idx, year, month")),
    "attach_mode": _with(
        EVENTS_FACT,
        _daily_ctes(),
        "SELECT queried_city, date, record_count, dominant_pollutant FROM daily",
    ),
    "enrich_with_dim": _with(
        LINEITEM_FACT,
        SUPPLIER_DIM,
        "SELECT waqi_idx, measured_at, aqi, dominant_pollutant, station_name, lat, lon FROM fact "
        "LEFT JOIN (SELECT dim.* FROM dim JOIN supplier ON waqi_idx = s_suppkey "
        "WHERE s_acctbal >= 0) USING (waqi_idx)",
    ),
    "rank_cities": f"""
WITH monthly AS (
  SELECT c_mktsegment AS queried_city, strftime(o_orderdate, '%Y') AS year,
         strftime(o_orderdate, '%m') AS month,
         CAST(floor({mean("o_totalprice")} / 10000) AS BIGINT) AS avg_aqi,
         max(o_totalprice) FILTER (o_orderstatus <> 'F') AS avg_pm25
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
)
SELECT *, CAST(dense_rank() OVER (PARTITION BY year, month
              ORDER BY avg_aqi DESC NULLS LAST) AS INTEGER) AS aqi_rank,
          CAST(dense_rank() OVER (PARTITION BY year, month
              ORDER BY avg_pm25 DESC NULLS LAST) AS INTEGER) AS pm25_rank
FROM monthly""",
    "rank_in_city": """
WITH placed AS (
  SELECT o_orderkey AS waqi_idx, CAST(c_nationkey AS VARCHAR) AS queried_city,
         strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
         CASE WHEN o_orderstatus <> 'P'
              THEN CAST(floor(o_totalprice / 1000) AS BIGINT) END AS avg_aqi
  FROM orders JOIN customer ON o_custkey = c_custkey
)
SELECT *, CAST(dense_rank() OVER (PARTITION BY queried_city, year, month
              ORDER BY avg_aqi DESC NULLS LAST) AS INTEGER) AS rank_in_city
FROM placed""",
    "aqi_band_hist": _with(
        EVENTS_FACT,
        f"SELECT queried_city, {band('aqi')} AS pollution_level, count(*) AS readings "
        "FROM fact GROUP BY ALL",
    ),
    "day_counts_by_band": _with(
        EVENTS_FACT,
        f"levels AS (SELECT waqi_idx, CAST(measured_at AS DATE) AS date, "
        f"{band('max(aqi)')} AS pollution_level FROM fact GROUP BY 1, 2)",
        f"SELECT waqi_idx, {_day_counts()} FROM levels GROUP BY waqi_idx",
    ),
    "dedup_latest": _with(LINEITEM_FACT, DEDUP_FACT),
    "distinct_by": _first(
        "orders",
        "o_custkey",
        "o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS FIRST",
    ),
    "latest_dim": _with(
        SHIPPED,
        """sightings AS (
  SELECT CAST(l_suppkey AS INTEGER) AS waqi_idx, s_name || ' ' || l_linestatus AS station_name,
         queried_city, s_nationkey + CAST(0.5 AS DOUBLE) AS lat,
         CAST(100 AS DOUBLE) + l_linenumber AS lon, 'station/' || l_suppkey AS url,
         'api' AS source, l_shipdate AS measured_at
  FROM shipped)""",
        _latest_dim("sightings"),
    ),
    "drop_stale": _with(
        EVENTS_FACT,
        "SELECT waqi_idx, measured_at, aqi FROM fact "
        "WHERE measured_at >= TIMESTAMP '2024-01-17 12:00:00'",
    ),
    "require_not_null": _with(
        EVENTS_FACT,
        "SELECT waqi_idx, measured_at, aqi, dominant_pollutant FROM fact "
        "WHERE aqi <= 100 AND dominant_pollutant <> 'error'",
    ),
    "new_only": _with(
        PLACES,
        CUSTOMER_DIM,
        "SELECT * FROM dim WHERE waqi_idx NOT IN "
        "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    ),
    "flatten_api": _with(FLAT, f"SELECT {FLAT_COLUMNS} FROM flat"),
    "flatten_api_choice": """
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN floor(value) END AS aqi,
       CASE WHEN event_type = 'view' THEN value WHEN value = floor(value) THEN value
            ELSE floor(value * 2) END AS both,
       floor(value) AS single, CAST(NULL AS DOUBLE) AS absent,
       CASE WHEN event_type <> 'click' THEN value END AS text
FROM events""",
    "ok_responses": _with(
        RESPONSES,
        "SELECT city AS queried_city, CAST(user_id AS INTEGER) AS idx, FALSE AS no_aqi "
        "FROM responses WHERE outcome NOT IN ('network', 'api_status')",
    ),
    "api_to_silver_fact": _with(
        FLAT, FRESH, READINGS, f"SELECT {_FACT_SELECT} FROM readings"
    ),
    "api_to_silver_dim": _with(FLAT, FRESH, READINGS, _latest_dim("readings")),
    "clean_csv_rows": _with(CSV_CLEAN, f"SELECT {CSV_COLUMNS} FROM clean"),
    "csv_to_silver_fact": "WITH " + CSV_CLEAN + "," + CSV_FACT,
    "csv_to_silver_dim": _with(CSV_CLEAN, _latest_dim("clean")),
    "classify_keyword": """
SELECT * FROM (
  SELECT p_partkey, p_name,
         CASE WHEN p_name LIKE '%bolt%' OR p_name LIKE '%gear%' THEN 'metal'
              WHEN p_name LIKE '%red%' OR p_name LIKE '%hot%' THEN 'warm'
              WHEN p_name LIKE '%small%' THEN 'little' END AS label
  FROM part) WHERE label IS NOT NULL""",
    "split_location": """
SELECT s_suppkey, s_acctbal AS lat,
       CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS DOUBLE) END AS lon FROM supplier""",
    "clean_values": """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '5-LOW' THEN NULL
            WHEN o_orderpriority = '2-HIGH' THEN ' -' ELSE o_orderpriority END AS text,
       CASE WHEN o_orderstatus NOT IN ('O', 'P') THEN 'pm10' END AS pollutant,
       CAST(round(o_totalprice, 2) AS DOUBLE) AS pressure,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS DOUBLE) END AS number
FROM orders""",
    "parse_times": """
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'P'
            THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 90 MINUTE END AS iso,
       CASE o_orderstatus WHEN 'O' THEN o_orderdate - INTERVAL 7 HOUR
            WHEN 'F' THEN o_orderdate + INTERVAL 210 MINUTE END AS zoned,
       CAST(o_orderdate AS DATE) AS day,
       CAST(o_orderdate + INTERVAL 27 HOUR AS DATE) AS local_day
FROM orders""",
    "bronze_key": _with(
        EVENTS,
        "cities AS (SELECT event_id, arrived, lower(replace(queried_city, ' ', '-')) AS city "
        "FROM placed UNION ALL SELECT event_id, arrived, 'x' FROM placed)",
        "SELECT event_id, city, 'api_raw/queried_city=' || city || "
        "strftime(arrived, '/year=%Y/month=%m/day=%d/') || city || "
        "strftime(arrived, '_%Y-%m-%dT%H-%M-%SZ.json') AS key, "
        "strftime(arrived, '%Y%m%d_%H%M%S') AS ingestion_id FROM cities",
    ),
    "land_roundtrip": _with(
        FLAT,
        f"SELECT {FLAT_COLUMNS.replace(', source, ingested_at', '')} "
        "FROM flat WHERE outcome = 'success'",
    ),
    "land_folders": _with(
        RESPONSES,
        """
SELECT city AS queried_city, strftime(arrived, '%Y') AS year, strftime(arrived, '%m') AS month,
       strftime(arrived, '%d') AS day, count(*) AS documents, count(*) AS noted,
       min('api_raw/queried_city=' || city || strftime(arrived, '/year=%Y/month=%m/day=%d/') || city
           || strftime(arrived, '_%Y-%m-%dT%H-%M-%SZ.json')) AS first_key,
       max(strftime(arrived, '%Y%m%d_%H%M%S')) AS last_id, 'waqi_city_endpoint' AS source
FROM responses WHERE outcome = 'success' GROUP BY ALL""",
    ),
    "ingest_outcomes": _with(
        RESPONSES,
        """
SELECT city, arrived AS ingested_at, strftime(arrived, '%Y%m%d_%H%M%S') AS ingestion_id, outcome,
       CASE outcome WHEN 'success' THEN CAST(user_id AS VARCHAR) END AS idx,
       CASE outcome WHEN 'success' THEN CASE WHEN value < 1 THEN '-'
            WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
            ELSE CAST(value AS VARCHAR) END END AS aqi,
       CASE outcome WHEN 'success'
            THEN strftime(arrived + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S+07:00') END AS measured_at,
       CASE outcome WHEN 'success' THEN 'api_raw/queried_city=' || city ||
            strftime(arrived, '/year=%Y/month=%m/day=%d/') || city ||
            strftime(arrived, '_%Y-%m-%dT%H-%M-%SZ.json') END AS s3_key,
       CASE outcome WHEN 'api_status' THEN
            CASE WHEN event_type = 'error' THEN 'status: error' ELSE 'status: none' END
            WHEN 'network' THEN 'no answer' WHEN 'unknown' THEN 'no data.time' END AS error
FROM responses""",
    ),
    "ingest_summary": _with(
        RESPONSES,
        """
SELECT strftime(date_trunc('hour', arrived), '%Y%m%d_%H%M%S') AS ingestion_id, count(*) AS cities,
       count(*) FILTER (outcome = 'success') AS success,
       count(*) FILTER (outcome <> 'success') AS failed,
       count(*) FILTER (outcome = 'network') AS failed_network,
       count(*) FILTER (outcome = 'api_status') AS failed_api_status,
       count(*) FILTER (outcome = 'unknown') AS failed_unknown
FROM responses GROUP BY 1""",
    ),
    "incremental_fact": _with(
        FLAT, FRESH, READINGS, f"SELECT {_FACT_SELECT} FROM readings"
    ),
    "incremental_dim": _with(
        FLAT,
        FRESH,
        READINGS,
        READINGS_BY_HALF,
        "SELECT * FROM early_dim UNION ALL SELECT * FROM all_dim "
        "WHERE waqi_idx NOT IN (SELECT waqi_idx FROM early_dim)",
    ),
    "incremental_runs": _with(
        FLAT,
        FRESH,
        READINGS,
        READINGS_BY_HALF,
        "landed AS (SELECT * FROM flat WHERE outcome = 'success')",
        """
SELECT CAST(1 AS INTEGER) AS run, 'LOADED' AS status,
       (SELECT count(*) FROM landed WHERE arrived < TIMESTAMP '2024-01-16') AS raw_rows,
       (SELECT count(*) FROM fresh WHERE arrived < TIMESTAMP '2024-01-16') AS fresh_rows,
       (SELECT count(*) FROM early_dim) AS new_stations,
       (SELECT count(*) FROM early) AS new_rows
UNION ALL
SELECT 2, 'LOADED', (SELECT count(*) FROM landed), (SELECT count(*) FROM fresh),
       (SELECT count(*) FROM all_dim) - (SELECT count(*) FROM early_dim),
       (SELECT count(*) FROM readings) - (SELECT count(*) FROM early)
UNION ALL SELECT 3, 'SKIPPED', 0, 0, 0, 0
UNION ALL
SELECT 4, 'SKIPPED', (SELECT count(*) FROM landed WHERE arrived < TIMESTAMP '2024-01-16'), 0, 0, 0""",
    ),
    "csv_load_once": "WITH " + CSV_CLEAN + "," + CSV_FACT,
    "write_read_daily": "",
    "write_read_ranking": "",
    "write_read_station": "",
    "dq_report": _with(
        EVENTS_FACT, CUSTOMER_DIM, _union(_fact_report(JANUARY) + _dim_report())
    ),
    "dq_report_failing": _with(
        EVENTS_FACT,
        DAMAGED,
        CUSTOMER_DIM,
        "known AS (SELECT * FROM dim WHERE queried_city <> 'EUROPE')",
        _union(_fact_report("2024-02-28T00:00:00", "damaged") + _dim_report("known")),
    ),
    "dq_report_missing_dim": _with(
        EVENTS_FACT,
        _union(
            _fact_report(JANUARY)
            + [
                _report_row(
                    "dim_station_query", "dim_station", None, "NULL", "NULL", "FALSE",
                    "'dim_station could not be read'",
                )
            ]
        ),
    ),
    "dq_report_sampled": _with(
        EVENTS_FACT,
        "report AS (" + _union(_fact_report(JANUARY, sampled="least(count(*), 500)")) + ")",
        "SELECT * FROM report WHERE \"check\" <> 'city_coverage'",
    ),
    "dq_summary": _with(
        EVENTS_FACT,
        DAMAGED,
        CUSTOMER_DIM,
        "report AS (" + _union(_fact_report(JANUARY, "damaged") + _dim_report()) + ")",
        "SELECT bool_and(passed) AS quality_passed, count(*) FILTER (passed) AS checks_passed, "
        "count(*) AS checks_total FROM report",
    ),
    "missing_values": """
SELECT event_type FROM (VALUES ('click'), ('scroll'), ('signup'), ('refund')) AS t(event_type)
WHERE event_type NOT IN (SELECT event_type FROM events)""",
    "sample_size": "SELECT least(count(*), 1000) AS rows FROM lineitem",
    "distinct_text": _with(
        EVENTS_FACT,
        "SELECT dominant_pollutant, array_to_string(list_sort(list(DISTINCT queried_city)), ',') "
        "AS cities, count(DISTINCT waqi_idx) AS stations, "
        "round(CAST(count(*) FILTER (aqi > 50) AS DOUBLE) / count(*) * 100, 2) AS share "
        "FROM fact GROUP BY 1",
    ),
    "gated_refresh": _with(
        FLAT,
        FRESH,
        READINGS,
        f"stations AS ({_latest_dim('readings')})",
        """counts AS (
  SELECT (SELECT count(*) FROM flat WHERE outcome = 'success') AS raw_rows,
         (SELECT count(*) FROM fresh) AS fresh_rows,
         (SELECT count(*) FROM stations) AS new_stations,
         (SELECT count(*) FROM readings) AS new_rows)""",
        """
SELECT 'all cities' AS run, 'LOADED' AS load_status, counts.*, TRUE AS quality_passed,
       CAST(11 AS BIGINT) AS checks_passed, CAST(11 AS BIGINT) AS checks_total,
       'gold refreshed' AS outcome,
       (SELECT count(DISTINCT (queried_city, CAST(measured_at AS DATE))) FROM readings)
         AS daily_rows,
       (SELECT count(DISTINCT (queried_city, date_trunc('month', measured_at))) FROM readings)
         AS ranking_rows,
       (SELECT count(DISTINCT (waqi_idx, queried_city, date_trunc('month', measured_at)))
        FROM readings) AS station_rows
FROM counts
UNION ALL
SELECT 'one more city', 'LOADED', counts.*, FALSE, 9, 11, 'stopped: checks failed', 0, 0, 0
FROM counts""",
    ),
}

_STORED = LINEITEM_FACT.replace("fact AS (", "every AS (", 1) + (
    ", fact AS (" + DEDUP_FACT.replace("FROM fact", "FROM every") + ")"
)
ORACLES["write_read_daily"] = _with(_STORED, _daily_ctes(), "SELECT * FROM daily")
ORACLES["write_read_ranking"] = _with(
    _STORED, _daily_ctes(), MONTHLY, RANKING, "SELECT * FROM ranking"
)
ORACLES["write_read_station"] = _with(_STORED, SUPPLIER_DIM, STATIONS, STATION_RANKED)

_HELD = (
    "held AS (SELECT * REPLACE ('kaggle' AS source) FROM dim WHERE waqi_idx IN "
    "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))"
)
ORACLES["union_rows"] = ORACLES["insert_new"] = _with(
    PLACES,
    CUSTOMER_DIM,
    _HELD,
    "SELECT * FROM held UNION ALL SELECT * FROM dim "
    "WHERE waqi_idx NOT IN (SELECT waqi_idx FROM held)",
)

ORACLES["refresh_backfill"] = ORACLES["write_read_daily"]
ORACLES["refresh_backfill_ranking"] = ORACLES["write_read_ranking"]
ORACLES["refresh_backfill_station"] = ORACLES["write_read_station"]
for _suffix, _stored in (("", "daily"), ("_ranking", "ranking"), ("_station", "station")):
    ORACLES["refresh_after_crash" + _suffix] = ORACLES["write_read_" + _stored]
    ORACLES["refresh_from_states" + _suffix] = ORACLES["write_read_" + _stored]
_LOADED = "loaded AS (" + DEDUP_FACT + ")"
ORACLES["dq_report_merged"] = _with(
    EVENTS_FACT, _LOADED, CUSTOMER_DIM, _union(_fact_report(JANUARY, "loaded") + _dim_report())
)
ORACLES["dq_report_merged_failing"] = _with(
    EVENTS_FACT,
    DAMAGED,
    _LOADED.replace("FROM fact", "FROM damaged"),
    CUSTOMER_DIM,
    "known AS (SELECT * FROM dim WHERE queried_city <> 'EUROPE')",
    _union(_fact_report("2024-01-28T12:34:56", "loaded") + _dim_report("known")),
)
ORACLES["flatten_variant"] = ORACLES["flatten_api"]
ORACLES["flatten_variant_choice"] = ORACLES["flatten_api_choice"]
ORACLES["insert_bucketed"] = ORACLES["dedup_latest"]
ORACLES["sample_seeded"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE CAST('0x' || substr(md5('7|' || o_orderkey), 1, 8) AS BIGINT) < 429496729"""
ORACLES["approx_stations"] = _with(
    LINEITEM_FACT,
    "SELECT queried_city, year, month, count(DISTINCT waqi_idx) AS stations, TRUE AS close FROM fact GROUP BY ALL",
)
_SUPPLIER_DOCUMENT = """
documents AS (
  SELECT s_suppkey AS key, s_acctbal >= 0 AS valid,
         CASE s_suppkey % 5
           WHEN 1 THEN substr('{ "status": "ok", "data": { "idx": ' || s_suppkey || ', "aqi": ', 1, 40)
           WHEN 2 THEN '<html>busy ' || s_suppkey || '</html>' END AS document
  FROM supplier
)"""
ORACLES["bronze_quarantine"] = _with(
    _SUPPLIER_DOCUMENT,
    "SELECT document, CAST(count(*) AS BIGINT) AS copies, '2024-01-02T00:00:00+00:00' AS noted_at "
    "FROM documents WHERE document IS NOT NULL GROUP BY document",
)
ORACLES["bronze_quarantine_runs"] = _with(
    _SUPPLIER_DOCUMENT,
    """SELECT 'LOADED' AS status, count(*) AS raw_rows, count(*) FILTER (document IS NULL AND valid) AS fresh_rows,
  count(*) FILTER (document IS NULL AND valid) AS new_stations, count(*) FILTER (document IS NULL AND valid) AS new_rows,
  CAST(0 AS BIGINT) AS dropped_rows, count(document) AS unreadable_rows FROM documents""",
)
ORACLES["unexpected_values"] = _with(
    EVENTS_FACT,
    DAMAGED,
    "SELECT DISTINCT source FROM damaged WHERE source NOT IN ('kaggle', 'api')",
)
ORACLES["read_csv_headers"] = ORACLES["clean_csv_rows"]
_HOURLY = LINEITEM_FACT.replace("fact AS (", "dated_fact AS (", 1) + """,
moved AS (SELECT * REPLACE (measured_at + CAST(temperature * 3 AS INTEGER) * INTERVAL 1 HOUR AS measured_at) FROM dated_fact),
fact AS (SELECT * REPLACE (strftime(measured_at + INTERVAL 7 HOUR, '%Y') AS year,
                           strftime(measured_at + INTERVAL 7 HOUR, '%m') AS month) FROM moved)"""
ORACLES["city_ranking_local_days"] = _with(
    _HOURLY, _daily_ctes(7), MONTHLY, RANKING, "SELECT * FROM ranking"
)
ORACLES["read_indented_bronze"] = f"""
SELECT CAST(s_suppkey AS INTEGER) AS waqi_idx, s_name AS station_name, CAST(NULL AS VARCHAR) AS url,
       {_ABSENT} AS lat, {_ABSENT} AS lon, 'city-' || (s_nationkey % 5) AS queried_city,
       TIMESTAMP '2024-01-01 20:00:00' AS measured_at,
       CASE WHEN s_acctbal >= 0 THEN CAST(s_suppkey AS DOUBLE) END AS aqi,
       'pm25' AS dominant_pollutant, {_ABSENT} AS pm25, {_ABSENT} AS pm10, {_ABSENT} AS co,
       {_ABSENT} AS no2, {_ABSENT} AS o3, {_ABSENT} AS so2, {_ABSENT} AS humidity,
       {_ABSENT} AS temperature, {_ABSENT} AS pressure, {_ABSENT} AS wind
FROM supplier"""
ORACLES["tables_registered"] = _with(
    FLAT,
    FRESH,
    READINGS,
    f"stations AS ({_latest_dim('readings')})",
    """
SELECT 'fact' AS name, (SELECT count(*) FROM readings) AS rows
UNION ALL SELECT 'dim', (SELECT count(*) FROM stations)
UNION ALL SELECT 'daily',
  (SELECT count(DISTINCT (queried_city, CAST(measured_at AS DATE))) FROM readings)
UNION ALL SELECT 'ranking',
  (SELECT count(DISTINCT (queried_city, date_trunc('month', measured_at))) FROM readings)
UNION ALL SELECT 'station',
  (SELECT count(DISTINCT (waqi_idx, queried_city, date_trunc('month', measured_at))) FROM readings)""",
)
