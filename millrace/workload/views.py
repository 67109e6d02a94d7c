"""The source tables of the registered queries, as Spark frames and as SQL views.

The test tables are clean, so faults are put in by the same arithmetic on their
keys in both dialects. Each ``*_SQL`` text is the body of a common table expression.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.contracts import API_RESPONSE_TEXTS
from millrace.session import materialize
from millrace.sources.tables import explode_results

# Parameters of the detection queries.
WIDTH = "3 hours"
BASELINE_END = datetime(2024, 1, 22)
INCIDENT_END = datetime(2024, 1, 23)
INCIDENT_PATH = "/p2"
MULTIPLIER = 30
QUANTILE = 0.95
CHURN_DATE = "2000-07-08"
PAGE_SIZE = 40

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- web logs --------------------------------------------------------------


def web_logs(spark: SparkSession, sf: str) -> DataFrame:
    return logs_from_events(table(spark, sf, "events"))


def logs_from_events(events: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    error = F.col("event_type") == "error"
    return events.withColumn("k", k).select(
        "event_id",
        F.concat(
            F.lit("10.0."), F.expr("user_id div 256").cast("string"), F.lit("."), (F.col("user_id") % 256).cast("string")
        ).alias("ip"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        F.concat(F.lit("/p"), (F.col("k") % 10).cast("string")).alias("path"),
        F.when(error & (F.col("k") % 2 == 1), 503)
        .when(error, 500)
        .when(F.col("k") % 10 == 7, 404)
        .otherwise(200)
        .cast("bigint")
        .alias("status"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("bytes"),
        F.concat(F.lit("agent/"), (F.col("k") % 5).cast("string")).alias("user_agent"),
    )


WEB_LOGS_SQL = r"""
    SELECT event_id,
        '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
        ts AS timestamp,
        CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
        '/p' || CAST(k % 10 AS VARCHAR) AS path,
        CAST(CASE WHEN event_type = 'error' AND k % 2 = 1 THEN 503 WHEN event_type = 'error' THEN 500
             WHEN k % 10 = 7 THEN 404 ELSE 200 END AS BIGINT) AS status,
        CAST(floor(value * 1000) AS BIGINT) AS bytes,
        'agent/' || CAST(k % 5 AS VARCHAR) AS user_agent
    FROM (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events)
"""


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def raw_logs(spark: SparkSession, sf: str) -> DataFrame:
    return raw_from_logs(web_logs(spark, sf))


def raw_from_logs(logs: DataFrame) -> DataFrame:
    """Log rows as texts, some of them broken; ``event_id`` is the position."""
    e = "event_id"
    return logs.select(
        e,
        F.when(_every(e, 97), "999.1.1.1").when(_every(e, 101), "2001:db8::7").otherwise(F.col("ip")).alias("ip"),
        F.when(_every(e, 89), "not-a-time")
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("timestamp"),
        F.when(_every(e, 83), "PUT").otherwise(F.col("method")).alias("method"),
        F.when(_every(e, 79), F.substring("path", 2, 9))
        .when(_every(e, 73), F.concat(F.lit("  "), "path", F.lit(" ")))
        .when(_every(e, 71), F.repeat(F.col("path"), 100))
        .otherwise(F.col("path"))
        .alias("path"),
        F.when(_every(e, 67), "999")
        .when(_every(e, 61), "abc")
        .when(_every(e, 59), "503.0")
        .otherwise(F.col("status").cast("string"))
        .alias("status"),
        F.when(_every(e, 53), "-1").when(~_every(e, 47), F.col("bytes").cast("string")).alias("bytes"),
        F.when(_every(e, 43), "   ").otherwise(F.col("user_agent")).alias("user_agent"),
    )


RAW_LOGS_SQL = r"""
    SELECT event_id,
        CASE WHEN event_id % 97 = 0 THEN '999.1.1.1' WHEN event_id % 101 = 0 THEN '2001:db8::7' ELSE ip END AS ip,
        CASE WHEN event_id % 89 = 0 THEN 'not-a-time'
             ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%S') END AS timestamp,
        CASE WHEN event_id % 83 = 0 THEN 'PUT' ELSE method END AS method,
        CASE WHEN event_id % 79 = 0 THEN substr(path, 2, 9) WHEN event_id % 73 = 0 THEN '  ' || path || ' '
             WHEN event_id % 71 = 0 THEN repeat(path, 100) ELSE path END AS path,
        CASE WHEN event_id % 67 = 0 THEN '999' WHEN event_id % 61 = 0 THEN 'abc'
             WHEN event_id % 59 = 0 THEN '503.0' ELSE CAST(status AS VARCHAR) END AS status,
        CASE WHEN event_id % 53 = 0 THEN '-1' WHEN event_id % 47 = 0 THEN NULL
             ELSE CAST(bytes AS VARCHAR) END AS bytes,
        CASE WHEN event_id % 43 = 0 THEN '   ' ELSE user_agent END AS user_agent
    FROM web_logs
"""

# One row per error, written out rule by rule.
LOG_ERRORS_SQL = r"""
    SELECT event_id, 'ip' AS loc, 'ip_any_address' AS type FROM raw_logs
     WHERE NOT regexp_full_match(ip, '((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)')
       AND NOT regexp_full_match(ip, '[0-9a-f]+(:[0-9a-f]+)*::[0-9a-f]+')
    UNION ALL
    SELECT event_id, 'timestamp', 'datetime_parsing' FROM raw_logs WHERE TRY_CAST(timestamp AS TIMESTAMP) IS NULL
    UNION ALL
    SELECT event_id, 'method', 'literal_error' FROM raw_logs WHERE method NOT IN ('GET', 'POST')
    UNION ALL
    SELECT event_id, 'path', CASE WHEN length(trim(path)) < 1 THEN 'string_too_short'
           WHEN length(trim(path)) > 200 THEN 'string_too_long' ELSE 'string_pattern_mismatch' END FROM raw_logs
     WHERE length(trim(path)) NOT BETWEEN 1 AND 200 OR trim(path) NOT LIKE '/%'
    UNION ALL
    SELECT event_id, 'status', CASE WHEN TRY_CAST(status AS DOUBLE) IS NULL THEN 'int_parsing'
           WHEN CAST(status AS DOUBLE) < 100 THEN 'greater_than_equal' ELSE 'less_than_equal' END FROM raw_logs
     WHERE TRY_CAST(status AS DOUBLE) IS NULL OR TRY_CAST(status AS DOUBLE) NOT BETWEEN 100 AND 599
    UNION ALL
    SELECT event_id, 'bytes', CASE WHEN bytes IS NULL THEN 'missing' ELSE 'greater_than_equal' END FROM raw_logs
     WHERE bytes IS NULL OR CAST(bytes AS BIGINT) < 0
    UNION ALL
    SELECT event_id, 'user_agent', 'string_too_short' FROM raw_logs WHERE trim(user_agent) = ''
"""

FEATURES_SQL = """
    SELECT time_bucket(INTERVAL '{width}', timestamp) AS timestamp,
        count(*) AS request_count,
        count(*) FILTER (status >= 500) AS error_5xx_count,
        count(*) FILTER (status >= 500) / count(*) AS error_rate_5xx,
        count(DISTINCT ip) AS unique_ips,
        CAST(sum(bytes) AS DOUBLE) / count(*) AS avg_bytes,
        CAST(list_sort(list(bytes))[CAST(floor((count(*) - 1) * CAST(0.95 AS DOUBLE) + 0.5) AS INTEGER) + 1]
             AS DOUBLE) AS p95_bytes,
        count(DISTINCT path) AS path_count
    FROM {logs} GROUP BY 1
"""

INJECTED_SQL = f"""
    SELECT event_id, ip, timestamp, method, path, bytes, user_agent,
        CASE WHEN hit THEN 503 ELSE status END AS status,
        unnest(range(CASE WHEN hit THEN {MULTIPLIER} ELSE 1 END)) AS copy
    FROM (SELECT *, timestamp >= TIMESTAMP '{BASELINE_END}' AND timestamp < TIMESTAMP '{INCIDENT_END}'
                    AND path = '{INCIDENT_PATH}' AS hit FROM web_logs)
"""

DETECTED_SQL = f"""
    SELECT *, error_rate_5xx AS anomaly_score, error_rate_5xx >= (
        SELECT quantile_cont(error_rate_5xx, {QUANTILE}) FROM features
        WHERE timestamp < TIMESTAMP '{BASELINE_END}') AS is_anomaly
    FROM features
"""

INCIDENT_WINDOWS_SQL = f"""
    SELECT *, max(opens) OVER (ORDER BY timestamp) AS incident_start FROM (
        SELECT *, CASE WHEN lag(timestamp) OVER (ORDER BY timestamp) IS NULL
            OR timestamp - lag(timestamp) OVER (ORDER BY timestamp) > INTERVAL '{WIDTH}' THEN timestamp END AS opens
        FROM detected WHERE is_anomaly)
"""


def with_views(body: str, **views: str) -> str:
    named = ",\n".join(f"{name} AS ({text})" for name, text in views.items())
    return f"WITH {named}\n{body}"


def log_sql(body: str) -> str:
    return with_views(body, web_logs=WEB_LOGS_SQL)


def raw_log_sql(body: str) -> str:
    return with_views(body, web_logs=WEB_LOGS_SQL, raw_logs=RAW_LOGS_SQL, log_errors=LOG_ERRORS_SQL)


def detection_sql(body: str) -> str:
    return with_views(
        body,
        web_logs=WEB_LOGS_SQL,
        injected=INJECTED_SQL,
        features=FEATURES_SQL.format(width=WIDTH, logs="injected"),
        detected=DETECTED_SQL,
        incident_windows=INCIDENT_WINDOWS_SQL,
    )


# --- sales -----------------------------------------------------------------


def sales_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Sales with missing and negative prices, missing regions and inflated quantities."""
    region = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name")
    )
    joined = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(region, F.col("o_custkey") == F.col("c_custkey"))
    )
    o, price = "l_orderkey", F.col("l_extendedprice")
    return joined.select(
        F.concat_ws("-", o, "l_linenumber").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(~_every(o, 17), F.col("r_name")).alias("region"),
        F.col("p_type").alias("category"),
        (F.col("l_quantity") * F.when(_every(o, 101), 100).otherwise(1)).cast("bigint").alias("quantity"),
        F.when(~_every(o, 25), F.when(_every(o, 199), -price).otherwise(price)).alias("unit_price"),
        F.col("l_discount").alias("discount"),
    )


def sales_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The same sales as texts, some of which are no number or date."""
    key = F.split("order_id", "-")[0].cast("bigint")

    def broken(n: int, text: str, otherwise: Column) -> Column:
        return F.when(key % n == 0, text).otherwise(otherwise)

    return sales_raw(spark, sf).select(
        "order_id",
        F.when(key % 211 == 0, "invalid")
        .when(key % 229 == 0, F.date_format("order_date", "yyyy-MM-dd'garbage'"))
        .when(key % 233 == 0, F.date_format("order_date", "'\t'yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("order_date", "yyyy-MM-dd"))
        .alias("order_date"),
        "region",
        "category",
        F.when(key % 223 == 0, "invalid")
        .when(key % 239 == 0, F.concat(F.col("quantity").cast("string"), F.lit(".0\t")))
        .when(key % 241 == 0, "2.5")
        .when(key % 251 == 0, "1e3")
        .otherwise(F.col("quantity").cast("string"))
        .alias("quantity"),
        F.when(
            F.col("unit_price").isNotNull(),
            broken(227, "1d", F.col("unit_price").cast("decimal(14,2)").cast("string")),
        ).alias("unit_price"),
        F.col("discount").cast("decimal(5,2)").cast("string").alias("discount"),
    )


def sales_table(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The joined sales, or the named columns of them, stored once: cleaning reads them several times."""
    rows = sales_raw(spark, sf)
    return materialize(rows.select(*columns) if columns else rows, "sales")


SALES_SQL = """
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
        CAST(o_orderdate AS DATE) AS order_date,
        CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE r_name END AS region,
        p_type AS category,
        CAST(l_quantity * CASE WHEN l_orderkey % 101 = 0 THEN 100 ELSE 1 END AS BIGINT) AS quantity,
        CASE WHEN l_orderkey % 25 = 0 THEN NULL WHEN l_orderkey % 199 = 0 THEN -l_extendedprice
             ELSE l_extendedprice END AS unit_price,
        l_discount AS discount
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""
SALES_TEXTS_SQL = """
    SELECT order_id, CASE WHEN k % 211 = 0 THEN 'invalid' WHEN k % 229 = 0 THEN strftime(order_date, '%Y-%m-%dgarbage')
            WHEN k % 233 = 0 THEN strftime(order_date, '%Y-%m-%d %H:%M:%S') ELSE strftime(order_date, '%Y-%m-%d') END
            AS order_date,
        region, category,
        CASE WHEN k % 223 = 0 THEN 'invalid' WHEN k % 239 = 0 THEN CAST(quantity AS VARCHAR) || '.0'
            WHEN k % 241 = 0 THEN '2.5' WHEN k % 251 = 0 THEN '1e3' ELSE CAST(quantity AS VARCHAR) END AS quantity,
        CASE WHEN unit_price IS NULL THEN NULL WHEN k % 227 = 0 THEN '1d'
             ELSE CAST(CAST(unit_price AS DECIMAL(14,2)) AS VARCHAR) END AS unit_price,
        CAST(CAST(discount AS DECIMAL(5,2)) AS VARCHAR) AS discount
    FROM (SELECT *, CAST(split_part(order_id, '-', 1) AS BIGINT) AS k FROM sales_typed)
"""


TYPED_SQL = """
    SELECT order_id, TRY_CAST(TRY_CAST(order_date AS TIMESTAMP) AS DATE) AS order_date, region, category,
        {quantity} AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
        TRY_CAST(discount AS DOUBLE) AS discount
    FROM sales_raw
"""
PRICED_SQL = "SELECT * REPLACE (CASE WHEN unit_price <= 0 THEN NULL ELSE unit_price END AS unit_price) FROM typed"
FILLED_SQL = """
    SELECT p.* REPLACE (coalesce(unit_price, m) AS unit_price)
    FROM priced p LEFT JOIN (SELECT category AS c, median(unit_price) AS m FROM priced GROUP BY 1) ON category = c
"""
BOUNDS_SQL = """
    SELECT {column!r} AS "column", q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
        SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1,
               quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {source})
"""
BOUNDED_SQL = """
    SELECT f.* REPLACE (greatest(CAST(ceil(lower) AS BIGINT), least(CAST(floor(upper) AS BIGINT), quantity)) AS quantity)
    FROM filled f, quantity_bounds
"""
AMOUNT_SQL = """
    CAST(round(CAST(quantity AS DECIMAL(19,2)) * CAST(unit_price AS DECIMAL(14,4))
               * (1 - CAST(discount AS DECIMAL(5,4))), 2) AS DOUBLE)
"""
CLEANED_SQL = f"SELECT *, {AMOUNT_SQL} AS amount FROM bounded"


def sales_sql(body: str, broken: bool = False) -> str:
    return with_views(
        body,
        sales_typed=SALES_SQL,
        sales_raw=SALES_TEXTS_SQL if broken else "SELECT * FROM sales_typed",
        typed=TYPED_SQL.format(quantity="TRY_CAST(quantity AS DOUBLE)" if broken else "quantity"),
        priced=PRICED_SQL,
        filled=FILLED_SQL,
        quantity_bounds=BOUNDS_SQL.format(column="quantity", source="filled"),
        price_bounds=BOUNDS_SQL.format(column="unit_price", source="filled"),
        bounded=BOUNDED_SQL,
        cleaned=CLEANED_SQL,
    )


# --- customers -------------------------------------------------------------


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer with order figures; ``churn`` is 1 without a late order."""
    money = F.col("o_totalprice").cast("decimal(18,2)")
    orders = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("n"),
            F.sum(money).cast("double").alias("spent"),
            F.min("o_orderdate").alias("first_day"),
            F.max("o_orderdate").alias("last_day"),
            F.min("o_orderpriority").alias("payment_method"),
        )
    )
    joined = table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_custkey") % 2 == 0, "female").otherwise("male").alias("gender"),
        F.when(F.col("c_nationkey") % 5 == 0, 1).otherwise(0).alias("senior"),
        F.expr("datediff(DATE'2002-01-01', CAST(first_day AS DATE)) div 30").cast("int").alias("tenure_months"),
        (F.col("spent") / F.col("n")).alias("monthly_charges"),
        F.when(~_every("c_custkey", 50), F.col("spent")).alias("total_charges"),
        F.col("c_mktsegment").alias("contract"),
        "payment_method",
        F.coalesce(F.col("n"), F.lit(0)).cast("int").alias("num_services"),
        F.when(F.col("last_day") >= F.lit(CHURN_DATE).cast("timestamp_ntz"), 0).otherwise(1).alias("churn"),
    )


CUSTOMERS_SQL = f"""
    SELECT c_custkey AS customer_id,
        CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
        CASE WHEN c_nationkey % 5 = 0 THEN 1 ELSE 0 END AS senior,
        CAST(date_diff('day', CAST(first_day AS DATE), DATE '2002-01-01') // 30 AS INTEGER) AS tenure_months,
        spent / n AS monthly_charges,
        CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE spent END AS total_charges,
        c_mktsegment AS contract, payment_method,
        CAST(coalesce(n, 0) AS INTEGER) AS num_services,
        CASE WHEN last_day >= TIMESTAMP '{CHURN_DATE}' THEN 0 ELSE 1 END AS churn
    FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent,
            min(o_orderdate) AS first_day, max(o_orderdate) AS last_day, min(o_orderpriority) AS payment_method
        FROM orders GROUP BY 1) ON c_custkey = o_custkey
"""


def customer_sql(body: str, **views: str) -> str:
    return with_views(body, customers=CUSTOMERS_SQL, **views)


# --- API users -------------------------------------------------------------


def api_documents(spark: SparkSession, sf: str) -> DataFrame:
    """JSON response texts of at most ``PAGE_SIZE`` users each, some of them broken."""
    named = table(spark, sf, "customer").join(
        table(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    c = "c_custkey"
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col(c) % 1000).cast("int"))
    profile = F.struct(
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("tier"),
        F.when(_every(c, 29), 150.0).when(~_every(c, 31), (F.col(c) % 101).cast("double")).alias("score"),
    )
    user = F.struct(
        F.col(c).alias("id"),
        F.col("c_name").alias("username"),
        F.when(_every(c, 13), "not-an-email")
        .when(~_every(c, 21), F.concat(F.lit(" User"), F.col(c).cast("string"), F.lit("@Example.COM ")))
        .alias("email"),
        F.when(_every(c, 7), -5).otherwise((F.col(c) % 60 + 18).cast("int")).alias("age"),
        F.when(_every(c, 37), "maybe").when(F.col(c) % 2 == 0, "true").otherwise("false").alias("is_active"),
        F.when(_every(c, 41), "2020-13-45").otherwise(day.cast("string")).alias("signup_date"),
        F.when(~_every(c, 43), profile).alias("profile"),
        F.when(~_every(c, 3), F.array("c_mktsegment")).alias("tags"),
    )
    pages = (
        named.groupBy(F.expr(f"{c} div {PAGE_SIZE}").alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col(c).alias("k"), user.alias("u")))).alias("users"))
        .withColumn("results", F.transform("users", lambda x: x["u"]))
    )
    document = F.struct(F.lit("success").alias("status"), F.size("results").alias("count"), "results")
    return pages.select("page", F.to_json(document).alias("document"))


def api_users(spark: SparkSession, sf: str) -> DataFrame:
    """Users parsed from the documents; ``row_no`` counts over all pages."""
    parsed = api_documents(spark, sf).select("page", F.from_json("document", API_RESPONSE_TEXTS).alias("d"))
    rows = explode_results(parsed.select("page", "d.results"), ["page"])
    return rows.select((F.col("page") * PAGE_SIZE + F.col("position")).alias("row_no"), *rows.columns[2:])


USERS_SQL = """
    SELECT c_custkey AS row_no, c_custkey AS id, c_name AS username,
        CASE WHEN c_custkey % 13 = 0 THEN 'not-an-email' WHEN c_custkey % 21 = 0 THEN NULL
             ELSE ' User' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' END AS email,
        CASE WHEN c_custkey % 7 = 0 THEN -5 ELSE c_custkey % 60 + 18 END AS age,
        CASE WHEN c_custkey % 37 = 0 THEN 'maybe' WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS is_active,
        CASE WHEN c_custkey % 41 = 0 THEN '2020-13-45'
             ELSE strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y-%m-%d') END AS signup_date,
        c_custkey % 43 <> 0 AS has_profile, n_name AS country, c_mktsegment AS tier,
        CASE WHEN c_custkey % 29 = 0 THEN 150.0 WHEN c_custkey % 31 = 0 THEN NULL
             ELSE CAST(c_custkey % 101 AS DOUBLE) END AS score,
        c_custkey % 3 <> 0 AS has_tags
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
USER_ERRORS_SQL = """
    SELECT row_no, id, 'age' AS field, 'greater_than_equal' AS type FROM users WHERE age < 0
    UNION ALL SELECT row_no, id, 'email', 'missing' FROM users WHERE email IS NULL
    UNION ALL SELECT row_no, id, 'email', 'value_error' FROM users
        WHERE instr(trim(email), '@') < 2 OR instr(substr(email, instr(email, '@') + 1), '.') = 0
    UNION ALL SELECT row_no, id, 'is_active', 'bool_parsing' FROM users WHERE is_active NOT IN ('true', 'false')
    UNION ALL SELECT row_no, id, 'signup_date', 'date_parsing' FROM users WHERE TRY_CAST(signup_date AS DATE) IS NULL
    UNION ALL SELECT row_no, id, 'profile', 'missing' FROM users WHERE NOT has_profile
    UNION ALL SELECT row_no, id, 'profile.score', 'missing' FROM users WHERE has_profile AND score IS NULL
    UNION ALL SELECT row_no, id, 'profile.score', 'less_than_equal' FROM users WHERE has_profile AND score > 100
"""


def user_sql(body: str) -> str:
    return with_views(body, users=USERS_SQL, user_errors=USER_ERRORS_SQL)
