"""Registered queries on web logs: counters, validation, windows, incidents."""

from __future__ import annotations

from collections.abc import Sequence

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.operators import counting, incidents, lookup, profiling, validation, windows
from millrace.operators.contracts import WEB_LOG
from millrace.session import materialize, scratch_path
from millrace.sources.tables import write_verified
from millrace.workload import views as v


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_sql(columns: Sequence[str], source: str, *numbers: str, digits: int = 6) -> str:
    picks = [f"round({c}, {digits}) AS {c}" if c in numbers else c for c in columns]
    return f"SELECT {', '.join(picks)} FROM {source}"


# --- counters --------------------------------------------------------------


def with_hour(logs: DataFrame) -> DataFrame:
    return logs.withColumn("hour", scalars.hour_label(F.col("timestamp")))


def counts_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return counting.count_by(v.web_logs(spark, sf), "status")


def counts_by_path(spark: SparkSession, sf: str) -> DataFrame:
    return counting.count_by(v.web_logs(spark, sf), "path")


def counts_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return counting.count_by(with_hour(v.web_logs(spark, sf)), "hour").orderBy("key")


def counts_by_ip(spark: SparkSession, sf: str) -> DataFrame:
    return counting.count_by(v.web_logs(spark, sf), "ip")


def log_counters(spark: SparkSession, sf: str) -> DataFrame:
    return counting.count_each(with_hour(v.web_logs(spark, sf)), ["status", "path", "hour", "ip"])


def top_paths(spark: SparkSession, sf: str) -> DataFrame:
    return counting.most_common(v.web_logs(spark, sf), "path", 5)


def top_ips(spark: SparkSession, sf: str) -> DataFrame:
    return counting.most_common(v.web_logs(spark, sf), "ip", 5)


def error_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(counting.error_ratio(v.web_logs(spark, sf)), "ratio_pct")


def status_map(spark: SparkSession, sf: str) -> DataFrame:
    folded = counting.status_map(v.web_logs(spark, sf))
    return folded.select("total", F.explode("status").alias("status", "n"))


def amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Events with an amount that is 0 unless something was bought."""
    bought = F.col("event_type").isin("purchase", "signup")
    return v.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "ts", F.when(bought, F.col("value")).otherwise(0.0).alias("amount")
    )


def event_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(counting.event_summary(amounts(spark, sf)), "avg")


def event_summary_sql(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(counting.event_summary_sql(spark, amounts(spark, sf)), "avg")


def result_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The two forms of the event summary compared, and against a shifted copy."""
    left = counting.event_summary(amounts(spark, sf))
    right = counting.event_summary_sql(spark, amounts(spark, sf))
    shifted = right.withColumn("avg", F.col("avg") + F.when(F.col("event_type") == "signup", 0.001).otherwise(1e-9))

    def summary(name: str, other: DataFrame) -> DataFrame:
        return lookup.result_difference(left, other, ["event_type"]).agg(
            F.lit(name).alias("comparison"), F.count("*").alias("n_different")
        )

    return summary("same", right).unionByName(summary("shifted", shifted))


def source_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Shape of the events, and their first five rows."""
    events = v.table(spark, sf, "events")
    flat = events.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "props")
    required = ["event_id", "user_id", "event_type", "ts"]
    first = profiling.source_profile(flat, required, 5, ["event_id"]).select("first_rows").scalar()
    return profiling.source_profile(events, required).withColumn("first_rows", first)


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    stored = write_verified(v.web_logs(spark, sf), scratch_path(spark, "roundtrip"))
    return stored.agg(
        F.count("*").alias("n_rows"), F.sum("bytes").alias("bytes"), F.count_distinct("path").alias("paths")
    )


AMOUNTS_SQL = """
    SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE 0.0 END AS amount FROM events
"""
EVENT_SUMMARY = v.with_views(
    """SELECT event_type, count(*) AS cnt,
        round(avg(amount), 6) AS avg
    FROM amounts WHERE amount > 0 GROUP BY 1""",
    amounts=AMOUNTS_SQL,
)

COUNTER_QUERIES = {
    "event_summary": event_summary,
    "event_summary_sql": event_summary_sql,
    "log_counts_by_status": counts_by_status,
    "log_counts_by_path": counts_by_path,
    "log_counts_by_hour": counts_by_hour,
    "log_counts_by_ip": counts_by_ip,
    "log_counters": log_counters,
    "top_paths": top_paths,
    "top_ips": top_ips,
    "error_ratio": error_ratio,
    "status_map": status_map,
    "result_diff": result_diff,
    "source_profile": source_profile,
    "parquet_roundtrip": parquet_roundtrip,
}
COUNTER_ORACLES = {
    "event_summary": EVENT_SUMMARY,
    "event_summary_sql": EVENT_SUMMARY,
    "log_counts_by_status": v.log_sql("SELECT status AS key, count(*) AS n FROM web_logs GROUP BY 1"),
    "log_counts_by_path": v.log_sql("SELECT path AS key, count(*) AS n FROM web_logs GROUP BY 1"),
    "log_counts_by_hour": v.log_sql(
        "SELECT strftime(timestamp, '%H') AS key, count(*) AS n FROM web_logs GROUP BY 1"
    ),
    "log_counts_by_ip": v.log_sql("SELECT ip AS key, count(*) AS n FROM web_logs GROUP BY 1"),
    "log_counters": v.log_sql(
        """SELECT 'status' AS dimension, CAST(status AS VARCHAR) AS key, count(*) AS n FROM web_logs GROUP BY 2
        UNION ALL SELECT 'path', path, count(*) FROM web_logs GROUP BY 2
        UNION ALL SELECT 'hour', strftime(timestamp, '%H'), count(*) FROM web_logs GROUP BY 2
        UNION ALL SELECT 'ip', ip, count(*) FROM web_logs GROUP BY 2"""
    ),
    "top_paths": v.log_sql(
        "SELECT path AS key, count(*) AS n FROM web_logs GROUP BY 1 ORDER BY n DESC, key LIMIT 5"
    ),
    "top_ips": v.log_sql("SELECT ip AS key, count(*) AS n FROM web_logs GROUP BY 1 ORDER BY n DESC, key LIMIT 5"),
    "error_ratio": v.log_sql(
        """SELECT count(*) AS total, count(*) FILTER (status BETWEEN 500 AND 599) AS errors_5xx,
        round(100.0 * CAST(count(*) FILTER (status BETWEEN 500 AND 599) AS DOUBLE) / count(*), 6) AS ratio_pct
        FROM web_logs"""
    ),
    "status_map": v.log_sql(
        """SELECT (SELECT count(*) FROM web_logs) AS total, status, count(*) AS n FROM web_logs GROUP BY 2"""
    ),
    "result_diff": v.with_views(
        """SELECT comparison, count(*) FILTER (a.event_type IS NULL OR b.event_type IS NULL OR a.cnt <> b.cnt
            OR abs(a.avg - b.avg - CASE WHEN b.event_type = 'signup' THEN signup ELSE other END) > 1e-6) AS n_different
        FROM (SELECT * FROM left_summary, (VALUES ('same', 0.0, 0.0), ('shifted', 0.001, 1e-9)) t(comparison, signup, other)) a
        FULL JOIN right_summary b ON a.event_type = b.event_type GROUP BY 1""",
        amounts=AMOUNTS_SQL,
        left_summary="SELECT event_type, count(*) AS cnt, avg(amount) AS avg FROM amounts WHERE amount > 0 GROUP BY 1",
        # the other result is worked out another way, from the events themselves
        right_summary="""SELECT event_type, count(*) AS cnt, sum(value) / count(*) AS avg FROM events
            WHERE event_type IN ('purchase', 'signup') AND value > 0 GROUP BY 1""",
    ),
    "source_profile": """SELECT 'event_id,ts,user_id,event_type,value,props' AS columns,
        CAST(6 AS BIGINT) AS n_columns, count(*) AS n_rows,
        (SELECT string_agg('{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '","ts":"'
            || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","props":' || to_json(props) || '}', chr(10) ORDER BY event_id)
         FROM (SELECT * FROM events ORDER BY event_id LIMIT 5)) AS first_rows FROM events""",
    "parquet_roundtrip": v.log_sql(
        """SELECT count(*) AS n_rows, CAST(sum(bytes) AS BIGINT) AS bytes, count(DISTINCT path) AS paths
        FROM web_logs"""
    ),
}

# --- validation ------------------------------------------------------------


def _log_errors(fields: tuple[str, ...], types: tuple[str, ...] = ()):
    """Errors of some fields only, so only their columns are read."""
    contract = validation.Contract([f for f in WEB_LOG.fields if f.path in fields])

    def query(spark: SparkSession, sf: str) -> DataFrame:
        tagged = contract.tag(v.raw_logs(spark, sf), "event_id")
        found = tagged.select("event_id", F.explode("errors").alias("e")).select("event_id", "e.loc", "e.type")
        return found.where(F.col("type").isin(*types)) if types else found

    return query


def _log_errors_sql(fields: tuple[str, ...], types: tuple[str, ...] = ()) -> str:
    where = f"loc IN ({', '.join(map(repr, fields))})"
    if types:
        where += f" AND type IN ({', '.join(map(repr, types))})"
    return v.raw_log_sql(f"SELECT event_id, loc, type FROM log_errors WHERE {where}")


ALL_FIELDS = tuple(f.path for f in WEB_LOG.fields)
RULES = {
    "validate_range": (("status", "bytes"), ("greater_than_equal", "less_than_equal")),
    "validate_ip": (("ip",), ()),
    "validate_enum": (("method",), ()),
    "validate_text": (("path", "user_agent"), ()),
    "validate_types": (("timestamp", "status"), ("datetime_parsing", "int_parsing")),
    "validate_required": (("bytes",), ("missing",)),
}


def validate_extra(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows as JSON texts, some with a field the contract does not know."""
    raw = v.raw_logs(spark, sf)
    with_extra = F.struct(*WEB_LOG.names(), F.when(F.col("event_id") % 31 == 0, 1).alias("debug"))
    texts = raw.withColumn("document", F.to_json(with_extra))
    tagged = WEB_LOG.tag(texts, "event_id", F.json_object_keys("document"))
    found = tagged.select("event_id", F.explode("errors").alias("e")).select("event_id", "e.loc", "e.type")
    return found.where(F.col("type") == "extra_forbidden")


def log_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Quarantined log rows: position, number of errors, first field."""
    invalid = WEB_LOG.invalid(WEB_LOG.tag(v.raw_logs(spark, sf), "event_id"), "event_id")
    return invalid.select(
        "row_no",
        F.size("errors").cast("long").alias("n_errors"),
        F.get("errors", F.lit(0))["loc"].alias("first_field"),
        F.get_json_object("data", "$.status").alias("raw_status"),
    )


def log_valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Typed rows that passed, with stripped texts."""
    return WEB_LOG.valid(WEB_LOG.tag(v.raw_logs(spark, sf), "event_id"), ["event_id"])


def log_split(spark: SparkSession, sf: str) -> DataFrame:
    return validation.split_counts(WEB_LOG.tag(v.raw_logs(spark, sf), "event_id"))


VALIDATION_QUERIES = {name: _log_errors(*rule) for name, rule in RULES.items()} | {
    "validate_extra": validate_extra,
    "log_quarantine": log_quarantine,
    "log_valid_rows": log_valid_rows,
    "log_validation_split": log_split,
}
VALIDATION_ORACLES = {name: _log_errors_sql(*rule) for name, rule in RULES.items()} | {
    "validate_extra": "SELECT event_id, 'debug' AS loc, 'extra_forbidden' AS type FROM events WHERE event_id % 31 = 0",
    "log_quarantine": v.raw_log_sql(
        """SELECT e.event_id AS row_no, count(*) AS n_errors,
        arg_min(loc, list_position(['ip','timestamp','method','path','status','bytes','user_agent'], loc)) AS first_field,
        any_value(status) AS raw_status
        FROM log_errors e JOIN raw_logs r ON e.event_id = r.event_id GROUP BY 1"""
    ),
    "log_valid_rows": v.raw_log_sql(
        """SELECT event_id, ip, CAST(timestamp AS TIMESTAMP) AS timestamp, method, trim(path) AS path,
        CAST(CAST(status AS DOUBLE) AS BIGINT) AS status, CAST(bytes AS BIGINT) AS bytes, trim(user_agent) AS user_agent
        FROM raw_logs WHERE event_id NOT IN (SELECT event_id FROM log_errors)"""
    ),
    "log_validation_split": v.raw_log_sql(
        """SELECT count(*) AS total, count(*) FILTER (NOT bad) AS valid, count(*) FILTER (bad) AS invalid
        FROM (SELECT event_id IN (SELECT event_id FROM log_errors) AS bad FROM raw_logs)"""
    ),
}

# --- windows and incidents -------------------------------------------------


def window_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(windows.window_features(v.web_logs(spark, sf), "1 hour"), "error_rate_5xx", "avg_bytes")


def window_features_5min(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(windows.window_features(v.web_logs(spark, sf), "5 minutes"), "error_rate_5xx", "avg_bytes")


def injected(spark: SparkSession, sf: str, check: bool = False) -> DataFrame:
    return windows.inject_incident(
        v.web_logs(spark, sf), v.INCIDENT_PATH, v.BASELINE_END, v.INCIDENT_END, v.MULTIPLIER, check
    )


def inject_incident(spark: SparkSession, sf: str) -> DataFrame:
    return injected(spark, sf, check=True).groupBy("path", "status").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes")
    )


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(windows.window_cells(injected(spark, sf), v.WIDTH), "cells")


def _scored(spark: SparkSession, sf: str, cells: DataFrame | None = None) -> DataFrame:
    """Window features written once, with the error rate as their score."""
    features = materialize(windows.features_of_cells(_cells(spark, sf) if cells is None else cells), "features")
    return features.withColumn("anomaly_score", F.col("error_rate_5xx"))


def _detected(spark: SparkSession, sf: str, cells: DataFrame | None = None) -> DataFrame:
    return windows.flag_anomalies(_scored(spark, sf, cells), v.BASELINE_END, v.QUANTILE)


def baseline_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(windows.baseline_error_rate(_scored(spark, sf), v.BASELINE_END), "baseline_error_rate")


def score_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(windows.score_threshold(_scored(spark, sf), v.BASELINE_END, v.QUANTILE), "threshold")


def detection_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = windows.detection_metrics(_detected(spark, sf), v.BASELINE_END, v.INCIDENT_END)
    return rounded(found, "precision", "recall", "f1")


def timeline_series(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(windows.timeline_series(_detected(spark, sf)), "error_rate_5xx", "rate_axis_max")


def _incidents(spark: SparkSession, sf: str) -> DataFrame:
    cells = _cells(spark, sf)
    detected = _detected(spark, sf, cells)
    baseline = windows.baseline_error_rate(detected, v.BASELINE_END).scalar()
    return incidents.incidents(None, detected, baseline, v.WIDTH, cells)


RATES = ("max_error_rate", "max_anomaly_score", "excess_errors")


def incident_table(spark: SparkSession, sf: str) -> DataFrame:
    detected = _detected(spark, sf)
    baseline = windows.baseline_error_rate(detected, v.BASELINE_END).scalar()
    found = incidents.incident_impact(incidents.incident_windows(detected, v.WIDTH), baseline, v.WIDTH)
    return rounded(found, *RATES)


def incident_causes(spark: SparkSession, sf: str) -> DataFrame:
    cells = _cells(spark, sf)
    marked = incidents.incident_windows(_detected(spark, sf, cells), v.WIDTH)
    return incidents.causes_of_cells(cells, materialize(marked, "incident-windows"))


def incident_at(spark: SparkSession, sf: str) -> DataFrame:
    """The incident that covers the start of the rewritten period, times as text."""
    found = incidents.incident_at(_incidents(spark, sf), datetime(2024, 1, 22, 13, 30))
    return rounded(found, *RATES)


def incident_of_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Every log row with the incident in progress at its time, if any; incidents here begin and end off window bounds."""
    marked = incidents.incident_windows(_detected(spark, sf), v.WIDTH)
    found = incidents.incident_impact(marked, 0.0, v.WIDTH)
    shifted = found.select(
        (F.col("incident_start") + F.expr("INTERVAL '7' MINUTE")).alias("start"),
        (F.col("incident_end") + F.expr("INTERVAL '43' MINUTE")).alias("end"),
        "severity",
    )
    return incidents.covering(v.web_logs(spark, sf).select("event_id", "timestamp"), shifted).select(
        "event_id", F.col("start").alias("incident_start"), "severity"
    )


def incident_kpi(spark: SparkSession, sf: str) -> DataFrame:
    counts = validation.split_counts(WEB_LOG.tag(v.raw_logs(spark, sf), "event_id"))
    detected = _detected(spark, sf)
    found = incidents.incident_impact(incidents.incident_windows(detected, v.WIDTH), 0.0, v.WIDTH)
    return incidents.incident_kpi(counts, detected, found)


def severity(spark: SparkSession, sf: str) -> DataFrame:
    """Windows per severity of their own error rate."""
    features = windows.window_features(injected(spark, sf), v.WIDTH)
    return features.groupBy(scalars.severity(F.col("error_rate_5xx")).alias("severity")).agg(
        F.count("*").alias("n"), F.sum("error_5xx_count").alias("errors")
    )


def mask_ip(spark: SparkSession, sf: str) -> DataFrame:
    """Raw clients, valid or not, masked."""
    raw = v.raw_logs(spark, sf)
    return raw.groupBy(scalars.mask_ip(F.col("ip")).alias("ip_masked")).agg(F.count("*").alias("n"))


FEATURE_COLUMNS = ("timestamp", *windows.FEATURES)
IMPACT_SQL = f"""
    SELECT incident_start, max(timestamp) + INTERVAL '{v.WIDTH}' AS incident_end, count(*) AS window_count,
        CASE WHEN max(error_rate_5xx) >= 0.30 THEN 'CRITICAL' WHEN max(error_rate_5xx) >= 0.15 THEN 'HIGH'
             ELSE 'MEDIUM' END AS severity,
        round(max(error_rate_5xx), 6) AS max_error_rate, round(max(anomaly_score), 6) AS max_anomaly_score,
        CAST(sum(request_count) AS BIGINT) AS request_count, CAST(sum(error_5xx_count) AS BIGINT) AS error_count,
        round(greatest(0.0, sum(error_5xx_count) - (
            SELECT CAST(sum(error_5xx_count) AS DOUBLE) / sum(request_count) FROM detected
            WHERE timestamp < TIMESTAMP '{v.BASELINE_END}') * sum(request_count)), 6) AS excess_errors
    FROM incident_windows GROUP BY 1
"""


def _best(value: str, order: str, condition: str) -> str:
    return f"""(SELECT {value} FROM related r WHERE r.incident_start = i.incident_start AND {condition}
        GROUP BY {value} ORDER BY count(*) DESC, {order} LIMIT 1)"""


CAUSES_SQL = f"""
    SELECT incident_start,
        coalesce({_best("path", "path", "status >= 500")}, '-') AS top_error_path,
        coalesce({_best("CAST(status AS VARCHAR)", "min(status)", "status >= 500")}, '-') AS top_status,
        regexp_replace({_best("ip", "ip", "TRUE")}, '[.][^.]*$', '.***') AS top_ip_masked
    FROM (SELECT DISTINCT incident_start FROM incident_windows) i
"""
RELATED_SQL = f"""
    SELECT l.*, w.incident_start FROM injected l JOIN incident_windows w
      ON l.timestamp >= w.timestamp AND l.timestamp < w.timestamp + INTERVAL '{v.WIDTH}'
"""


def _cause_sql(body: str) -> str:
    text = v.detection_sql(body)
    head, tail = text.rsplit("\n" + body, 1)
    return f"{head},\nrelated AS ({RELATED_SQL}),\nimpact AS ({IMPACT_SQL}),\ncauses AS ({CAUSES_SQL})\n{body}{tail}"


WINDOW_QUERIES = {
    "window_features": window_features,
    "window_features_5min": window_features_5min,
    "inject_incident": inject_incident,
    "baseline_error_rate": baseline_error_rate,
    "score_threshold": score_threshold,
    "detection_metrics": detection_metrics,
    "timeline_series": timeline_series,
    "incidents": incident_table,
    "incident_causes": incident_causes,
    "incident_at": incident_at,
    "incident_of_logs": incident_of_logs,
    "incident_kpi": incident_kpi,
    "severity": severity,
    "mask_ip": mask_ip,
}


def _feature_sql(width: str) -> str:
    return v.with_views(
        rounded_sql(FEATURE_COLUMNS, "features", "error_rate_5xx", "avg_bytes"),
        web_logs=v.WEB_LOGS_SQL,
        features=v.FEATURES_SQL.format(width=width, logs="web_logs"),
    )


ACTUAL = f"timestamp >= TIMESTAMP '{v.BASELINE_END}' AND timestamp < TIMESTAMP '{v.INCIDENT_END}'"
METRICS_SQL = f"""
    SELECT actual_windows, predicted_windows, true_positive_windows,
        round(p, 6) AS precision, round(r, 6) AS recall,
        round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1
    FROM (SELECT *, CASE WHEN predicted_windows > 0 THEN true_positive_windows / predicted_windows ELSE 0 END AS p,
            CASE WHEN actual_windows > 0 THEN true_positive_windows / actual_windows ELSE 0 END AS r
        FROM (SELECT count(*) FILTER ({ACTUAL}) AS actual_windows, count(*) FILTER (is_anomaly) AS predicted_windows,
                count(*) FILTER ({ACTUAL} AND is_anomaly) AS true_positive_windows FROM detected))
"""
WINDOW_ORACLES = {
    "window_features": _feature_sql("1 hour"),
    "window_features_5min": _feature_sql("5 minutes"),
    "inject_incident": v.detection_sql(
        "SELECT path, CAST(status AS BIGINT) AS status, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes "
        "FROM injected GROUP BY 1, 2"
    ),
    "baseline_error_rate": v.detection_sql(
        f"""SELECT round(CAST(sum(error_5xx_count) AS DOUBLE) / sum(request_count), 6) AS baseline_error_rate
        FROM features WHERE timestamp < TIMESTAMP '{v.BASELINE_END}'"""
    ),
    "score_threshold": v.detection_sql(
        f"""SELECT round(quantile_cont(error_rate_5xx, {v.QUANTILE}), 6) AS threshold
        FROM features WHERE timestamp < TIMESTAMP '{v.BASELINE_END}'"""
    ),
    "detection_metrics": v.detection_sql(METRICS_SQL),
    "timeline_series": v.detection_sql(
        """SELECT timestamp, request_count, round(error_rate_5xx, 6) AS error_rate_5xx,
            CASE WHEN is_anomaly THEN request_count END AS anomaly_marker,
            round((SELECT greatest(0.5, max(error_rate_5xx) * 1.1) FROM detected), 6) AS rate_axis_max FROM detected"""
    ),
    "incidents": v.detection_sql(IMPACT_SQL),
    "incident_causes": _cause_sql("SELECT * FROM causes"),
    "incident_at": _cause_sql(
        """SELECT strftime(incident_start, '%Y-%m-%d %H:%M:%S') AS start,
            strftime(incident_end, '%Y-%m-%d %H:%M:%S') AS "end",
            impact.* EXCLUDE (incident_start, incident_end), causes.* EXCLUDE (incident_start)
        FROM impact JOIN causes USING (incident_start)
        WHERE incident_start <= TIMESTAMP '2024-01-22 13:30:00' AND incident_end > TIMESTAMP '2024-01-22 13:30:00'"""
    ),
    "incident_of_logs": _cause_sql(
        """SELECT event_id, s AS incident_start, severity FROM web_logs LEFT JOIN (
            SELECT incident_start + INTERVAL 7 MINUTE AS s, incident_end + INTERVAL 43 MINUTE AS e, severity FROM impact)
        ON timestamp >= s AND timestamp < e"""
    ),
    "incident_kpi": v.with_views(
        """SELECT (SELECT count(*) FROM raw_logs) - bad AS valid_logs, bad AS invalid_logs,
            (SELECT count(*) FROM incident_windows) AS anomaly_windows,
            (SELECT count(DISTINCT incident_start) FROM incident_windows) AS incident_count
        FROM (SELECT count(DISTINCT event_id) AS bad FROM log_errors)""",
        web_logs=v.WEB_LOGS_SQL,
        raw_logs=v.RAW_LOGS_SQL,
        log_errors=v.LOG_ERRORS_SQL,
        injected=v.INJECTED_SQL,
        features=v.FEATURES_SQL.format(width=v.WIDTH, logs="injected"),
        detected=v.DETECTED_SQL,
        incident_windows=v.INCIDENT_WINDOWS_SQL,
    ),
    "severity": v.detection_sql(
        """SELECT CASE WHEN error_rate_5xx >= 0.30 THEN 'CRITICAL' WHEN error_rate_5xx >= 0.15 THEN 'HIGH'
            ELSE 'MEDIUM' END AS severity, count(*) AS n, CAST(sum(error_5xx_count) AS BIGINT) AS errors
        FROM features GROUP BY 1"""
    ),
    "mask_ip": v.raw_log_sql(
        r"""SELECT CASE WHEN regexp_full_match(ip, '[^.]*[.][^.]*[.][^.]*[.][^.]*')
            THEN regexp_extract(ip, '^([^.]*[.][^.]*[.][^.]*)', 1) || '.***' ELSE 'masked' END AS ip_masked,
            count(*) AS n FROM raw_logs GROUP BY 1"""
    ),
}

QUERIES = COUNTER_QUERIES | VALIDATION_QUERIES | WINDOW_QUERIES
ORACLES = COUNTER_ORACLES | VALIDATION_ORACLES | WINDOW_ORACLES
