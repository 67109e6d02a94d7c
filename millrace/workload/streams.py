"""Registered streaming queries over the event files, and the whole detection job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.models.forest import forest_sql
from millrace.operators.contracts import WEB_LOG
from millrace.operators.windows import FEATURES
from millrace.plans import detection
from millrace.plans.sales_state import SalesState
from millrace.session import materialize, scratch_path
from millrace.streaming import logs as stream
from millrace.workload import views as v
from millrace.workload.logs import CAUSES_SQL, FEATURE_COLUMNS, IMPACT_SQL, METRICS_SQL, RELATED_SQL, rounded, rounded_sql

WIDTH = "1 hour"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return stream.stream_table(spark, f"{sf}/events.parquet")


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows of the stream; watermarks need a zoned time."""
    return v.logs_from_events(_events(spark, sf)).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stream.run_to_table(stream.running_counts(_logs(spark, sf), "status"), "counts", "complete")


def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """All features of the windows that the stream has closed, exact as in a batch run."""
    closed = stream.window_features(_logs(spark, sf), WIDTH)
    return rounded(closed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), "error_rate_5xx", "avg_bytes")


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    sessions = stream.alert_sessions(_logs(spark, sf), "path", 0.5, WIDTH)
    return stream.run_to_table(sessions, "alerts").select(
        "path",
        F.col("start").cast("timestamp_ntz").alias("start"),
        F.col("end").cast("timestamp_ntz").alias("end"),
        "window_count",
        "request_count",
        "error_count",
    )


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in both outputs of the streaming validation."""
    folder = scratch_path(spark, "quarantine")
    raw = v.raw_from_logs(v.logs_from_events(_events(spark, sf)))
    paths = [f"{folder}/{part}" for part in ("valid", "invalid", "manifest")]
    stream.quarantine(raw, WEB_LOG, "event_id", *paths, f"{folder}/checkpoint").awaitTermination()
    stored = stream.committed(spark, paths[0], paths[2], "event_id bigint, batch bigint").agg(F.count("*").alias("valid"))
    rejected = stream.committed(spark, paths[1], paths[2], "row_no bigint, batch bigint").agg(F.count("*").alias("c"))
    return stored.withColumn("invalid", rejected.scalar())


def stream_report(spark: SparkSession, sf: str, per_trigger: int = 100) -> DataFrame:
    """A recurring sales report: a run adds what has arrived to the state of the report and reports on all sales."""
    folder = scratch_path(spark, "report")
    sales = v.sales_table(spark, sf)
    arriving = stream.read_stream(spark, sales.inputFiles()[0].rsplit("/", 1)[0], sales.schema, "*.parquet", per_trigger)
    state = SalesState(spark, f"{folder}/state")
    stream.each_batch(arriving, state.add, f"{folder}/checkpoint").awaitTermination()
    return state.report()


# --- the detection job -----------------------------------------------------

OPTIONS = detection.DetectionOptions(
    window=v.WIDTH,
    anomaly_quantile=0.99,
    incident_start=v.BASELINE_END,
    incident_end=v.INCIDENT_END,
    incident_path=v.INCIDENT_PATH,
    traffic_multiplier=v.MULTIPLIER,
)


def _run(spark: SparkSession, sf: str) -> detection.Detection:
    return detection.detect(v.raw_logs(spark, sf), "event_id", OPTIONS)


def detected_incidents(spark: SparkSession, sf: str) -> DataFrame:
    """Raw logs to incidents: validate, rewrite, features, forest, causes."""
    return rounded(_run(spark, sf).incidents, "max_error_rate", "max_anomaly_score", "excess_errors")


def anomaly_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of the injected logs with the score of the forest and its flag."""
    return rounded(_run(spark, sf).detected.select("timestamp", "anomaly_score", "is_anomaly"), "anomaly_score")


def forest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_run(spark, sf).metrics, "precision", "recall", "f1")


def detection_saved(spark: SparkSession, sf: str) -> DataFrame:
    """The job with all its outputs stored and read back; the report head."""
    result = _run(spark, sf)
    result.incidents = materialize(result.incidents, "incidents")  # saved and reported from one evaluation
    detection.save(result, scratch_path(spark, "detection"), OPTIONS)
    head = detection.report_head(result)
    sound = (F.col("incident_count") >= 1) & (F.col("incident_count") <= F.col("anomaly_windows"))
    return head.select("valid_logs", "invalid_logs", sound.alias("consistent"))


QUERIES = {
    "stream_counts": stream_counts,
    "stream_windows": stream_windows,
    "stream_alerts": stream_alerts,
    "stream_quarantine": stream_quarantine,
    "stream_report": stream_report,
    "detected_incidents": detected_incidents,
    "anomaly_scores": anomaly_scores,
    "forest_metrics": forest_metrics,
    "detection_saved": detection_saved,
}

# What one run over the whole files emits follows from the rows alone: counters hold
# every row, a window is out once the watermark has passed its end.
VALID_LOGS_SQL = """
    SELECT event_id, ip, CAST(timestamp AS TIMESTAMP) AS timestamp, method, trim(path) AS path,
        CAST(CAST(status AS DOUBLE) AS BIGINT) AS status, CAST(bytes AS BIGINT) AS bytes, trim(user_agent) AS user_agent
    FROM raw_logs WHERE event_id NOT IN (SELECT event_id FROM log_errors)
"""


def _detected_sql(body: str, causes: bool = False) -> str:
    """Validation, rewrite, features, the forest grown in SQL, flags and incidents."""
    before = f"timestamp < TIMESTAMP '{v.BASELINE_END}'"
    views = {
        "clean_logs": v.WEB_LOGS_SQL,
        "raw_logs": v.RAW_LOGS_SQL.replace("FROM web_logs", "FROM clean_logs"),
        "log_errors": v.LOG_ERRORS_SQL,
        "web_logs": VALID_LOGS_SQL,
        "injected": v.INJECTED_SQL,
        "features": v.FEATURES_SQL.format(width=v.WIDTH, logs="injected"),
    }
    more = {
        "detected": f"""SELECT *, anomaly_score >= (SELECT quantile_cont(anomaly_score, {OPTIONS.anomaly_quantile})
            FROM scored WHERE {before}) AS is_anomaly FROM scored""",
        "incident_windows": v.INCIDENT_WINDOWS_SQL,
        "impact": IMPACT_SQL,
    }
    if causes:
        more |= {"related": RELATED_SQL, "causes": CAUSES_SQL}
    grown = forest_sql("features", before, FEATURES, "timestamp", OPTIONS.trees, seed=OPTIONS.seed)
    named = ",\n".join(f"{name} AS ({text})" for name, text in views.items())
    rest = ",\n".join(f"{name} AS ({text})" for name, text in more.items())
    return f"WITH {named},\n{grown},\n{rest}\n{body}"


_CLOSED = f"""w + INTERVAL '{WIDTH}' <= (SELECT max(timestamp) FROM web_logs) - INTERVAL '10 minutes'"""
ORACLES = {
    # the threshold is a quantile of baseline scores, so one window at least reaches it
    "detection_saved": v.raw_log_sql(
        """SELECT (SELECT count(*) FROM raw_logs) - bad AS valid_logs, bad AS invalid_logs, true AS consistent
        FROM (SELECT count(DISTINCT event_id) AS bad FROM log_errors)"""
    ),
    "anomaly_scores": _detected_sql("SELECT timestamp, round(anomaly_score, 6) AS anomaly_score, is_anomaly FROM detected"),
    "forest_metrics": _detected_sql(METRICS_SQL),
    "detected_incidents": _detected_sql(
        """SELECT strftime(incident_start, '%Y-%m-%d %H:%M:%S') AS start,
            strftime(incident_end, '%Y-%m-%d %H:%M:%S') AS "end",
            impact.* EXCLUDE (incident_start, incident_end), causes.* EXCLUDE (incident_start)
        FROM impact JOIN causes USING (incident_start)""",
        causes=True,
    ),
    "stream_counts": v.log_sql("SELECT status AS key, count(*) AS n FROM web_logs GROUP BY 1"),
    "stream_windows": v.with_views(
        f"""SELECT {rounded_sql(FEATURE_COLUMNS, "closed", "error_rate_5xx", "avg_bytes")[7:]}""",
        web_logs=v.WEB_LOGS_SQL,
        closed=v.FEATURES_SQL.format(
            width=WIDTH, logs=f"(SELECT * FROM (SELECT *, time_bucket(INTERVAL '{WIDTH}', timestamp) AS w FROM web_logs) WHERE {_CLOSED})"
        ),
    ),
    # a session is out once the watermark has passed its last window by one length
    "stream_alerts": v.log_sql(
        f"""SELECT path, min(w) AS start, max(w) + INTERVAL '{WIDTH}' AS "end", count(*) AS window_count,
        CAST(sum(n) AS BIGINT) AS request_count, CAST(sum(e) AS BIGINT) AS error_count
        FROM (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY path ORDER BY w) AS session
            FROM (SELECT *, coalesce(w - lag(w) OVER (PARTITION BY path ORDER BY w) > INTERVAL '{WIDTH}', TRUE) AS opens
                FROM (SELECT path, time_bucket(INTERVAL '{WIDTH}', timestamp) AS w, count(*) AS n,
                        count(*) FILTER (status >= 500) AS e FROM web_logs GROUP BY 1, 2)
                WHERE e / n >= 0.5 AND {_CLOSED}))
        GROUP BY path, session
        HAVING max(w) + 2 * INTERVAL '{WIDTH}' - INTERVAL '1 microsecond'
            <= (SELECT max(timestamp) FROM web_logs) - INTERVAL '10 minutes'"""
    ),
    "stream_quarantine": v.raw_log_sql(
        """SELECT (SELECT count(*) FROM raw_logs) - bad AS valid, bad AS invalid
        FROM (SELECT count(DISTINCT event_id) AS bad FROM log_errors)"""
    ),
}
