"""Log windows: features per window, scenario rewrite, window-level scores."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import half_open, moment
from millrace.operators.quantiles import nearest_rank, quantile_columns
from millrace.session import materialize, require_rows

# The feature columns of the anomaly score, in order.
FEATURES = (
    "request_count",
    "error_5xx_count",
    "error_rate_5xx",
    "unique_ips",
    "avg_bytes",
    "p95_bytes",
    "path_count",
)


def window_start(width: str, ts: str = "timestamp") -> Column:
    return F.window(ts, width)["start"]


def window_cells(logs: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Log rows counted by (window, facet, value): all that features and causes need, in one scan.

    Facets are ``ip``, ``path`` and ``status`` (their value in ``text``) and ``bytes`` (in ``size``).
    Counting is map-side first, so a window with a large share of the rows is spread over many
    tasks. Works on a stream as well, where it is the one stateful step.
    """
    size_type = logs.schema["bytes"].dataType
    texts = [("ip", F.col("ip")), ("path", F.col("path")), ("status", F.col("status").cast("string"))]
    facets = [
        F.struct(F.lit(name).alias("facet"), text.alias("text"), F.lit(None).cast(size_type).alias("size"))
        for name, text in texts
    ]
    facets.append(F.struct(F.lit("bytes").alias("facet"), F.lit(None).cast("string").alias("text"), F.col("bytes").alias("size")))
    long = logs.select("timestamp", (F.col("status") >= 500).alias("failed"), F.inline(F.array(*facets)))
    counted = long.groupBy(F.window("timestamp", width).alias("w"), "facet", "text", "size").agg(
        F.count("*").alias("n"), F.count_if("failed").alias("errors")
    )
    return counted.select(F.col("w.start").alias("start"), "facet", "text", "size", "n", "errors")


def features_of_cells(cells: DataFrame) -> DataFrame:
    """One row per window of ``window_cells``: ``timestamp`` (its start) and the features, all exact.

    Store the cells first: they are read twice, for the counts and for the percentile.
    """
    facet = F.col("facet")
    sized = F.when(F.col("size").isNotNull(), F.col("n"))
    counts = cells.groupBy("start").agg(
        F.sum(F.when(facet == "bytes", F.col("n"))).alias("request_count"),
        F.sum(F.when(facet == "bytes", F.col("errors"))).alias("error_5xx_count"),
        F.count_if((facet == "ip") & F.col("text").isNotNull()).alias("unique_ips"),
        F.try_divide(F.sum(F.col("size") * F.col("n")), F.sum(sized)).alias("avg_bytes"),
        F.count_if((facet == "path") & F.col("text").isNotNull()).alias("path_count"),
    )
    tail = nearest_rank(cells.where((facet == "bytes") & F.col("size").isNotNull()), "size", "n", 0.95, ["start"])
    return counts.join(tail.select("start", F.col("value").cast("double").alias("p95_bytes")), "start", "left").select(
        F.col("start").alias("timestamp"),
        "request_count",
        "error_5xx_count",
        (F.col("error_5xx_count") / F.col("request_count")).alias("error_rate_5xx"),
        "unique_ips",
        "avg_bytes",
        "p95_bytes",
        "path_count",
    )


def window_features(logs: DataFrame, width: str = "5 minutes") -> DataFrame:
    """One row per non-empty tumbling window: ``timestamp`` (its start) and the features."""
    return features_of_cells(materialize(window_cells(logs, width), "cells"))


def inject_incident(
    logs: DataFrame, path: str, start: datetime, end: datetime, multiplier: int, check: bool = True
) -> DataFrame:
    """Rows of one path in [start, end) fail with 503 and occur ``multiplier`` times."""
    if multiplier < 1:
        raise ValueError("multiplier must be at least 1")
    hit = half_open(F.col("timestamp"), moment(start), moment(end)) & (F.col("path") == path)
    if check:
        require_rows(logs.where(hit), "the set of log rows to rewrite")
    hit = F.coalesce(hit, F.lit(False))
    copies = F.sequence(F.lit(1), F.when(hit, F.lit(multiplier)).otherwise(F.lit(1)))
    return (
        logs.withColumn("status", F.when(hit, F.lit(503)).otherwise(F.col("status")))
        .withColumn("_copy", F.explode(copies))
        .drop("_copy")
    )


def baseline_error_rate(features: DataFrame, baseline_end: datetime) -> DataFrame:
    """Server errors over requests before the cut-off."""
    return features.where(F.col("timestamp") < moment(baseline_end)).agg(
        F.try_divide(F.sum("error_5xx_count"), F.sum("request_count")).alias("baseline_error_rate")
    )


def score_threshold(
    scored: DataFrame, baseline_end: datetime, quantile: float = 0.999, approx: bool = False
) -> DataFrame:
    """Linear quantile of the scores before the cut-off."""
    if not 0 < quantile < 1:
        raise ValueError("quantile must lie between 0 and 1")
    baseline = scored.where(F.col("timestamp") < moment(baseline_end))
    return quantile_columns(baseline, "anomaly_score", {"threshold": quantile}, approx=approx).select("threshold")


def flag_anomalies(
    scored: DataFrame, baseline_end: datetime, quantile: float = 0.999, approx: bool = False
) -> DataFrame:
    """Add ``is_anomaly``: the score reaches the threshold of the baseline."""
    limit = score_threshold(scored, baseline_end, quantile, approx).scalar()
    return scored.withColumn("is_anomaly", F.col("anomaly_score") >= limit)


def detection_metrics(detected: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Precision, recall and F1 of the flags against a true interval, by window.

    Without an interval there is no truth: all measures are 0.
    """
    flagged = F.col("is_anomaly")
    actual = F.lit(False) if start is None else half_open(F.col("timestamp"), moment(start), moment(end))
    counts = detected.agg(
        F.count_if(actual).alias("actual_windows"),
        F.count_if(flagged).alias("predicted_windows"),
        F.count_if(actual & flagged).alias("true_positive_windows"),
    )
    hits = F.col("true_positive_windows")
    precision = F.coalesce(F.try_divide(hits, F.col("predicted_windows")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(hits, F.col("actual_windows")), F.lit(0.0))
    both = counts.select("*", precision.alias("precision"), recall.alias("recall"))
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return both.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def timeline_series(detected: DataFrame) -> DataFrame:
    """Chart data: time, requests, rate, marker of an anomaly and upper limit of the rate axis."""
    top = detected.agg(F.greatest(F.lit(0.5), F.max("error_rate_5xx") * 1.1).alias("m")).scalar()
    return detected.select(
        "timestamp",
        "request_count",
        "error_rate_5xx",
        F.when(F.col("is_anomaly"), F.col("request_count")).alias("anomaly_marker"),
        top.alias("rate_axis_max"),
    )
