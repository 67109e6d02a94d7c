"""Anomalous windows merged into incidents, with their causes and impact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import mask_ip, minute_text, severity
from millrace.operators.windows import window_cells
from millrace.session import attach, materialize

RANGE = 4096  # windows of a range whose islands one task finds


def incident_windows(detected: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Anomalous windows with ``incident_start``, the first window of their incident.

    A gap of more than one window length starts a new incident. Gaps are found inside ranges
    of ``RANGE`` windows, each a task of its own. An island that the last window of the range before reaches
    continues that range's last island; such links are followed by pointer doubling, so an incident may
    span any number of ranges and no step meets all windows.
    """
    flagged = detected.where("is_anomaly")
    length = F.expr(f"INTERVAL {width}")
    span = RANGE * _micros(length)
    ranged = flagged.withColumn("_range", F.floor(_micros_of(F.col("timestamp")) / span))
    in_range = Window.partitionBy("_range").orderBy("timestamp")
    previous = F.lag("timestamp").over(in_range)
    opens = previous.isNull() | (F.col("timestamp") > previous + length)
    marked = ranged.withColumn("_opens", F.when(opens, F.col("timestamp"))).withColumn("_island", F.max("_opens").over(in_range))
    marked = materialize(marked.drop("_opens"), "flagged")
    firsts = marked.groupBy("_range").agg(F.min("timestamp").alias("_island"))
    lasts = marked.groupBy((F.col("_range") + 1).alias("_range")).agg(
        F.max("timestamp").alias("_last"), F.max("_island").alias("_before")
    )
    reached = firsts.join(lasts, "_range").where(F.col("_island") <= F.col("_last") + length)
    links = materialize(reached.select("_island", "_before"), "links")
    while True:
        onward = links.select(F.col("_island").alias("_before"), F.col("_before").alias("_further"))
        if links.join(onward, "_before", "left_semi").isEmpty():
            break
        further = links.join(onward, "_before", "left")
        links = materialize(further.select("_island", F.coalesce("_further", "_before").alias("_before")), "links")
    joined = marked.join(links, "_island", "left")
    return joined.select(*detected.columns, F.coalesce("_before", "_island").alias("incident_start"))


def _micros_of(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _micros(length: Column) -> Column:
    """Microseconds of an interval."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return _micros_of(zero + length) - _micros_of(zero)


def incident_impact(windows: DataFrame, baseline, width: str = "5 minutes") -> DataFrame:
    """Per incident: interval, windows, severity, highest rate and score, excess errors.

    ``baseline`` is the baseline error rate, a number or a column.
    """
    rate = F.lit(baseline) if isinstance(baseline, (int, float)) else baseline
    grouped = windows.groupBy("incident_start").agg(
        F.max("timestamp").alias("_last"),
        F.count("*").alias("window_count"),
        F.max("error_rate_5xx").alias("max_error_rate"),
        F.max("anomaly_score").alias("max_anomaly_score"),
        F.sum("request_count").alias("request_count"),
        F.sum("error_5xx_count").alias("error_count"),
    )
    excess = F.greatest(F.lit(0.0), F.col("error_count") - rate * F.col("request_count"))
    return grouped.select(
        "incident_start",
        (F.col("_last") + F.expr(f"INTERVAL {width}")).alias("incident_end"),
        "window_count",
        severity(F.col("max_error_rate")).alias("severity"),
        "max_error_rate",
        "max_anomaly_score",
        "request_count",
        "error_count",
        excess.alias("excess_errors"),
    )


def incident_causes(logs: DataFrame, windows: DataFrame, width: str = "5 minutes") -> DataFrame:
    return causes_of_cells(window_cells(logs, width), windows)


def causes_of_cells(cells: DataFrame, windows: DataFrame) -> DataFrame:
    """Per incident: top error path, most frequent error status, top client (masked), from ``window_cells``.

    An incident is a union of whole windows, so the interval join is an equi-join on
    the window start. Candidates are counted per (incident, facet, value) before the
    best is taken; ties go to the smaller value. ``-`` stands for no candidate.
    """
    spans = windows.select(F.col("timestamp").alias("start"), "incident_start")
    named = cells.where((F.col("facet") != "bytes") & F.col("text").isNotNull())
    votes = F.when(F.col("facet") == "ip", F.col("n")).otherwise(F.col("errors"))
    related = attach(named.select("start", "facet", "text", votes.alias("votes")), spans, ["start"], "inner")
    counted = related.where("votes > 0").groupBy("incident_start", "facet", "text").agg(F.sum("votes").alias("n"))
    # least of (-n, value): most frequent first, then the smaller value
    best = {
        facet: F.min(
            F.when(
                F.col("facet") == facet,
                F.struct(
                    (-F.col("n")).alias("n"),
                    (F.col("text").cast("long") if facet == "status" else F.lit(0).cast("long")).alias("o"),
                    F.col("text").alias("value"),
                ),
            )
        )
        for facet in ("path", "status", "ip")
    }
    picked = counted.groupBy("incident_start").agg(*[e.alias(k) for k, e in best.items()])
    found = windows.select("incident_start").distinct().join(picked, "incident_start", "left")
    return found.select(
        "incident_start",
        F.coalesce("path.value", F.lit("-")).alias("top_error_path"),
        F.coalesce("status.value", F.lit("-")).alias("top_status"),
        # no client at all is masked like any text that is not an IPv4 address
        mask_ip(F.coalesce("ip.value", F.lit("-"))).alias("top_ip_masked"),
    )


def incidents(
    logs: DataFrame | None, detected: DataFrame, baseline, width: str = "5 minutes", cells: DataFrame | None = None
) -> DataFrame:
    """Impact and causes of every incident, times as text; from the logs or their stored ``window_cells``."""
    windows = materialize(incident_windows(detected, width), "incident-windows")
    impact = incident_impact(windows, baseline, width)
    causes = causes_of_cells(window_cells(logs, width) if cells is None else cells, windows)
    return impact.join(causes, "incident_start", "left").select(
        minute_text(F.col("incident_start")).alias("start"),
        minute_text(F.col("incident_end")).alias("end"),
        *[c for c in impact.columns if c not in ("incident_start", "incident_end")],
        *[c for c in causes.columns if c != "incident_start"],
    )


def covering(points: DataFrame, intervals: DataFrame, ts: str = "timestamp", start: str = "start", end: str = "end") -> DataFrame:
    """Points with the intervals [start, end) that hold them: an equi-join for any boundaries, any number of points.

    An interval's level is the least power of two that is at least its length; it lies in at most a few buckets
    of that length. A point asks in one bucket of each level that occurs, of which there are at most 64. The
    exact bounds are checked after the join. Points in no interval keep nulls; one in several has a row for each.
    Empty and null intervals hold nothing.
    """
    low, high = _micros_of(F.col(start)), _micros_of(F.col(end))
    sound = intervals.where(F.col(start) < F.col(end))
    levels = sound.withColumn("_level", F.ceil(F.log2((high - low).cast("double"))).cast("int"))
    levels = materialize(levels, "intervals")
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_level"))
    buckets = F.sequence(F.floor(low / size), F.floor((high - 1) / size))
    dealt = levels.withColumn("_bucket", F.explode(buckets))
    present = [r["_level"] for r in levels.select("_level").distinct().collect()]  # at most 64
    key = materialize_id(points, "_point")
    at = _micros_of(F.col(ts))
    probes = F.array(
        *(F.struct(F.lit(n).alias("_level"), F.floor(at / F.lit(1 << n)).alias("_bucket")) for n in present)
    ) if present else F.array().cast("array<struct<_level:int,_bucket:bigint>>")
    asked = key.select("_point", ts, F.inline(probes))
    inside = (F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end))
    found = asked.join(dealt, ["_level", "_bucket"]).where(inside).drop("_level", "_bucket", ts)
    return key.join(found, "_point", "left").drop("_point")


def materialize_id(df: DataFrame, name: str) -> DataFrame:
    """The rows stored with a number each, so that every branch of a plan sees the same numbers."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def incident_at(found: DataFrame, moment: datetime) -> DataFrame:
    """The incident whose [start, end) holds a moment."""
    text = moment.strftime("%Y-%m-%d %H:%M:%S")
    return found.where((F.col("start") <= text) & (F.lit(text) < F.col("end"))).orderBy("start").limit(1)


def incident_kpi(tagged_counts: DataFrame, detected: DataFrame, found: DataFrame) -> DataFrame:
    """Report head: valid and invalid rows, anomalous windows, incidents."""
    return tagged_counts.select(
        F.col("valid").alias("valid_logs"),
        F.col("invalid").alias("invalid_logs"),
        detected.agg(F.count_if("is_anomaly").alias("c")).scalar().alias("anomaly_windows"),
        found.agg(F.count("*").alias("c")).scalar().alias("incident_count"),
    )
