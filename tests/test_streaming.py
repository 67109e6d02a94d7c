import pytest
from pyspark.sql import functions as F

from millrace.operators import counting, windows
from millrace.operators.contracts import WEB_LOG
from millrace.plans.sales_report import sales_report
from millrace.plans.sales_state import SalesState
from millrace.session import scratch_path
from millrace.streaming import logs as stream
from millrace.workload import views as v


def source(spark, sf, tmp_path, parts=3):
    """Log rows in several files, in time order, one file per micro-batch."""
    events = v.web_logs(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    folder = str(tmp_path / "logs")
    ordered = events.withColumn("part", F.expr(f"cast((unix_timestamp(timestamp) - 1704067200) div {30 * 86400 // parts + 1} as int)"))
    for i in range(parts):
        ordered.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(folder)
    return stream.read_stream(spark, folder, events.schema, "*.parquet", per_trigger=1), events


def test_counters_over_several_batches(spark, sf, tmp_path):
    rows, events = source(spark, sf, tmp_path)
    found = stream.run_to_table(stream.running_counts(rows, "status"), "t", "complete")
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in counting.count_by(events, "status").collect()}


def test_closed_windows_equal_the_batch_result(spark, sf, tmp_path):
    rows, events = source(spark, sf, tmp_path)
    found = {r["timestamp"]: r for r in stream.window_features(rows, "1 hour").collect()}
    batch = {r["timestamp"]: r for r in windows.window_features(events, "1 hour").collect()}
    assert len(batch) - 3 <= len(found) < len(batch)
    # all seven features, none of them a sketch
    assert all(row == batch[start] for start, row in found.items())


def test_quarantine_stores_every_row_once(spark, sf, tmp_path):
    raw = v.raw_logs(spark, sf)
    folder = scratch_path(spark, "quarantine-test")
    raw.repartition(3).write.parquet(f"{folder}/raw")
    rows = stream.read_stream(spark, f"{folder}/raw", raw.schema, "*.parquet", per_trigger=1)
    outputs = [f"{folder}/{part}" for part in ("valid", "invalid", "manifest")]
    for _ in range(2):  # the second run finds nothing new
        stream.quarantine(rows, WEB_LOG, "event_id", *outputs, f"{folder}/checkpoint").awaitTermination()
    valid = stream.committed(spark, outputs[0], outputs[2], "event_id bigint, batch bigint")
    invalid = stream.committed(spark, outputs[1], outputs[2], "row_no bigint, batch bigint").select(F.col("row_no").alias("event_id"))
    assert valid.union(invalid).exceptAll(raw.select("event_id")).isEmpty()
    assert valid.count() + invalid.count() == raw.count()
    told = stream.manifest(spark, outputs[2]).agg(F.sum("valid"), F.sum("invalid"), F.sum("total")).first()
    assert tuple(told) == (valid.count(), invalid.count(), raw.count())


def test_a_batch_that_dies_between_its_two_writes_is_not_seen(spark, sf, tmp_path, monkeypatch):
    raw = v.raw_logs(spark, sf)
    folder = scratch_path(spark, "quarantine-killed")
    raw.repartition(3).write.parquet(f"{folder}/raw")
    rows = stream.read_stream(spark, f"{folder}/raw", raw.schema, "*.parquet", per_trigger=1)
    outputs = [f"{folder}/{part}" for part in ("valid", "invalid", "manifest")]
    calls = []

    class Dying(type(WEB_LOG)):
        def invalid(self, tagged, position, *more):
            calls.append(position)
            found = super().invalid(tagged, position, *more)
            return found.where(F.raise_error(F.lit("killed")).isNull()) if len(calls) == 2 else found

    dying = Dying(WEB_LOG.fields)
    query = stream.quarantine(rows, dying, "event_id", *outputs, f"{folder}/checkpoint")
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination()
    # the second batch's valid rows are stored, and not seen
    seen = stream.committed(spark, outputs[0], outputs[2], "event_id bigint, batch bigint")
    assert spark.read.parquet(outputs[0]).count() > seen.count() > 0
    assert stream.manifest(spark, outputs[2]).count() == 1
    stream.quarantine(rows, WEB_LOG, "event_id", *outputs, f"{folder}/checkpoint").awaitTermination()
    valid = stream.committed(spark, outputs[0], outputs[2], "event_id bigint, batch bigint")
    invalid = stream.committed(spark, outputs[1], outputs[2], "row_no bigint, batch bigint").select(F.col("row_no").alias("event_id"))
    both = valid.union(invalid)
    assert both.exceptAll(raw.select("event_id")).isEmpty() and both.count() == raw.count()


def test_alert_sessions(spark, tmp_path):
    times = [0, 5, 10, 40, 300]
    rows = [(f"2025-01-01 0{m // 60}:{m % 60:02d}:01", "/a", 503) for m in times] + [("2025-01-01 00:20:00", "/a", 200)]
    frame = spark.createDataFrame(rows, "t string, path string, status int").select(
        F.col("t").cast("timestamp").alias("timestamp"), "path", "status"
    )
    folder = str(tmp_path / "in")
    frame.coalesce(1).write.parquet(folder)
    alerts = stream.alert_sessions(stream.read_stream(spark, folder, frame.schema, "*.parquet"), "path", 0.5)
    found = stream.run_to_table(alerts, "t").orderBy("start").collect()
    assert [(str(r["start"]), r["window_count"]) for r in found] == [("2025-01-01 00:00:00", 3), ("2025-01-01 00:40:00", 1)]


def test_report_covers_all_batches(spark, sf):
    from millrace.workload import sales, streams

    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # many files, so many batches
    try:
        whole = sorted(map(tuple, sales.sales_report(spark, sf).collect()))
        assert sorted(map(tuple, streams.stream_report(spark, sf, per_trigger=1).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_streams_read_files_and_folders_alike(spark, sf, tmp_path):
    from millrace.workload import streams

    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    for query in (streams.stream_counts, streams.stream_windows, streams.stream_quarantine):
        assert sorted(map(tuple, query(spark, str(tmp_path)).collect())) == sorted(map(tuple, query(spark, sf).collect()))


def test_a_stream_without_input_gives_an_empty_table(spark, tmp_path):
    from millrace.streaming import logs as stream

    (tmp_path / "none").mkdir()
    arriving = stream.read_stream(spark, str(tmp_path / "none"), spark.range(0).schema)
    assert stream.run_to_table(arriving, "none").count() == 0


def test_incremental_report_equals_the_report_over_all_sales(spark, sf, tmp_path):
    sales = v.sales_table(spark, sf).select("category", "quantity", "unit_price", "discount")
    parts = [sales.where(F.abs(F.xxhash64("unit_price", "quantity", F.col("discount"))) % 3 == k) for k in range(3)]
    folder = scratch_path(spark, "report-test")
    state = SalesState(spark, f"{folder}/state")
    with pytest.raises(Exception):
        state.report()
    seen = parts[0].limit(0)
    for k, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{folder}/in/{k}")
        arriving = stream.read_stream(spark, f"{folder}/in/*", sales.schema, "*.parquet", per_trigger=1)
        query = stream.each_batch(arriving, state.add, f"{folder}/checkpoint")
        query.awaitTermination()
        # a run reads what has arrived since the last one, and nothing before it
        assert sum(p["numInputRows"] for p in query.recentProgress) == part.count()
        seen = seen.union(part)
        want = [tuple(r) for r in sales_report(seen).orderBy("rank").collect()]
        assert [tuple(r) for r in state.report().orderBy("rank").collect()] == want
    # a batch that comes again counts once; one without its line in the manifest is not seen
    state.add(parts[2], 2)
    assert [tuple(r) for r in state.report().orderBy("rank").collect()] == want
    parts[0].groupBy("quantity").agg(F.count("*").alias("n")).write.parquet(f"{folder}/state/quantities/batch=9")
    assert [tuple(r) for r in state.report().orderBy("rank").collect()] == want


def test_sales_without_what_the_report_needs_end_their_batch(spark):
    state = SalesState(spark, scratch_path(spark, "report-bad"))
    schema = "category string, quantity bigint, unit_price double, discount double"
    with pytest.raises(Exception, match="missing after cleaning"):
        state.add(spark.createDataFrame([("a", None, 1.0, 0.0)], schema), 0)
    state.add(spark.createDataFrame([("a", 1, None, 0.0), ("b", 2, 5.0, 0.0), ("b", 2, 5.0, 0.0)], schema), 0)
    with pytest.raises(Exception, match="group median"):
        state.report().collect()
    state.add(spark.createDataFrame([("a", 3, 7.0, 0.5), ("a", 1, -4.0, 0.0)], schema), 1)
    rows = {r["category"]: r["amount"] for r in state.report().collect()}
    assert rows == {"total": 44.5, "a": 24.5, "b": 20.0}
