from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.models.forest import IsolationForest, fit_forest, forest_sql
from millrace.operators import incidents as inc
from millrace.operators import windows as win
from millrace.plans import detection
from millrace.session import materialize, scratch_path

START = datetime(2025, 3, 5, 14, 0)
LOGS = "timestamp timestamp_ntz, path string, status long, ip string, bytes long"
SCENARIO = {
    "incident_start": START,
    "incident_end": START + timedelta(minutes=30),
    "incident_path": "/api/v1/search",
    "traffic_multiplier": 5,
}
OPTIONS = detection.DetectionOptions(**SCENARIO)


def minute(n):
    return START + timedelta(minutes=n)


def test_injection_copies_the_hit_rows_only(spark):
    rows = [(minute(1), "/api/v1/search", 200, "10.0.0.1", 1), (minute(2), "/api/v1/search", 200, "10.0.0.2", 1), (minute(3), "/health", 200, "10.0.0.3", 1)]
    logs = spark.createDataFrame(rows, LOGS)
    out = win.inject_incident(logs, "/api/v1/search", START, minute(30), 3)
    assert out.count() == 7
    hit = out.where("path = '/api/v1/search'")
    assert hit.count() == 6 and hit.where("status <> 503").count() == 0
    assert logs.where("status = 503").count() == 0
    with pytest.raises(ValueError, match="empty"):
        win.inject_incident(logs, "/none", START, minute(30), 3)
    with pytest.raises(ValueError):
        win.inject_incident(logs, "/health", START, minute(30), 0)


def test_window_features(spark):
    rows = [(minute(i / 3), "/a", 503 if i < 2 else 200, f"10.0.0.{i}", i + 1) for i in range(10)]
    row = win.window_features(spark.createDataFrame(rows, LOGS), "5 minutes").collect()
    assert len(row) == 1
    found = row[0].asDict()
    assert found == {
        "timestamp": START, "request_count": 10, "error_5xx_count": 2, "error_rate_5xx": 0.2,
        "unique_ips": 10, "avg_bytes": 5.5, "p95_bytes": 10.0, "path_count": 1,
    }


def test_windows_are_closed_on_the_left(spark):
    rows = [(minute(0), "/a", 200, "i", 1), (minute(5), "/a", 200, "i", 1), (minute(14.99), "/a", 200, "i", 1)]
    found = win.window_features(spark.createDataFrame(rows, LOGS), "5 minutes").orderBy("timestamp").collect()
    assert [r["timestamp"] for r in found] == [minute(0), minute(5), minute(10)]


def feature_rows(spark, count=150, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(count + 3):
        extreme = i >= count
        requests = 1000.0 if extreme else float(rng.normal(100, 3))
        rate = 0.8 if extreme else float(rng.normal(0.08, 0.005))
        rows.append((minute(5 * (i - count)), requests, requests * rate, rate, *[float(rng.normal(m, s)) for m, s in ((80, 3), (5000, 50), (9000, 90))], 10.0))
    schema = "timestamp timestamp_ntz, request_count double, error_5xx_count double, error_rate_5xx double, unique_ips double, avg_bytes double, p95_bytes double, path_count double"
    return spark.createDataFrame(rows, schema)


def test_forest_flags_the_extreme_windows(spark):
    features = feature_rows(spark)
    forest = detection.fit_detector(features, OPTIONS)
    detected = win.flag_anomalies(forest.score(features), START, 0.999).orderBy("timestamp").collect()
    assert [r["is_anomaly"] for r in detected[-3:]] == [True] * 3
    assert sum(r["is_anomaly"] for r in detected[:-3]) == 1
    assert all(0 < r["anomaly_score"] <= 1 for r in detected)


def test_forest_repeats_and_survives_storage(spark):
    features = feature_rows(spark)
    baseline = features.where(F.col("timestamp") < F.lit(START))
    a = fit_forest(baseline, win.FEATURES, "timestamp", trees=20)
    b = fit_forest(baseline.repartition(7), win.FEATURES, "timestamp", trees=20)
    assert a.nodes.sort_values(["tree", "node"]).reset_index(drop=True).equals(b.nodes.sort_values(["tree", "node"]).reset_index(drop=True))
    path = scratch_path(spark, "forest-test")
    a.attributes = {"window": "5 minutes"}
    a.save(spark, path)
    loaded = IsolationForest.load(spark, path)
    assert loaded.attributes == {"window": "5 minutes"} and list(loaded.features) == list(win.FEATURES)
    both = loaded.score(a.score(features), "again")
    assert both.where("abs(again - anomaly_score) > 1e-12").count() == 0


def test_every_tree_sees_exactly_the_sample_size(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), F.rand(1).alias("x"))
    forest = fit_forest(rows, ["x"], "k", trees=10, sample_size=64)
    assert set(forest.sample_sizes.values()) == {64} and len(forest.sample_sizes) == 10
    # more isolated points get higher scores
    scored = forest.score(spark.createDataFrame([(0.5,), (50.0,)], "x double")).orderBy("x").collect()
    assert scored[0]["anomaly_score"] < scored[1]["anomaly_score"]


def test_detector_guards(spark):
    with pytest.raises(ValueError, match="100"):
        detection.fit_detector(feature_rows(spark, 50), OPTIONS)
    with pytest.raises(ValueError, match="missing"):
        detection.fit_detector(feature_rows(spark).withColumn("avg_bytes", F.lit(None).cast("double")), OPTIONS)


def test_evaluation(spark):
    rows = [(minute(5 * i), f) for i, f in enumerate([True, True, False, True])]
    detected = spark.createDataFrame(rows, "timestamp timestamp_ntz, is_anomaly boolean")
    row = win.detection_metrics(detected, START, minute(15)).first()
    assert row["true_positive_windows"] == 2
    assert row["precision"] == pytest.approx(2 / 3) and row["recall"] == pytest.approx(2 / 3) and row["f1"] == pytest.approx(2 / 3)
    none = win.detection_metrics(detected, None, None).first()
    assert (none["precision"], none["recall"], none["f1"], none["predicted_windows"]) == (0.0, 0.0, 0.0, 3)


def detected_windows(spark):
    errors = [40, 35, 8, 8, 8, 8, 20]
    rows = [(minute(5 * i), 100, e, e / 100, 0.9 if i in (0, 1, 6) else 0.1, i in (0, 1, 6)) for i, e in enumerate(errors)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, request_count long, error_5xx_count long, error_rate_5xx double, anomaly_score double, is_anomaly boolean")


def incident_logs(spark):
    rows = [(minute(0), "/api/v1/search", 503, "192.168.0.10", 1)] * 10 + [(minute(30), "/health", 500, "10.0.0.2", 1)]
    return spark.createDataFrame(rows, LOGS)


def test_incidents_merge_neighbours_and_find_causes(spark):
    found = inc.incidents(incident_logs(spark), detected_windows(spark), 0.08).orderBy("start").collect()
    assert len(found) == 2
    first, second = (r.asDict() for r in found)
    assert (first["start"], first["end"]) == ("2025-03-05 14:00:00", "2025-03-05 14:10:00")
    assert (first["window_count"], first["severity"], first["max_error_rate"]) == (2, "CRITICAL", 0.4)
    assert (first["top_error_path"], first["top_status"], first["top_ip_masked"]) == ("/api/v1/search", "503", "192.168.0.***")
    assert (first["request_count"], first["error_count"]) == (200, 75) and first["excess_errors"] == pytest.approx(59.0)
    assert (second["top_error_path"], second["severity"]) == ("/health", "HIGH")


def test_incidents_equal_session_windows(spark):
    flagged = detected_windows(spark).where("is_anomaly").withColumn("t", F.col("timestamp").cast("timestamp"))
    sessions = flagged.groupBy(F.session_window("t", "5 minutes").alias("s")).count().select("s.start", "s.end", "count").collect()
    windows = inc.incident_windows(detected_windows(spark))
    own = inc.incident_impact(windows, 0.0).select("incident_start", "incident_end", "window_count").collect()
    assert sorted(map(tuple, sessions)) == sorted(map(tuple, own))


def test_no_anomalies_and_no_related_logs(spark):
    quiet = detected_windows(spark).withColumn("is_anomaly", F.lit(False))
    assert inc.incidents(incident_logs(spark), quiet, 0.08).count() == 0
    found = inc.incidents(incident_logs(spark).where("status = 1"), detected_windows(spark), 0.08).first()
    assert (found["top_error_path"], found["top_status"], found["top_ip_masked"]) == ("-", "-", "masked")


def test_incident_at(spark):
    found = inc.incidents(incident_logs(spark), detected_windows(spark), 0.08)
    assert inc.incident_at(found, START).first()["start"] == "2025-03-05 14:00:00"
    assert inc.incident_at(found, minute(10)).count() == 0


@pytest.mark.parametrize(
    "wrong",
    [{"window": "0 minutes"}, {"anomaly_quantile": 1.0}, {"incident_end": START}, {"traffic_multiplier": 0}],
)
def test_options(wrong):
    with pytest.raises(ValueError):
        detection.DetectionOptions(**{**SCENARIO, **wrong})


def raw_logs(spark, n=200_000, seed=0):
    """Traffic as published: 0 to 5 s between requests, ten paths, 8 % server errors; all texts."""
    rng = np.random.default_rng(seed)
    at = np.datetime64("2025-03-01T00:00:00") + rng.integers(0, 6, n).cumsum().astype("timedelta64[s]")
    octets = [rng.integers(1, 224, n), rng.integers(0, 256, n), rng.integers(0, 256, n), rng.integers(1, 255, n)]
    paths = np.array(["/api/v1/search", *[f"/p{i}" for i in range(9)]])
    statuses = np.array(["200"] * 80 + ["301", "302", "404", "500", "503"] * 4)
    data = pd.DataFrame(
        {
            "n": np.arange(n),
            "ip": pd.DataFrame(octets).T.astype(str).agg(".".join, axis=1),
            "timestamp": np.datetime_as_string(at, unit="s"),
            "method": "GET",
            "path": rng.choice(paths, n),
            "status": rng.choice(statuses, n),
            "bytes": rng.integers(120, 250_001, n).astype(str),
            "user_agent": "agent/1.0",
        }
    )
    return spark.createDataFrame(data)


def test_whole_job_finds_the_injected_incident(spark):
    """The published scenario: recall 100 %, threshold 0.648, maximum rate 45 %.

    The measures depend on what is drawn, as the threshold is an extreme of the baseline: over five seeds of the
    forest the recall on this traffic was 0.5, 1.0, 1.0, 1.0 and 1.0, so the middle one of three counts.
    """
    bad = raw_logs(spark, 3).withColumn("ip", F.lit("999.1.1.1"))
    result = detection.detect(raw_logs(spark).unionByName(bad), "n", OPTIONS)
    assert tuple(result.counts.first()) == (200_003, 200_000, 3)
    assert result.detected.count() == 1667
    recalls = [result.metrics.first()["recall"]]
    features = result.detected.drop("anomaly_score", "is_anomaly")
    for seed in (1, 2):
        forest = detection.fit_detector(features, replace(OPTIONS, seed=seed))
        flagged = win.flag_anomalies(materialize(forest.score(features), "scored"), START, 0.999)
        recalls.append(win.detection_metrics(flagged, START, minute(30)).first()["recall"])
    assert sorted(recalls)[1] >= 0.9
    threshold = win.score_threshold(result.detected, START).first()[0]
    assert threshold == pytest.approx(0.648, abs=0.03)
    assert result.baseline.first()[0] == pytest.approx(0.08, abs=0.005)
    during = result.incidents.where("start < '2025-03-05 14:30:00' AND end > '2025-03-05 14:00:00'")
    hit = during.orderBy(F.desc("max_error_rate")).first()
    assert (hit["severity"], hit["top_error_path"], hit["top_status"]) == ("CRITICAL", "/api/v1/search", "503")
    folder = scratch_path(spark, "detection-test")
    detection.save(result, folder, OPTIONS)
    assert spark.read.json(f"{folder}/invalid_logs").count() == 3
    assert spark.read.json(f"{folder}/incidents").count() == result.incidents.count()
    head = detection.report_head(result).first()
    assert head["invalid_logs"] == 3 and head["incident_count"] == result.incidents.count()


@pytest.mark.parametrize("span", [1, 2, 3, 50])
def test_incidents_stitched_over_ranges_equal_one_scan(spark, monkeypatch, span):
    monkeypatch.setattr(inc, "RANGE", span)
    rng = np.random.default_rng(span)
    flags = rng.random(120) < 0.7
    flags[20:60] = True  # an incident over many ranges
    rows = [(minute(5 * i), bool(f)) for i, f in enumerate(flags) if f or rng.random() < 0.5]
    detected = spark.createDataFrame(rows, "timestamp timestamp_ntz, is_anomaly boolean").repartition(4)
    start, want, last = None, {}, None
    for t, flag in rows:
        if flag:
            start = t if last is None or t - last > timedelta(minutes=5) else start
            want[t] = start
            last = t
    windows = inc.incident_windows(detected)
    assert {r["timestamp"]: r["incident_start"] for r in windows.collect()} == want
    plan = windows._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_covering_intervals_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    spans = []
    for i in range(60):
        low = START + timedelta(microseconds=int(rng.integers(0, 4 * 10**9)))
        spans.append((low, low + timedelta(microseconds=int(10 ** rng.uniform(0, 9.5))), i))
    spans += [(START, START, 100), (minute(9), minute(1), 101), (None, minute(3), 102), (START, None, 103)]
    points = [(k, START + timedelta(microseconds=int(rng.integers(0, 5 * 10**9)))) for k in range(400)]
    points += [(1000 + i, low) for low, _, i in spans[:60]] + [(2000 + i, high) for _, high, i in spans[:60]] + [(5000, None), (5000, START)]
    got = inc.covering(
        spark.createDataFrame(points, "k long, timestamp timestamp_ntz"), spark.createDataFrame(spans, "start timestamp_ntz, end timestamp_ntz, i long")
    )
    want = []
    for k, t in points:
        hits = [i for low, high, i in spans if t is not None and low is not None and high is not None and low <= t < high]
        want += [(k, i) for i in hits] or [(k, None)]
    key = lambda x: (x[0], -1 if x[1] is None else x[1])
    assert sorted(((r["k"], r["i"]) for r in got.collect()), key=key) == sorted(want, key=key)
    none = inc.covering(spark.createDataFrame(points, "k long, timestamp timestamp_ntz"), spark.createDataFrame([], "start timestamp_ntz, end timestamp_ntz, i long"))
    assert none.count() == len(points) and none.where("i is not null").count() == 0


def test_forest_equals_its_sql_statement(spark):
    import duckdb

    features = feature_rows(spark, 400)
    names = list(win.FEATURES)
    baseline = features.where(F.col("timestamp") < F.lit(START))
    for size, trees in ((64, 7), (256, 3)):  # 400 rows: every tree draws its sample
        forest = fit_forest(baseline, names, "timestamp", trees=trees, sample_size=size, seed=5)
        got = {r["timestamp"]: r["anomaly_score"] for r in forest.score(features).collect()}
        con = duckdb.connect()
        con.register("rows", features.toPandas())
        sql = forest_sql("features", f"timestamp < TIMESTAMP '{START}'", names, "timestamp", trees, size, 5)
        found = con.execute(f"WITH features AS (SELECT * FROM rows), {sql} SELECT timestamp, anomaly_score FROM scored").fetchall()
        assert len(found) == len(got) == 403
        assert all(score == pytest.approx(got[t], abs=1e-12) for t, score in found)
