"""Exact quantiles against brute force, with small sketches so that brackets are used."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.quantiles import Request, column_quantiles, nearest_rank, quantile_columns, quantile_requests, quantiles

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0]


def skewed(seed: int = 7) -> pd.DataFrame:
    """One group with far more than a third of the rows, heavy ties, far outliers."""
    rng = np.random.default_rng(seed)
    big = np.concatenate([rng.normal(100, 3, 9000), np.full(4000, 101.0), rng.normal(0, 1e6, 500)])
    return pd.DataFrame(
        {
            "g": ["hot"] * len(big) + ["cold"] * 800 + ["one"],
            "v": np.concatenate([big, rng.integers(0, 7, 800).astype(float), [42.0]]),
        }
    )


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_grouped_linear_equals_numpy(spark, accuracy):
    data = skewed()
    rows = spark.createDataFrame(data).repartition(5)
    found = {r["g"]: r for r in quantiles(rows, "v", PROBS, ["g"], accuracy=accuracy).collect()}
    for group, part in data.groupby("g")["v"]:
        assert found[group]["n"] == len(part)
        np.testing.assert_allclose(found[group]["quantiles"], np.quantile(part, PROBS), rtol=1e-12)


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_global_linear_equals_numpy(spark, accuracy):
    data = skewed(11)
    found = quantiles(spark.createDataFrame(data), "v", PROBS, accuracy=accuracy).first()
    np.testing.assert_allclose(found["quantiles"], np.quantile(data["v"], PROBS), rtol=1e-12)


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_nearest_rank(spark, accuracy):
    data = skewed(3)
    found = {
        r["g"]: r["q"]
        for r in quantile_columns(
            spark.createDataFrame(data), "v", {"q": 0.95}, ["g"], how="nearest", accuracy=accuracy
        ).collect()
    }
    for group, part in data.groupby("g")["v"]:
        values = np.sort(part.to_numpy())
        assert found[group] == values[int(np.floor((len(values) - 1) * 0.95 + 0.5))]


def test_nearest_of_one_to_ten(spark):
    assert quantiles(spark.range(1, 11), "id", [0.95], how="nearest").first()["quantiles"] == [10.0]


def test_attached_lookup_is_stored_and_not_tied_to_a_size(spark):
    from millrace.session import attach

    rows = spark.range(5000).select((F.col("id") % 50).alias("g"), F.col("id").alias("v"))
    lookup = rows.groupBy("g").agg(F.count("*").alias("n"))
    assert attach(rows, lookup, ["g"]).where("n = 100").count() == 5000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert attach(rows, lookup, ["g"]).where("n = 100").count() == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_values_and_keys_are_left_out(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), (None, 5.0), ("a", 3.0)], "g string, v double")
    assert [(r["g"], r["n"], r["quantiles"]) for r in quantiles(rows, "v", [0.5], ["g"]).collect()] == [("a", 2, [2.0])]


def test_no_rows_give_null(spark):
    row = quantiles(spark.range(0), "id", [0.5]).first()
    assert row["n"] is None and row["quantiles"] == [None]


def test_column_quantiles(spark):
    rows = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None)], "a int, b double")
    found = {r["column"]: r["quantiles"] for r in column_quantiles(rows, ["a", "b"], [0.5]).collect()}
    assert found == {"a": [2.0], "b": [15.0]}


def test_approximate_is_close(spark):
    found = quantiles(spark.range(100_001), "id", [0.5], approx=True).first()["quantiles"][0]
    assert abs(found - 50_000) <= 20


def test_arguments(spark):
    with pytest.raises(ValueError):
        quantiles(spark.range(3), "id", [1.5])
    with pytest.raises(ValueError):
        quantiles(spark.range(3), "id", [0.5], how="lower")


def test_several_requests_share_one_search(spark):
    data = skewed().assign(w=lambda d: np.arange(len(d)) % 97, h=lambda d: np.where(np.arange(len(d)) % 5 == 0, None, "x"))
    rows = spark.createDataFrame(data, "g string, v double, w bigint, h string").repartition(4)
    requests = [Request("a", "v", (0.5, 0.95), ("g",)), Request("b", "w", (0.25, 0.75)), Request("c", "v", (0.5,), ("h", "g")), Request("none", "v", (0.1,), ("h",))]
    found = quantile_requests(rows, requests, accuracy=200)
    for r in found["a"].collect():
        part = data[data.g == r["g"]].v
        assert (r["n"], r["q0"], r["q1"]) == (len(part), pytest.approx(np.quantile(part, 0.5)), pytest.approx(np.quantile(part, 0.95)))
    whole = found["b"].first()
    assert found["b"].columns == ["n", "q0", "q1"] and (whole["q0"], whole["q1"]) == (np.quantile(data.w, 0.25), np.quantile(data.w, 0.75))
    keyed = data[data.h == "x"]
    assert {(r["h"], r["g"]): r["q0"] for r in found["c"].collect()} == {
        ("x", g): pytest.approx(np.quantile(part.v, 0.5)) for g, part in keyed.groupby("g")
    }
    assert found["none"].first()["q0"] == pytest.approx(np.quantile(keyed.v, 0.1)) and found["none"].count() == 1


def test_nearest_rank_of_counted_values(spark):
    rng = np.random.default_rng(2)
    rows = [(g, int(x)) for g, top, n in (("a", 10**6, 500), ("b", 5, 300), ("c", 10**12, 1)) for x in rng.integers(0, top, n)]
    counted = spark.createDataFrame(rows, "g string, x bigint").groupBy("g", "x").agg(F.count("*").alias("n"))
    for p in (0.0, 0.5, 0.95, 1.0):
        got = {r["g"]: r["value"] for r in nearest_rank(counted, "x", "n", p, ["g"]).collect()}
        for g in "abc":
            values = sorted(x for k, x in rows if k == g)
            assert got[g] == values[int(np.floor((len(values) - 1) * p + 0.5))]
