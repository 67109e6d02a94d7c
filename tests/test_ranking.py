import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.ranking import hash_parts, running_totals, stratified_folds, stratified_split


def test_running_totals_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"s": np.unique(rng.normal(size=3000)), "a": 1, "b": 2})
    data["a"] = rng.integers(0, 5, len(data))
    found = running_totals(spark.createDataFrame(data), "s", ["a", "b"], ranges=16).toPandas()
    expected = data.sort_values("s", ascending=False)
    expected["cum_a"], expected["cum_b"] = expected["a"].cumsum(), expected["b"].cumsum()
    merged = found.merge(expected, on="s", suffixes=("", "_x"))
    assert len(merged) == len(data)
    assert (merged["cum_a"] == merged["cum_a_x"]).all() and (merged["cum_b"] == merged["cum_b_x"]).all()


def test_running_totals_of_one_value_and_of_none(spark):
    one = spark.createDataFrame([(0.5, 3)], "s double, a long")
    assert running_totals(one, "s", ["a"]).first()["cum_a"] == 3
    assert running_totals(one.where("a < 0"), "s", ["a"]).count() == 0


def skewed_classes(spark, n=7003):
    return spark.range(n).select(F.col("id"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("y"))


def test_split_has_exact_sizes_and_is_a_partition(spark):
    rows = skewed_classes(spark)
    parts = stratified_split(rows, "id", "y").toPandas()
    assert len(parts) == 7003 and parts["id"].is_unique
    for _, group in parts.groupby("y"):
        assert (group["split"] == "train").sum() == int(np.floor(len(group) * 0.8))


def test_split_repeats_and_depends_on_the_seed(spark):
    rows = skewed_classes(spark, 500)
    first, again = stratified_split(rows, "id", "y"), stratified_split(rows.repartition(3), "id", "y")
    assert first.exceptAll(again).isEmpty()
    assert not first.exceptAll(stratified_split(rows, "id", "y", seed=1)).isEmpty()


@pytest.mark.parametrize("n", [3, 501, 7003])
def test_folds_differ_by_at_most_one(spark, n):
    parts = stratified_folds(skewed_classes(spark, n), "id", "y", 5).toPandas()
    assert len(parts) == n and parts["fold"].between(0, 4).all()
    for _, group in parts.groupby("y"):
        sizes = group["fold"].value_counts().reindex(range(5), fill_value=0).tolist()
        assert sizes == [len(group) // 5 + (f < len(group) % 5) for f in range(5)]


def test_hash_parts_follow_the_hash_order(spark):
    rows = skewed_classes(spark, 2000)
    cut = hash_parts(rows, "id", "y", [lambda n: F.floor(n / 3)], 9, "p")
    data = cut.withColumn("h", F.xxhash64(F.lit(9), "id")).toPandas()
    for _, group in data.groupby("y"):
        assert group.loc[group["p"] == 0, "h"].max() < group.loc[group["p"] == 1, "h"].min()


def test_arguments(spark):
    with pytest.raises(ValueError):
        stratified_split(spark.range(3), "id", "id", 1.0)
    with pytest.raises(ValueError):
        stratified_folds(spark.range(3), "id", "id", 1)
