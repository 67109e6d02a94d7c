import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from millrace.functions.pvalues import chi_square_tail, regularized_beta, t_two_sided
from millrace.models import churn, growing, preparation, scoring, trees
from millrace.operators import hypothesis
from millrace.session import scratch_path


def test_tail_probabilities():
    # closed forms: t with 1 and 2 degrees of freedom, chi-square with 2, 4 and 1
    for t in (0.1, 1.0, 3.0, 50.0):
        assert t_two_sided(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-9)
        assert t_two_sided(-t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-8)
    for x in (0.01, 1.0, 9.0, 80.0):
        assert chi_square_tail(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-9)
        assert chi_square_tail(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-9)
        assert chi_square_tail(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-8)
    assert regularized_beta(2, 3, 0.4) == pytest.approx(0.5248, rel=1e-9)
    # table values
    assert t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert chi_square_tail(3.841, 1) == pytest.approx(0.05, abs=1e-4)
    # large degrees of freedom approach the normal distribution
    assert t_two_sided(1.959964, 1e7) == pytest.approx(0.05, abs=1e-6)


def test_welch(spark):
    a, b = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9], [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0]
    rows = spark.createDataFrame([(1, x) for x in a] + [(0, x) for x in b] + [(0, None)], "g int, x double")
    found = hypothesis.welch_t(rows, "x", "g")
    va, vb = np.var(a, ddof=1) / len(a), np.var(b, ddof=1) / len(b)
    assert found["t_statistic"] == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(va + vb))
    assert found["dof"] == pytest.approx((va + vb) ** 2 / (va**2 / 5 + vb**2 / 7))
    assert 0.05 < found["p_value"] < 0.5 and not found["significant"]
    with pytest.raises(ValueError):
        hypothesis.welch_t(rows.where("g = 0"), "x", "g")


def test_chi_square_agrees_with_mllib(spark):
    rows = spark.range(900).select(
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("r"),
        (F.xxhash64("id") % 5 > F.col("id") % 3 - 1).cast("int").alias("c"),
    )
    found = hypothesis.chi_square(rows, "r", "c")
    indexed = StringIndexer(inputCol="r", outputCol="i").fit(rows).transform(rows)
    vectors = VectorAssembler(inputCols=["i"], outputCol="f").transform(indexed)
    other = ChiSquareTest.test(vectors, "f", "c").first()
    assert found["chi2_statistic"] == pytest.approx(other["statistics"][0])
    assert found["dof"] == other["degreesOfFreedom"][0] == 2
    assert found["p_value"] == pytest.approx(other["pValues"][0], abs=1e-12)


def test_yates_correction_and_absent_cells(spark):
    def table(*cells):
        return spark.createDataFrame([(r, c) for r, c, n in cells for _ in range(n)], "r string, c int")

    two = hypothesis.chi_square(table(("a", 0, 10), ("a", 1, 20), ("b", 0, 30), ("b", 1, 5)), "r", "c")
    observed = np.array([[10, 20], [30, 5]])
    expected = observed.sum(1, keepdims=True) * observed.sum(0) / observed.sum()
    assert two["chi2_statistic"] == pytest.approx((((abs(observed - expected) - 0.5) ** 2) / expected).sum())
    absent = hypothesis.chi_square(table(("a", 0, 8), ("b", 1, 7)), "r", "c")
    e = np.array([[8 * 8, 8 * 7], [7 * 8, 7 * 7]]) / 15
    assert absent["chi2_statistic"] == pytest.approx((((abs(np.array([[8, 0], [0, 7]]) - e) - 0.5) ** 2) / e).sum())
    three = hypothesis.chi_square(table(("a", 0, 8), ("b", 1, 7), ("c", 0, 3), ("c", 1, 3)), "r", "c")
    o = np.array([[8, 0], [0, 7], [3, 3]])
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    assert three["chi2_statistic"] == pytest.approx(((o - e) ** 2 / e).sum())
    with pytest.raises(ValueError):
        hypothesis.chi_square(table(("a", 0, 3), ("b", 0, 3)), "r", "c")


def scores(spark, n=4000, seed=2):
    rng = np.random.default_rng(seed)
    label = (rng.random(n) < 0.2).astype(int)
    score = np.round(np.clip(rng.normal(0.3 + 0.2 * label, 0.15), 0, 1), 3)
    data = pd.DataFrame({"label": label, "score": score})
    return data, spark.createDataFrame(data)


def test_roc_auc(spark):
    data, rows = scores(spark)
    found = scoring.roc_auc(rows).first()[0]
    positive, negative = data.loc[data.label == 1, "score"].to_numpy(), data.loc[data.label == 0, "score"].to_numpy()
    wins = (positive[:, None] > negative).sum() + 0.5 * (positive[:, None] == negative).sum()
    assert found == pytest.approx(wins / len(positive) / len(negative))
    judge = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert found == pytest.approx(judge.evaluate(rows.withColumn("label", F.col("label").cast("double"))), abs=1e-9)
    assert scoring.roc_auc(rows.where("label = 1")).first()[0] is None


def test_curve_and_threshold(spark):
    data, rows = scores(spark)
    curve = scoring.pr_curve(rows)
    found = curve.toPandas().set_index("threshold")
    assert len(found) == data["score"].nunique()
    for t in list(found.index[:: max(1, len(found) // 25)]):
        taken = data[data["score"] >= t]
        assert found.loc[t, "precision"] == pytest.approx(taken["label"].mean())
        assert found.loc[t, "recall"] == pytest.approx(taken["label"].sum() / data["label"].sum())
    best = scoring.pick_threshold(curve, 0.60).first()
    assert best["threshold"] == found.index[found["recall"] >= 0.60].max()
    with pytest.raises(Exception, match="no threshold"):
        scoring.pick_threshold(curve.where("recall < 0.1"), 0.6).collect()


def test_report(spark):
    rows = spark.createDataFrame([(0, 0.1), (0, 0.9), (1, 0.8), (1, 0.2), (1, 0.7)], "label int, score double")
    found = {r["name"]: r for r in scoring.classification_report(rows, 0.5).collect()}
    assert (found["1"]["precision"], found["1"]["recall"], found["1"]["support"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert found["0"]["f1"] == pytest.approx(0.5) and found["accuracy"]["f1"] == pytest.approx(0.6)
    assert found["macro avg"]["f1"] == pytest.approx((2 / 3 + 0.5) / 2)
    assert found["weighted avg"]["recall"] == pytest.approx(0.6)
    none = {r["name"]: r for r in scoring.classification_report(rows, 2.0).collect()}
    assert none["1"]["precision"] == none["1"]["f1"] == 0.0


def test_preparation_learns_from_training_rows_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "b"), (4.0, None), (None, "a")], "x double, c string")
    fills = {r["column"]: r["fill"] for r in preparation.training_fills(train, ["x"], ["c"]).collect()}
    assert fills == {"x": "2.5", "c": "a"}
    model = preparation.preparation(["x"], ["c"]).fit(train)
    out = [r["features"].toArray().tolist() for r in model.transform(spark.createDataFrame([(None, "z"), (100.0, "b")], "x double, c string")).collect()]
    filled = np.array([1, 2, 3, 4, 2.5])
    scaled = (100 - filled.mean()) / filled.std()
    assert out[0] == pytest.approx([0.0, 0.0, 0.0]) and out[1] == pytest.approx([scaled, 0.0, 1.0])
    with pytest.raises(ValueError, match="x"):
        preparation.preparation(["x"], ["c"]).fit(train.withColumn("x", F.lit(None).cast("double")))


def test_standardize_uses_the_population_deviation(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "x double, k double")
    found = preparation.standardize(rows, ["x", "k"]).orderBy("x").collect()
    assert [r["x"] for r in found] == pytest.approx(((np.arange(1, 5) - 2.5) / np.arange(1, 5).std()).tolist())
    assert {r["k"] for r in found} == {0.0}


OPTIONS = churn.ChurnOptions(trees=10, depths=(3, 5), leaves=(5, 10), folds=3)


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(0)
    n = 600
    tenure = rng.integers(1, 72, n)
    contract = rng.choice(["month", "year", "two years"], n)
    p = 1 / (1 + np.exp(0.06 * tenure - 1.5 - 1.2 * (contract == "month")))
    data = pd.DataFrame(
        {
            "customer_id": [f"C{i:05d}" for i in range(n)],
            "gender": rng.choice(["F", "M"], n),
            "senior": rng.integers(0, 2, n),
            "tenure_months": tenure,
            "monthly_charges": rng.normal(70, 20, n),
            "total_charges": np.where(rng.random(n) < 0.02, np.nan, tenure * 70.0),
            "contract": contract,
            "payment_method": rng.choice(["card", "bank"], n),
            "num_services": rng.integers(1, 8, n),
            "churn": (rng.random(n) < p).astype(int),
        }
    )
    return spark.createDataFrame(data).withColumn("total_charges", F.nanvl("total_charges", F.lit(None)))


def test_churn_study(spark, customers):
    rows = churn.model_rows(customers, OPTIONS)
    train, test = churn.split_and_fold(rows, OPTIONS)
    assert train.count() + test.count() == 600
    depth, leaf, auc = churn.best_point(churn.grid_search(train, OPTIONS))
    assert depth in OPTIONS.depths and leaf in OPTIONS.leaves and auc > 0.65
    oof = churn.out_of_fold(train, depth, leaf, OPTIONS)
    assert oof.count() == train.count() == oof.select("customer_id").distinct().count()
    chosen = churn.choose_threshold(oof, OPTIONS).first()
    assert chosen["recall"] >= 0.60 and 0 < chosen["threshold"] < 1
    model = churn.fit_churn(train, depth, leaf, OPTIONS)
    assert churn.held_out_auc(model, test, OPTIONS).first()[0] > 0.6
    change = churn.largest_score_change(model, scratch_path(spark, "model-test"), test, OPTIONS).first()
    assert change["n_rows"] == test.count() and change["max_change"] == 0.0


def test_forests_grow_on_all_slots(spark, customers, monkeypatch):
    assert [churn.growing_tasks(n, 12) for n in (0, 480, 576_000, 3_000_000, 3_456_000)] == [1, 1, 12, 12, 24]
    monkeypatch.setattr(churn, "LEAST_ROWS", 20)
    slots = spark.sparkContext.defaultParallelism
    train, _ = churn.split_and_fold(churn.model_rows(customers.coalesce(1), OPTIONS), OPTIONS)
    fit_rows, held = churn.prepared_folds(train, OPTIONS)
    assert {f.rdd.getNumPartitions() for f in fit_rows.values()} == {held.rdd.getNumPartitions()} == {min(slots, -(-train.count() // 20))}
    assert held.count() == train.count() and fit_rows[0].count() == train.where("fold <> 0").count()


def test_labels_are_checked(customers):
    with pytest.raises(ValueError, match="0 or 1"):
        churn.model_rows(customers.withColumn("churn", F.lit(2)), OPTIONS)
    with pytest.raises(ValueError, match="missing"):
        churn.model_rows(customers.drop("gender"), OPTIONS)


def fitted_rows(spark, n=400):
    draw = np.random.default_rng(4)
    a, b, c = draw.normal(size=n), draw.integers(0, 2, n).astype(float), draw.integers(0, 6, n).astype(float)
    label = (a + b - 0.3 * c + draw.normal(size=n) > 0).astype(int)
    rows = spark.createDataFrame(pd.DataFrame({"key": np.arange(n), "a": a, "b": b, "c": c, "churn": label, "fold": np.arange(n) % 2}))
    # b carries the metadata of a feature with two values, as one-hot columns do
    indexed = StringIndexer(inputCol="b", outputCol="bi", stringOrderType="alphabetAsc").fit(rows).transform(rows)
    return VectorAssembler(inputCols=["a", "bi", "c"], outputCol="features").transform(indexed).cache()


def test_node_table_scores_as_the_forest_does(spark):
    rows = fitted_rows(spark)
    model = churn.forest(churn.ChurnOptions(trees=12), 5, 3).fit(rows)
    table = trees.node_table(model)
    dense = rows.withColumn("p", vector_to_array("features"))
    both = dense.select(
        "key", trees.cut_scores(dense, "p", "fold", {0: [table], 1: [table, table]}, [5, 0]).alias("s"), "fold"
    ).join(model.transform(rows).select("key", vector_to_array("probability")[1].alias("wanted")), "key").collect()
    assert len(both) == 400 and all(abs(r["s"][0] - r["wanted"]) < 1e-12 for r in both)
    # cut at the root every tree answers with its share of class 1; a fold may have several forests
    roots = table.share[table.roots].mean()
    assert all(abs(r["s"][1] - roots) < 1e-12 and len(r["s"]) == 2 + 2 * r["fold"] for r in both)


def test_a_cut_tree_predicts_as_one_grown_to_that_depth_where_nothing_is_drawn(spark):
    rows = fitted_rows(spark)

    def tree(depth):
        return RandomForestClassifier(
            labelCol="churn", numTrees=1, maxDepth=depth, featureSubsetStrategy="all", bootstrap=False, minInstancesPerNode=3, seed=1
        ).fit(rows)

    points = np.array([r["features"].toArray() for r in rows.collect()])
    deep, shallow = trees.node_table(tree(7)), trees.node_table(tree(3))
    cut, grown = deep.scores(points, [3])[:, 0], shallow.scores(points, [3, 7])
    assert np.array_equal(grown[:, 0], grown[:, 1])
    assert np.array_equal(cut > 0.5, grown[:, 0] > 0.5) and 0 < (cut > 0.5).mean() < 1
    # where MLlib has merged leaves of one class the cut tree is finer, elsewhere they agree
    assert (np.abs(cut - grown[:, 0]) < 1e-12).any()


def test_auc_by_group_equals_the_evaluator(spark):
    data, rows = scores(spark)
    grouped = rows.withColumn("g", (F.col("score") * 1000 % 3).cast("int")).union(
        spark.createDataFrame([(1, 0.5, 9), (1, 0.5, 9)], "label long, score double, g int")
    )
    found = {r["g"]: (r["roc_auc"], r["n"]) for r in scoring.roc_auc_by(grouped, ["g"]).collect()}
    for g in range(3):
        part = grouped.where(F.col("g") == g)
        assert found[g] == (pytest.approx(scoring.roc_auc(part).first()[0], abs=1e-12), part.count())
    assert found[9] == (None, 2)


def grown_by_hand(points, labels, weights, splits, leaf, depth, n_drawn, key, number=1):
    """(feature, split, left, right) or the share of class 1: one split after the other, on the values themselves."""
    n, ones = weights.sum(), weights[labels == 1].sum()

    def impurity(w, y):
        p = w[y == 1].sum() / w.sum()
        return 2 * p * (1 - p) * w.sum()

    best = (1e-9 * n, None)
    if depth and 0 < ones < n:
        for f in growing.drawn(np.array([number], dtype=np.uint64), len(splits), n_drawn, key)[0]:
            for cut in splits[f]:
                left = points[:, f] <= cut
                if weights[left].sum() >= leaf and weights[~left].sum() >= leaf:
                    sides = sum(impurity(weights[side], labels[side]) for side in (left, ~left))
                    gain = impurity(weights, labels) - sides
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut, left))
    if best[1] is None:
        return ones / n
    f, cut, left = best[1]
    ends = [
        grown_by_hand(points[side], labels[side], weights[side], splits, leaf, depth - 1, n_drawn, key, 2 * number + k)
        for k, side in enumerate((left, ~left))
    ]
    return (f, cut, *ends)


def as_pairs(tree, place=0):
    if tree.left[place] == place:
        return tree.share[place]
    return (tree.feature[place], tree.split[place], as_pairs(tree, tree.left[place]), as_pairs(tree, tree.right[place]))


def flat(tree):
    return [x for part in tree for x in flat(part)] if isinstance(tree, tuple) else [float(tree)]


def some_points(n=700):
    draw = np.random.default_rng(9)
    points = np.stack([draw.normal(size=n), draw.integers(0, 2, n), draw.integers(0, 6, n), draw.integers(0, 90, n), draw.integers(0, 2, n)], 1).astype(float)
    labels = (points[:, 0] + points[:, 1] - 0.3 * points[:, 2] + draw.normal(size=n) > 0.5).astype(int)
    splits = [growing.thresholds(*growing.points_of(points[:, f])) for f in range(points.shape[1])]
    return points, labels, growing._COUNTS[draw.integers(0, 65_536, n)], splits


@pytest.mark.parametrize("at_once", [growing.MOST_NODES, 3])
def test_trees_grown_in_tasks_equal_those_by_hand(monkeypatch, at_once):
    monkeypatch.setattr(growing, "MOST_NODES", at_once)
    points, labels, counts, splits = some_points()
    codes, leaves = growing.coded(points, labels, splits), (3, 8, 30)
    together = growing.grow(codes, counts, splits, leaves, 6, 3, 77)
    inside = counts > 0
    for leaf, tree in zip(leaves, together):
        hand = grown_by_hand(points[inside], labels[inside], counts[inside].astype(float), splits, leaf, 6, 3, 77)
        assert flat(as_pairs(tree)) == pytest.approx(flat(hand))
        assert as_pairs(tree) == as_pairs(growing.grow(codes, counts, splits, [leaf], 6, 3, 77)[0])
    assert len({len(t.share) for t in together}) == 3 and 5 < len(together[2].share) < len(together[0].share)
    # an empty sample, one class only, no levels
    for n, y in ((counts * 0, labels), (counts, labels * 0)):
        (tree,) = growing.grow(growing.coded(points, y, splits), n, splits, [3], 6, 3, 77)
        assert tree.share == [pytest.approx(y.mean())] and tree.left == [0]
    assert len(growing.grow(codes, counts, splits, [3], 0, 3, 77)[0].share) == 1


def test_trees_grown_in_tasks_predict_as_mllib_where_nothing_is_drawn(spark):
    rows = fitted_rows(spark).withColumn("a", F.round("a")).drop("features")
    rows = VectorAssembler(inputCols=["a", "bi", "c"], outputCol="features").transform(rows)
    model = RandomForestClassifier(
        labelCol="churn", numTrees=1, maxDepth=4, featureSubsetStrategy="all", bootstrap=False, minInstancesPerNode=7, seed=1
    ).fit(rows)
    points, labels = np.array([r["features"].toArray() for r in rows.collect()]), np.array([r["churn"] for r in rows.collect()])
    splits = [growing.thresholds(*growing.points_of(points[:, f])) for f in range(3)]
    own = growing.grow(growing.coded(points, labels, splits), np.ones(len(points), dtype=np.uint8), splits, [7], 4, 3, 0)
    found = trees.NodeTable(**growing.table_of(own)).scores(points, [4])[:, 0]
    wanted = trees.node_table(model).scores(points, [4])[:, 0]
    assert np.array_equal(found > 0.5, wanted > 0.5) and 0 < (found > 0.5).mean() < 1
    assert (np.abs(found - wanted) < 1e-12).any()


def test_bins_hold_about_as_many_rows():
    values = np.random.default_rng(1).normal(size=60_000)
    parts = [growing.points_of(part) for part in np.split(values, 3)]
    splits = growing.thresholds(*(np.concatenate(side) for side in zip(*parts)))
    assert len(splits) == growing.BINS - 1 and all(len(p[0]) == growing.POINTS for p in parts)
    sizes = np.bincount(np.searchsorted(splits, values))
    assert len(sizes) == growing.BINS and sizes.min() > 1600 and sizes.max() < 2150
    assert growing.thresholds(np.array([3.0, 1.0, 3.0]), np.array([1, 1, 5])).tolist() == [2.0]
    assert growing.thresholds(np.array([4.0]), np.array([9])).tolist() == []
    many, few = np.arange(40.0), np.where(np.arange(40) == 39, 10_000, 1)
    assert growing.thresholds(many, few).tolist() == [38.5]


def test_no_jobs_are_added_by_more_forests(spark, customers):
    # one customer alone has a category, so the rows that its fold's forests grow from lack a feature
    rare = customers.withColumn("payment_method", F.when(F.col("customer_id") == "C00007", "cheque").otherwise(F.col("payment_method")))
    train, _ = churn.split_and_fold(churn.model_rows(rare, OPTIONS), OPTIONS)
    track, taken = spark.sparkContext.statusTracker(), {}
    for leaves in ((5,), (5, 10, 20)):
        spark.sparkContext.setJobGroup(f"forests {leaves}", "")
        scores = churn.nested_scores(train, OPTIONS.depths, leaves, OPTIONS)
        found = {(r["max_depth"], r["min_leaf"], r["customer_id"]): r["score"] for r in scores.collect()}
        assert len(found) == len(leaves) * 2 * train.count() == scores.count() and all(0 <= s <= 1 for s in found.values())
        taken[leaves] = len(track.getJobIdsForGroup(f"forests {leaves}")), {k: s for k, s in found.items() if k[1] == 5}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # preparing the folds takes as many jobs either way, growing ten times as many forests a few; the same forest comes out
    assert abs(taken[5, 10, 20][0] - taken[(5,)][0]) <= 5 and taken[5, 10, 20][1] == pytest.approx(taken[(5,)][1])


def test_folds_too_large_for_a_task_grow_by_mllib(spark, customers, monkeypatch):
    train, _ = churn.split_and_fold(churn.model_rows(customers, OPTIONS), OPTIONS)
    found = {}
    for cells in (growing.MOST_CELLS, 0):
        monkeypatch.setattr(churn, "MOST_CELLS", cells)
        found[cells] = {(r["max_depth"], r["min_leaf"]): (r["mean_auc"], r["folds"], r["n_scored"]) for r in churn.grid_search(train, OPTIONS).collect()}
    own, other = found.values()
    assert own.keys() == other.keys() and len(own) == 4
    assert all(own[k] == (pytest.approx(other[k][0], abs=0.05), *other[k][1:]) for k in own)
