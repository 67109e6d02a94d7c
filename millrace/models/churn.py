"""Churn classifier: stratified split, fold-wise search, threshold, evaluation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.models.growing import MOST_CELLS, FoldRows
from millrace.models.preparation import preparation
from millrace.models.scoring import pick_threshold, pr_curve, roc_auc, roc_auc_by
from millrace.models.trees import NodeTable, cut_scores, node_table
from millrace.operators.ranking import stratified_folds, stratified_split
from millrace.session import materialize, require_columns

# The columns of the customer table that the model reads.
NUMERIC = ("senior", "tenure_months", "monthly_charges", "total_charges", "num_services")
CATEGORICAL = ("gender", "contract", "payment_method")

# Searched depths and leaf sizes, wanted recall.
DEPTHS = (6, 8, 10)
LEAVES = (5, 10, 20)
TARGET_RECALL = 0.60

# Rows of a task that grows trees: fewer are not worth a task, more do not fit it beside their bootstrap counts and nodes.
LEAST_ROWS, MOST_ROWS = 4096, 250_000


@dataclass(frozen=True)
class ChurnOptions:
    numeric: Sequence[str] = NUMERIC
    categorical: Sequence[str] = CATEGORICAL
    key: str = "customer_id"
    label: str = "churn"
    trees: int = 200
    depths: Sequence[int] = DEPTHS
    leaves: Sequence[int] = LEAVES
    folds: int = 5
    seed: int = 42
    target_recall: float = TARGET_RECALL
    parallelism: int = 4


def model_rows(customers: DataFrame, options: ChurnOptions = ChurnOptions()) -> DataFrame:
    """Key, features and label; the label must be 0 or 1."""
    wanted = [options.key, *options.numeric, *options.categorical, options.label]
    require_columns(customers, wanted)
    rows = customers.select(*wanted)
    label = F.col(options.label)
    if not rows.where(label.isNull() | ~label.isin(0, 1)).isEmpty():
        raise ValueError(f"{options.label} must be 0 or 1")
    return rows.withColumn(options.label, label.cast("int"))


def split_and_fold(rows: DataFrame, options: ChurnOptions = ChurnOptions()) -> tuple[DataFrame, DataFrame]:
    """(train with ``fold``, test), both read from stored tables.

    Every fit and evaluation starts from these rows, so they are written once.
    """
    parts = materialize(stratified_split(rows, options.key, options.label, 0.8, options.seed), "split")
    train = parts.where("split = 'train'").drop("split")
    folded = stratified_folds(train, options.key, options.label, options.folds, options.seed + 1)
    return materialize(folded, "train", ["fold"]), parts.where("split = 'test'").drop("split")


def forest(options: ChurnOptions, depth: int, leaf: int) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=options.label,
        featuresCol="features",
        numTrees=options.trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        maxMemoryInMB=1024,  # whole levels of all trees are split in one pass
        cacheNodeIds=True,  # a level starts at the nodes that rows have reached, not at the roots
        checkpointInterval=-1,  # the stored rows are near enough
        featureSubsetStrategy="sqrt",
        seed=options.seed,
    )


def with_score(predicted: DataFrame, options: ChurnOptions) -> DataFrame:
    """Key, label and the probability of class 1."""
    return predicted.select(
        options.key,
        F.col(options.label).alias("label"),
        vector_to_array("probability")[1].alias("score"),
    )


def growing_tasks(n_rows: int, slots: int) -> int:
    """Tasks that grow a forest: all slots once a task has rows enough, whole waves of them for more rows than fit.

    The rows are few bytes and the work on each is large, so the tasks that Spark cuts by bytes are too few.
    """
    if n_rows <= slots * MOST_ROWS:
        return max(1, min(slots, -(-n_rows // LEAST_ROWS)))
    return slots * -(-n_rows // (slots * MOST_ROWS))


def dealt(rows: DataFrame, tasks: int, label: str) -> DataFrame:
    """The rows stored in as many equal files as tasks shall read them."""
    return materialize(rows.repartition(tasks), label)


def side_by_side(spark: SparkSession, work: Callable, items: Sequence, parallelism: int) -> list:
    """Jobs of a few candidates at a time; Spark schedules their tasks."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items)


def prepared_folds(train: DataFrame, options: ChurnOptions) -> tuple[dict[int, DataFrame], DataFrame]:
    """Per fold the rows to fit on; and all rows with the features that their own fold's preprocessing gives.

    ``train`` is stored by fold, so what is prepared for a fold's held-out rows reads that fold only.
    """
    tasks = growing_tasks(train.count(), train.sparkSession.sparkContext.defaultParallelism)

    def one(fold: int) -> tuple[int, DataFrame, DataFrame]:
        seen, held = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
        prepared = preparation(options.numeric, options.categorical).fit(seen)
        fit_rows = dealt(prepared.transform(seen).select("features", options.label), tasks, "fold-fit")
        return fold, fit_rows, prepared.transform(held).select(options.key, options.label, "features", "fold")

    parts = side_by_side(train.sparkSession, one, range(options.folds), options.parallelism)
    held = reduce(DataFrame.unionByName, [p[2] for p in parts])
    return {fold: rows for fold, rows, _ in parts}, dealt(
        held.withColumn("features", vector_to_array("features")), tasks, "held"
    )


def grown_by_mllib(
    fit_rows: dict[int, DataFrame], depth: int, leaves: Sequence[int], options: ChurnOptions
) -> dict[tuple[int, int], NodeTable]:
    """A forest for each fold and leaf size.

    Forests are grown side by side as far as one leaves slots idle, and one more to fill its pauses; where a forest takes several
    waves of tasks it is grown alone.
    """
    spark = fit_rows[0].sparkSession
    at_once = min(options.parallelism, 1 + spark.sparkContext.defaultParallelism // max(1, fit_rows[0].rdd.getNumPartitions()))
    points = [(fold, leaf) for fold in fit_rows for leaf in leaves]

    def grown(point: tuple[int, int]) -> NodeTable:
        return node_table(forest(options, depth, point[1]).fit(fit_rows[point[0]]))

    return dict(zip(points, side_by_side(spark, grown, points, at_once)))


def nested_scores(
    train: DataFrame, depths: Sequence[int], leaves: Sequence[int], options: ChurnOptions = ChurnOptions()
) -> DataFrame:
    """Each training row scored by the forests that did not see its fold: key, label, fold, max_depth, min_leaf, score.

    One forest per (fold, leaf size) is grown to the largest depth and cut at the others, see ``trees``. All
    rows are scored in one pass, each by the forests of its fold. Tasks that hold a fold's rows grow its trees, see ``growing``;
    MLlib grows them where a fold is too large for that.
    """
    fit_rows, held = prepared_folds(train, options)
    folds = FoldRows(fit_rows, options.label)
    if folds.cells <= MOST_CELLS:
        tables = folds.forests(leaves, max(depths), options.trees, options.seed)
    else:
        tables = grown_by_mllib(fit_rows, max(depths), leaves, options)
    forests = {fold: [tables[fold, leaf] for leaf in leaves] for fold in range(options.folds)}
    names = F.array(*(F.struct(F.lit(d).alias("max_depth"), F.lit(n).alias("min_leaf")) for n in leaves for d in depths))
    scored = held.select(
        options.key, F.col(options.label).alias("label"), "fold", cut_scores(held, "features", "fold", forests, depths).alias("s")
    )
    pairs = F.zip_with(names, F.col("s"), lambda n, s: F.struct(n["max_depth"].alias("max_depth"), n["min_leaf"].alias("min_leaf"), s.alias("score")))
    return scored.select(options.key, "label", "fold", F.inline(pairs))


def grid_search(train: DataFrame, options: ChurnOptions = ChurnOptions()) -> DataFrame:
    """Mean ROC-AUC over the folds for each depth and leaf size.

    Preprocessing is learned once per fold from its training part and shared by all
    candidates, and a forest per fold and leaf size serves all depths.
    """
    scores = nested_scores(train, options.depths, options.leaves, options)
    found = roc_auc_by(scores, ["fold", "max_depth", "min_leaf"])
    return found.groupBy("max_depth", "min_leaf").agg(
        F.avg("roc_auc").alias("mean_auc"), F.count("*").alias("folds"), F.sum("n").alias("n_scored")
    )


def best_point(search: DataFrame) -> tuple[int, int, float]:
    """(depth, leaf, mean AUC) of the best candidate; ties to the smaller forest."""
    row = search.orderBy(F.desc("mean_auc"), "max_depth", F.desc("min_leaf")).first()
    return row["max_depth"], row["min_leaf"], row["mean_auc"]


def fit_churn(train: DataFrame, depth: int, leaf: int, options: ChurnOptions = ChurnOptions()) -> PipelineModel:
    """Preprocessing and forest fitted on the same rows, as one pipeline model."""
    prepared = preparation(options.numeric, options.categorical).fit(train)
    tasks = growing_tasks(train.count(), train.sparkSession.sparkContext.defaultParallelism)
    rows = dealt(prepared.transform(train).select("features", options.label), tasks, "fit")
    model = forest(options, depth, leaf).fit(rows)
    return PipelineModel(stages=[*prepared.stages, model])


def out_of_fold(train: DataFrame, depth: int, leaf: int, options: ChurnOptions = ChurnOptions()) -> DataFrame:
    """Each training row scored by the model that did not see its fold: key, label, score."""
    return nested_scores(train, [depth], [leaf], options).select(options.key, "label", "score")


def choose_threshold(oof: DataFrame, options: ChurnOptions = ChurnOptions()) -> DataFrame:
    return pick_threshold(pr_curve(oof), options.target_recall)


def held_out_auc(model: PipelineModel, test: DataFrame, options: ChurnOptions = ChurnOptions()) -> DataFrame:
    return roc_auc(with_score(model.transform(test), options))


def largest_score_change(
    model: PipelineModel, path: str, rows: DataFrame, options: ChurnOptions = ChurnOptions()
) -> DataFrame:
    """Save and reload the model, score the rows with both: rows compared, largest change."""
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    before = with_score(model.transform(rows), options).select(options.key, F.col("score").alias("a"))
    after = with_score(loaded.transform(rows), options).select(options.key, F.col("score").alias("b"))
    return before.join(after, options.key, "full").agg(
        F.count("*").alias("n_rows"),
        F.max(F.coalesce(F.abs(F.col("a") - F.col("b")), F.lit(1.0))).alias("max_change"),
    )
