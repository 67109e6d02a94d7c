"""Registered queries on customers: group comparison, tests, model measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import label_of
from millrace.models import churn, preparation, scoring
from millrace.operators import counting, hypothesis, ranking
from millrace.session import materialize, scratch_path
from millrace.workload import views as v
from millrace.workload.logs import rounded

LABELS = {0: "stayed", 1: "left"}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def class_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return counting.class_ratio(v.customers(spark, sf), "churn")


def minority_share(spark: SparkSession, sf: str) -> DataFrame:
    return counting.minority_share(v.customers(spark, sf), "churn")


def group_means(spark: SparkSession, sf: str) -> DataFrame:
    return counting.group_means(v.customers(spark, sf), "churn", ["monthly_charges", "tenure_months"])


def group_diff(spark: SparkSession, sf: str) -> DataFrame:
    return counting.group_difference(v.customers(spark, sf), "churn", ["monthly_charges", "tenure_months"])


def boxplot_stats(spark: SparkSession, sf: str) -> DataFrame:
    labelled = v.customers(spark, sf).withColumn("group", label_of(F.col("churn"), LABELS))
    return rounded(
        counting.boxplot_stats(labelled, "group", "monthly_charges"), "whisker_low", "whisker_high"
    )


def crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return counting.crosstab(v.customers(spark, sf), "contract", "churn", (0, 1))


def welch_t(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        hypothesis.welch_statistics(v.customers(spark, sf), "monthly_charges", "churn"), "t_statistic", "dof", digits=4
    )


def welch_p(spark: SparkSession, sf: str) -> DataFrame:
    """The t-test with its two-sided p-value and verdict."""
    found = hypothesis.welch_statistics(v.customers(spark, sf), "monthly_charges", "churn")
    return rounded(hypothesis.with_p_value(found, "t_statistic", "dof", "t"), "t_statistic", "dof", "p_value")


def chi_square(spark: SparkSession, sf: str) -> DataFrame:
    found = hypothesis.chi_square_statistics(v.customers(spark, sf), "contract", "churn")
    return rounded(hypothesis.with_p_value(found, "chi2_statistic", "dof", "chi2"), "chi2_statistic", "p_value")


def chi_square_yates(spark: SparkSession, sf: str) -> DataFrame:
    """A 2 x 2 table, with the continuity correction."""
    return rounded(hypothesis.chi_square_statistics(v.customers(spark, sf), "gender", "churn"), "chi2_statistic")


def impute_train(spark: SparkSession, sf: str) -> DataFrame:
    """What imputation learns: medians as numbers, modes as texts."""
    fills = preparation.training_fills(v.customers(spark, sf), churn.NUMERIC, churn.CATEGORICAL)
    number = F.col("fill").try_cast("double")
    return fills.select(
        "column", F.round(number, 4).alias("median"), F.when(number.isNull(), F.col("fill")).alias("mode")
    )


def standardize(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["senior", "monthly_charges", "num_services"]
    scaled = preparation.standardize(v.customers(spark, sf), columns)
    return rounded(scaled.select("customer_id", *columns), *columns)


def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Customers per encoded vector; one segment is not seen in training."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = v.customers(spark, sf).select("contract")
    seen = rows.where(F.col("contract") != "MACHINERY")
    encoded = Pipeline(stages=preparation.one_hot_stages(["contract"])).fit(seen).transform(rows)
    slots = vector_to_array("contract__v")
    names = [s for s in SEGMENTS if s != "MACHINERY"]
    parts = [F.get(slots, F.lit(i)).cast("long").alias(f"is_{n.lower()}") for i, n in enumerate(names)]
    return encoded.select("contract", *parts).groupBy("contract", *[f"is_{n.lower()}" for n in names]).agg(
        F.count("*").alias("n")
    )


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = ranking.stratified_split(v.customers(spark, sf).select("customer_id", "churn"), "customer_id", "churn")
    return parts.groupBy("churn", "split").agg(F.count("*").alias("n"), F.count_distinct("customer_id").alias("keys"))


def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    parts = ranking.stratified_folds(v.customers(spark, sf).select("customer_id", "churn"), "customer_id", "churn")
    return parts.groupBy("churn", F.col("fold").cast("long").alias("fold")).agg(F.count("*").alias("n"))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """A fixed arithmetic score, so that the measures have a SQL twin."""
    return v.customers(spark, sf).select(
        F.col("churn").alias("label"), (1 - F.col("num_services") / 100.0).cast("double").alias("score")
    )


def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scoring.pr_curve(_scored(spark, sf)), "threshold", "precision", "recall")


def pick_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scoring.pick_threshold(scoring.pr_curve(_scored(spark, sf)), 0.60), "threshold", "precision", "recall")


def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scoring.roc_auc(_scored(spark, sf)), "roc_auc")


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scoring.classification_report(_scored(spark, sf), 0.92), "precision", "recall", "f1")


# --- the model itself ------------------------------------------------------

OPTIONS = churn.ChurnOptions()
# The depth and leaf size the published search selected.
DEPTH, LEAF = 6, 20


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(churn.model_rows(v.customers(spark, sf), OPTIONS), "customers")


def _summed(scores: DataFrame) -> DataFrame:
    """Rows and customers per class, and whether every score is a probability."""
    inside = F.coalesce(F.col("score").between(0, 1), F.lit(False))
    return scores.groupBy(F.col("label").cast("bigint").alias("label")).agg(
        F.count("*").alias("n"), F.count_distinct(OPTIONS.key).alias("customers"), F.bool_and(inside).alias("in_range")
    )


def churn_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Test customers scored by the forest fitted on the training customers."""
    train, test = churn.split_and_fold(_rows(spark, sf), OPTIONS)
    model = churn.fit_churn(train, DEPTH, LEAF, OPTIONS)
    return _summed(churn.with_score(model.transform(test), OPTIONS))


def churn_grid(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = churn.split_and_fold(_rows(spark, sf), OPTIONS)
    found = churn.grid_search(train, OPTIONS)
    return found.select(
        F.col("max_depth").cast("bigint").alias("max_depth"),
        F.col("min_leaf").cast("bigint").alias("min_leaf"),
        "folds",
        "n_scored",
        F.col("mean_auc").between(0.5, 1).alias("in_range"),
    )


def churn_oof(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = churn.split_and_fold(_rows(spark, sf), OPTIONS)
    return _summed(churn.out_of_fold(train, DEPTH, LEAF, OPTIONS))


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    train, test = churn.split_and_fold(_rows(spark, sf), OPTIONS)
    model = churn.fit_churn(train, DEPTH, LEAF, OPTIONS)
    return churn.largest_score_change(model, scratch_path(spark, "churn-model"), test, OPTIONS)


QUERIES = {
    "class_ratio": class_ratio,
    "minority_share": minority_share,
    "group_means": group_means,
    "group_diff": group_diff,
    "boxplot_stats": boxplot_stats,
    "crosstab": crosstab,
    "welch_t": welch_t,
    "welch_p": welch_p,
    "chi_square": chi_square,
    "chi_square_yates": chi_square_yates,
    "impute_train": impute_train,
    "standardize": standardize,
    "one_hot": one_hot,
    "stratified_split": stratified_split,
    "stratified_folds": stratified_folds,
    "pr_curve": pr_curve,
    "pick_threshold": pick_threshold,
    "roc_auc": roc_auc,
    "classification_report": classification_report,
    "churn_scores": churn_scores,
    "churn_oof": churn_oof,
    "churn_grid": churn_grid,
    "model_roundtrip": model_roundtrip,
}

# --- SQL twins -------------------------------------------------------------

_MEAN = "round(avg({c}), 2)"
_DIFF = "round({a} - {b}, 2)".format(
    a=_MEAN.replace("{c}", "CASE WHEN churn = 1 THEN {{c}} END").replace("{{c}}", "{c}"),
    b=_MEAN.replace("{c}", "CASE WHEN churn = 0 THEN {{c}} END").replace("{{c}}", "{c}"),
)
_CHI = """
    SELECT CAST((r - 1) * (c - 1) AS BIGINT) AS dof, x AS chi2 FROM
        (SELECT count(DISTINCT {a}) AS r, count(DISTINCT churn) AS c FROM customers),
        (SELECT sum(power({gap}, 2) / e) AS x FROM (
            SELECT (SELECT count(*) FROM customers x WHERE x.{a} = p.{a} AND x.churn = q.churn) AS o,
                (SELECT count(*) FROM customers x WHERE x.{a} = p.{a}) * (SELECT count(*) FROM customers x
                 WHERE x.churn = q.churn) / (SELECT count(*) FROM customers) AS e
            FROM (SELECT DISTINCT {a} FROM customers) p, (SELECT DISTINCT churn FROM customers) q))
"""
_CURVE = """
    SELECT t AS threshold, tp / (tp + fp) AS precision, tp / (SELECT count(*) FROM scored WHERE label = 1) AS recall
    FROM (SELECT t, (SELECT count(*) FROM scored WHERE label = 1 AND score >= t) AS tp,
                 (SELECT count(*) FROM scored WHERE label = 0 AND score >= t) AS fp
          FROM (SELECT DISTINCT score AS t FROM scored))
"""
_SCORED = "SELECT churn AS label, 1 - num_services / CAST(100 AS DOUBLE) AS score FROM customers"
_REPORT = """
    SELECT CAST(k AS VARCHAR) AS name, CASE WHEN hit + fp > 0 THEN hit / (hit + fp) ELSE 0.0 END AS p,
        CASE WHEN s > 0 THEN hit / s ELSE 0.0 END AS r,
        CASE WHEN hit + fp + s > 0 THEN 2 * hit / (hit + fp + s) ELSE 0.0 END AS f, s
    FROM (SELECT k, count(*) FILTER (label = k AND pred = k) AS hit, count(*) FILTER (label <> k AND pred = k) AS fp,
            count(*) FILTER (label = k) AS s
          FROM (SELECT label, CASE WHEN score >= 0.92::DOUBLE THEN 1 ELSE 0 END AS pred FROM scored), (VALUES (0), (1)) c(k)
          GROUP BY k)
"""


def _scored_sql(body: str) -> str:
    return v.customer_sql(body, scored=_SCORED)


def _parts(cut: str) -> str:
    return v.customer_sql(
        f"""SELECT churn, {cut}, count(*) AS n FROM (SELECT churn, row_number() OVER (PARTITION BY churn
        ORDER BY customer_id) AS k, count(*) OVER (PARTITION BY churn) AS n FROM customers) GROUP BY 1, 2"""
    )


_CLASS_SIZES = "SELECT churn AS label, count(*) AS n, CAST(floor(count(*) * 0.8) AS BIGINT) AS train FROM customers GROUP BY 1"
_GRID = v.customer_sql(
    " UNION ALL ".join(
        f"SELECT CAST({d} AS BIGINT) AS max_depth, CAST({leaf} AS BIGINT) AS min_leaf, CAST({OPTIONS.folds} AS BIGINT) AS folds,"
        " CAST(sum(train) AS BIGINT) AS n_scored, true AS in_range FROM sizes"
        for d in OPTIONS.depths
        for leaf in OPTIONS.leaves
    ),
    sizes=_CLASS_SIZES,
)
# Simpson's rule over the density of Student's t from 0 to |t|
_T_TAIL = """
    SELECT n_a, n_b, round(t, 6) AS t_statistic, round(dof, 6) AS dof, round(1 - 2 * area, 6) AS p_value,
        CASE WHEN 1 - 2 * area < 0.05 THEN 'significant' ELSE 'not significant' END AS verdict
    FROM (SELECT n_a, n_b, t, dof, sum(w * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi())
            * power(1 + power(abs(t) * i / 4000, 2) / dof, -(dof + 1) / 2)) * abs(t) / 4000 / 3 AS area
        FROM welch, (SELECT i, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(4001) r(i))
        GROUP BY n_a, n_b, t, dof)
"""
_WELCH = """
    SELECT n_a, n_b, (m_a - m_b) / sqrt(s_a + s_b) AS t,
        power(s_a + s_b, 2) / (s_a * s_a / (n_a - 1) + s_b * s_b / (n_b - 1)) AS dof
    FROM (SELECT count(a) AS n_a, count(b) AS n_b, avg(a) AS m_a, avg(b) AS m_b, var_samp(a) / count(a) AS s_a,
            var_samp(b) / count(b) AS s_b
        FROM (SELECT CASE WHEN churn = 1 THEN monthly_charges END AS a, CASE WHEN churn = 0 THEN monthly_charges END AS b
              FROM customers))
"""

ORACLES = {
    "welch_p": v.customer_sql(_T_TAIL, welch=_WELCH),
    "churn_scores": v.customer_sql(
        "SELECT CAST(label AS BIGINT) AS label, n - train AS n, n - train AS customers, true AS in_range FROM sizes",
        sizes=_CLASS_SIZES,
    ),
    "churn_oof": v.customer_sql(
        "SELECT CAST(label AS BIGINT) AS label, train AS n, train AS customers, true AS in_range FROM sizes",
        sizes=_CLASS_SIZES,
    ),
    "churn_grid": _GRID,
    "model_roundtrip": v.customer_sql(
        "SELECT CAST(sum(n - train) AS BIGINT) AS n_rows, 0.0::DOUBLE AS max_change FROM sizes", sizes=_CLASS_SIZES
    ),
    "class_ratio": v.customer_sql(
        """SELECT churn, count(*) AS count,
        round(CAST(100 * count(*) AS DOUBLE) / (SELECT count(*) FROM customers), 2) AS ratio_pct
        FROM customers GROUP BY 1"""
    ),
    "minority_share": v.customer_sql(
        """SELECT min(r) AS minority_pct FROM (SELECT round(CAST(100 * count(*) AS DOUBLE)
        / (SELECT count(*) FROM customers), 2) AS r FROM customers GROUP BY churn)"""
    ),
    "group_means": v.customer_sql(
        f"""SELECT churn, {_MEAN.format(c="monthly_charges")} AS avg_monthly_charges,
        {_MEAN.format(c="tenure_months")} AS avg_tenure_months, count(*) AS count FROM customers GROUP BY 1"""
    ),
    "group_diff": v.customer_sql(
        f"""SELECT {_DIFF.format(c="monthly_charges")} AS diff_monthly_charges,
        {_DIFF.format(c="tenure_months")} AS diff_tenure_months FROM customers"""
    ),
    "boxplot_stats": v.customer_sql(
        """SELECT "group", count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median,
        round(any_value(q3), 6) AS q3,
        round(min(monthly_charges) FILTER (monthly_charges >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
        round(max(monthly_charges) FILTER (monthly_charges <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
        count(*) FILTER (monthly_charges NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
        FROM (SELECT CASE churn WHEN 0 THEN 'stayed' WHEN 1 THEN 'left' END AS "group", monthly_charges,
            quantile_cont(monthly_charges, 0.25) OVER (PARTITION BY churn) AS q1,
            quantile_cont(monthly_charges, 0.5) OVER (PARTITION BY churn) AS q2,
            quantile_cont(monthly_charges, 0.75) OVER (PARTITION BY churn) AS q3
            FROM customers WHERE monthly_charges IS NOT NULL) GROUP BY 1"""
    ),
    "crosstab": v.customer_sql(
        """SELECT contract, count(*) FILTER (churn = 0) AS churn_0, count(*) FILTER (churn = 1) AS churn_1
        FROM customers GROUP BY 1"""
    ),
    "welch_t": v.customer_sql(
        """SELECT n_a, n_b, round((m_a - m_b) / sqrt(s_a + s_b), 4) AS t_statistic,
        round(power(s_a + s_b, 2) / (s_a * s_a / (n_a - 1) + s_b * s_b / (n_b - 1)), 4) AS dof
        FROM (SELECT *, v_a / n_a AS s_a, v_b / n_b AS s_b FROM (SELECT
            count(monthly_charges) FILTER (churn = 1) AS n_a, count(monthly_charges) FILTER (churn = 0) AS n_b,
            avg(monthly_charges) FILTER (churn = 1) AS m_a, avg(monthly_charges) FILTER (churn = 0) AS m_b,
            var_samp(monthly_charges) FILTER (churn = 1) AS v_a, var_samp(monthly_charges) FILTER (churn = 0) AS v_b
            FROM customers))"""
    ),
    "chi_square": v.customer_sql(
        f"""SELECT round(chi2, 6) AS chi2_statistic, dof, round(exp(-chi2 / 2) * (1 + chi2 / 2), 6) AS p_value,
        CASE WHEN exp(-chi2 / 2) * (1 + chi2 / 2) < 0.05 THEN 'significant' ELSE 'not significant' END AS verdict
        FROM ({_CHI.format(a="contract", gap="o - e")})"""
    ),
    "chi_square_yates": v.customer_sql(
        f"""SELECT round(chi2, 6) AS chi2_statistic, dof
        FROM ({_CHI.format(a="gender", gap="abs(o - e) - least(0.5, abs(o - e))")})"""
    ),
    "impute_train": v.customer_sql(
        "\nUNION ALL ".join(
            [
                f"SELECT '{c}' AS \"column\", round(CAST(median({c}) AS DOUBLE), 4) AS median, NULL AS mode FROM customers"
                for c in churn.NUMERIC
            ]
            + [
                f"SELECT '{c}', NULL, (SELECT {c} FROM customers WHERE {c} IS NOT NULL GROUP BY 1 "
                f"ORDER BY count(*) DESC, {c} LIMIT 1)"
                for c in churn.CATEGORICAL
            ]
        )
    ),
    "standardize": v.customer_sql(
        "SELECT customer_id, "
        + ", ".join(
            f"round(({c} - (SELECT avg({c}) FROM customers)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 "
            f"ELSE stddev_pop({c}) END FROM customers), 6) AS {c}"
            for c in ("senior", "monthly_charges", "num_services")
        )
        + " FROM customers"
    ),
    "one_hot": v.customer_sql(
        "SELECT contract, "
        + ", ".join(
            f"CAST(contract = '{s}' AS BIGINT) AS is_{s.lower()}" for s in SEGMENTS if s != "MACHINERY"
        )
        + ", count(*) AS n FROM customers GROUP BY ALL"
    ),
    "stratified_split": v.customer_sql(
        """SELECT churn, CASE WHEN k <= floor(c * 0.8) THEN 'train' ELSE 'test' END AS split, count(*) AS n,
        count(*) AS keys FROM (SELECT churn, row_number() OVER (PARTITION BY churn ORDER BY customer_id) AS k,
            count(*) OVER (PARTITION BY churn) AS c FROM customers) GROUP BY 1, 2"""
    ),
    "stratified_folds": _parts("(k - 1) % 5 AS fold"),
    "pr_curve": _scored_sql(
        f"""SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall
        FROM ({_CURVE})"""
    ),
    "pick_threshold": _scored_sql(
        f"""SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall
        FROM ({_CURVE}) WHERE recall >= 0.60 ORDER BY threshold DESC LIMIT 1"""
    ),
    "roc_auc": _scored_sql(
        """SELECT round(sum(w * n) / sum(n), 6) AS roc_auc FROM (
            SELECT a.n * b.n AS n, CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5 ELSE 0 END AS w
            FROM (SELECT score, CAST(count(*) AS DOUBLE) AS n FROM scored WHERE label = 1 GROUP BY 1) a,
                 (SELECT score, CAST(count(*) AS DOUBLE) AS n FROM scored WHERE label = 0 GROUP BY 1) b)"""
    ),
    "classification_report": _scored_sql(
        f"""SELECT name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support
        FROM (WITH k AS ({_REPORT}) SELECT * FROM k
            UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT sum(r * s) / sum(s) AS a, sum(s) AS n FROM k)
            UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM k
            UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM k)"""
    ),
}
