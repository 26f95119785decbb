"""Queries and oracles for folds, hold-outs and classification scores.

The probabilities scored here are two fixed functions of the features, so that SQL can
follow; the trained models are in ``models``.
"""

from pyspark.sql import functions as F

from tillroll.catalog.customers import FEATURE_ROWS, features
from tillroll.catalog.oracle_base import with_ctes
from tillroll.catalog.registry import query
from tillroll.operators import customers, metrics, sampling
from tillroll.session import settle

BETA = 2
RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY y_label ORDER BY md5('11:' || customer_id), customer_id) AS place,
         count(*) OVER (PARTITION BY y_label) AS rows_of_label
  FROM feature_rows WHERE target = 'train')"""
SCORED = """
scored AS (
  SELECT CAST((place - 1) % 5 AS INTEGER) AS fold, customer_id, y_label, candidate,
         CASE WHEN candidate = 'recent' THEN 1.0::DOUBLE / (1.0::DOUBLE + recency / 90.0::DOUBLE)
              ELSE frequency / (frequency + 10.0::DOUBLE) END AS probability
  FROM ranked, (VALUES ('recent'), ('frequent')) v(candidate))"""
CONFUSION = """
confusion AS (
  SELECT candidate, fold,
         count(*) FILTER (y_label = 0 AND NOT probability > 0.5) AS tn,
         count(*) FILTER (y_label = 0 AND probability > 0.5) AS fp,
         count(*) FILTER (y_label = 1 AND NOT probability > 0.5) AS fn,
         count(*) FILTER (y_label = 1 AND probability > 0.5) AS tp
  FROM scored GROUP BY candidate, fold)"""
CURVE = """
curve AS (
  SELECT *, CASE WHEN tp + fp + fn = 0 THEN 0.0::DOUBLE
    ELSE 5.0::DOUBLE * tp / (5.0::DOUBLE * tp + 4.0::DOUBLE * fn + fp) END AS fbeta
  FROM (SELECT candidate, fold, i * 0.01::DOUBLE AS threshold,
               count(*) FILTER (y_label = 1 AND probability > i * 0.01::DOUBLE) AS tp,
               count(*) FILTER (y_label = 0 AND probability > i * 0.01::DOUBLE) AS fp,
               count(*) FILTER (y_label = 1 AND NOT probability > i * 0.01::DOUBLE) AS fn
        FROM scored, range(0, 101) r(i) GROUP BY ALL))"""
BEST = """
best AS (
  SELECT candidate, fold, threshold, fbeta FROM (
    SELECT *, row_number() OVER (PARTITION BY candidate, fold ORDER BY fbeta DESC, threshold) AS place FROM curve)
  WHERE place = 1)"""
FOLDED = (*FEATURE_ROWS, RANKED, SCORED)


def training_rows(spark, sf_dir):
    return settle(customers.train_rows(features(spark, sf_dir)))


def scored(spark, sf_dir):
    folds = sampling.stratified_folds(training_rows(spark, sf_dir), seed=11)
    rules = F.array(
        F.struct(F.lit("recent").alias("candidate"), (1.0 / (1.0 + F.col("recency") / 90.0)).alias("probability")),
        F.struct(F.lit("frequent").alias("candidate"), (F.col("frequency") / (F.col("frequency") + 10.0)).alias("probability")),
    )
    return folds.select("fold", "customer_id", "y_label", F.inline(rules))


def curve(spark, sf_dir):
    return metrics.threshold_fbeta_curve(scored(spark, sf_dir), BETA, ["candidate", "fold"])


def rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, 9))
    return df


@query(
    "stratified_holdout",
    with_ctes(*FEATURE_ROWS, RANKED)
    + """SELECT customer_id, y_label,
  CASE WHEN place <= ceil(rows_of_label * 0.2::DOUBLE) THEN 1 ELSE 0 END AS is_test FROM ranked""",
)
def holdout(spark, sf_dir):
    marked = sampling.stratified_holdout(training_rows(spark, sf_dir), 0.2, seed=11)
    return marked.select("customer_id", "y_label", "is_test")


@query("stratified_folds", with_ctes(*FEATURE_ROWS, RANKED) + "SELECT customer_id, y_label, CAST((place - 1) % 5 AS INTEGER) AS fold FROM ranked")
def folds(spark, sf_dir):
    return sampling.stratified_folds(training_rows(spark, sf_dir), seed=11).select("customer_id", "y_label", "fold")


@query(
    "threshold_label",
    with_ctes(*FOLDED) + "SELECT customer_id, candidate, CASE WHEN probability > 0.25 THEN 1 ELSE 0 END AS label FROM scored",
)
def labelled(spark, sf_dir):
    label = metrics.threshold_label(F.col("probability"), 0.25).alias("label")
    return scored(spark, sf_dir).select("customer_id", "candidate", label)


@query("confusion_matrix", with_ctes(*FOLDED, CONFUSION) + "SELECT * FROM confusion")
def confusion(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir), ["candidate", "fold"])


@query(
    "summed_confusion_matrix",
    with_ctes(*FOLDED, CONFUSION)
    + """SELECT candidate, CAST(sum(tn) AS BIGINT) AS tn, CAST(sum(fp) AS BIGINT) AS fp,
  CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(tp) AS BIGINT) AS tp FROM confusion GROUP BY candidate""",
)
def summed(spark, sf_dir):
    matrices = metrics.confusion_matrix(scored(spark, sf_dir), ["candidate", "fold"])
    return metrics.summed_confusion_matrix(matrices, ["candidate"])


@query(
    "fbeta_score",
    with_ctes(*FOLDED, CONFUSION)
    + """SELECT candidate, fold, round(CASE WHEN tp + fp + fn = 0 THEN 0.0::DOUBLE
  ELSE 5.0::DOUBLE * tp / (5.0::DOUBLE * tp + 4.0::DOUBLE * fn + fp) END, 9) AS fbeta FROM confusion""",
)
def fbeta(spark, sf_dir):
    matrices = metrics.confusion_matrix(scored(spark, sf_dir), ["candidate", "fold"])
    return matrices.select("candidate", "fold", F.round(metrics.fbeta_score(BETA), 9).alias("fbeta"))


@query(
    "balanced_accuracy",
    with_ctes(*FOLDED, CONFUSION)
    # a fold without one of the labels has the recall of the other one
    + """SELECT candidate, fold, round((COALESCE(found, left_out) + COALESCE(left_out, found)) / 2, 9) AS balanced_accuracy
FROM (SELECT candidate, fold, tp::DOUBLE / NULLIF(tp + fn, 0) AS found, tn::DOUBLE / NULLIF(tn + fp, 0) AS left_out
      FROM confusion)""",
)
def balanced(spark, sf_dir):
    matrices = metrics.confusion_matrix(scored(spark, sf_dir), ["candidate", "fold"])
    return matrices.select("candidate", "fold", F.round(metrics.balanced_accuracy(), 9).alias("balanced_accuracy"))


@query(
    "threshold_fbeta_curve",
    with_ctes(*FOLDED, CURVE)
    + "SELECT candidate, fold, round(threshold, 2) AS threshold, tp, fp, fn, round(fbeta, 9) AS fbeta FROM curve",
)
def curve_query(spark, sf_dir):
    return rounded(curve(spark, sf_dir), "fbeta").withColumn("threshold", F.round("threshold", 2))


@query(
    "best_threshold",
    with_ctes(*FOLDED, CURVE, BEST)
    + "SELECT candidate, fold, round(threshold, 2) AS threshold, round(fbeta, 9) AS fbeta FROM best",
)
def best_query(spark, sf_dir):
    best = metrics.best_threshold(curve(spark, sf_dir), ["candidate", "fold"])
    return rounded(best, "fbeta").withColumn("threshold", F.round("threshold", 2))


@query(
    "select_candidate",
    with_ctes(*FOLDED, CURVE, BEST)
    + """SELECT candidate, round(avg(threshold), 9) AS threshold, round(avg(fbeta), 9) AS fbeta
FROM best GROUP BY candidate ORDER BY avg(fbeta) DESC, candidate LIMIT 1""",
)
def selected(spark, sf_dir):
    from tillroll.plans.predictor import select_candidate

    best = metrics.best_threshold(curve(spark, sf_dir), ["candidate", "fold"])
    return rounded(select_candidate(best), "threshold", "fbeta")
