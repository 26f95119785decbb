"""Scores of predicted probabilities: (keys..., y_label, probability)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

THRESHOLDS = 101  # 0.00, 0.01, ... 1.00


def threshold_label(probability: Column, threshold) -> Column:
    """1 above the threshold; a probability equal to it is 0."""
    return F.when(probability > threshold, 1).otherwise(0)


def confusion_matrix(predictions: DataFrame, by: Sequence[str] = (), threshold=0.5) -> DataFrame:
    """Counts tn, fp, fn, tp per group."""
    true, predicted = F.col("y_label"), threshold_label(F.col("probability"), threshold)

    def cell(t, p):
        return F.count(F.when((true == t) & (predicted == p), 1))

    return predictions.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def summed_confusion_matrix(matrices: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return matrices.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")])


def fbeta_score(beta: float) -> Column:
    """F-beta from the columns tp, fp, fn; 0 when there is nothing to find and nothing found."""
    b2 = float(beta) ** 2
    tp = (1 + b2) * F.col("tp")
    whole = tp + b2 * F.col("fn") + F.col("fp")
    return F.when(whole == 0, 0.0).otherwise(tp / F.when(whole != 0, whole))


def balanced_accuracy() -> Column:
    """Mean recall of the classes that occur."""
    found = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    left = F.try_divide(F.col("tn"), F.col("tn") + F.col("fp"))
    return (F.coalesce(found, left) + F.coalesce(left, found)) / 2


def threshold_fbeta_curve(predictions: DataFrame, beta: float, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn and F-beta at thresholds 0.00 to 1.00.

    A row only matters by how many thresholds its probability exceeds, so rows first
    shrink to 102 counts per group; the thresholds are applied to those counts.
    """
    by = list(by)
    p = F.col("probability")
    base = F.greatest(F.floor(p * 100) - 1, F.lit(0))
    exceeded = base
    for step in range(3):  # floor(p * 100) can be off by one in floating point
        exceeded = exceeded + F.when(
            (base + step < THRESHOLDS) & (p > (base + step) * F.lit(0.01)), 1
        ).otherwise(0)
    counts = predictions.groupBy(*by, exceeded.alias("exceeded")).agg(
        F.count(F.when(F.col("y_label") == 1, 1)).alias("positive"),
        F.count(F.when(F.col("y_label") == 0, 1)).alias("negative"),
    )
    above = F.col("exceeded") > F.col("step")
    return (
        counts.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(THRESHOLDS - 1))))
        .groupBy(*by, "step")
        .agg(
            F.sum(F.when(above, F.col("positive")).otherwise(0)).alias("tp"),
            F.sum(F.when(above, F.col("negative")).otherwise(0)).alias("fp"),
            F.sum(F.when(above, 0).otherwise(F.col("positive"))).alias("fn"),
        )
        .select(*by, (F.col("step") * F.lit(0.01)).alias("threshold"), "tp", "fp", "fn",
                fbeta_score(beta).alias("fbeta"))
    )


def best_threshold(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Highest F-beta of a curve and the lowest threshold that reaches it."""
    best = F.max(F.struct("fbeta", (-F.col("threshold")).alias("negated"))).alias("best")
    return curve.groupBy(*by).agg(best).select(
        *by, (-F.col("best.negated")).alias("threshold"), F.col("best.fbeta").alias("fbeta")
    )


def rmse(forecast: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return forecast.groupBy(*by).agg(
        F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), F.lit(2.0)))).alias("rmse")
    )
