"""Descriptions of raw lines, features and series."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from tillroll.functions.ranks import exact_quantiles
from tillroll.operators.cleaning import is_cancellation


def null_counts(df: DataFrame) -> DataFrame:
    """One row: nulls per column, and rows with any null as ``rows_with_null``."""
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    return df.agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns],
        F.count(F.when(any_null, 1)).alias("rows_with_null"),
    )


def distinct_counts(lines: DataFrame) -> DataFrame:
    """Rows and distinct customers, products, orders and cancellations."""
    return lines.agg(
        F.count("*").alias("rows"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("stock_code").alias("products"),
        F.count_distinct(F.when(~is_cancellation(), F.col("invoice"))).alias("orders"),
        F.count_distinct(F.when(is_cancellation(), F.col("invoice"))).alias("cancellations"),
    )


def non_numeric_stock_codes(lines: DataFrame) -> DataFrame:
    """Codes that do not start with a digit, with their distinct descriptions: (stock_code, description)."""
    return lines.where(~F.col("stock_code").rlike("^[0-9]")).select("stock_code", "description").distinct()


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*items)).alias("p")).select("p.column", "p.value")


def _quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = exact_quantiles(df, columns, (0.25, 0.5, 0.75))

    def at(p):
        return F.max(F.when(F.col("probability") == p, F.col("value")))

    return found.groupBy("column").agg(at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min, exact quartiles and max per column."""
    moments = _long(df, columns).groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return moments.join(_quartiles(df, columns), "column")


def boxplot_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 interquartile ranges) and number of outliers."""
    margin = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col("value").between(F.col("q25") - margin, F.col("q75") + margin)
    # one row of quartiles per named column: bounded by the argument list
    quartiles = F.broadcast(_quartiles(df, columns))
    return (
        _long(df, columns)
        .where(F.col("value").isNotNull())
        .join(quartiles, "column")
        .groupBy("column", "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
            F.count(F.when(~inside, 1)).alias("outliers"),
        )
    )


def label_balance(df: DataFrame, label: str = "y_label") -> DataFrame:
    """Rows per label and how many times more the other label has."""
    counts = df.where(F.col(label).isNotNull()).agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("negative"),
        F.count(F.when(F.col(label) == 1, 1)).alias("positive"),
    )
    return counts.withColumn("imbalance", F.try_divide(F.col("negative"), F.col("positive")))


def feature_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every two columns, from one aggregate: (feature, other, correlation)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one_row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}~{b}") for a, b in pairs])
    items = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            items.append(F.struct(F.lit(x).alias("feature"), F.lit(y).alias("other"), F.col(f"{a}~{b}").alias("correlation")))
    return one_row.select(F.explode(F.array(*items)).alias("p")).select("p.*")


def variance_inflation(df: DataFrame, columns: Sequence[str], limit: float = 10.0) -> DataFrame:
    """Variance inflation factor per feature, without intercept, and whether it reaches ``limit``.

    One aggregate gives the matrix G of products; the factor of feature i is G_ii times the
    i-th diagonal element of the inverse of G. Only that one row goes to Python.
    """
    complete = df.dropna(subset=list(columns))
    names = list(columns)
    sums = [
        F.sum(F.col(a).cast("double") * F.col(b)).alias(f"{i}_{j}")
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]

    def factors(batches):
        for pdf in batches:
            for row in pdf.to_numpy(dtype=float):
                gram = row.reshape(len(names), len(names))
                factor = np.diag(gram) * np.diag(np.linalg.pinv(gram))
                yield pd.DataFrame({"feature": names, "vif": factor, "high": (factor >= limit).astype("int32")})

    return complete.agg(*sums).mapInPandas(factors, "feature string, vif double, high int")


def autocorrelation(series: DataFrame, lags: int = 51) -> DataFrame:
    """Autocorrelation per series up to ``lags``: (series_id, lag, acf)."""
    whole = Window.partitionBy("series_id")
    ordered = whole.orderBy("week_end")
    centered = series.withColumn("x", F.col("total_price") - F.avg("total_price").over(whole))
    shifted = centered.select(
        "series_id", "x", *[F.lag("x", k).over(ordered).alias(f"x_{k}") for k in range(1, lags + 1)]
    )
    sums = shifted.groupBy("series_id").agg(
        F.sum(F.col("x") * F.col("x")).alias("s_0"),
        *[F.sum(F.col("x") * F.col(f"x_{k}")).alias(f"s_{k}") for k in range(1, lags + 1)],
    )
    items = [F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"s_{k}"), F.col("s_0")).alias("acf")) for k in range(lags + 1)]
    return sums.select("series_id", F.explode(F.array(*items)).alias("p")).select("series_id", "p.*").where(
        F.col("acf").isNotNull()
    )


def partial_autocorrelation(acf: DataFrame) -> DataFrame:
    """Partial autocorrelation per series from its autocorrelations (Durbin-Levinson).

    A group is one series' autocorrelations, one row per lag.
    """

    def solve(pdf):
        pdf = pdf.sort_values("lag")
        r = pdf["acf"].to_numpy()
        result, phi, error = [1.0], np.zeros(0), 1.0
        for k in range(1, len(r)):
            reflection = (r[k] - phi @ r[k - 1:0:-1]) / error if error > 1e-12 else 0.0
            phi = np.append(phi - reflection * phi[::-1], reflection)
            error *= 1 - reflection**2
            result.append(reflection)
        return pd.DataFrame({"series_id": pdf["series_id"], "lag": pdf["lag"], "pacf": result})

    return acf.groupBy("series_id").applyInPandas(solve, "series_id string, lag int, pacf double")
