"""Tools for many weekly series at once: (series_id, week_end, total_price).

A series has one row per week, so a window over a series is bounded by the calendar.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F, Window

from tillroll.contracts import check_n_periods, check_test_size

BOX_COX_SHIFT = 1e-6
SMALLEST = 1e-16
POWER_ZERO = 1e-9  # powers nearer to 0 are logarithms
FLAT = 1e-9  # logarithms that differ by less are one value
GOLDEN = (math.sqrt(5) - 1) / 2


def _ordered():
    return Window.partitionBy("series_id").orderBy("week_end")


def _whole():
    return Window.partitionBy("series_id")


def lag_sequences(series: DataFrame, input_lags: int, output_lags: int = 1) -> DataFrame:
    """Sliding windows: ``x_1`` .. ``x_in`` and the ``y_1`` .. ``y_out`` that follow; ``week_end`` is that of ``x_1``."""
    ahead = [F.lead("total_price", k).over(_ordered()) for k in range(input_lags + output_lags)]
    names = [f"x_{k + 1}" for k in range(input_lags)] + [f"y_{k + 1}" for k in range(output_lags)]
    columns = [column.alias(name) for column, name in zip(ahead, names)]
    return series.select("series_id", "week_end", *columns).where(F.col(names[-1]).isNotNull())


def _positions(series: DataFrame) -> DataFrame:
    return series.withColumn("position", F.row_number().over(_ordered()) - 1).withColumn(
        "length", F.count("*").over(_whole())
    )


def time_series_holdout(series: DataFrame, test_size) -> DataFrame:
    """Mark the last rows of every series (``is_test`` 1): a count, or a share of the length."""
    check_test_size(test_size)
    length = F.col("length")
    start = F.ceil(length * (1 - test_size)) if test_size < 1 else length - int(test_size)
    too_short = F.raise_error(F.lit(f"test_size {test_size} is not below the length of a series"))
    is_test = F.when(length <= test_size, too_short.cast("int")).when(F.col("position") >= start, 1).otherwise(0)
    return _positions(series).select("series_id", "week_end", "total_price", is_test.alias("is_test"))


def expanding_folds(series: DataFrame, n_splits: int = 6, test_size: int = 8, keep_short: bool = False) -> DataFrame:
    """Rows per fold: the test weeks of a fold (``is_test`` 1) and all weeks before them.

    A series that has no week before its first fold has no rows; with ``keep_short`` it has one without a
    fold, and all rows have a ``reason``, null for the others.
    """
    fold = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold")
    start = F.col("length") - (n_splits - F.col("fold")) * test_size
    long_enough = F.col("length") > n_splits * test_size
    placed = _positions(series)
    folds = (
        placed.where(long_enough)
        .select("*", fold)
        .where(F.col("position") < start + test_size)
        .select("series_id", "fold", "week_end", "total_price",
                F.when(F.col("position") >= start, 1).otherwise(0).alias("is_test"))
    )
    return folds if not keep_short else _with_short(folds, placed.where(~long_enough), "too few weeks for the folds")


def _with_short(rows: DataFrame, short: DataFrame, reason: str) -> DataFrame:
    """Rows with a null reason, and a row for each short series with the reason only."""
    alone = short.select("series_id", F.lit(reason).alias("reason")).distinct()
    return rows.withColumn("reason", F.lit(None).cast("string")).unionByName(alone, allowMissingColumns=True)


def latest_lag_vector(series: DataFrame, n: int, keep_short: bool = False) -> DataFrame:
    """Last ``n`` values per series in order, and the last week: (series_id, week_end, lags).

    A shorter series has no row; with ``keep_short`` it has one without lags, and all rows have a ``reason``.
    """
    place = F.row_number().over(_whole().orderBy(F.desc("week_end")))
    ordered = F.array_sort(F.collect_list(F.struct("week_end", "total_price")))
    vectors = (
        series.withColumn("place", place)
        .where(F.col("place") <= n)
        .groupBy("series_id")
        .agg(F.max("week_end").alias("week_end"), ordered.alias("rows"))
    )
    whole = F.size("rows") == n
    lags = vectors.where(whole).select("series_id", "week_end", F.transform("rows", lambda r: r["total_price"]).alias("lags"))
    return lags if not keep_short else _with_short(lags, vectors.where(~whole), "too few weeks for the lags")


def future_weeks(series: DataFrame, n_periods: int) -> DataFrame:
    """The ``n_periods`` weeks after the last one of every series: (series_id, step, week_end)."""
    check_n_periods(n_periods)
    step = F.explode(F.sequence(F.lit(1), F.lit(n_periods))).alias("step")
    last = series.groupBy("series_id").agg(F.max("week_end").alias("last"))
    return last.select("series_id", "last", step).select(
        "series_id", "step", F.date_add("last", F.col("step") * 7).alias("week_end")
    )


def difference_series(series: DataFrame, order: int = 1) -> DataFrame:
    """Difference to the week before, ``order`` times; the first ``order`` weeks fall away."""
    for _ in range(order):
        step = F.col("total_price") - F.lag("total_price").over(_ordered())
        series = series.withColumn("total_price", step).where(F.col("total_price").isNotNull())
    return series


def _shifted() -> Column:
    return F.greatest(F.col("total_price") + F.lit(BOX_COX_SHIFT), F.lit(SMALLEST))


def box_cox_lambdas(series: DataFrame, low: float = -2.0, high: float = 2.0, tolerance: float = 1e-7) -> DataFrame:
    """Power per series with the highest profile log-likelihood between low and high: (series_id, power).

    With z the logarithm less its mean, the power minimises the variance of (exp(power z) - 1) / power, whose
    logarithm is convex in the power; so a golden-section search within one row per series finds it. Weeks without
    a value do not count; a series of equal values has power 1.
    """
    logs = F.collect_list(F.log(_shifted())).alias("logs")
    rows = series.groupBy("series_id").agg(logs, F.avg(F.log(_shifted())).alias("mean"))
    rows = rows.select("series_id", F.transform("logs", lambda x: x - F.col("mean")).alias("z"))

    def spread(power):
        """Logarithm of the variance at a power."""
        transformed = F.transform("z", lambda z: F.when(F.abs(power) < POWER_ZERO, z).otherwise(F.expm1(power * z) / power))
        sums = F.aggregate(
            transformed, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("ss")),
            lambda t, y: F.struct((t["s"] + y).alias("s"), (t["ss"] + y * y).alias("ss")),
        )
        n = F.size("z")
        # an array of one entry binds the sums to a name, so that they are computed once
        return F.transform(F.array(sums), lambda t: F.log(t["ss"] / n - (t["s"] / n) * (t["s"] / n)))[0]

    def narrowed(t, _):
        left = t["at_c"] <= t["at_d"]
        a, b = F.when(left, t["a"]).otherwise(t["c"]), F.when(left, t["d"]).otherwise(t["b"])
        point = F.when(left, b - (b - a) * GOLDEN).otherwise(a + (b - a) * GOLDEN)
        found = F.transform(F.array(point), lambda p: F.struct(p.alias("power"), spread(p).alias("value")))
        return F.transform(
            found,
            lambda new: F.struct(
                a.alias("a"), b.alias("b"),
                F.when(left, new["power"]).otherwise(t["d"]).alias("c"), F.when(left, t["c"]).otherwise(new["power"]).alias("d"),
                F.when(left, new["value"]).otherwise(t["at_d"]).alias("at_c"), F.when(left, t["at_c"]).otherwise(new["value"]).alias("at_d"),
            ),
        )[0]

    c, d = high - (high - low) * GOLDEN, low + (high - low) * GOLDEN
    first = [F.lit(float(v)).alias(name) for name, v in (("a", low), ("b", high), ("c", c), ("d", d))]
    start = F.struct(*first, spread(F.lit(c)).alias("at_c"), spread(F.lit(d)).alias("at_d"))
    steps = F.sequence(F.lit(1), F.lit(golden_steps(high - low, tolerance)))
    best = F.aggregate(steps, start, narrowed, lambda t: (t["a"] + t["b"]) / 2)
    flat = F.array_max("z") - F.array_min("z") < FLAT
    return rows.select("series_id", F.when((F.size("z") == 0) | flat, 1.0).otherwise(best).alias("power"))


def golden_steps(width: float, tolerance: float) -> int:
    """Steps of a golden-section search until the bounds are tolerance apart."""
    return max(1, math.ceil(math.log(tolerance / width) / math.log(GOLDEN)))


def box_cox(series: DataFrame, lambdas: DataFrame) -> DataFrame:
    power = F.col("power")
    value = F.when(F.abs(power) < POWER_ZERO, F.log(_shifted())).otherwise((F.pow(_shifted(), power) - 1) / power)
    return series.join(lambdas, "series_id").withColumn("total_price", value)


def inverse_box_cox(transformed: DataFrame) -> DataFrame:
    """Undo ``box_cox``; the power is taken from the ``power`` column.

    A value below the range of a positive power becomes the smallest sales, none; one at or above the bound
    that a negative power has would be infinite and becomes null.
    """
    power, y = F.col("power"), F.col("total_price")
    base = y * power + 1
    value = (
        F.when(F.abs(power) < POWER_ZERO, F.exp(y))
        .when(base > 0, F.pow(base, 1 / power))
        .when((base <= 0) & (power > 0), 0.0)
    )
    return transformed.withColumn("total_price", value - F.lit(BOX_COX_SHIFT))


def min_max_scale(series: DataFrame) -> DataFrame:
    """Scale every series to (-1, 1); keeps its ``low`` and ``range`` (1 for a constant series)."""
    low = F.min("total_price").over(_whole())
    width = F.max("total_price").over(_whole()) - low
    return (
        series.withColumn("low", low)
        .withColumn("range", F.when(width == 0, 1.0).otherwise(width))
        .withColumn("total_price", (F.col("total_price") - F.col("low")) / F.col("range") * 2 - 1)
    )


def inverse_min_max(scaled: DataFrame) -> DataFrame:
    value = (F.col("total_price") + 1) / 2 * F.col("range") + F.col("low")
    return scaled.withColumn("total_price", value).drop("low", "range")


def standardize_features(df: DataFrame, columns) -> DataFrame:
    """Each column minus its mean, over its population standard deviation (1 if constant)."""
    stats = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_std") for c in columns]
    )
    one_row = stats.select(F.struct("*").alias("stats")).scalar()
    wide = df.withColumn("stats", one_row)
    for c in columns:
        spread = F.col(f"stats.{c}_std")
        wide = wide.withColumn(c, (F.col(c) - F.col(f"stats.{c}_mean")) / F.when(spread == 0, 1.0).otherwise(spread))
    return wide.drop("stats")
