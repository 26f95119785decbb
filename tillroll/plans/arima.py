"""ARIMA search and forecasts for many series.

One row per series carries its weeks as an array, which the calendar bounds. The unit of
parallel work is a series and a family of orders: all candidates that differ in p and q only are
fitted side by side, on all folds.
"""

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from tillroll.contracts import check_n_periods, check_type
from tillroll.functions import arima
from tillroll.operators import metrics, series as tools
from tillroll.session import spread

# grid key -> column; column names ignore case, so the seasonal orders are spelled out
COLUMNS = {
    "p": "p", "d": "d", "q": "q", "P": "seasonal_p", "D": "seasonal_d", "Q": "seasonal_q", "m": "season",
}
ORDER = list(COLUMNS.values())
N_SPLITS = 6
TEST_PERIODS = 8


def check_arima_grid(grid: dict):
    check_type("grid", grid, dict)
    if not grid:
        raise ValueError("the grid is empty")
    missing = [k for k in COLUMNS if k not in grid]
    if missing:
        raise KeyError(f"the grid lacks {missing}")
    for key, values in grid.items():
        if key not in COLUMNS:
            raise NameError(f"{key} is not an ARIMA parameter")
        check_type(key, values, list)
        if not values:
            raise ValueError(f"the value list of {key} is empty")
        for value in values:
            check_type(key, value, int)


def _orders(grid: dict) -> list[dict]:
    """Combinations that make sense: seasonal terms need a season length."""
    check_arima_grid(grid)
    combined = [dict(zip(COLUMNS, values)) for values in itertools.product(*[grid[k] for k in COLUMNS])]
    return [o for o in combined if o["m"] > 0 or (o["P"], o["D"], o["Q"]) == (0, 0, 0)]


def _timed(series: DataFrame) -> DataFrame:
    """One row per series: its values in order and its last week."""
    rows = F.array_sort(F.collect_list(F.struct("week_end", "total_price")))
    return (
        series.groupBy("series_id")
        .agg(F.max("week_end").alias("last_week"), rows.alias("rows"))
        .select("series_id", "last_week", F.transform("rows", lambda r: r["total_price"]).alias("history"))
    )


def arima_candidates(series: DataFrame, grid: dict, n_splits: int = N_SPLITS, test_size: int = TEST_PERIODS) -> DataFrame:
    """Candidate orders per series, and whether every fold leaves enough weeks to fit them."""
    orders = _orders(grid)
    items = [
        F.struct(
            F.lit(number).alias("candidate"), *[F.lit(order[k]).alias(c) for k, c in COLUMNS.items()],
            F.lit(arima.weeks_lost(order)).alias("weeks_used"),
            F.lit(arima.weeks_wanted(order)).alias("weeks_wanted"),
        )
        for number, order in enumerate(orders)
    ]
    lengths = series.groupBy("series_id").agg(F.count("*").alias("length"))
    first_fold = F.col("length") - n_splits * test_size
    return lengths.select("series_id", "length", F.inline(F.array(*items))).withColumn(
        "feasible", F.when(first_fold >= F.col("weeks_wanted"), 1).otherwise(0)
    )


def arima_grid_search(
    series: DataFrame, grid: dict, box_cox: bool = False, n_splits: int = N_SPLITS, test_size: int = TEST_PERIODS
) -> DataFrame:
    """Mean AIC and RMSE over expanding folds of each candidate of each series, by exact likelihood.

    A candidate that some fold leaves too few weeks has a row with nulls and a reason. The RMSE is null if
    some fold's forecast lies where the Box-Cox transform cannot be undone.
    """
    families = {}
    for number, order in enumerate(_orders(grid)):
        families.setdefault(arima.family(order), []).append((number, order))
    families = list(families.values())
    family = F.explode(F.sequence(F.lit(0), F.lit(len(families) - 1))).alias("family")
    work = spread(_timed(series).select("series_id", "history", family), "series_id", "family")

    def fit_folds(batches):
        for pdf in batches:
            found = []
            for series_id, history, family in pdf[["series_id", "history", "family"]].itertuples(index=False):
                first = len(history) - n_splits * test_size
                feasible = [(n, order) for n, order in families[family] if first >= arima.weeks_wanted(order)]
                if feasible:
                    rows = arima.search(np.asarray(history, dtype=float), feasible, n_splits, test_size, box_cox)
                    found += [(series_id, *row) for row in rows]
            yield pd.DataFrame(found, columns=["series_id", "candidate", "fold", "aic", "rmse"])

    scores = (
        work.mapInPandas(fit_folds, "series_id string, candidate int, fold int, aic double, rmse double")
        .groupBy("series_id", "candidate")
        .agg(F.avg("aic").alias("aic"), F.when(F.count("rmse") == F.count("*"), F.avg("rmse")).alias("rmse"))
    )
    candidates = arima_candidates(series, grid, n_splits, test_size).select("series_id", "candidate", *ORDER, "feasible")
    reason = F.when(F.col("feasible") == 0, "too few weeks in the first fold").alias("reason")
    every = candidates.join(scores, ["series_id", "candidate"], "left")
    return every.select("series_id", "candidate", *ORDER, "aic", "rmse", reason)


def select_arima(scores: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """Candidate with the lowest mean AIC per series; equal ones go to the first candidate.

    With series, each of them has a row: nulls and a reason if no candidate was feasible.
    """
    best = F.min(F.struct("aic", "candidate", *ORDER, "rmse")).alias("best")
    scored = scores.where(F.col("aic").isNotNull())
    chosen = scored.groupBy("series_id").agg(best).select("series_id", *[f"best.{c}" for c in ("candidate", *ORDER, "aic", "rmse")])
    if series is None:
        return chosen
    reason = F.when(F.col("candidate").isNull(), "too few weeks for every candidate").alias("reason")
    return series.select("series_id").distinct().join(chosen, "series_id", "left").select(*chosen.columns, reason)


def training_part(series: DataFrame, test_size: int = TEST_PERIODS) -> DataFrame:
    """All weeks but the last ``test_size`` of each series, for a search that the hold-out does not see."""
    place = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("week_end")))
    return series.withColumn("_place", place).where(F.col("_place") > test_size).drop("_place")


def arima_fit(series: DataFrame, selected: DataFrame, box_cox: bool = False) -> DataFrame:
    """The selected order of each series fitted to all weeks: one row per series, which can be stored.

    (series_id, last_week, the order, power, parameters, history). A series whose selected order is null has
    null parameters; power is null without Box-Cox.
    """
    work = spread(_timed(series).join(selected.select("series_id", *ORDER), "series_id"), "series_id")

    def fit_each(batches):
        for pdf in batches:
            powers, parameters = [], []
            for row in pdf.itertuples(index=False):
                order = {k: int(getattr(row, c)) for k, c in COLUMNS.items()}
                history = np.asarray(row.history, dtype=float)
                power = arima.box_cox_power(history) if box_cox else None
                fitted = arima.fit(arima.to_box_cox(history, power) if box_cox else history, order)
                powers.append(power)
                parameters.append(fitted.x[0].tolist())
            yield pdf.assign(power=pd.Series(powers, dtype=float, index=pdf.index), parameters=parameters)

    known = "series_id string, last_week date, history array<double>, " + ", ".join(f"{c} int" for c in ORDER)
    ordered = F.col(ORDER[0]).isNotNull()
    work = work.select("series_id", "last_week", "history", *[F.col(c).cast("int").alias(c) for c in ORDER])
    fitted = work.where(ordered).mapInPandas(fit_each, known + ", power double, parameters array<double>")
    every = fitted.unionByName(work.where(~ordered), allowMissingColumns=True)
    return every.select("series_id", "last_week", *ORDER, "power", "parameters", "history")


def forecast_fitted(models: DataFrame, n_periods: int) -> DataFrame:
    """The weeks after those that arima_fit saw: (series_id, step, week_end, predicted).

    A series without parameters has its weeks with null predictions; so has a week whose Box-Cox value has
    no finite sales.
    """
    check_n_periods(n_periods)

    def predict(batches):
        for pdf in batches:
            parts = []
            for row in pdf.itertuples(index=False):
                order = {k: int(getattr(row, c)) for k, c in COLUMNS.items()}
                history = np.asarray(row.history, dtype=float)
                transformed = not pd.isna(row.power)
                values = arima.to_box_cox(history, row.power) if transformed else history
                predicted = arima.known(values, order, row.parameters).forecast(n_periods)[0]
                if transformed:
                    predicted = arima.from_box_cox(predicted, row.power)
                parts.append((row.series_id, row.last_week, [float(v) if np.isfinite(v) else None for v in predicted]))
            yield pd.DataFrame(parts, columns=["series_id", "last_week", "predicted"])

    fitted = F.col("parameters").isNotNull()
    nothing = F.array_repeat(F.lit(None).cast("double"), n_periods).alias("predicted")
    return (
        models.where(fitted)
        .mapInPandas(predict, "series_id string, last_week date, predicted array<double>")
        .unionByName(models.where(~fitted).select("series_id", "last_week", nothing))
        .select("series_id", "last_week", F.posexplode("predicted").alias("position", "predicted"))
        .select(
            "series_id",
            (F.col("position") + 1).alias("step"),
            F.date_add("last_week", (F.col("position") + 1) * 7).alias("week_end"),
            "predicted",
        )
    )


def arima_forecast(series: DataFrame, selected: DataFrame, n_periods: int, box_cox: bool = False) -> DataFrame:
    """Refit the selected order on all weeks and forecast: (series_id, step, week_end, predicted).

    A series whose selected order is null has its weeks with null predictions.
    """
    check_n_periods(n_periods)
    return forecast_fitted(arima_fit(series, selected, box_cox), n_periods)


def evaluate_forecast(series: DataFrame, selected: DataFrame, test_size: int = TEST_PERIODS, box_cox: bool = False) -> DataFrame:
    """RMSE of each series on its last ``test_size`` weeks, forecast from the weeks before: (series_id, rmse, reason).

    selected should come from a search of ``training_part(series, test_size)``. A series without weeks
    before the hold-out, without a selected order, or with a week that has no finite forecast, has a null and a reason.
    """
    length = F.count("*").over(Window.partitionBy("series_id"))
    sized = series.withColumn("_length", length)
    marked = tools.time_series_holdout(sized.where(F.col("_length") > test_size).drop("_length"), test_size)
    train = marked.where("is_test = 0").drop("is_test")
    actual = marked.where("is_test = 1").select("series_id", "week_end", F.col("total_price").alias("actual"))
    forecast = arima_forecast(train, selected, test_size, box_cox)
    finite = F.every(F.col("predicted").isNotNull()).over(Window.partitionBy("series_id"))
    whole = forecast.withColumn("_finite", finite).where("_finite").drop("_finite")
    scores = metrics.rmse(whole.join(actual, ["series_id", "week_end"]), ["series_id"])
    chosen = selected.select("series_id", F.col(ORDER[0]).isNotNull().alias("_chosen"))
    every = sized.groupBy("series_id").agg(F.max("_length").alias("_length")).join(chosen, "series_id", "left")
    short = (
        F.when(F.col("_length") <= test_size, "no weeks before the hold-out")
        .when(F.coalesce("_chosen", F.lit(False)), "no finite forecast")
        .otherwise("no order was selected")
    )
    reason = F.when(F.col("rmse").isNull(), short).alias("reason")
    return every.join(scores, "series_id", "left").select("series_id", "rmse", reason)
