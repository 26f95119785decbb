"""One nonlinear autoregression for all series.

Lag vectors of every series, each scaled to (-1, 1) by its own training weeks, are
pooled into one table, on which Spark ML fits tree ensembles.
"""

import itertools
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from tillroll.contracts import check_n_periods, check_type
from tillroll.operators import metrics, series as tools
from tillroll.session import settle

LAGS = 4
REGRESSORS = {
    "GBTRegressor": (GBTRegressor, {"maxIter", "maxDepth", "stepSize"}),
    "RandomForestRegressor": (RandomForestRegressor, {"numTrees", "maxDepth"}),
}
ROUNDS_PER_STORE = 10
#: Fits that run side by side; each has a few small tasks at a time.
FITS_AT_ONCE = 8


def regressor_grid(settings: dict) -> list[tuple[str, dict]]:
    """Combinations of parameter values per regressor name."""
    check_type("settings", settings, dict)
    if not settings:
        raise ValueError("settings are empty")
    found = []
    for name, grid in settings.items():
        if name not in REGRESSORS:
            raise NameError(f"{name} is not a regressor; choose from {', '.join(REGRESSORS)}")
        check_type(name, grid, dict)
        for key, values in grid.items():
            if key not in REGRESSORS[name][1]:
                raise NameError(f"{key} is not a parameter of {name}")
            check_type(key, values, list)
            if not values:
                raise ValueError(f"the value list of {key} is empty")
        found += [(name, dict(zip(grid, values))) for values in itertools.product(*grid.values())]
    return found


def _scales(series: DataFrame) -> DataFrame:
    width = F.max("total_price") - F.min("total_price")
    return series.groupBy("series_id").agg(
        F.min("total_price").alias("low"), F.when(width == 0, 1.0).otherwise(width).alias("range")
    )


def _scaled_sequences(sequences: DataFrame, scales: DataFrame, lags: int) -> DataFrame:
    names = [*[f"x_{k}" for k in range(1, lags + 1)], "y_1"]
    # forests draw their samples by the order of rows, which a join does not keep
    joined = sequences.join(scales, "series_id").repartition("series_id").sortWithinPartitions("series_id", "week_end")
    return joined.withColumns({c: (F.col(c) - F.col("low")) / F.col("range") * 2 - 1 for c in names})


def _pipeline(name: str, parameters: dict, lags: int, seed: int) -> Pipeline:
    assembler = VectorAssembler(inputCols=[f"x_{k}" for k in range(1, lags + 1)], outputCol="features")
    kind, _ = REGRESSORS[name]
    return Pipeline(stages=[assembler, kind(featuresCol="features", labelCol="y_1", seed=seed, **parameters)])


def _unscaled(column: str):
    return (F.col(column) + 1) / 2 * F.col("range") + F.col("low")


def _fits(grid: list) -> list[tuple[str, dict, list]]:
    """What has to be fitted for the candidates: (name, parameters, [(candidate, boosting rounds or None)]).

    A round of boosting depends on the rounds before it only, so the candidates that differ in their number share
    the fit of the longest.
    """
    fits = {}
    for number, (name, parameters) in enumerate(grid):
        rounds = parameters.get("maxIter")
        same = (name, *sorted((k, v) for k, v in parameters.items() if k != "maxIter"), number if rounds is None else "rounds")
        fits.setdefault(same, []).append((number, rounds))
    found = []
    for sizes in fits.values():
        longest = max(sizes, key=lambda size: size[1] or 0)[0]
        found.append((*grid[longest], sizes))
    return found


def _first_trees(fitted: PipelineModel, rounds: int | None) -> PipelineModel:
    """The fitted pipeline as it was after so many boosting rounds."""
    model = fitted.stages[-1]
    if rounds is None or rounds >= model.getNumTrees:
        return fitted
    old, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    package = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(package.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for k, (tree, weight) in enumerate(itertools.islice(zip(old.trees(), model.treeWeights), rounds)):
        trees[k], weights[k] = tree, weight
    shorter = package.GBTRegressionModel(f"{model.uid}_{rounds}", trees, weights)
    shorter.setFeaturesCol(model.getFeaturesCol())
    return PipelineModel([*fitted.stages[:-1], GBTRegressionModel(shorter)])


def autoregression_grid_search(
    series: DataFrame, settings: dict, lags: int = LAGS, n_splits: int = 6, test_size: int = 8, seed: int = 0
) -> DataFrame:
    """RMSE per candidate and fold: (candidate, fold, rmse), in units of sales.

    Lag vectors are folded by time within each series; scaling uses the training weeks of
    the fold only. Fits run side by side, and boosted candidates that differ in rounds only are one fit.
    """
    sequences = tools.lag_sequences(series, lags)
    labelled = sequences.withColumn("total_price", F.col("y_1"))
    folded = settle(
        tools.expanding_folds(labelled, n_splits, test_size)
        .drop("total_price")
        .join(sequences, ["series_id", "week_end"])
    )
    scaled = []
    for fold in range(n_splits):
        rows = folded.where(F.col("fold") == fold)
        seen = rows.where("is_test = 0").select("series_id", F.explode(F.array("x_1", "y_1")).alias("total_price"))
        scaled.append(settle(_scaled_sequences(rows, _scales(seen), lags)))

    def scores(job):
        fold, (name, parameters, sizes) = job
        fitted = _pipeline(name, parameters, lags, seed).fit(scaled[fold].where("is_test = 0"))
        parts = None
        for number, size in sizes:
            tested = _first_trees(fitted, size).transform(scaled[fold].where("is_test = 1")).select(
                F.lit(number).alias("candidate"), F.lit(fold).alias("fold"),
                _unscaled("y_1").alias("actual"), _unscaled("prediction").alias("predicted"),
            )
            part = metrics.rmse(tested, ["candidate", "fold"])
            parts = part if parts is None else parts.unionByName(part)
        return [tuple(row) for row in parts.collect()]

    jobs = list(itertools.product(range(n_splits), _fits(regressor_grid(settings))))
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        found = [row for part in pool.map(scores, jobs) for row in part]
    return series.sparkSession.createDataFrame(found, "candidate int, fold int, rmse double")


def select_autoregression(scores: DataFrame) -> DataFrame:
    """Candidate with the lowest mean RMSE."""
    return scores.groupBy("candidate").agg(F.avg("rmse").alias("rmse")).orderBy("rmse", "candidate").limit(1)


def train_autoregression(
    series: DataFrame, settings: dict, lags: int = LAGS, seed: int = 0, n_splits: int = 6, test_size: int = 8
) -> tuple[PipelineModel, DataFrame]:
    """Search, then fit the best candidate on all weeks. Returns the model and the search scores."""
    scores = settle(autoregression_grid_search(series, settings, lags, n_splits, test_size, seed))
    best = select_autoregression(scores).first().candidate
    name, parameters = regressor_grid(settings)[best]
    scaled = settle(_scaled_sequences(tools.lag_sequences(series, lags), _scales(series), lags))
    return _pipeline(name, parameters, lags, seed).fit(scaled), scores


def autoregression_forecast(series: DataFrame, model: PipelineModel, n_periods: int, lags: int = LAGS) -> DataFrame:
    """Forecast one week at a time: (series_id, step, week_end, predicted).

    Every round predicts the next week of all series and slides their lag vectors; the
    table is stored every few rounds, so that the plan stays short.
    """
    check_n_periods(n_periods)
    names: Sequence[str] = [f"x_{k}" for k in range(1, lags + 1)]
    state = tools.latest_lag_vector(series, lags).join(_scales(series), "series_id")
    state = state.select(
        "series_id", "week_end", "low", "range", F.array().cast("array<double>").alias("path"),
        *[((F.col("lags")[k] - F.col("low")) / F.col("range") * 2 - 1).alias(name) for k, name in enumerate(names)],
    )
    for done in range(1, n_periods + 1):
        state = model.transform(state).select(
            "series_id", "week_end", "low", "range",
            F.concat("path", F.array("prediction")).alias("path"),
            *[F.col(new).alias(old) for old, new in zip(names, [*names[1:], "prediction"])],
        )
        if done % ROUNDS_PER_STORE == 0 and done < n_periods:
            state = settle(state)
    return state.select("series_id", "week_end", "low", "range", F.posexplode("path").alias("position", "value")).select(
        "series_id",
        (F.col("position") + 1).alias("step"),
        F.date_add("week_end", (F.col("position") + 1) * 7).alias("week_end"),
        _unscaled("value").alias("predicted"),
    )
