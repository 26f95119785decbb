"""Which customers buy next quarter: search, selection, evaluation, prediction.

Features are one row per customer. All logistic candidates and folds are fitted together;
every other candidate and fold is a distributed Spark ML fit, a few at a time. Predictions of
all fits are written to one table, so that all scores come out of one aggregation.
"""

import itertools
import math
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType

from tillroll.contracts import check_test_size, check_type
from tillroll.errors import NotTrainedError
from tillroll.operators import metrics, sampling
from tillroll.operators.customers import predict_rows, train_rows
from tillroll.operators.lookups import keyed_lookup
from tillroll.plans import logistic
from tillroll.schema import FEATURES
from tillroll.session import settle, shared_folder

TREE = {"criterion", "max_depth", "min_samples_split", "class_weight"}
LOGISTIC = "LogisticRegression"
# classifiers that give probabilities, and the parameters each accepts
REGISTRY = {
    LOGISTIC: (None, {"C", "penalty", "l1_ratio", "class_weight"}),  # see logistic.py
    "RandomForestClassifier": (RandomForestClassifier, TREE | {"n_estimators", "max_features"}),
    "DecisionTreeClassifier": (DecisionTreeClassifier, TREE),
    "GradientBoostingClassifier": (GBTClassifier, {"n_estimators", "max_depth", "learning_rate", "class_weight"}),
    "GaussianNB": (NaiveBayes, set()),
    "MLPClassifier": (MultilayerPerceptronClassifier, {"hidden_layer_sizes", "max_iter"}),
}
DEFAULT_BETA = 2
DEEPEST_TREE = 30
FITS_AT_A_TIME = 4


@dataclass(frozen=True)
class Candidate:
    """A classifier name and one value per hyperparameter."""

    classifier: str
    parameters: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.classifier}({', '.join(f'{k}={v}' for k, v in self.parameters)})"


def candidate_grid(settings: list) -> list[Candidate]:
    """Every combination of the listed hyperparameter values.

    A setting names a classifier (``CLF_NAME``) and may give ``HYPERPARAMS``: a dict of
    value lists, or a list of such dicts.
    """
    check_type("settings", settings, list)
    if not settings:
        raise ValueError("settings are empty")
    found = []
    for setting in settings:
        check_type("setting", setting, dict)
        unknown = set(setting) - {"CLF_NAME", "HYPERPARAMS"}
        if unknown:
            raise NameError(f"unknown keys in a setting: {sorted(unknown)}")
        if "CLF_NAME" not in setting:
            raise KeyError("a setting needs CLF_NAME")
        name = setting["CLF_NAME"]
        check_type("CLF_NAME", name, str)
        if name not in REGISTRY:
            raise NameError(f"{name} is not a classifier with probabilities; choose from {', '.join(REGISTRY)}")
        grids = setting.get("HYPERPARAMS", {})
        check_type("HYPERPARAMS", grids, (dict, list))
        for grid in grids if isinstance(grids, list) else [grids]:
            check_type("HYPERPARAMS", grid, dict)
            for key, values in grid.items():
                if key not in REGISTRY[name][1]:
                    raise NameError(f"{key} is not a parameter of {name}")
                check_type(key, values, list)
                if not values:
                    raise ValueError(f"the value list of {key} is empty")
                for value in values:
                    _check_value(key, value)
            found += [Candidate(name, tuple(zip(grid, values))) for values in itertools.product(*grid.values())]
    return found


def _check_value(key: str, value) -> None:
    good = {
        "penalty": lambda: value in logistic.PENALTIES,
        "class_weight": lambda: value is None or isinstance(value, dict) or value in ("balanced", "balanced_subsample"),
        "C": lambda: value > 0,
        "l1_ratio": lambda: 0 <= value <= 1,
    }
    if key in good and not good[key]():
        raise ValueError(f"{value!r} is no value of {key}")


def _estimator(candidate: Candidate, seed: int):
    kind, _ = REGISTRY[candidate.classifier]
    given = dict(candidate.parameters)
    model = kind(featuresCol="features", labelCol="y_label")
    if model.hasParam("seed"):
        model.setSeed(seed)
    if given.get("class_weight") is not None:
        model.setWeightCol("weight")
    if "criterion" in given:
        model.setImpurity(given["criterion"])
    if "max_depth" in given:
        model.setMaxDepth(DEEPEST_TREE if given["max_depth"] is None else given["max_depth"])
    if "min_samples_split" in given:  # nearest Spark has: rows per leaf
        model.setMinInstancesPerNode(max(1, given["min_samples_split"] // 2))
    if kind is RandomForestClassifier:
        model.setNumTrees(given.get("n_estimators", 100)).setFeatureSubsetStrategy(given.get("max_features", "sqrt"))
    elif kind is GBTClassifier:
        model.setMaxIter(given.get("n_estimators", 100)).setStepSize(given.get("learning_rate", 0.1))
    elif kind is NaiveBayes:
        model.setModelType("gaussian")
    elif kind is MultilayerPerceptronClassifier:
        layers = [len(FEATURES), *given.get("hidden_layer_sizes", (100,)), 2]
        model.setLayers(layers).setMaxIter(given.get("max_iter", 200))
    return model


def fit_candidate(candidate: Candidate, rows: DataFrame, standardize: bool = True, seed: int = 0) -> PipelineModel:
    """Fit one candidate. With ``standardize`` features are scaled by mean and population deviation."""
    if candidate.classifier == LOGISTIC:
        fits, _ = logistic.fit(rows, FEATURES, [dict(candidate.parameters)], standardize=standardize)
        return logistic.as_model(FEATURES, fits[0])
    counts = {r.y_label: r.n for r in rows.groupBy("y_label").agg(F.count("*").alias("n")).collect()}
    n_rows = sum(counts.values())
    weight = F.lit(1.0)
    for label, value in logistic.class_weights(dict(candidate.parameters).get("class_weight"), counts).items():
        weight = F.when(F.col("y_label") == label, value).otherwise(weight)
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="raw" if standardize else "features")]
    if standardize:
        # StandardScaler divides by the sample deviation; the factor makes it the population's
        factor = math.sqrt(n_rows / max(1, n_rows - 1))
        stages += [
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
            ElementwiseProduct(
                inputCol="scaled", outputCol="features", scalingVec=Vectors.dense([factor] * len(FEATURES))
            ),
        ]
    stages.append(_estimator(candidate, seed))
    return Pipeline(stages=stages).fit(rows.withColumn("weight", weight))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the probability of label 1."""
    helpers = ["raw", "scaled", "features", "rawPrediction", "prediction"]
    scored = model.transform(rows)
    plain = isinstance(scored.schema["probability"].dataType, ArrayType)
    chances = F.col("probability") if plain else vector_to_array("probability")
    return scored.withColumn("probability", chances[1]).drop(*helpers)


def cross_validate_classifiers(
    rows: DataFrame, candidates: Sequence[Candidate], beta: float, n_folds: int = 5, standardize: bool = True, seed: int = 0
) -> DataFrame:
    """Scores per candidate and fold.

    (candidate, fold, threshold, fbeta, fbeta_at_half, balanced_accuracy, tn, fp, fn, tp):
    ``fbeta`` is the one at the fold's best ``threshold``, the others are at 0.5.
    """
    folded = settle(sampling.stratified_folds(rows, n_folds, seed=seed))
    path = f"{shared_folder(rows.sparkSession)}/predictions-{uuid.uuid4().hex}"
    columns = ["fold", "customer_id", "y_label", "probability"]
    together = [n for n, c in enumerate(candidates) if c.classifier == LOGISTIC]
    if together:
        fits, _ = logistic.fit(folded, FEATURES, [dict(candidates[n].parameters) for n in together], n_folds, standardize)
        for one in fits:
            one.candidate = together[one.candidate]
        table = logistic.held_out_probabilities(folded, FEATURES, fits)
        table.select("number", *columns).write.partitionBy("number").parquet(path)

    def predict(numbered):
        number, candidate = numbered
        parts = []
        for fold in range(n_folds):
            model = fit_candidate(candidate, folded.where(F.col("fold") != fold), standardize, seed)
            parts.append(score(model, folded.where(F.col("fold") == fold)))
        table = reduce(DataFrame.unionByName, parts).select(F.col("fold").cast("int").alias("fold"), *columns[1:])
        table.write.parquet(f"{path}/number={number}")

    with ThreadPoolExecutor(FITS_AT_A_TIME) as pool:
        list(pool.map(predict, [(n, c) for n, c in enumerate(candidates) if n not in together]))
    names = F.element_at(F.array(*[F.lit(c.name) for c in candidates]), F.col("number") + 1)
    predictions = rows.sparkSession.read.parquet(path).withColumn("candidate", names)
    by = ["candidate", "fold"]
    best = metrics.best_threshold(metrics.threshold_fbeta_curve(predictions, beta, by), by)
    at_half = metrics.confusion_matrix(predictions, by).select(
        *by,
        metrics.fbeta_score(beta).alias("fbeta_at_half"),
        metrics.balanced_accuracy().alias("balanced_accuracy"),
        "tn", "fp", "fn", "tp",
    )
    return best.join(at_half, by)


def select_candidate(scores: DataFrame) -> DataFrame:
    """Candidate with the highest mean F-beta, and the mean of its per-fold best thresholds."""
    means = scores.groupBy("candidate").agg(F.avg("fbeta").alias("fbeta"), F.avg("threshold").alias("threshold"))
    return means.orderBy(F.desc("fbeta"), "candidate").limit(1).select("candidate", "threshold", "fbeta")


def evaluate_holdout(model: PipelineModel, threshold: float, train: DataFrame, test: DataFrame, beta: float) -> DataFrame:
    """(split, fbeta, balanced_accuracy, tn, fp, fn, tp) of a fitted model at its operating threshold."""
    rows = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("holdout")))
    matrix = metrics.confusion_matrix(score(model, rows), ["split"], threshold)
    return matrix.select(
        "split", metrics.fbeta_score(beta).alias("fbeta"),
        metrics.balanced_accuracy().alias("balanced_accuracy"), "tn", "fp", "fn", "tp",
    )


@dataclass
class PurchasePredictor:
    """A trained predictor and how it scored."""

    candidate: Candidate
    model: PipelineModel
    threshold: float
    cv_scores: DataFrame
    evaluation: DataFrame


def train_purchase_predictor(
    features: DataFrame, settings: list, test_size: float = 0.2, beta: float = DEFAULT_BETA,
    standardize: bool = True, seed: int = 0,
) -> PurchasePredictor:
    """Search on a stratified training part, evaluate the winner, fit it on all training rows."""
    check_test_size(test_size, 1)
    candidates = candidate_grid(settings)
    marked = settle(sampling.stratified_holdout(train_rows(features), test_size, seed=seed))
    train = marked.where("is_test = 0").drop("is_test")
    test = marked.where("is_test = 1").drop("is_test")
    scores = settle(cross_validate_classifiers(train, candidates, beta, standardize=standardize, seed=seed))
    best = select_candidate(scores).first()
    winner = next(c for c in candidates if c.name == best.candidate)
    refitted = fit_candidate(winner, train, standardize, seed)
    evaluation = settle(evaluate_holdout(refitted, best.threshold, train, test, beta))
    final = fit_candidate(winner, marked, standardize, seed)
    return PurchasePredictor(winner, final, best.threshold, scores, evaluation)


def predict_purchases(features: DataFrame, model: PipelineModel | None, threshold: float) -> DataFrame:
    """(customer_id, probability, label) of the rows to predict."""
    if model is None:
        raise NotTrainedError("train or load a model first")
    return score(model, predict_rows(features)).select(
        "customer_id", "probability", metrics.threshold_label(F.col("probability"), threshold).alias("label")
    )


def customers_buying(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("label") == 1).select("customer_id")


def customers_not_buying(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("label") == 0).select("customer_id")


def lookup_prediction(predictions: DataFrame, customers, ignore_missing: bool = False) -> DataFrame:
    """Label of the wanted customers."""
    return keyed_lookup(predictions, "customer_id", customers, ["label"], ignore_missing)
