"""Logistic regressions fitted together against a plain numpy fit of each."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.plans import logistic, predictor

COLUMNS = ["a", "b", "c"]
CANDIDATES = [
    {},
    {"C": 0.05},
    {"penalty": "none"},
    {"penalty": None, "class_weight": "balanced"},
    {"penalty": "l1", "C": 0.1},
    {"penalty": "l1", "C": 1e-4},
    {"penalty": "elasticnet", "C": 0.02, "l1_ratio": 0.3},
    {"C": 0.5, "class_weight": {0: 3.0, 1: 0.5}},
]


def drawn(n=600, seed=4):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(50, 20, n), draw.integers(0, 9, n).astype(float), draw.exponential(3, n)])
    y = (x[:, 0] / 20 - x[:, 1] / 4 + draw.logistic(size=n) > 2.0).astype(float)
    return x, y, draw.integers(0, 5, n)


def frame(spark, x, y, fold):
    rows = [(*map(float, a), float(b), int(c)) for a, b, c in zip(x, y, fold)]
    return spark.createDataFrame(rows, "a double, b double, c double, y_label double, fold int").repartition(4)


def plain(x, y, parameters):
    """Proximal gradient steps with momentum, on scaled features."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    rows = np.column_stack([np.ones(len(y)), (x - mean) / scale])
    kind, c, given = parameters.get("penalty", "l2"), parameters.get("C", 1.0), parameters.get("class_weight")
    share = {"l2": 0.0, "l1": 1.0, "elasticnet": parameters.get("l1_ratio")}.get(kind)
    l1, l2 = (0.0, 0.0) if share is None else (share / c, (1 - share) / c)
    weight = np.ones(len(y))
    if given == "balanced":
        weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    elif given:
        weight = np.where(y == 1, given[1], given[0])
    free = np.array([0.0, 1.0, 1.0, 1.0])
    rate = 1 / (np.linalg.norm((rows * weight[:, None]).T @ rows, 2) / 4 + l2)
    beta = ahead = np.zeros(4)
    turn = 1.0
    for _ in range(20_000):
        slopes = rows.T @ (weight * (1 / (1 + np.exp(-rows @ ahead)) - y)) + l2 * free * ahead
        moved = ahead - rate * slopes
        moved = np.where(free == 1, np.sign(moved) * np.maximum(np.abs(moved) - rate * l1, 0), moved)
        following = (1 + np.sqrt(1 + 4 * turn * turn)) / 2
        if (ahead - moved) @ (moved - beta) > 0:
            following, momentum = 1.0, 0.0
        else:
            momentum = (turn - 1) / following
        ahead, beta, turn = moved + momentum * (moved - beta), moved, following
    slopes = beta[1:] / scale
    return np.array([beta[0] - slopes @ mean, *slopes])


def test_every_penalty_and_weight_equals_a_plain_fit(spark):
    x, y, fold = drawn()
    fits, passes = logistic.fit(frame(spark, x, y, fold), COLUMNS, CANDIDATES)
    assert passes <= 10 and [f.candidate for f in fits] == list(range(len(CANDIDATES)))
    for one, parameters in zip(fits, CANDIDATES):
        assert one.coefficients == pytest.approx(plain(x, y, parameters), abs=1e-6), parameters
    assert fits[5].coefficients[1:] == [0.0, 0.0, 0.0]


def test_folds_are_fitted_without_their_own_rows(spark):
    x, y, fold = drawn()
    fits, passes = logistic.fit(frame(spark, x, y, fold), COLUMNS, CANDIDATES, n_folds=5)
    assert passes <= 10 and len(fits) == 5 * len(CANDIDATES)
    for one in fits:
        if one.candidate in (0, 4):
            kept = fold != one.held
            assert one.coefficients == pytest.approx(plain(x[kept], y[kept], CANDIDATES[one.candidate]), abs=1e-6)
    scored = logistic.held_out_probabilities(frame(spark, x, y, fold), COLUMNS, fits)
    assert scored.count() == len(y) * len(CANDIDATES)
    of = {(f.held, f.candidate): np.array(f.coefficients) for f in fits}
    for r in scored.limit(50).collect():
        line = of[r.fold, r.number] @ np.array([1.0, r.a, r.b, r.c])
        assert r.probability == pytest.approx(1 / (1 + np.exp(-line)))


def test_odd_tables(spark):
    x, y, fold = drawn(60)
    apart = (x[:, 0] > np.median(x[:, 0])).astype(float)
    fits, passes = logistic.fit(frame(spark, x, apart, fold), COLUMNS, [{"penalty": "none"}, {}])
    assert passes <= logistic.STEPS and np.isfinite(fits[0].coefficients).all()
    assert fits[1].coefficients == pytest.approx(plain(x, apart, {}), abs=1e-6)
    fits, _ = logistic.fit(frame(spark, x, np.ones(60), fold), COLUMNS, [{}])
    assert np.isfinite(fits[0].coefficients).all()
    same = x.copy()
    same[:, 2] = 7.0
    fits, _ = logistic.fit(frame(spark, same, y, fold), COLUMNS, [{}, {"penalty": "l1"}])
    assert [f.coefficients[3] for f in fits] == pytest.approx([0.0, 0.0])
    nothing = frame(spark, x, y, fold).limit(0)
    fits, passes = logistic.fit(nothing, COLUMNS, [{}])
    assert passes == 0 and fits[0].coefficients == [0.0] * 4
    holes = frame(spark, x, y, fold).withColumn("b", F.when(F.col("b") > 3, F.col("b")))
    with pytest.raises(ValueError):
        logistic.fit(holes, COLUMNS, [{}])


@pytest.mark.parametrize("given", [{"penalty": ["l3"]}, {"class_weight": ["even"]}, {"C": [0]}, {"l1_ratio": [2]}])
def test_values_without_meaning_are_refused(given):
    with pytest.raises(ValueError):
        predictor.candidate_grid([{"CLF_NAME": "LogisticRegression", "HYPERPARAMS": given}])


def test_listed_class_weights_move_a_tree(spark):
    rows = spark.range(200).select(
        F.col("id").alias("customer_id"), *[(F.col("id") % 2).alias(c) for c in predictor.FEATURES],
        (F.col("id") % 10 < F.when(F.col("id") % 2 == 0, 4).otherwise(7)).cast("double").alias("y_label"),
    )

    def mean(weight):
        candidate = predictor.Candidate("DecisionTreeClassifier", (("class_weight", weight),))
        return predictor.score(predictor.fit_candidate(candidate, rows), rows).agg(F.avg("probability")).first()[0]

    assert mean({0: 1.0, 1: 9.0}) > mean(None) + 0.1
