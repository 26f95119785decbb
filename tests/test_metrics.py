import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.functions.ranks import FEW, exact_quantiles, narrowed, rank_by_hash
from tillroll.operators import metrics, profile, sampling


def predictions(spark, pairs):
    return spark.createDataFrame([(float(y), float(p)) for y, p in pairs], "y_label double, probability double")


def brute_curve(pairs, beta):
    curve = []
    for i in range(101):
        t = i * 0.01
        tp = sum(y == 1 and p > t for y, p in pairs)
        fp = sum(y == 0 and p > t for y, p in pairs)
        fn = sum(y == 1 and p <= t for y, p in pairs)
        whole = (1 + beta**2) * tp + beta**2 * fn + fp
        curve.append((1 + beta**2) * tp / whole if whole else 0.0)
    return curve


def test_curve_equals_brute_force_at_the_thresholds_themselves(spark):
    rng = np.random.default_rng(0)
    exact = [(int(rng.integers(2)), i * 0.01) for i in range(101)]
    noise = [(int(rng.integers(2)), float(p)) for p in rng.random(300)]
    near = [(1, float(np.nextafter(i * 0.01, 1))) for i in range(100)]
    pairs = exact + noise + near
    curve = metrics.threshold_fbeta_curve(predictions(spark, pairs), 0.5).orderBy("threshold").collect()
    assert np.allclose([r.fbeta for r in curve], brute_curve(pairs, 0.5))
    best = metrics.best_threshold(metrics.threshold_fbeta_curve(predictions(spark, pairs), 0.5)).first()
    wanted = brute_curve(pairs, 0.5)
    assert best.threshold == pytest.approx(int(np.argmax(wanted)) * 0.01)


def test_lowest_threshold_wins(spark):
    best = metrics.best_threshold(metrics.threshold_fbeta_curve(predictions(spark, [(1, 0.9), (0, 0.2)]), 1)).first()
    assert (round(best.threshold, 2), best.fbeta) == (0.2, 1.0)


def test_confusion_edges(spark):
    def scores(pairs):
        matrix = metrics.confusion_matrix(predictions(spark, pairs))
        return matrix.select("*", metrics.fbeta_score(2).alias("f"), metrics.balanced_accuracy().alias("b")).first()

    at_half = scores([(1, 0.5), (0, 0.5), (1, 0.6)])
    assert (at_half.tn, at_half.fp, at_half.fn, at_half.tp) == (1, 0, 1, 1)
    none_found = scores([(1, 0.1), (0, 0.1)])
    assert (none_found.f, none_found.b) == (0.0, 0.5)
    perfect = scores([(1, 0.9), (0, 0.1)])
    assert (perfect.f, perfect.b) == (1.0, 1.0)
    assert scores([(0, 0.1)]).f == 0.0


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    data = {
        "skewed": np.concatenate([np.exp(rng.normal(5, 3, 700)), -np.exp(rng.normal(1, 2, 300))]),
        "copies": np.concatenate([np.full(400, 3.0), rng.integers(0, 10, 600).astype(float)]),
    }
    table = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), list(data))
    found = {(r.column, r.probability): r.value for r in exact_quantiles(table, list(data), (0, 0.25, 0.5, 0.9, 1)).collect()}
    assert len(found) == 10
    for (name, p), value in found.items():
        assert value == pytest.approx(np.quantile(data[name], p), rel=1e-12)


def test_quantiles_of_a_narrow_range_rank_few_rows(spark):
    table = spark.range(1_000_000).select((F.col("id") + 1e9).alias("v"))
    values = table.select(F.lit(0).alias("at"), F.col("v").alias("value"))
    targets, passes = narrowed(values, (0, 0.25, 0.5, 0.75, 1))
    assert passes <= 3 and len(targets) == 8
    assert all(t.n <= FEW or t.low == t.high for t in targets)
    assert all(t.before <= t["rank"] < t.before + t.n for t in targets)
    found = {r.probability: r.value for r in exact_quantiles(table, ["v"], (0, 0.25, 0.5, 1)).collect()}
    assert found == {0: 1e9, 0.25: 1e9 + 249_999.75, 0.5: 1e9 + 499_999.5, 1: 1e9 + 999_999}


def test_quantiles_of_odd_values(spark):
    odd = [None, float("nan"), float("-inf"), -1e300, -1e-300, 0.0, 1e-300, 1e-300, 1e-299, 5.0, float("inf")]
    table = spark.createDataFrame([(v, None) for v in odd], "v double, empty double")
    known = sorted(v for v in odd if v is not None and v == v)
    found = {(r.column, r.probability): r.value for r in exact_quantiles(table, ["v", "empty"], (0, 0.25, 0.5, 0.75, 1)).collect()}
    assert found == {("v", p): known[round(p * 8)] for p in (0, 0.25, 0.5, 0.75, 1)}
    values = table.where("v IS NOT NULL AND NOT isnan(v)").select(F.lit(0).alias("at"), F.col("v").alias("value"))
    targets, _ = narrowed(values, (0, 0.25, 0.5, 0.75, 1), few=0)
    assert {t["rank"]: t.low for t in targets} == {k: known[k] for k in (0, 2, 4, 6, 8)}
    assert exact_quantiles(table.limit(0), ["v"], (0.5,)).count() == 0


def test_ranks_are_a_permutation_per_group(spark):
    table = spark.range(5000).selectExpr("id AS customer_id", "CAST(id % 3 = 0 AS DOUBLE) AS y_label")
    ranked = rank_by_hash(table, ["y_label"], "customer_id", 5, "place")
    for label, size in ((1.0, 1667), (0.0, 3333)):
        places = [r.place for r in ranked.where(F.col("y_label") == label).collect()]
        assert sorted(places) == list(range(1, size + 1))


def test_stratified_parts(spark):
    table = spark.range(1000).selectExpr("id AS customer_id", "CAST(id % 10 = 0 AS DOUBLE) AS y_label")
    marked = sampling.stratified_holdout(table, 0.2, seed=3)
    assert rows(marked.where("is_test = 1").groupBy("y_label").count()) == [(0.0, 180), (1.0, 20)]
    folds = sampling.stratified_folds(table, 5, seed=3)
    assert {r["count"] for r in folds.groupBy("y_label", "fold").count().collect()} == {20, 180}
    assert rows(marked) == rows(sampling.stratified_holdout(table, 0.2, seed=3))
    assert rows(marked) != rows(sampling.stratified_holdout(table, 0.2, seed=4))
    with pytest.raises(ValueError):
        sampling.stratified_holdout(table, 1.5)


def test_variance_inflation(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2))
    x = np.column_stack([x, x[:, 0] + 0.1 * rng.normal(size=200)])
    table = spark.createDataFrame(x.tolist(), ["a", "b", "c"])
    found = {r.feature: r.vif for r in profile.variance_inflation(table, ["a", "b", "c"]).collect()}
    for i, name in enumerate("abc"):
        others = np.delete(x, i, axis=1)
        residual = x[:, i] - others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert found[name] == pytest.approx(x[:, i] @ x[:, i] / (residual @ residual), rel=1e-6)


def test_boxplot_and_balance(spark):
    table = spark.createDataFrame([(float(v), float(v > 3)) for v in (1, 2, 3, 4, 100)], ["x", "y_label"])
    box = profile.boxplot_stats(table, ["x"]).first()
    assert (box.q25, box.q50, box.q75, box.lower_whisker, box.upper_whisker, box.outliers) == (2, 3, 4, 1, 4, 1)
    assert profile.label_balance(table).first().imbalance == 1.5
