import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.catalog import forecast as catalog
from tillroll.errors import IncompatibleTransformError, ModelNotFoundError
from tillroll.functions import arima as single, kalman
from tillroll.operators import profile, series as tools, stationarity
from tillroll.plans import arima, autoregression, use_cases
from tillroll.sources import datasets

FIRST = dt.date(2020, 1, 5)


def weekly(spark, **histories):
    data = [(name, FIRST + dt.timedelta(weeks=i), float(v)) for name, h in histories.items() for i, v in enumerate(h)]
    return spark.createDataFrame(data, "series_id string, week_end date, total_price double")


def ar1(n, phi=0.6, seed=0, level=100.0):
    rng = np.random.default_rng(seed)
    x = [0.0]
    for _ in range(n + 50):
        x.append(phi * x[-1] + rng.normal())
    return level + np.array(x[-n:])


def order(**given):
    return {"p": 0, "d": 0, "q": 0, "P": 0, "D": 0, "Q": 0, "m": 0} | given


GRID = {"p": [0, 1], "d": [0], "q": [0], "P": [0], "D": [0], "Q": [0], "m": [0]}


def test_coefficients_are_recovered():
    ar, _ = single.fit(ar1(3000), order(p=1)).coefficients()
    assert ar[1][0] == pytest.approx(0.6, abs=0.05)
    rng = np.random.default_rng(4)
    shocks = rng.normal(size=4000)
    _, ma = single.fit(10 + shocks[1:] + 0.5 * shocks[:-1], order(q=1)).coefficients()
    assert ma[1][0] == pytest.approx(0.5, abs=0.06)


def dense_likelihood(shape, x, y):
    """Log-likelihood, mean and forecast of a series as one draw from a Gaussian, from the weights of its shocks."""
    ar, ma = shape.coefficients(x[None])
    n, psi = len(y), np.zeros(8000)
    psi[0] = 1.0
    for k in range(1, len(psi)):
        psi[k] = (ma[k][0] if k in ma else 0.0) + sum(v[0] * psi[k - lag] for lag, v in ar.items() if lag <= k)
    covariance = np.array([psi[: len(psi) - k] @ psi[k:] for k in range(n + 5)])
    matrix = covariance[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    root = np.linalg.cholesky(matrix)
    own, ones = np.linalg.solve(root, y), np.linalg.solve(root, np.ones(n))
    mean = (own @ ones) / (ones @ ones)
    scale = ((own - mean * ones) ** 2).mean()
    ahead = [mean + covariance[h : h + n][::-1] @ np.linalg.solve(matrix, y - mean) for h in range(1, 4)]
    return -0.5 * (n * np.log(2 * np.pi * scale) + n + 2 * np.log(np.diag(root)).sum()), mean, ahead


@pytest.mark.parametrize(
    "sizes", [(0, 0, 0, 0, 0), (1, 0, 0, 0, 0), (2, 0, 0, 0, 0), (0, 1, 0, 0, 0), (2, 2, 0, 0, 0), (1, 1, 1, 0, 4), (1, 2, 1, 1, 7), (0, 1, 2, 0, 12)]
)
def test_likelihood_and_forecast_equal_the_dense_gaussian(sizes):
    rng = np.random.default_rng(sum(sizes))
    shape = kalman.Shape(*sizes)
    x, y, lengths = rng.normal(size=(3, shape.n)) * 0.5, rng.normal(size=(3, 70)) + 5, np.array([70, 55, 31])
    mean, _, likelihood, _ = kalman.Models(shape, x).run(y, lengths)
    ahead = kalman.forecast(shape, x, y, lengths, 3)
    for i, n in enumerate(lengths):
        wanted, centre, weeks = dense_likelihood(shape, x[i], y[i, :n])
        assert likelihood[i] == pytest.approx(wanted, abs=1e-6)
        assert mean[i] == pytest.approx(centre, abs=1e-6)
        assert ahead[i] == pytest.approx(weeks, abs=1e-6)


def test_fit_is_a_maximum_and_counts_its_parameters():
    fits = single.fit(ar1(150, 0.5, 7), order(p=1, q=1))
    shape, x = fits.shape, fits.x
    best = fits.likelihood[0]
    for step in np.eye(2):
        for size in (0.05, -0.05):
            assert kalman.log_likelihoods(shape, x + size * step, fits.series, fits.lengths)[0] <= best + 1e-6
    assert fits.aic[0] == pytest.approx(2 * 4 - 2 * best)


def test_differences_are_undone():
    line = 5.0 + 2.0 * np.arange(60)
    assert np.allclose(single.fit(line, order(d=1)).forecast(3)[0], [125, 127, 129])
    season = np.tile([1.0, 5.0, 2.0, 8.0], 12)
    assert np.allclose(single.fit(season, order(D=1, m=4)).forecast(5)[0], [1, 5, 2, 8, 1])


def test_search_of_a_family_equals_single_fits():
    history = ar1(90, 0.7, 3)
    candidates = [(0, order()), (1, order(p=1)), (2, order(p=2, q=1)), (3, order(q=1)), (4, order(p=1, m=52))]
    found = {(n, fold): (aic, rmse) for n, fold, aic, rmse in single.search(history, candidates, 3, 8)}
    assert len(found) == 15
    for n, o in candidates:
        for fold in range(3):
            end = len(history) - (3 - fold) * 8
            alone = single.fit(history[:end], o)
            error = np.sqrt(np.mean((history[end : end + 8] - alone.forecast(8)[0]) ** 2))
            assert found[n, fold][0] == pytest.approx(alone.aic[0], abs=0.05)
            assert found[n, fold][1] == pytest.approx(error, rel=0.05)
    assert found[1, 0] == found[4, 0]


def test_hold_out_does_not_reach_the_search(spark):
    history = ar1(110, 0.7, 5)
    other = np.concatenate([history[:-8], history[-8:] * 50])
    series = weekly(spark, a=history, b=other, tiny=ar1(6), few=ar1(30))
    scores = arima.arima_grid_search(arima.training_part(series), GRID)
    kept = {(r.series_id, r.candidate): (r.aic, r.reason) for r in scores.collect()}
    assert kept["a", 1] == kept["b", 1] and kept["a", 0] == kept["b", 0]
    assert kept["few", 0] == (None, "too few weeks in the first fold")
    selected = arima.select_arima(scores, series)
    result = {r.series_id: (r.rmse is None, r.reason) for r in arima.evaluate_forecast(series, selected).collect()}
    assert result == {
        "a": (False, None), "b": (False, None), "tiny": (True, "no weeks before the hold-out"), "few": (True, "no order was selected"),
    }


@pytest.mark.parametrize("power", [-1.0, 0.0, 0.5, 2.0])
def test_box_cox_goes_back(power):
    x = np.array([1.0, 2.5, 10.0])
    assert np.allclose(single.from_box_cox(single.to_box_cox(x, power), power), x)


def test_search_prefers_the_true_order(spark):
    series = weekly(spark, a=ar1(200, 0.8, 1), short=ar1(30))
    candidates = {(r.series_id, r.p): r.feasible for r in arima.arima_candidates(series, GRID).collect()}
    assert candidates == {("a", 0): 1, ("a", 1): 1, ("short", 0): 0, ("short", 1): 0}
    selected = arima.select_arima(arima.arima_grid_search(series, GRID))
    assert rows(selected, "series_id", "p") == [("a", 1)]
    forecast = arima.arima_forecast(series, selected, 4).orderBy("step").collect()
    last = FIRST + dt.timedelta(weeks=199)
    assert [r.week_end for r in forecast] == [last + dt.timedelta(weeks=k) for k in range(1, 5)]
    assert arima.evaluate_forecast(series.where("series_id = 'a'"), selected).first().rmse < 5
    outlook = use_cases.sales_outlook(arima.arima_forecast(series, selected, 4)).collect()
    assert outlook[0].series_total == pytest.approx(sum(r.predicted for r in outlook))
    assert all((r.week_end - r.week_begin).days == 7 for r in outlook)


def test_search_with_box_cox_and_seasons(spark):
    grid = GRID | {"d": [1], "q": [0, 1], "P": [0, 1], "m": [0, 4]}
    series = weekly(spark, a=np.abs(ar1(120)), flat=np.full(120, 7.0))
    scores = arima.arima_grid_search(series, grid, box_cox=True)
    assert scores.where("season = 0 AND seasonal_p > 0").count() == 0
    assert scores.groupBy("series_id").count().count() == 2
    forecast = arima.arima_forecast(series, arima.select_arima(scores), 52, box_cox=True)
    assert forecast.count() == 104
    flat = [r.predicted for r in forecast.where("series_id = 'flat'").collect()]
    assert np.allclose(flat, 7.0, atol=1e-3)


def test_pooled_autoregression(spark):
    series = weekly(spark, **{f"s{k}": 50 * (k + 1) + 10 * np.sin(np.arange(90) / 3 + k) for k in range(4)})
    settings = {"RandomForestRegressor": {"numTrees": [10], "maxDepth": [2, 6]}}
    model, scores = autoregression.train_autoregression(series, settings, seed=1, n_splits=2)
    assert scores.count() == 4
    assert autoregression.select_autoregression(scores).first().candidate == 1
    first = rows(autoregression.autoregression_forecast(series, model, 12))
    assert len(first) == 48
    again, _ = autoregression.train_autoregression(series, settings, seed=1, n_splits=2)
    assert first == rows(autoregression.autoregression_forecast(series, again, 12))
    low, high = 50 - 11, 200 + 11
    assert all(low <= r[3] <= high for r in first)


def test_rows_reach_the_fit_in_one_order(spark):
    series = weekly(spark, **{f"s{k}": np.arange(30.0) + k for k in range(5)})
    found = []
    for df in (series, series.orderBy(F.desc("total_price"), "series_id").repartition(3)):
        sequences = tools.lag_sequences(df, 4).orderBy(F.desc("week_end"))
        found.append(autoregression._scaled_sequences(sequences, autoregression._scales(df), 4).collect())
    assert found[0] == found[1] and len(found[0]) == 5 * 26


def test_registered_autoregression_searches_all_folds(spark, monkeypatch):
    series = weekly(spark, **{f"s{k}": 50 * (k + 1) + 10 * np.sin(np.arange(90) / 3 + k) for k in range(2)})
    monkeypatch.setattr(catalog, "country_series", lambda *_: series)
    monkeypatch.setattr(catalog, "REGRESSORS", {"RandomForestRegressor": {"numTrees": [2], "maxDepth": [2]}})
    scores = catalog.regressed.__wrapped__(spark, "nowhere")[2]
    assert rows(scores, "candidate", "fold") == [(0, fold) for fold in range(6)]


def test_registered_autoregression_has_the_candidates_of_the_reference():
    boosted = [p for name, p in autoregression.regressor_grid(catalog.REGRESSORS) if name == "GBTRegressor"]
    assert len(boosted) == 12 and max(p["maxIter"] for p in boosted) == 200


def test_boosted_candidates_of_one_fit_score_as_fitted_alone(spark):
    series = weekly(spark, **{f"s{k}": 50 * (k + 1) + 10 * np.sin(np.arange(90) / 3 + k) for k in range(3)})
    settings = {"GBTRegressor": {"maxIter": [5, 2, 9], "maxDepth": [2, 3]}, "RandomForestRegressor": {"numTrees": [3]}}
    grid = autoregression.regressor_grid(settings)
    assert sorted(len(sizes) for _, _, sizes in autoregression._fits(grid)) == [1, 3, 3]
    together = rows(autoregression.autoregression_grid_search(series, settings, n_splits=2, seed=1))
    alone = []
    for number, (name, parameters) in enumerate(grid):
        one = {name: {k: [v] for k, v in parameters.items()}}
        alone += [(number, *row[1:]) for row in rows(autoregression.autoregression_grid_search(series, one, n_splits=2, seed=1))]
    assert together == sorted(alone, key=str)


def test_stationarity(spark):
    rng = np.random.default_rng(5)
    series = weekly(spark, noise=rng.normal(size=300), walk=np.cumsum(rng.normal(size=300)))
    found = {(r.series_id, r.test): r.stationary for r in stationarity.stationarity_tests(series).collect()}
    assert found[("noise", "adf")] == found[("noise", "kpss")] == 1
    assert found[("walk", "adf")] == found[("walk", "kpss")] == 0
    assert rows(stationarity.differencing_order(series)) == [("noise", 0), ("walk", 1)]


def test_partial_autocorrelation_of_ar1(spark):
    acf = profile.autocorrelation(weekly(spark, a=ar1(2000, 0.6, 2)), lags=5)
    pacf = {r.lag: r.pacf for r in profile.partial_autocorrelation(acf).collect()}
    assert pacf[0] == 1.0
    assert pacf[1] == pytest.approx(0.6, abs=0.06)
    assert all(abs(pacf[k]) < 0.08 for k in range(2, 6))


def test_sequences_holdout_and_folds(spark):
    series = weekly(spark, a=range(60))
    first = tools.lag_sequences(series, 3, 2).orderBy("week_end").first()
    assert (first.x_1, first.x_3, first.y_1, first.y_2) == (0, 2, 3, 4)
    assert tools.lag_sequences(series, 3, 2).count() == 60 - 5 + 1
    assert tools.time_series_holdout(series, 0.25).where("is_test = 1").count() == 15
    folds = tools.expanding_folds(series)
    assert rows(folds.where("is_test = 0").groupBy("fold").count()) == [(f, 12 + 8 * f) for f in range(6)]
    assert {r["count"] for r in folds.where("is_test = 1").groupBy("fold").count().collect()} == {8}
    assert rows(tools.latest_lag_vector(series, 2), "lags") == [([58.0, 59.0],)]
    with pytest.raises(Exception, match="test_size"):
        tools.time_series_holdout(series, 60).collect()


def test_scaling_goes_back(spark):
    series = weekly(spark, a=[1, 3, 2], flat=[4, 4])
    scaled = tools.min_max_scale(series)
    assert rows(scaled.where("series_id = 'a'").orderBy("week_end"), "total_price") == [(-1.0,), (0.0,), (1.0,)]
    assert rows(tools.inverse_min_max(scaled)) == rows(series)
    lambdas = tools.box_cox_lambdas(series)
    back = tools.inverse_box_cox(tools.box_cox(series, lambdas)).select("series_id", "week_end", "total_price")
    assert np.allclose([r[2] for r in rows(back)], [r[2] for r in rows(series)])


@pytest.mark.parametrize("n", [0, -5, 53])
def test_forecast_length_is_checked(spark, n):
    with pytest.raises(ValueError):
        tools.future_weeks(weekly(spark, a=[1.0]), n)


def test_short_series_have_rows(spark):
    series = weekly(spark, long=ar1(120, 0.6, 3), short=[1.0, 2.0, 4.0])
    tests = {(r.series_id, r.test): r for r in stationarity.stationarity_tests(series).collect()}
    assert len(tests) == 4
    for test in ("adf", "kpss"):
        assert (tests["short", test].statistic, tests["short", test].p_value, tests["short", test].stationary) == (None, None, None)
        assert tests["short", test].reason == "fewer than 12 weeks"
        assert tests["long", test].stationary in (0, 1) and tests["long", test].reason is None
    orders = {r.series_id: r.differences for r in stationarity.differencing_order(series).collect()}
    assert orders["short"] is None and orders["long"] == 0
    grid = {"p": [1], "d": [0], "q": [0], "P": [0], "D": [0], "Q": [0], "m": [0]}
    selected = arima.select_arima(arima.arima_grid_search(series, grid), series)
    found = {r.series_id: (r.candidate, r.p, r.reason) for r in selected.collect()}
    assert found == {"long": (0, 1, None), "short": (None, None, "too few weeks for every candidate")}
    outlook = use_cases.sales_outlook(arima.arima_forecast(series, selected, 4)).collect()
    assert sorted((r.series_id, r.step, r.predicted is None, r.series_total is None) for r in outlook) == [
        (name, step, name == "short", name == "short") for name in ("long", "short") for step in (1, 2, 3, 4)
    ]


def test_short_series_keep_a_row_with_a_reason(spark):
    series = weekly(spark, long=range(60), short=range(48), tiny=range(2))
    folds = tools.expanding_folds(series, keep_short=True)
    assert rows(folds.where("reason IS NOT NULL"), "series_id", "fold", "is_test") == [("short", None, None), ("tiny", None, None)]
    assert folds.where("reason IS NULL").drop("reason").exceptAll(tools.expanding_folds(series)).count() == 0
    lags = tools.latest_lag_vector(series, 3, keep_short=True)
    assert rows(lags, "series_id", "lags", "reason") == [
        ("long", [57.0, 58.0, 59.0], None), ("short", [45.0, 46.0, 47.0], None), ("tiny", None, "too few weeks for the lags"),
    ]


def test_box_cox_power_is_the_best_of_a_fine_grid(spark):
    draw = np.random.default_rng(3)
    values = {
        "log": np.exp(draw.normal(3, 0.7, 90)), "root": draw.normal(20, 4, 120) ** 2, "left": 50 - draw.gamma(2, 4, 80),
        "zeros": np.where(np.arange(60) % 9 == 0, 0.0, draw.gamma(3, 100, 60)), "two": np.array([1.0, 7.0]),
    }
    found = {r.series_id: r.power for r in tools.box_cox_lambdas(weekly(spark, flat=[5, 5, 5], one=[2], **values)).collect()}
    assert found.pop("flat") == 1 and found.pop("one") == 1 and set(found) == set(values)
    for name, x in values.items():
        logs = np.log(x + tools.BOX_COX_SHIFT)
        fine = np.arange(-2, 2, 1e-4) + 5e-5

        def likelihood(power):
            return -len(x) / 2 * np.log(np.var(np.exp(power * (logs - logs.mean())) / power))

        best = fine[np.argmax([likelihood(power) for power in fine])]
        assert abs(found[name] - best) < 1e-4, name
        assert abs(single.box_cox_power(x) - found[name]) < 1e-5, name


def test_box_cox_powers_copy_no_weeks(spark):
    plan = tools.box_cox_lambdas(weekly(spark, a=[1, 2, 3]))._jdf.queryExecution().toString()
    assert "Generate explode" not in plan and "ArrowEval" not in plan and "MapInPandas" not in plan


def test_inverse_box_cox_beyond_its_range_is_null(spark):
    table = spark.createDataFrame([("n", -0.5, 1.5), ("n", -0.5, 2.0), ("n", -0.5, 9.0), ("p", 0.5, -3.0), ("z", 0.0, 1.0)], "series_id string, power double, total_price double")
    back = [r.total_price for r in tools.inverse_box_cox(table).collect()]
    assert np.allclose([back[0], back[3], back[4]], [16.0, 0.0, np.e], atol=1e-5) and back[1] is None and back[2] is None
    same = [single.from_box_cox(np.array([r.total_price]), r.power)[0] for r in table.collect()]
    assert [None if np.isnan(v) else round(v, 9) for v in same] == [v if v is None else round(v, 9) for v in back]


@pytest.mark.parametrize("box_cox", [False, True])
def test_stored_forecaster(spark, tmp_path, box_cox):
    draw = np.random.default_rng(8)
    series = weekly(spark, a=np.exp(4 + np.cumsum(draw.normal(0, 0.1, 120))), b=draw.gamma(5, 20, 110), short=[1, 2])
    orders = [("a", 1, 1, 1, 0, 0, 0, 0), ("b", 2, 0, 0, 1, 0, 0, 4), ("short", *[None] * 7)]
    selected = spark.createDataFrame(orders, "series_id string, " + ", ".join(f"{c} int" for c in arima.ORDER))
    direct = rows(arima.arima_forecast(series, selected, 6, box_cox))
    base = str(tmp_path)
    datasets.save_forecaster(arima.arima_fit(series, selected, box_cox), base, "sales", transformed=box_cox)
    with pytest.raises(IncompatibleTransformError):
        datasets.load_forecaster(spark, base, "sales", transformed=not box_cox)
    with pytest.raises(ModelNotFoundError):
        datasets.load_forecaster(spark, base, "absent", transformed=box_cox)
    models = datasets.load_forecaster(spark, base, "sales", transformed=box_cox)
    assert rows(arima.forecast_fitted(models, 6)) == direct
    assert len(direct) == 18 and {r[3] for r in direct if r[0] == "short"} == {None}
    history = [r.total_price for r in series.where("series_id = 'a'").orderBy("week_end").collect()]
    power = single.box_cox_power(np.array(history)) if box_cox else None
    values = single.to_box_cox(np.array(history), power) if box_cox else np.array(history)
    plain = single.fit(values, {"p": 1, "d": 1, "q": 1, "P": 0, "D": 0, "Q": 0, "m": 0}).forecast(6)[0]
    plain = single.from_box_cox(plain, power) if box_cox else plain
    assert np.allclose([r[3] for r in direct if r[0] == "a"], plain, rtol=1e-5)
