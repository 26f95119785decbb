"""Queries and oracles for series tools."""

from pyspark.sql import functions as F

from tillroll.catalog.cleaning import text_day
from tillroll.catalog.customers import FEATURE_ROWS, features
from tillroll.catalog.oracle_base import with_ctes
from tillroll.catalog.profile import SERIES_CTES, country_series
from tillroll.catalog.registry import query
from tillroll.operators import metrics, series
from tillroll.schema import FEATURES
from tillroll.session import settle

DAY = "CAST(week_end AS VARCHAR) AS week_end"
PLACED = """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY week_end) - 1 AS position,
         count(*) OVER (PARTITION BY series_id) AS length FROM series)"""


def shown(df, *columns, digits=6):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df.withColumn("week_end", text_day("week_end")) if "week_end" in df.columns else df


@query(
    "lag_sequences",
    with_ctes(*SERIES_CTES)
    + "SELECT * FROM (SELECT series_id, "
    + DAY
    + ", total_price AS x_1, "
    + ", ".join(f"lead(total_price, {k}) OVER w AS {'x' if k < 4 else 'y'}_{k + 1 if k < 4 else k - 3}" for k in range(1, 6))
    + " FROM series WINDOW w AS (PARTITION BY series_id ORDER BY series.week_end)) WHERE y_2 IS NOT NULL",
)
def lags(spark, sf_dir):
    return shown(series.lag_sequences(country_series(spark, sf_dir), 4, 2))


@query(
    "time_series_holdout",
    with_ctes(*SERIES_CTES, PLACED)
    + f"SELECT series_id, {DAY}, total_price, CASE WHEN position >= length - 8 THEN 1 ELSE 0 END AS is_test FROM placed",
)
def last_weeks(spark, sf_dir):
    return shown(series.time_series_holdout(country_series(spark, sf_dir), 8))


@query(
    "time_series_holdout_share",
    with_ctes(*SERIES_CTES, PLACED)
    + f"""SELECT series_id, {DAY}, total_price,
  CASE WHEN position >= ceil(length * (1 - 0.2::DOUBLE)) THEN 1 ELSE 0 END AS is_test FROM placed""",
)
def last_share(spark, sf_dir):
    return shown(series.time_series_holdout(country_series(spark, sf_dir), 0.2))


@query(
    "expanding_folds",
    with_ctes(*SERIES_CTES, PLACED)
    + f"""SELECT series_id, CAST(fold AS INTEGER) AS fold, {DAY}, total_price,
  CASE WHEN position >= length - 48 + 8 * fold THEN 1 ELSE 0 END AS is_test, CAST(NULL AS VARCHAR) AS reason
FROM placed, range(0, 6) r(fold) WHERE length > 48 AND position < length - 40 + 8 * fold
UNION ALL
SELECT DISTINCT series_id, CAST(NULL AS INTEGER), NULL, NULL, CAST(NULL AS INTEGER), 'too few weeks for the folds' FROM placed WHERE length <= 48""",
)
def folds(spark, sf_dir):
    return shown(series.expanding_folds(country_series(spark, sf_dir), keep_short=True))


@query(
    "latest_lag_vector",
    with_ctes(*SERIES_CTES, PLACED)
    + """SELECT series_id, CAST(max(week_end) AS VARCHAR) AS week_end,
  max(CASE WHEN position = length - 4 THEN total_price END) AS lag_4,
  max(CASE WHEN position = length - 3 THEN total_price END) AS lag_3,
  max(CASE WHEN position = length - 2 THEN total_price END) AS lag_2,
  max(CASE WHEN position = length - 1 THEN total_price END) AS lag_1, CAST(NULL AS VARCHAR) AS reason
FROM placed WHERE length >= 4 GROUP BY series_id
UNION ALL
SELECT DISTINCT series_id, NULL, NULL, NULL, NULL, NULL, 'too few weeks for the lags' FROM placed WHERE length < 4""",
)
def latest(spark, sf_dir):
    vector = series.latest_lag_vector(country_series(spark, sf_dir), 4, keep_short=True)
    lag = [F.col("lags")[i].alias(f"lag_{4 - i}") for i in range(4)]
    return shown(vector.select("series_id", "week_end", *lag, "reason"))


@query(
    "future_weeks",
    with_ctes(*SERIES_CTES)
    + """SELECT series_id, CAST(k AS INTEGER) AS step, CAST(max(series.week_end) + CAST(7 * k AS INTEGER) AS VARCHAR) AS week_end
FROM series, range(1, 9) r(k) GROUP BY series_id, k""",
)
def weeks_ahead(spark, sf_dir):
    return shown(series.future_weeks(country_series(spark, sf_dir), 8))


@query(
    "difference_series",
    with_ctes(
        *SERIES_CTES,
        "\nfirst AS (SELECT series_id, week_end, total_price - lag(total_price) OVER (PARTITION BY series_id ORDER BY week_end) AS d FROM series)",
    )
    + f"""SELECT * FROM (SELECT series_id, {DAY}, round(d - lag(d) OVER (PARTITION BY series_id ORDER BY first.week_end), 6) AS total_price
FROM first WHERE d IS NOT NULL) WHERE total_price IS NOT NULL""",
)
def differences(spark, sf_dir):
    return shown(series.difference_series(country_series(spark, sf_dir), 2), "total_price")


def _level(name, before, step, points):
    """The best of an even grid around the power found before: the likelihood has one maximum."""
    return f"""
{name} AS (
  SELECT series_id, arg_max(power, likelihood) AS power FROM (
    SELECT series_id, power,
           -count(*)::DOUBLE / 2 * ln(var_pop(CASE WHEN abs(power) < 1e-9 THEN z ELSE (exp(power * z) - 1) / power END)) AS likelihood
    FROM logs JOIN (SELECT series_id, power + i * {step}::DOUBLE AS power FROM {before}, range(-{points}, {points} + 1) r(i)) USING (series_id)
    GROUP BY series_id, power)
  GROUP BY series_id)"""


# grids of finer and finer steps, where the query narrows an interval
LAMBDAS = (
    """
shifted AS (SELECT series_id, week_end, greatest(total_price + 1e-6::DOUBLE, 1e-16::DOUBLE) AS x FROM series),
logs AS (SELECT series_id, ln(x) - avg(ln(x)) OVER (PARTITION BY series_id) AS z FROM shifted),
middle AS (SELECT DISTINCT series_id, 0.0::DOUBLE AS power FROM series),"""
    + ",".join(
        [
            _level("tenths", "middle", 0.1, 20),
            _level("hundredths", "tenths", 0.005, 20),
            _level("thousandths", "hundredths", 0.0005, 10),
            _level("finest", "thousandths", 0.00001, 50),
        ]
    )
    + """,
chosen AS (SELECT series_id, round(power, 3) AS power FROM finest)"""
)


@query("box_cox_lambdas", with_ctes(*SERIES_CTES, LAMBDAS) + "SELECT series_id, power FROM chosen")
def powers(spark, sf_dir):
    return shown(series.box_cox_lambdas(country_series(spark, sf_dir)), "power", digits=3)


@query(
    "box_cox",
    with_ctes(*SERIES_CTES, LAMBDAS)
    + f"""SELECT series_id, {DAY}, power,
  round(CASE WHEN power = 0 THEN ln(x) ELSE (pow(x, power) - 1) / power END, 6) AS total_price
FROM shifted JOIN chosen USING (series_id)""",
)
def transformed(spark, sf_dir):
    weekly = country_series(spark, sf_dir)
    rounded = shown(series.box_cox_lambdas(weekly), "power", digits=3)
    return shown(series.box_cox(weekly, rounded), "total_price")


@query(
    "inverse_box_cox",
    with_ctes(*SERIES_CTES) + f"SELECT series_id, {DAY}, round(total_price, 3) AS total_price FROM series",
)
def restored(spark, sf_dir):
    weekly = country_series(spark, sf_dir)
    back = series.inverse_box_cox(series.box_cox(weekly, series.box_cox_lambdas(weekly)))
    return shown(back.drop("power"), "total_price", digits=3)


SCALED = """
scaled AS (
  SELECT series_id, week_end, total_price, (total_price - low) / CASE WHEN high = low THEN 1 ELSE high - low END * 2 - 1 AS z
  FROM series JOIN (SELECT series_id, min(total_price) AS low, max(total_price) AS high FROM series GROUP BY series_id)
  USING (series_id))"""


@query(
    "min_max_scale",
    with_ctes(*SERIES_CTES, SCALED) + f"SELECT series_id, {DAY}, round(z, 9) AS total_price FROM scaled",
)
def scaled(spark, sf_dir):
    return shown(series.min_max_scale(country_series(spark, sf_dir)).drop("low", "range"), "total_price", digits=9)


@query(
    "inverse_min_max",
    with_ctes(*SERIES_CTES) + f"SELECT series_id, {DAY}, round(total_price, 6) AS total_price FROM series",
)
def unscaled(spark, sf_dir):
    return shown(series.inverse_min_max(series.min_max_scale(country_series(spark, sf_dir))), "total_price")


@query(
    "standardize_features",
    with_ctes(*FEATURE_ROWS)
    + "SELECT customer_id, target, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in FEATURES)
    + " FROM feature_rows",
)
def standardized(spark, sf_dir):
    table = settle(features(spark, sf_dir))
    return shown(series.standardize_features(table, FEATURES).drop("y_label"), *FEATURES)


@query(
    "rmse",
    with_ctes(
        *SERIES_CTES,
        "\nnaive AS (SELECT series_id, total_price AS actual, lag(total_price) OVER (PARTITION BY series_id ORDER BY week_end) AS predicted FROM series)",
    )
    + """SELECT series_id, round(sqrt(avg(pow(actual - predicted, 2))), 6) AS rmse
FROM naive WHERE predicted IS NOT NULL GROUP BY series_id""",
)
def naive_rmse(spark, sf_dir):
    pairs = series.lag_sequences(country_series(spark, sf_dir), 1).withColumnsRenamed(
        {"x_1": "predicted", "y_1": "actual"}
    )
    return shown(metrics.rmse(pairs, ["series_id"]), "rmse")
