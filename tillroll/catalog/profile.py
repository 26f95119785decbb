"""Queries and oracles for descriptions of lines, features and series."""

from pyspark.sql import functions as F

from tillroll.catalog.cleaning import COUNTRY_WEEKLY, country_weekly, lines
from tillroll.catalog.customers import FEATURE_ROWS
from tillroll.catalog.metrics import rounded, training_rows
from tillroll.catalog.oracle_base import INVOICES, with_ctes
from tillroll.catalog.registry import query
from tillroll.operators import profile, sales, series
from tillroll.operators.cleaning import drop_missing_customers
from tillroll.schema import FEATURES
from tillroll.session import settle

TRAIN = (*FEATURE_ROWS, "\ntrain_features AS (SELECT * FROM feature_rows WHERE target = 'train')")
SERIES = "\nseries AS (SELECT country AS series_id, week_end, total_price FROM weekly)"
SERIES_CTES = (*COUNTRY_WEEKLY, SERIES)


def country_series(spark, sf_dir):
    return settle(sales.as_series(country_weekly(spark, sf_dir), ["country"]))


def long_sql(table, columns):
    parts = [f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {table}" for c in columns]
    return "\nlong AS (" + " UNION ALL ".join(parts) + ")"


LINE_COLUMNS = ("invoice", "stock_code", "quantity", "invoice_date", "price", "customer_id")


@query(
    "null_counts",
    with_ctes(INVOICES)
    + "SELECT "
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in LINE_COLUMNS)
    + ", count(*) FILTER (" + " OR ".join(f"{c} IS NULL" for c in LINE_COLUMNS) + ") AS rows_with_null FROM invoices",
)
def nulls(spark, sf_dir):
    return profile.null_counts(lines(spark, sf_dir))


COUNTS_SQL = """SELECT count(*) AS rows, count(DISTINCT customer_id) AS customers,
  count(DISTINCT stock_code) AS products, count(DISTINCT invoice) FILTER (invoice NOT LIKE 'C%') AS orders,
  count(DISTINCT invoice) FILTER (invoice LIKE 'C%') AS cancellations FROM invoices"""


@query("distinct_counts", with_ctes(INVOICES) + COUNTS_SQL)
def counts(spark, sf_dir):
    return profile.distinct_counts(lines(spark, sf_dir))


@query("distinct_counts_of_customers", with_ctes(INVOICES) + COUNTS_SQL + " WHERE customer_id IS NOT NULL")
def customer_counts(spark, sf_dir):
    return profile.distinct_counts(drop_missing_customers(lines(spark, sf_dir)))


@query(
    "non_numeric_stock_codes",
    with_ctes(INVOICES)
    + "SELECT DISTINCT stock_code, description FROM invoices WHERE NOT regexp_matches(stock_code, '^[0-9]')",
)
def special_codes(spark, sf_dir):
    return profile.non_numeric_stock_codes(lines(spark, sf_dir, description=True))


SUMMARY_SQL = """SELECT "column", count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
  round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max FROM long GROUP BY "column" """


def summary(df, columns):
    result = profile.numeric_summary(df, columns)
    for c in ("mean", "std", "min", "q25", "q50", "q75", "max"):
        result = result.withColumn(c, F.round(c, 6))
    return result


@query(
    "numeric_summary",
    with_ctes(INVOICES, long_sql("(SELECT * FROM invoices WHERE customer_id IS NOT NULL)", ["quantity", "price"]))
    + SUMMARY_SQL,
)
def line_summary(spark, sf_dir):
    return summary(drop_missing_customers(lines(spark, sf_dir)), ["quantity", "price"])


@query("numeric_summary_of_features", with_ctes(*TRAIN, long_sql("train_features", FEATURES)) + SUMMARY_SQL)
def feature_summary(spark, sf_dir):
    return summary(training_rows(spark, sf_dir), FEATURES)


@query(
    "boxplot_stats",
    with_ctes(
        *TRAIN, long_sql("train_features", FEATURES),
        """
box AS (SELECT "column", quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
               quantile_cont(value, 0.75) AS q75 FROM long GROUP BY "column"),
marked AS (SELECT *, value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside
           FROM long JOIN box USING ("column") WHERE value IS NOT NULL)""",
    )
    + """SELECT "column", q25, q50, q75, min(value) FILTER (inside) AS lower_whisker,
  max(value) FILTER (inside) AS upper_whisker, count(*) FILTER (NOT inside) AS outliers
FROM marked GROUP BY "column", q25, q50, q75""",
)
def boxes(spark, sf_dir):
    return profile.boxplot_stats(training_rows(spark, sf_dir), FEATURES)


@query(
    "label_balance",
    with_ctes(*TRAIN)
    + """SELECT count(*) FILTER (y_label = 0) AS negative, count(*) FILTER (y_label = 1) AS positive,
  round(count(*) FILTER (y_label = 0) / count(*) FILTER (y_label = 1), 9) AS imbalance FROM train_features""",
)
def balance(spark, sf_dir):
    return rounded(profile.label_balance(training_rows(spark, sf_dir)), "imbalance")


CORRELATED = [*FEATURES, "y_label"]


@query(
    "feature_correlation",
    with_ctes(*TRAIN)
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature, '{b}' AS other, round(corr({a}, {b}), 6) AS correlation FROM train_features"
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def correlation(spark, sf_dir):
    result = profile.feature_correlation(training_rows(spark, sf_dir), CORRELATED)
    return result.withColumn("correlation", F.round("correlation", 6))


@query("variance_inflation")
def inflation(spark, sf_dir):
    return profile.variance_inflation(training_rows(spark, sf_dir), FEATURES)


@query(
    "autocorrelation",
    with_ctes(
        *SERIES_CTES,
        """
steps AS (SELECT series_id, week_end, total_price - lag(total_price) OVER (PARTITION BY series_id ORDER BY week_end) AS d FROM series),
centered AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY week_end) AS t,
                    d - avg(d) OVER (PARTITION BY series_id) AS x FROM steps WHERE d IS NOT NULL),
spread AS (SELECT series_id, sum(x * x) AS s0 FROM centered GROUP BY series_id)""",
    )
    + """SELECT a.series_id, CAST(b.t - a.t AS INTEGER) AS lag, CASE WHEN abs(sum(a.x * b.x) / any_value(s0)) < 5e-7 THEN 0.0::DOUBLE
  ELSE round(sum(a.x * b.x) / any_value(s0), 6) END AS acf
FROM centered a JOIN centered b ON b.series_id = a.series_id AND b.t BETWEEN a.t AND a.t + 51
  JOIN spread s ON s.series_id = a.series_id
GROUP BY a.series_id, b.t - a.t""",
)
def acf(spark, sf_dir):
    steps = series.difference_series(country_series(spark, sf_dir))
    return profile.autocorrelation(steps).withColumn("acf", F.round("acf", 6))


@query("partial_autocorrelation")
def pacf(spark, sf_dir):
    steps = series.difference_series(country_series(spark, sf_dir))
    return profile.partial_autocorrelation(profile.autocorrelation(steps))
