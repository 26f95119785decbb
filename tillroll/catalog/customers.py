"""Queries and oracles for customer features."""

from pyspark.sql import functions as F

from tillroll.catalog.cleaning import lines, text_day
from tillroll.catalog.oracle_base import CUSTOMER, with_ctes
from tillroll.catalog.registry import query
from tillroll.operators import cleaning, customers
from tillroll.session import settle

DAYS = """
days AS (SELECT DISTINCT customer_id, CAST(invoice_date AS DATE) AS day FROM customer_lines),
top AS (SELECT max(day) AS latest, CAST(date_trunc('quarter', max(day)) AS DATE) AS q FROM days),
past AS (SELECT customer_id, day FROM days, top WHERE day <= q - 1),
recent AS (SELECT customer_id, day FROM days, top WHERE day > q - 1)"""


def features_sql(prefix, source):
    """Feature CTEs over a table of distinct (customer_id, day)."""
    return f"""
{prefix}rf AS (
  SELECT customer_id, CAST(any_value(e) - max(day) AS INTEGER) AS recency,
         CAST(count(*) AS INTEGER) AS frequency
  FROM {source}, (SELECT CAST(date_trunc('quarter', max(day)) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS e FROM {source})
  GROUP BY customer_id),
{prefix}gaps AS (
  SELECT customer_id,
         CAST(max(day) - max(CASE WHEN place = 2 THEN day END) AS INTEGER) AS diff_purchase_t_1,
         CAST(max(day) - max(CASE WHEN place = 3 THEN day END) AS INTEGER) AS diff_purchase_t_2
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY day DESC) AS place FROM {source})
  GROUP BY customer_id),
{prefix}quarters AS (SELECT DISTINCT customer_id, year(day) * 4 + quarter(day) AS qn FROM {source}),
{prefix}streaks AS (
  SELECT a.customer_id, CAST(count(b.qn) AS INTEGER) AS purchase_subsequent_quarters
  FROM {prefix}quarters a LEFT JOIN {prefix}quarters b ON a.customer_id = b.customer_id AND b.qn = a.qn + 1
  GROUP BY a.customer_id),
{prefix}features AS (
  SELECT * FROM {prefix}rf JOIN {prefix}gaps USING (customer_id) JOIN {prefix}streaks USING (customer_id))"""


LABELS = """
labels_of AS (
  SELECT l.customer_id, CASE WHEN last_past >= q - INTERVAL 3 MONTH AND first_current IS NOT NULL
                             THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y_label
  FROM (SELECT customer_id, max(day) AS last_past FROM past GROUP BY customer_id) l
       LEFT JOIN (SELECT customer_id, min(day) AS first_current FROM recent GROUP BY customer_id) r
       ON l.customer_id = r.customer_id, top)"""

FEATURE_CTES = (*CUSTOMER, DAYS, features_sql("past_", "past"), features_sql("all_", "days"), LABELS)
FEATURE_TABLE = """
feature_rows AS (
  SELECT f.*, y_label, 'train' AS target FROM past_features f JOIN labels_of USING (customer_id)
  WHERE frequency >= 3
  UNION ALL SELECT *, NULL, 'predict' FROM all_features WHERE frequency >= 3)"""
FEATURE_ROWS = (*FEATURE_CTES, FEATURE_TABLE)


def customer_lines(spark, sf_dir):
    return cleaning.clean_customer_lines(lines(spark, sf_dir))


def timelines(spark, sf_dir):
    return settle(customers.customer_timelines(customer_lines(spark, sf_dir)))


def features(spark, sf_dir):
    return customers.purchase_features(customer_lines(spark, sf_dir))


@query(
    "split_quarters",
    with_ctes(*CUSTOMER, DAYS)
    + """SELECT CASE WHEN CAST(invoice_date AS DATE) <= q - 1 THEN 'past' ELSE 'current' END AS side,
  invoice, stock_code, customer_id, CAST(CAST(invoice_date AS DATE) AS VARCHAR) AS invoice_day
FROM customer_lines, top""",
)
def quarters_split(spark, sf_dir):
    past, current = customers.split_quarters(settle(customer_lines(spark, sf_dir)))
    both = past.withColumn("side", F.lit("past")).unionByName(current.withColumn("side", F.lit("current")))
    day = F.to_date("invoice_date").cast("string").alias("invoice_day")
    return both.select("side", "invoice", "stock_code", "customer_id", day)


@query(
    "distinct_purchase_days",
    with_ctes(*CUSTOMER, DAYS) + "SELECT customer_id, CAST(day AS VARCHAR) AS purchase_day FROM days",
)
def purchase_days(spark, sf_dir):
    days = customers.distinct_purchase_days(customer_lines(spark, sf_dir))
    return days.withColumn("purchase_day", text_day("purchase_day"))


@query(
    "last_purchase_per_customer",
    with_ctes(*CUSTOMER, DAYS)
    + "SELECT customer_id, CAST(max(day) AS VARCHAR) AS last_purchase FROM past GROUP BY customer_id",
)
def last_purchase(spark, sf_dir):
    past, _ = customers.split_quarters(settle(customer_lines(spark, sf_dir)))
    return customers.last_purchase_per_customer(past).withColumn("last_purchase", text_day("last_purchase"))


@query(
    "first_purchase_per_customer",
    with_ctes(*CUSTOMER, DAYS)
    + "SELECT customer_id, CAST(min(day) AS VARCHAR) AS first_purchase FROM recent GROUP BY customer_id",
)
def first_purchase(spark, sf_dir):
    _, current = customers.split_quarters(settle(customer_lines(spark, sf_dir)))
    return customers.first_purchase_per_customer(current).withColumn(
        "first_purchase", text_day("first_purchase")
    )


@query("next_quarter_label", with_ctes(*CUSTOMER, DAYS, LABELS) + "SELECT * FROM labels_of")
def label(spark, sf_dir):
    return customers.next_quarter_label(*customers.split_quarters(settle(customer_lines(spark, sf_dir))))


@query(
    "customer_recency_frequency",
    with_ctes(*CUSTOMER, DAYS, features_sql("all_", "days")) + "SELECT * FROM all_rf",
)
def recency_frequency(spark, sf_dir):
    return customers.customer_recency_frequency(timelines(spark, sf_dir))


@query(
    "recency_days",
    with_ctes(*CUSTOMER, DAYS, features_sql("past_", "past")) + "SELECT customer_id, recency FROM past_rf",
)
def recency(spark, sf_dir):
    past = customers.past_timelines(timelines(spark, sf_dir))
    return customers.customer_recency_frequency(past).select("customer_id", "recency")


@query(
    "last_n_purchases",
    with_ctes(*CUSTOMER, DAYS)
    + """SELECT customer_id, CAST(day AS VARCHAR) AS purchase_day, CAST(place AS INTEGER) AS place
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY day DESC) AS place FROM days)
WHERE place <= 3""",
)
def last_three(spark, sf_dir):
    days = customers.distinct_purchase_days(customer_lines(spark, sf_dir))
    return customers.last_n_purchases(days).withColumn("purchase_day", text_day("purchase_day"))


@query(
    "purchase_gaps",
    with_ctes(*CUSTOMER, DAYS, features_sql("all_", "days")) + "SELECT * FROM all_gaps",
)
def gaps(spark, sf_dir):
    return customers.purchase_gaps(timelines(spark, sf_dir))


@query(
    "quarter_pairs",
    with_ctes(*CUSTOMER, DAYS)
    + """SELECT DISTINCT a.customer_id, CAST(CAST(date_trunc('quarter', a.day) AS DATE) AS VARCHAR) AS quarter,
  CAST(CAST(date_trunc('quarter', b.day) AS DATE) AS VARCHAR) AS next_quarter
FROM days a JOIN days b ON a.customer_id = b.customer_id
  AND date_trunc('quarter', b.day) = date_trunc('quarter', a.day) + INTERVAL 3 MONTH""",
)
def pairs_of_quarters(spark, sf_dir):
    pairs = customers.quarter_pairs(customers.distinct_purchase_days(customer_lines(spark, sf_dir)))
    return pairs.select("customer_id", text_day("quarter"), text_day("next_quarter"))


@query(
    "quarter_streaks",
    with_ctes(*CUSTOMER, DAYS, features_sql("all_", "days")) + "SELECT * FROM all_streaks",
)
def streaks(spark, sf_dir):
    return customers.quarter_streaks(timelines(spark, sf_dir))


@query("assemble_features", with_ctes(*FEATURE_CTES) + "SELECT * FROM all_features")
def assembled(spark, sf_dir):
    return customers.assemble_features(timelines(spark, sf_dir))


@query("filter_min_frequency", with_ctes(*FEATURE_CTES) + "SELECT * FROM all_features WHERE frequency >= 3")
def frequent(spark, sf_dir):
    return customers.filter_min_frequency(customers.assemble_features(timelines(spark, sf_dir)))


@query(
    "union_train_predict",
    with_ctes(*FEATURE_ROWS) + "SELECT target, count(*) AS customers, count(y_label) AS labels FROM feature_rows GROUP BY target",
)
def stacked(spark, sf_dir):
    table = settle(customer_lines(spark, sf_dir))
    all_times = customers.customer_timelines(table)
    train = customers.filter_min_frequency(
        customers.assemble_features(customers.past_timelines(all_times))
    ).join(customers.next_quarter_label(*customers.split_quarters(table)), "customer_id")
    predict = customers.filter_min_frequency(customers.assemble_features(all_times))
    return (
        customers.union_train_predict(train, predict)
        .groupBy("target")
        .agg(F.count("*").alias("customers"), F.count("y_label").alias("labels"))
    )


@query("purchase_features", with_ctes(*FEATURE_ROWS) + "SELECT * FROM feature_rows")
def all_features(spark, sf_dir):
    return features(spark, sf_dir)


@query(
    "train_rows",
    with_ctes(*FEATURE_ROWS) + "SELECT * EXCLUDE (target) FROM feature_rows WHERE target = 'train'",
)
def training(spark, sf_dir):
    return customers.train_rows(features(spark, sf_dir))


@query(
    "predict_rows",
    with_ctes(*FEATURE_ROWS) + "SELECT * EXCLUDE (target, y_label) FROM feature_rows WHERE target = 'predict'",
)
def predicting(spark, sf_dir):
    return customers.predict_rows(features(spark, sf_dir))


@query(
    "customer_recency_lookup",
    with_ctes(*FEATURE_ROWS)
    + """SELECT customer_id, recency FROM feature_rows WHERE target = 'predict'
  AND customer_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def recency_lookup(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("customer_id")
    )
    return customers.customer_recency_lookup(features(spark, sf_dir), urgent)
