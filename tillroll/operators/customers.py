"""Customer features from purchase days.

Every feature follows from the set of days a customer bought on. ``customer_timelines``
gathers that set once, in one shuffle by customer whose partial aggregate already drops
repeated days; the set cannot outgrow the calendar. The features are then computed from
the sorted array without a further shuffle.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from tillroll.functions.dates import quarter_begin, quarter_end, quarter_number, recency_days
from tillroll.session import settle


def distinct_purchase_days(lines: DataFrame) -> DataFrame:
    return lines.select("customer_id", F.to_date("invoice_date").alias("purchase_day")).distinct()


def customer_timelines(lines: DataFrame) -> DataFrame:
    """One row per customer with the ascending array of distinct purchase days."""
    return lines.groupBy("customer_id").agg(
        F.array_sort(F.collect_set(F.to_date("invoice_date"))).alias("days")
    )


def latest_day(timelines: DataFrame) -> Column:
    """Scalar subquery: the last purchase day of all customers."""
    return timelines.select(F.max(F.element_at("days", -1))).scalar()


def past_timelines(timelines: DataFrame) -> DataFrame:
    """Timelines cut at the end of the quarter before the latest purchase day."""
    cut = timelines.withColumn("split_day", quarter_end(latest_day(timelines), -1))
    kept = F.filter("days", lambda day: day <= F.col("split_day"))
    return cut.withColumn("days", kept).where(F.size("days") > 0).drop("split_day")


def split_quarters(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of the past quarters and of the quarter of the latest date."""
    day = F.to_date("invoice_date")
    split_day = quarter_end(lines.select(F.max(day)).scalar(), -1)
    return lines.where(day <= split_day), lines.where(day > split_day)


def last_purchase_per_customer(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_id").agg(F.max(F.to_date("invoice_date")).alias("last_purchase"))


def first_purchase_per_customer(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_id").agg(F.min(F.to_date("invoice_date")).alias("first_purchase"))


def next_quarter_label(past: DataFrame, current: DataFrame) -> DataFrame:
    """1 for past customers who bought in the quarter before the current one and in the current one.

    Customers seen only in the current quarter have no row.
    """
    last = last_purchase_per_customer(past)
    first = first_purchase_per_customer(current)
    latest = current.select(F.max(F.to_date("invoice_date"))).scalar()
    in_previous = F.col("last_purchase").between(quarter_begin(latest, -1), quarter_end(latest, -1))
    bought = F.col("first_purchase").isNotNull()
    return last.join(first, "customer_id", "left").select(
        "customer_id", F.when(in_previous & bought, 1.0).otherwise(0.0).alias("y_label")
    )


def customer_recency_frequency(timelines: DataFrame) -> DataFrame:
    """Days from the last purchase to the quarter's end, and the number of purchase days."""
    return timelines.select("customer_id", *_recency_frequency(latest_day(timelines)))


def _recency_frequency(latest: Column) -> list[Column]:
    return [
        recency_days(F.element_at("days", -1), latest).alias("recency"),
        F.size("days").alias("frequency"),
    ]


def last_n_purchases(days: DataFrame, n: int = 3) -> DataFrame:
    """The latest ``n`` purchase days per customer with their place, 1 = latest."""
    latest_first = Window.partitionBy("customer_id").orderBy(F.desc("purchase_day"))
    return days.withColumn("place", F.row_number().over(latest_first)).where(F.col("place") <= n)


def _gaps(n: int) -> list[Column]:
    latest = F.element_at("days", -1)
    return [
        F.when(F.size("days") > back, F.date_diff(latest, F.try_element_at("days", F.lit(-1 - back))))
        .alias(f"diff_purchase_t_{back}")
        for back in range(1, n)
    ]


def purchase_gaps(timelines: DataFrame, n: int = 3) -> DataFrame:
    """Days from the latest purchase to each of the ``n - 1`` before it; null when there are fewer."""
    return timelines.select("customer_id", *_gaps(n))


def _streaks() -> Column:
    quarters = F.array_distinct(F.transform("days", quarter_number))
    return F.size(F.array_intersect(quarters, F.transform(quarters, lambda q: q - 1)))


def quarter_streaks(timelines: DataFrame) -> DataFrame:
    """Number of quarters with a purchase that were followed by a quarter with one."""
    return timelines.select("customer_id", _streaks().alias("purchase_subsequent_quarters"))


def quarter_pairs(days: DataFrame) -> DataFrame:
    """Customers and quarters in which they bought, if they bought in the next one too."""
    quarter = quarter_begin(F.col("purchase_day")).alias("quarter")
    quarters = days.select("customer_id", quarter).distinct()
    following = F.lead("quarter").over(Window.partitionBy("customer_id").orderBy("quarter"))
    return quarters.withColumn("next_quarter", following).where(
        F.col("next_quarter") == F.add_months("quarter", 3)
    )


def assemble_features(timelines: DataFrame, n: int = 3) -> DataFrame:
    """Recency, frequency, gaps and streaks side by side; one pass over the timelines."""
    return timelines.select(
        "customer_id",
        *_recency_frequency(latest_day(timelines)),
        *_gaps(n),
        _streaks().alias("purchase_subsequent_quarters"),
    )


def filter_min_frequency(features: DataFrame, n: int = 3) -> DataFrame:
    return features.where(F.col("frequency") >= n)


def union_train_predict(train: DataFrame, predict: DataFrame) -> DataFrame:
    """Stack both sets with their target; rows to predict have a null label."""
    return train.withColumn("target", F.lit("train")).unionByName(
        predict.withColumn("target", F.lit("predict")), allowMissingColumns=True
    )


def purchase_features(lines: DataFrame, n: int = 3) -> DataFrame:
    """Features of the past quarters with their label, and of all quarters without one.

    The label of a past customer also follows from the timeline: a day in the quarter
    before the latest one and a day after it.
    """
    timelines = settle(customer_timelines(lines))
    latest = latest_day(timelines)
    both = F.exists("all_days", lambda day: day > quarter_end(F.col("latest"), -1)) & F.exists(
        "days", lambda day: day >= quarter_begin(F.col("latest"), -1)
    )
    past = past_timelines(timelines.withColumn("all_days", F.col("days")))
    past_latest = past_timelines(timelines).select(F.max(F.element_at("days", -1))).scalar()
    train = (
        past.withColumn("latest", latest)
        .select(
            "customer_id",
            *_recency_frequency(past_latest),
            *_gaps(n),
            _streaks().alias("purchase_subsequent_quarters"),
            F.when(both, 1.0).otherwise(0.0).alias("y_label"),
        )
        .transform(filter_min_frequency, n)
    )
    predict = filter_min_frequency(assemble_features(timelines, n), n)
    return union_train_predict(train, predict)


def train_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("target") == "train").drop("target")


def predict_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("target") == "predict").drop("target", "y_label")


def customer_recency_lookup(features: DataFrame, customers: Sequence[int] | DataFrame) -> DataFrame:
    """Recency of the wanted customers, from the rows to predict."""
    recency = predict_rows(features).select("customer_id", "recency")
    if isinstance(customers, DataFrame):
        return recency.join(customers.select("customer_id").distinct(), "customer_id")
    return recency.where(F.col("customer_id").isin(list(customers)))
