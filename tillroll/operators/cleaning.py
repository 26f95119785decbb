"""Filters that turn raw invoice lines into countable purchases."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.amounts import abs_quantity
from tillroll.functions.dates import normalize_invoice_date
from tillroll.schema import (
    CANCELLATION_DAYS,
    CANCELLATION_PREFIX,
    NON_CUSTOMER_CODES,
    NON_SALES_CODES,
)
from tillroll.session import settle

MATCH_KEYS = ["stock_code", "match_quantity", "price", "customer_id"]


def is_cancellation() -> Column:
    return F.col("invoice").startswith(CANCELLATION_PREFIX)


def drop_missing_customers(lines: DataFrame) -> DataFrame:
    return lines.dropna(subset=["customer_id"])


def exclude_stock_codes(lines: DataFrame, codes: Sequence[str]) -> DataFrame:
    return lines.where(~F.col("stock_code").isin(list(codes)))


def remove_cancellations(lines: DataFrame) -> DataFrame:
    return lines.where(~is_cancellation())


def split_cancellations(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cancellations and purchases."""
    return lines.where(is_cancellation()), lines.where(~is_cancellation())


def _period(days: int) -> Column:
    """Number of the ``days`` long calendar period a line falls into."""
    return F.floor(_day("invoice_date") / (days + 1))


def _day(moment: str) -> Column:
    return F.date_diff(F.to_date(moment), F.lit("1970-01-01").cast("date"))


def _span(days: int) -> Column:
    # whole days between two moments are floored: 14 days 23:59:59 still counts as 14
    return F.make_dt_interval(F.lit(days + 1))


def _match_cells(lines: DataFrame, days: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Distinct purchases and cancellations, each with the (period, day) cell in which they meet.

    A cancellation stands in its own period and the one before. Where more than ``crowd`` cancellations of a
    key stand in a period, its cells are single days, and a cancellation stands on each day that its window
    touches; elsewhere the day is -1. Purchases are never copied.
    """
    keyed = lines.withColumn("match_quantity", abs_quantity(F.col("quantity"))).withColumn(
        "period", _period(days)
    )
    cancellations, purchases = split_cancellations(keyed)
    purchases = purchases.groupBy(
        *MATCH_KEYS, "period", F.col("invoice_date").alias("purchase_date")
    ).agg(F.count("*").alias("purchase_lines"))
    cancellations = cancellations.groupBy(*MATCH_KEYS, "period", F.col("invoice_date").alias("cancel_date")).agg(
        F.count("*").alias("cancel_lines")
    )
    # they are few beside the purchases, and read three times
    cancellations = settle(cancellations).withColumn("period", F.explode(F.array(F.col("period"), F.col("period") - 1)))
    cell = [*MATCH_KEYS, "period"]
    crowded = cancellations.groupBy(*cell).agg(F.count("*").alias("_n")).where(F.col("_n") > crowd)
    crowded = crowded.select(*cell, F.lit(True).alias("_crowded"))
    whole = F.lit(-1)
    purchases = purchases.join(crowded, cell, "left").withColumn(
        "day", F.when(F.col("_crowded"), _day("purchase_date")).otherwise(whole)
    )
    length = days + 1
    first = F.greatest(_day("cancel_date") - length, (F.col("period") * length).cast("int"))
    last = F.least(_day("cancel_date"), ((F.col("period") + 1) * length - 1).cast("int"))
    touched = F.when(F.col("_crowded"), F.when(first <= last, F.sequence(first, last))).otherwise(F.array(whole))
    cancellations = cancellations.join(crowded, cell, "left").withColumn("day", F.explode(touched))
    return purchases.drop("_crowded"), cancellations.drop("_crowded")


def match_cancellations(lines: DataFrame, days: int = CANCELLATION_DAYS, crowd: int = 1000) -> DataFrame:
    """Purchases and the cancellations that follow them within ``days`` whole days.

    Lines that agree in every matched field are one row with a count, so copies do
    not multiply. The time range is an equi-join on calendar periods as long as the
    window: a match lies in the purchase's own period or in the next one. Periods with more than
    ``crowd`` cancellations of a key are joined day by day, so that a hot key is many cells, in which
    nearly all pairs are matches.
    """
    purchases, cancellations = _match_cells(lines, days, crowd)
    cell = [*MATCH_KEYS, "period", "day"]
    in_window = (F.col("cancel_date") >= F.col("purchase_date")) & (
        F.col("cancel_date") < F.col("purchase_date") + _span(days)
    )
    whole_days = F.extract(F.lit("DAY"), F.col("cancel_date") - F.col("purchase_date"))
    return (
        purchases.repartition(*cell).join(cancellations.repartition(*cell), cell)
        .where(in_window)
        .select(
            "stock_code",
            F.col("match_quantity").alias("quantity"),
            "price",
            "customer_id",
            "purchase_date",
            "cancel_date",
            whole_days.cast("int").alias("days_between"),
            "purchase_lines",
            "cancel_lines",
        )
    )


def remove_instant_cancellations(lines: DataFrame, days: int = CANCELLATION_DAYS) -> DataFrame:
    """Drop purchases that are followed by a matching cancellation within ``days`` days.

    Per key and period the cancellations shrink to two moments: the latest one, which counts for purchases of
    the same period, and the earliest one, which counts for those of the period before. A purchase is
    cancelled iff the first is not before it or the second is inside its window, so
    each purchase meets at most two rows however many cancellations share its key. Cancellations
    get their second row after they are grouped.

    Lines and cancellations come out of the same lines, which may be a join. Nothing but the join of both asks for
    known keys, and that only by values that are no keys, so that Spark finds the steps before it equal
    and moves the lines through them once.
    """
    keyed = lines.withColumn("match_quantity", abs_quantity(F.col("quantity"))).withColumn(
        "period", _period(days)
    )
    # equality of keys would keep null keys out of the cancellations' side alone, long before the join
    met = F.when(reduce(Column.__and__, [F.col(key).isNotNull() for key in MATCH_KEYS]), F.col("invoice_date"))
    grouped = (
        keyed.where(is_cancellation())
        .groupBy(*MATCH_KEYS, "period")
        .agg(F.max(met).alias("latest"), F.min(met).alias("earliest"))
    )
    none = F.lit(None).cast(dict(grouped.dtypes)["latest"])
    same = F.struct(F.col("period"), F.col("latest").alias("latest_same"), none.alias("earliest_next"))
    after = F.struct((F.col("period") - 1).alias("period"), none.alias("latest_same"), F.col("earliest").alias("earliest_next"))
    moments = grouped.select(*MATCH_KEYS, F.inline(F.array(same, after)))
    # a cancellation has no key to be met by, so the invoice need not travel for the match
    own = F.when(~is_cancellation(), F.col("match_quantity"))
    line, moment = keyed.withColumn("match_quantity", own).alias("line"), moments.alias("moment")
    date = F.col("line.invoice_date")
    matches = (F.col("moment.latest_same") >= date) | (F.col("moment.earliest_next") < date + _span(days))
    for key in [*MATCH_KEYS, "period"]:
        matches = matches & F.col(f"line.{key}").eqNullSafe(F.col(f"moment.{key}"))
    return line.join(moment, matches, "left_anti").drop("match_quantity", "period")


def _clean(lines: DataFrame, codes: Sequence[str]) -> DataFrame:
    return (
        lines.transform(drop_missing_customers)
        .transform(exclude_stock_codes, codes)
        .transform(remove_instant_cancellations)
        .transform(remove_cancellations)
    )


def clean_sales_lines(lines: DataFrame) -> DataFrame:
    """Purchases that count for sales; discounts stay."""
    return _clean(lines, NON_SALES_CODES)


def clean_customer_lines(lines: DataFrame, normalize_dates: bool = False) -> DataFrame:
    """Purchases of products; optionally with the date cut to the day."""
    cleaned = _clean(lines, NON_CUSTOMER_CODES)
    if normalize_dates:
        cleaned = cleaned.withColumn("invoice_date", normalize_invoice_date(F.col("invoice_date")))
    return cleaned
