"""Weekly sales series."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillroll.functions.amounts import line_total
from tillroll.functions.dates import week_end
from tillroll.session import settle


def weekly_sales(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of line totals per week ending on Sunday, weeks without sales as 0.

    ``by`` names the columns that make a series; without it all lines are one series.
    Gaps are filled from the first to the last week of each series. The sums, one row per series and week
    with sales, are stored, so that the lines are read and cleaned once for them and for the first and last weeks.
    """
    by = list(by)
    sums = lines.groupBy(*by, week_end(F.col("invoice_date")).alias("week_end")).agg(
        F.sum(line_total(F.col("quantity"), F.col("price"))).alias("week_total")
    )
    sums = settle(sums)
    weeks = F.sequence(F.min("week_end"), F.max("week_end"), F.expr("INTERVAL '7' DAY"))
    # an empty table has no first week: sequence gives null and explode no row
    spine = sums.groupBy(*by).agg(weeks.alias("weeks")).select(*by, F.explode("weeks").alias("week_end"))
    return spine.join(sums, [*by, "week_end"], "left").select(
        *by, "week_end", F.coalesce(F.col("week_total").cast("double"), F.lit(0.0)).alias("total_price")
    )


def as_series(weekly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weekly sales with one ``series_id``; the single series is called 'all'."""
    key = F.concat_ws("|", *by) if by else F.lit("all")
    return weekly.select(key.alias("series_id"), "week_end", "total_price")


def zero_sales_weeks(weekly: DataFrame) -> DataFrame:
    return weekly.where(F.col("total_price") < 1)


def preview(df: DataFrame, order: Sequence[str], rows: int = 8) -> DataFrame:
    """First ``rows`` rows in the given order."""
    return df.orderBy(*order).limit(rows)
