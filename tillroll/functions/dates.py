"""Calendar expressions: weeks that end on Sunday, quarters, days between."""

from pyspark.sql import Column, DataFrame, functions as F


def parse_invoice_date(text: Column, pattern: str | None = None) -> Column:
    """Timestamp of a text date."""
    return F.to_timestamp_ntz(text, F.lit(pattern)) if pattern else text.cast("timestamp_ntz")


def normalize_invoice_date(moment: Column) -> Column:
    """The calendar day of a timestamp."""
    return F.to_date(moment)


def week_end(moment: Column) -> Column:
    """Sunday that closes the week of ``moment``."""
    return F.date_add(F.trunc(F.to_date(moment), "week"), 6)


def quarter_begin(day: Column, offset: int = 0) -> Column:
    """First day of the quarter ``offset`` quarters away."""
    return F.add_months(F.trunc(F.to_date(day), "quarter"), 3 * offset)


def quarter_end(day: Column, offset: int = 0) -> Column:
    """Last day of the quarter ``offset`` quarters away; a quarter end is its own end."""
    return F.date_sub(quarter_begin(day, offset + 1), 1)


def quarter_number(day: Column) -> Column:
    """Quarters counted from year 0, so that neighbours differ by 1."""
    return F.year(day) * 4 + F.quarter(day)


def recency_days(last_day: Column, latest: Column) -> Column:
    """Days from a purchase to the end of the quarter the data runs into."""
    return F.date_diff(quarter_end(latest), last_day)


def quarter_bounds(df: DataFrame, day: str) -> DataFrame:
    """Begin and end of the previous, current and next quarter of a date column."""
    bounds = []
    for name, offset in (("previous", -1), ("current", 0), ("next", 1)):
        bounds += [
            quarter_begin(F.col(day), offset).alias(f"{name}_begin"),
            quarter_end(F.col(day), offset).alias(f"{name}_end"),
        ]
    return df.select("*", *bounds)
