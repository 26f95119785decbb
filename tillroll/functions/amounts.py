"""Quantities and money."""

from pyspark.sql import Column, functions as F


def line_total(quantity: Column, price: Column) -> Column:
    """Quantity times price in whole cents, so that sums do not depend on their order."""
    return (quantity * price).cast("decimal(18,2)")


def abs_quantity(quantity: Column) -> Column:
    return F.abs(quantity)
