"""Retail analytics on invoice lines, written as Spark DataFrame transformations."""
