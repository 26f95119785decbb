"""What moves through a shuffle, seen in plans and stored files: each test fails on code that moves more."""

from pyspark.sql import functions as F

from tillroll.operators import cleaning, sales
from tillroll.session import new_path
from tillroll.sources.invoices import order_invoice_lines


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def stored(spark, df):
    path = new_path(spark, "case")
    df.write.parquet(path)
    return spark.read.parquet(path), path


LINES = [
    ("1", "a", 1.0, "2020-01-05 10:00:00", 2.0, 7), ("2", "a", 1.0, "2020-01-20 10:00:00", 2.0, 7),
    ("C3", "a", -1.0, "2020-01-10 10:00:00", 2.0, 7), ("4", "b", 1.0, "2020-01-05 10:00:00", 2.0, None),
    ("C5", "b", -1.0, "2020-01-06 10:00:00", 2.0, None), ("6", "a", 1.0, "2020-02-20 10:00:00", 2.0, 7),
]


def test_weekly_sales_read_the_lines_once(spark, invoice_lines):
    lines, path = stored(spark, invoice_lines(LINES))
    weekly = sales.weekly_sales(lines)
    assert weekly.count() == 8
    assert not any(path in name for name in weekly.inputFiles())


def test_cancellations_are_grouped_before_they_meet_two_periods(spark, invoice_lines):
    left = cleaning.remove_instant_cancellations(invoice_lines(LINES))
    assert sorted(r.invoice for r in left.collect()) == ["2", "4", "6", "C3", "C5"]
    steps = plan(left)
    assert steps.index("Generate") < steps.index("Aggregate")


def test_countries_join_the_orders_before_the_lines(spark):
    steps = plan(order_invoice_lines(spark, "/root/testdata/sf0.001", country=True).select(F.sum("quantity"), F.max("country")))
    assert steps.index("l_orderkey") < steps.index("c_nationkey")
    lineitem = [line for line in steps.splitlines() if "Relation" in line and "l_orderkey" in line][0]
    depth = {line: len(line) - len(line.lstrip(" :+-")) for line in steps.splitlines() if "Join" in line}
    assert len(lineitem) - len(lineitem.lstrip(" :+-")) <= min(depth.values()) + 9
