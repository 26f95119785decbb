import datetime as dt

import pytest

from tests.conftest import rows
from tillroll.functions.dates import quarter_bounds
from tillroll.operators import customers


def purchases(invoice_lines, days_of):
    return invoice_lines(
        [
            (f"{c}-{i}", "10", 1.0, f"{day} 10:00:00", 1.0, c)
            for c, days in days_of.items()
            for i, day in enumerate(days)
        ]
    )


@pytest.mark.parametrize(
    "latest, past_end",
    [("2020-05-20", "2020-03-31"), ("2020-06-30", "2020-03-31"), ("2020-04-01", "2020-03-31")],
)
def test_quarter_edges(invoice_lines, latest, past_end):
    lines = purchases(invoice_lines, {1: ["2020-01-05", past_end], 2: [latest]})
    past, current = customers.split_quarters(lines)
    assert rows(past, "customer_id") == [(1,), (1,)]
    assert rows(current, "customer_id") == [(2,)]


def test_quarter_bounds(spark):
    day = spark.createDataFrame([(dt.date(2020, 3, 31),)], "day date")
    row = quarter_bounds(day, "day").first()
    assert [str(v) for v in row] == [
        "2020-03-31", "2019-10-01", "2019-12-31", "2020-01-01", "2020-03-31", "2020-04-01", "2020-06-30",
    ]


def test_counts_recency_and_gaps(invoice_lines):
    lines = purchases(
        invoice_lines,
        {
            1: ["2020-01-10"],
            2: ["2020-01-10", "2020-01-10", "2020-01-15"],
            3: ["2020-01-01", "2020-01-11", "2020-01-31"],
            5: ["2020-01-01", "2020-01-02", "2020-02-01", "2020-02-11", "2020-02-20"],
        },
    )
    found = rows(customers.assemble_features(customers.customer_timelines(lines)))
    assert found == [
        (1, 81, 1, None, None, 0), (2, 76, 2, 5, None, 0), (3, 60, 3, 20, 30, 0), (5, 40, 5, 9, 19, 0),
    ]


def test_label(invoice_lines):
    lines = purchases(
        invoice_lines,
        {
            1: ["2020-02-01", "2020-05-01"],  # previous and current
            2: ["2020-05-01"],  # current only: no row
            3: ["2020-02-01"],  # previous only
            4: ["2019-11-01", "2020-05-01"],  # older and current
        },
    )
    label = customers.next_quarter_label(*customers.split_quarters(lines))
    assert rows(label) == [(1, 1.0), (3, 0.0), (4, 0.0)]
    features = customers.purchase_features(lines, n=1)
    assert rows(customers.train_rows(features), "customer_id", "y_label") == [(1, 1.0), (3, 0.0), (4, 0.0)]
    assert "y_label" not in customers.predict_rows(features).columns


def test_streaks(invoice_lines):
    quarter = {1: "2020-01-05", 2: "2020-04-05", 3: "2020-07-05", 4: "2020-10-05", 5: "2021-01-05"}
    shapes = {1: [1, 2, 3], 2: [1, 3], 3: [1, 2, 4, 5], 4: [2]}
    lines = purchases(invoice_lines, {c: [quarter[q] for q in qs] for c, qs in shapes.items()})
    assert rows(customers.quarter_streaks(customers.customer_timelines(lines))) == [(1, 2), (2, 0), (3, 2), (4, 0)]
    assert customers.quarter_pairs(customers.distinct_purchase_days(lines)).count() == 4


def test_only_frequent_customers_have_features(invoice_lines):
    lines = purchases(
        invoice_lines,
        {1: ["2020-01-01", "2020-01-02", "2020-01-03", "2020-05-01"], 2: ["2020-01-01", "2020-05-01", "2020-05-02"]},
    )
    features = customers.purchase_features(lines)
    assert rows(features, "customer_id", "target", "y_label") == [
        (1, "predict", None), (1, "train", 1.0), (2, "predict", None),
    ]
    assert rows(customers.customer_recency_lookup(features, [2])) == [(2, 59)]
