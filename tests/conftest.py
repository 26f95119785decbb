import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture
def invoice_lines(spark):
    """Lines from tuples (invoice, stock_code, quantity, date text, price, customer_id)."""

    def build(rows):
        schema = "invoice string, stock_code string, quantity double, moment string, price double, customer_id long"
        table = spark.createDataFrame(rows, schema)
        return table.selectExpr(
            "invoice", "stock_code", "quantity", "CAST(moment AS TIMESTAMP_NTZ) AS invoice_date", "price", "customer_id"
        )

    return build


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=str)
