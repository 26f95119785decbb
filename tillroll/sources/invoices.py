"""Read raw invoice lines."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.errors import DatasetNotFoundError
from tillroll.schema import COLUMN_NAMES, INVOICE_SCHEMA


#: Headers that may be missing; the others must be there.
OPTIONAL = {"Description", "Country"}


def scan_invoices(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read invoice lines from CSV (with header) or parquet and rename the columns.

    CSV columns are found by their header, in any order; quotes inside a quoted text are doubled. With
    ``multi_line`` a text may hold line breaks, and a file is then read by one task. Further columns are left
    out. A missing header raises KeyError; a number that does not parse fails the job that reads it.
    The date stays as written; ``parse_invoice_date`` turns text into a timestamp.
    """
    try:
        if path.rstrip("/").endswith(".parquet"):
            lines = spark.read.parquet(path)
        else:
            lines = _typed(spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multi_line))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise DatasetNotFoundError(path) from error
        raise
    lines = lines.withColumnsRenamed({old: new for old, new in COLUMN_NAMES.items() if old in lines.columns})
    if "customer_id" in lines.columns:
        lines = lines.withColumn("customer_id", F.col("customer_id").cast("bigint"))
    return lines


def _typed(raw: DataFrame) -> DataFrame:
    """The columns of the schema, by name, from texts."""
    if "Customer ID" not in raw.columns and "CustomerID" in raw.columns:
        raw = raw.withColumnRenamed("CustomerID", "Customer ID")
    missing = [f.name for f in INVOICE_SCHEMA if f.name not in raw.columns and f.name not in OPTIONAL]
    if missing:
        raise KeyError(f"the header lacks {missing}")

    def column(name, kind):
        if name not in raw.columns:
            return F.lit(None).cast(kind).alias(name)
        text = F.col(f"`{name}`")
        if kind.typeName() == "string":
            return text.alias(name)
        value = text.try_cast("double")
        value = value if kind.typeName() == "double" else F.when(value == F.floor(value), value).try_cast(kind)
        unread = F.raise_error(F.concat(F.lit(f"{name}: cannot read "), text)).cast(kind)
        return F.when(text.isNotNull() & (F.trim(text) != "") & value.isNull(), unread).otherwise(value).alias(name)

    return raw.select(*[column(f.name, f.dataType) for f in INVOICE_SCHEMA])


def order_invoice_lines(
    spark: SparkSession,
    sf_dir: str,
    *,
    description: bool = False,
    country: bool = False,
) -> DataFrame:
    """Orders and their line items seen as invoice lines.

    Every line item is a purchase; a returned one also gives a cancellation at its
    ship date. Both come out of one scan and one join. The part and customer tables
    are joined only when their columns are asked for.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if country:
        # homes join the orders, of which there are fewer than lines, so the lines move once
        customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
        nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
        homes = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
        orders = orders.join(homes.select("c_custkey", "n_name"), orders.o_custkey == F.col("c_custkey"))
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if description:
        parts = spark.read.parquet(f"{sf_dir}/part.parquet")
        joined = joined.join(parts, joined.l_partkey == parts.p_partkey)

    cancelled = F.col("cancelled")
    order_time = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (F.col("o_orderkey") % 24).cast("int")
    )
    code = F.col("l_partkey") % 97
    columns = [
        F.when(cancelled, F.concat(F.lit("C"), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("o_orderkey").cast("string")).alias("invoice"),
        F.when(code == 0, "POST").when(code == 1, "D")
        .otherwise(F.col("l_partkey").cast("string")).alias("stock_code"),
        F.when(cancelled, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(cancelled, F.col("l_shipdate")).otherwise(order_time).alias("invoice_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.when(F.col("o_orderkey") % 23 != 0, F.col("o_custkey")).alias("customer_id"),
    ]
    if description:
        columns.append(F.col("p_name").alias("description"))
    if country:
        columns.append(F.col("n_name").alias("country"))
    kinds = F.when(F.col("l_returnflag") == "R", F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    return joined.withColumn("cancelled", F.explode(kinds)).select(*columns)
