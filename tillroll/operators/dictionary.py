"""Dense numbers for values, without a global sort in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import settle


def dense_index(values: DataFrame, column: str) -> DataFrame:
    """(column, index): the distinct values of a column, numbered from 0 in their order; a null comes first.

    A range sort deals the values in order; the partitions' counts (one row each) give the offsets.
    """
    order = F.col(column).asc_nulls_first()
    swept = values.select(column).distinct().repartitionByRange(order).sortWithinPartitions(order)
    placed = settle(swept.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    counts = placed.groupBy(F.col("_part").alias("_p")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    index = F.col("_offset") + F.col("_at") - F.col("_first")
    return placed.join(offsets, F.col("_part") == F.col("_p")).select(column, index.alias("index"))
