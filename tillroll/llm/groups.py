"""Group values carried back to rows when one group may hold a third of them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts into which the rows of one key are dealt.
PARTS = 64


def with_group_min(df: DataFrame, key: str, value: str, name: str, spread: str, largest: bool = False) -> DataFrame:
    """Add the smallest (or largest) `value` of each row's `key`, without gathering a key in one task.

    Rows are dealt by (key, part of spread). Extremes are combined before each shuffle, and a key
    has at most PARTS rows when its parts meet. A null key is no group: its rows get null.
    """
    best = F.max if largest else F.min
    part = F.pmod(F.xxhash64(spread), F.lit(PARTS))
    dealt = df.withColumn("_part", part)
    parts = dealt.where(F.col(key).isNotNull()).groupBy(key, "_part").agg(best(value).alias(name))
    whole = parts.groupBy(key).agg(best(name).alias(name))
    known = parts.drop(name).join(whole, key)
    return dealt.join(known, [key, "_part"], "left").drop("_part")
