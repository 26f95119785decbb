"""Exact ranks and quantiles without sorting a whole group in one task."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from tillroll.session import Scratch

HASH_PREFIX = 3  # hex digits: 4096 buckets per group
BINS = 1024  # of a refinement
FEW = 10_000  # rows of a bin that are ranked at once


def seeded_hash(seed, *keys: Column) -> Column:
    """Reproducible pseudo-random text: md5 of the seed and the keys, joined by ':'."""
    parts = [seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))]
    return F.md5(F.concat_ws(":", *parts, *[key.cast("string") for key in keys]))


def rank_by_hash(df: DataFrame, group: Sequence[str], key: str, seed, name: str) -> DataFrame:
    """Random but exact 1-based rank within ``group``, plus the group's size as ``group_size``.

    A group may hold half of all rows, so it is never one window partition: rows are
    ranked within a (group, hash prefix) bucket, and the rows of the buckets before it
    come from a table of at most 4096 counts per group.
    """
    group = list(group)
    hashed = df.withColumn("_hash", seeded_hash(seed, F.col(key))).withColumn(
        "_bucket", F.substring("_hash", 1, HASH_PREFIX)
    )
    per_group = Window.partitionBy(*group)
    before = per_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*group, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn("group_size", F.sum("_rows").over(per_group))
        .drop("_rows")
    )
    within = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy("_hash", key))
    return (
        hashed.withColumn("_within", within)
        .join(offsets, [*group, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_hash", "_bucket", "_within", "_before")
    )


def _value_bin(value: Column) -> Column:
    # grows with the value, 64 bins per doubling
    size = F.floor(F.log2(F.abs(value) + 1) * 64)
    return F.when(value < 0, -size - 1).otherwise(size)


def _bin_facts():
    return F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: (column, probability, value).

    Bins are counted between the known bounds of a wanted rank, and the bounds narrow to its bin, until
    that holds one value or few rows; only those rows are ranked. Nulls and NaN are left out, and a column
    of nothing else has no rows.
    """
    spark = df.sparkSession
    with Scratch(spark) as scratch:
        values = scratch.settle(df.select(*[F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(columns)]))
        pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("at"), F.col(f"v{k}").alias("value")) for k in range(len(columns))]))
        values = values.select(pairs.alias("p")).select("p.at", "p.value").where("value IS NOT NULL AND NOT isnan(value)")
        targets, _ = narrowed(values, probabilities)
        found = _ranked(values, targets)
    rows = []
    for k, total in sorted({(t.at, t.total) for t in targets}):
        for p in probabilities:
            position = p * (total - 1)
            low, high = found[k, math.floor(position)], found[k, math.ceil(position)]
            value = low if low == high else low + (high - low) * (position - math.floor(position))
            rows.append((columns[k], float(p), value))
    return spark.createDataFrame(rows, "column string, probability double, value double")


def narrowed(values: DataFrame, probabilities: Sequence[float], few: int = FEW):
    """A row per wanted (at, rank) of (at, value) with total, low, high, before and n; and the passes over values.

    low..high are the values of the rank's bin, before and n the rows below and in it: at most ``few``, or of one value.
    """
    bins = values.withColumn("bin", _value_bin(F.col("value"))).groupBy("at", "bin").agg(*_bin_facts())
    all_of = Window.partitionBy("at")
    bins = bins.withColumn("upto", F.sum("n").over(all_of.orderBy("bin"))).withColumn("total", F.sum("n").over(all_of))
    position = [F.lit(float(p)) * (F.col("total") - 1) for p in probabilities]
    wanted = F.explode(F.array_distinct(F.array(*[edge(p).cast("long") for p in position for edge in (F.floor, F.ceil)])))
    held = (F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto"))
    columns = ["at", "rank", "total", "low", "high", (F.col("upto") - F.col("n")).alias("before"), "n"]
    targets = bins.withColumn("rank", wanted).where(held).select(*columns).collect()  # two rows a column and probability
    passes, done = 1, []
    while True:
        done += [t for t in targets if t.n <= few or t.low == t.high]
        targets = [t for t in targets if t.n > few and t.low != t.high]
        if not targets:
            return done, passes
        share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
        inside = _inside(values, targets).withColumn("bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
        bins = inside.groupBy("at", "rank", "total", "before", "bin").agg(*_bin_facts())
        running = Window.partitionBy("at", "rank").orderBy("bin")
        bins = bins.withColumn("upto", F.col("before") + F.sum("n").over(running)).drop("before")
        targets = bins.where(held).select(*columns).collect()
        passes += 1


def _inside(values: DataFrame, targets) -> DataFrame:
    """Values between the bounds of each target; there are at most two targets a column and probability."""
    known = [(t.at, t["rank"], t.total, t.low, t.high, t.before) for t in targets]
    schema = "at int, rank long, total long, low double, high double, before long"
    table = F.broadcast(values.sparkSession.createDataFrame(known, schema))
    return values.join(table, "at").where(F.col("value").between(F.col("low"), F.col("high")))


def _ranked(values: DataFrame, targets) -> dict:
    """The value at each target's rank."""
    found = {(t.at, t["rank"]): t.low for t in targets if t.low == t.high}
    rest = [t for t in targets if t.low != t.high]
    if rest:
        place = F.row_number().over(Window.partitionBy("at", "rank").orderBy("value")) - 1 + F.col("before")
        hits = _inside(values, rest).withColumn("place", place).where(F.col("place") == F.col("rank"))
        found |= {(r.at, r["rank"]): r.value for r in hits.select("at", "rank", "value").collect()}
    return found
