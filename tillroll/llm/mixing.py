"""Documents mixed to target shares of their sources along a curriculum.

Each source has a weight, and a schedule that says how its weight moves over training time 0..1.
Its target is its share of all words, at most `most` times what it has; the excess goes to the
other sources by weight until none is above. The schedule is integrated to the cumulative demand
of the source; a document stands where the demand reaches the middle of its words, so inverting
the integral gives its position, one for each round that takes it. Documents of a source come in
the order of md5(doc_id): whole rounds through the source, then a last part of a round that may cut
one document.

Null texts have size 0 and are taken 0 times; a null source is a source of its own. Repeated rows
each count. An empty table gives no rows. Reruns agree.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillroll.session import settle

WORD = r"[^\x20\x09-\x0D]+"

#: Documents that one running sum goes over, about; buckets grow with the table.
BUCKET_ROWS = 20_000


def text_size(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame, weights=(1, 2, 3)) -> DataFrame:
    """Sources by code point, null last, with repeating weights; one row per source."""
    ordered = sizes.orderBy(F.col("source").asc_nulls_last())
    names = [f.name for f in sizes.schema]
    indexed = ordered.rdd.zipWithIndex().map(lambda pair: (*pair[0], pair[1]))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sizes.schema) + ", place long"
    table = sizes.sparkSession.createDataFrame(indexed, schema)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    return table.select(*names, "place", weight.alias("weight"))


def source_targets(sources: DataFrame, most: float = 3.0) -> DataFrame:
    """Targets by weight; each round settles the sources that reach their limit.

    With the sources ordered by limit per weight, those below the common level are at their limit,
    so the rounds end after as many steps as new limits are reached.
    """
    sources = settle(sources.withColumn("most", F.col("source_size") * most))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, reached = 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * level
        held, open_weight, n = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(full, 1)),
        ).first()
        if n == reached or not open_weight:
            break
        reached, level = n, (total - held) / open_weight
    return sources.withColumn("target", F.least("most", F.col("weight") * level)).drop("most")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """All columns of docs with size, source_size, target, taken, position and positions; see mix_sizes.

    Columns of docs with these names are replaced. Rows are known by a hash of all their columns, so only narrow
    rows are counted and ranked, and whole ones are shuffled once; rows equal in all columns each have their own share.
    """
    found = ["size", "source_size", "target", "taken", "position", "positions"]
    keys = _row_keys(docs)
    shares = mix_sizes(docs, carry=keys, **settings).select(*keys, *found)
    one = Window.partitionBy(*keys).orderBy(F.lit(1))
    kept = docs.withColumns(keys).select(*[c for c in docs.columns if c not in found], *keys)
    kept = kept.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")
    return kept.join(shares, list(keys)).drop(*keys)


def _row_keys(docs: DataFrame) -> dict:
    """128 bits of a hash over all columns of a row and over which of them are null."""
    values = [F.col(f"`{c}`") for c in docs.columns]
    known = [value.isNull() for value in values]
    return {"_k1": F.xxhash64(*values, *known), "_k2": F.xxhash64(F.lit(1), *values, *known)}


def mix_sizes(docs: DataFrame, weights=(1, 2, 3), most: float = 3.0, slopes=(-1.0, 0.0, 1.0), carry: dict | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, position and positions of each row, and the columns of carry.

    positions has one entry for each round that takes words of the row, in order; position is the
    first of them, null if nothing is taken. All entries but that of the last round, which may cut
    the row, stand for the whole row.

    A source's weight at time t is its weight times 1 + slope * (t - 0.5); the slopes repeat like
    the weights and lie within -2..2, so weights stay positive and their integral over 0..1 is kept.
    """
    sized = settle(
        docs.select(
            "doc_id", "source", text_size(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place"),
            *[value.alias(name) for name, value in (carry or {}).items()],
        )
    )
    counted = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = source_targets(ranked_sources(counted, weights), most)
    slope = F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), (F.col("place") % len(slopes) + 1).cast("int"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rounds = F.floor(ratio + 1e-12)
    sources = settle(
        sources.select(
            F.col("source").alias("_source"), "source_size", "target", rounds.alias("rounds"),
            F.round(F.col("target") - rounds * F.col("source_size")).cast("long").alias("rest"), slope.alias("slope"), "n",
        )
    )
    # running sums: buckets of the md5 order, sized by the table, so no source is one task
    rows = sized.count()
    buckets = max(1, min(1 << 28, -(-rows // BUCKET_ROWS)))
    fraction = F.conv(F.substring("place", 1, 7), 16, 10).cast("long")
    sized = sized.withColumn("bucket", F.floor(fraction * buckets / (1 << 28)))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("base")
    )
    sums = sums.join(sources, F.col("_s").eqNullSafe(F.col("_source"))).drop("_source")
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    start = F.col("base") + F.col("within")
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    placed = placed.withColumn("taken", (F.col("rounds") * F.col("size") + last).cast("long"))
    # shares of the source's demand that are met at the middle of the document's words in each round
    here = F.when(F.col("size") > 0, F.col("rounds") + (last > 0).cast("int")).otherwise(0).cast("int")
    placed = placed.withColumn("_start", start).withColumn("_last", last).withColumn("_rounds", here)

    def position(turn):
        part = F.when(turn < F.col("rounds"), F.col("size")).otherwise(F.col("_last"))
        share = (turn * F.col("source_size") + F.col("_start") + part / 2) / F.col("target")
        return time_of(F.least(F.lit(1.0), share), F.col("slope"))

    every = F.transform(F.sequence(F.lit(0), F.col("_rounds") - 1), position)
    placed = placed.withColumn("positions", F.when(F.col("_rounds") > 0, every).otherwise(F.array().cast("array<double>")))
    placed = placed.withColumn("position", F.get("positions", F.lit(0)))
    return placed.select(
        "doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), "taken", "position", "positions", *(carry or {})
    )


def time_of(share, slope):
    """The time at which t + slope * (t * t - t) / 2, the integral of the schedule, reaches share."""
    a, b = slope / 2, 1 - slope / 2
    root = (-b + F.sqrt(b * b + 4 * a * share)) / (2 * a)
    return F.when(slope == 0, share).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), root)))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Each occurrence of a document that the mix takes, range-sorted by its position.

    round counts a document's occurrences from 0, words are those taken in it, position is its own.
    """
    kept = [c for c in mixed.columns if c not in ("position", "positions", "round", "words")]
    each = mixed.select(*kept, F.posexplode("positions").alias("round", "position"))
    words = F.least(F.col("size"), F.col("taken") - F.col("round") * F.col("size"))
    return each.withColumn("words", words).orderBy("position", "doc_id", "round")
