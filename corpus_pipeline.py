"""Stages that prepare the documents for training, in order.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. Its
result is written as Parquet in the shared folder and read again as the next one's input, so a
lost executor costs a re-read. Empty inputs pass as empty tables; null and empty texts are clean.
Repeated rows are judged alike; near duplicates leave one of them. Columns that a stage adds for itself begin
with an underscore, leaked_items too is the stage's own, and columns of docs with these names are lost.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, minhash, mixing, pii, toxicity
from tillroll.session import Scratch, settle

#: The first stages return these columns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark, docs, sf_dir):
    """Documents whose score is below one half; the network is fitted on labelled rows of docs."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = toxicity.scorer(spark, toxicity.fit_in_task(docs, labels))
    return docs.withColumn("_score", score(F.col("text"))).where("_score < 0.5").drop("_score")


def drop_near_duplicates(spark, docs, sf_dir):
    """One row of each near-duplicate group: that of least doc_id, null ids last, whatever ids repeat.

    Rows are chosen by a hash of all their columns, so rows equal in all of them count as one. Null and
    empty texts are each a group of their own.
    """
    row = F.xxhash64(*docs.columns, *[F.col(c).isNull() for c in docs.columns])
    groups = minhash.near_duplicates(docs.select(row.alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")).distinct()
    known = docs.select(row.alias("_row"), "doc_id").distinct().join(groups, "_row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first")
    kept = settle(known.groupBy("_group").agg(first).select(F.col("first._row").alias("_row")))
    one = Window.partitionBy("_row").orderBy(F.lit(1))
    rows = docs.withColumn("_row", row).withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return rows.join(kept, "_row", "left_semi").drop("_row", "_n")


def drop_benchmark_leaks(spark, docs, sf_dir):
    """Documents that leak no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_leaks(docs, benchmark).where(F.size("leaked_items") == 0).drop("leaked_items")


def mask_personal_data(spark, docs, sf_dir):
    """Every document, personal data replaced by the name of its kind in brackets; n_chars follows."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))


def mix_sources(spark, docs, sf_dir):
    """The documents of the mix, one row for each round that takes words of it, range-sorted by training position."""
    return mixing.in_training_order(mixing.mix(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("personal_data", mask_personal_data),
    ("source_mix", mix_sources),
]

#: SQL cannot express the fitted stages; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for _, stage in STAGES[:-1]:
            following = scratch.settle(stage(spark, docs, sf_dir))
            scratch.drop(docs)  # a stage's input goes once its result is stored
            docs = following
        return settle(STAGES[-1][1](spark, docs, sf_dir))
