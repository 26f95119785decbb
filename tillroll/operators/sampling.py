"""Reproducible hold-outs and folds. Random choices follow md5 of seed and key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, Window

from tillroll.contracts import check_test_size
from tillroll.functions.ranks import rank_by_hash, seeded_hash
from tillroll.session import spread


def stratified_holdout(df: DataFrame, test_size: float, label: str = "y_label", key: str = "customer_id", seed=0) -> DataFrame:
    """Mark a random share of every label as test rows (``is_test`` 1), rounded up per label."""
    check_test_size(test_size, 1)
    ranked = rank_by_hash(df, [label], key, seed, "_rank")
    return ranked.withColumn(
        "is_test", F.when(F.col("_rank") <= F.ceil(F.col("group_size") * F.lit(test_size)), 1).otherwise(0)
    ).drop("_rank", "group_size")


def stratified_folds(df: DataFrame, n_folds: int = 5, label: str = "y_label", key: str = "customer_id", seed=0) -> DataFrame:
    """Deal the rows of every label to ``n_folds`` folds in turn."""
    ranked = rank_by_hash(df, [label], key, seed, "_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % n_folds).cast("int")).drop("_rank", "group_size")


def holdout_items(pairs: DataFrame, k: int = 10, splits: Sequence[int] = (0,), seed=0) -> tuple[DataFrame, DataFrame]:
    """Train and test pairs: every customer with at least ``2 k`` items gives ``k`` random ones to the test.

    All splits come out of one plan with a ``split_id`` column. Pairs move once, to their customer; they get their
    splits and places there, and those places tell both sides apart.
    """
    customer = Window.partitionBy("customer_id")
    # few bytes and much work, so they keep their tasks; pairs without a customer count as none
    sized = spread(pairs, "customer_id", waves=1).select("customer_id", "stock_code", F.count("customer_id").over(customer).alias("_items"))
    tested = F.col("_items") >= 2 * k
    split_ids = F.explode(F.array(*[F.lit(int(s)) for s in splits])).alias("split_id")
    all_splits = sized.select(split_ids, "customer_id", "stock_code", tested.alias("_tested"))
    hashed = all_splits.withColumn(
        "_hash", seeded_hash(seed, F.col("split_id"), F.col("customer_id"), F.col("stock_code"))
    )
    order = Window.partitionBy("customer_id", "split_id").orderBy("_hash", "stock_code")
    columns = ["split_id", "customer_id", "stock_code"]
    test = hashed.where("_tested").withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    # a pair that is there twice has one rank; one without a code equals none of the test
    train = hashed.withColumn("_rank", F.rank().over(order)).where(
        ~F.col("_tested") | (F.col("_rank") > k) | F.col("stock_code").isNull()
    )
    return train.select(columns), test.select(columns)
