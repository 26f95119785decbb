"""Item-based recommendations from neighbors and scores (operators/neighbors.py, operators/scores.py)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, Window

from tillroll.operators.lookups import keyed_lookup


#: Purchases of a customer from which their candidates are dealt to several arrays.
SLICE_ITEMS = 4096


def member_slices(lists: DataFrame, sizes: DataFrame, column: str, customer: list) -> DataFrame:
    """customer, slice, members: the distinct values of a customer's lists as arrays of bounded size.

    The lists travel as they are, so that a value is no row. Customers with several slices deal the values by hash.
    """
    sized = lists.join(sizes, customer, "left").withColumn("n_slices", F.coalesce("n_slices", F.lit(1)))
    part = F.explode(F.sequence(F.lit(0), F.col("n_slices") - 1)).alias("slice")
    mine = F.expr(f"CASE WHEN n_slices = 1 THEN {column} ELSE filter({column}, x -> pmod(xxhash64(x), n_slices) = slice) END")
    dealt = sized.select(*customer, "n_slices", column, part).select(*customer, "slice", mine.alias(column))
    return dealt.groupBy(*customer, "slice").agg(F.array_distinct(F.flatten(F.collect_list(column))).alias("members"))


def candidate_items(pairs: DataFrame, neighbors: DataFrame, by: Sequence[str] = (), slice_items: int = SLICE_ITEMS) -> DataFrame:
    """Distinct neighbors of a customer's items, bought ones included.

    The neighbors of an item travel as one array, and become rows only where their customer's are together.
    """
    by = list(by)
    customer = [*by, "customer_id"]
    near = neighbors.groupBy(*by, F.col("item").alias("stock_code")).agg(F.collect_list(F.struct("neighbor")).alias("near"))
    lists = pairs.join(near, [*by, "stock_code"]).select(*customer, F.col("near.neighbor").alias("near"))
    sizes = pairs.groupBy(*customer).agg(F.ceil(F.count("*") / F.lit(slice_items)).cast("int").alias("n_slices"))
    return member_slices(lists, sizes, "near", customer).select(*customer, F.explode("members").alias("stock_code"))


def exclude_purchased(candidates: DataFrame, pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return candidates.join(pairs, [*by, "customer_id", "stock_code"], "left_anti")


def top_recommendations(scores: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` best scored items per customer; equal scores in code order."""
    order = Window.partitionBy(*by, "customer_id").orderBy(F.desc(F.round("score", 9)), "stock_code")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def as_top_columns(ranked: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """Ranked rows as columns ``top_1`` .. ``top_n``; missing places are null."""
    places = [F.max(F.when(F.col("rank") == k, F.col(value))).alias(f"top_{k}") for k in range(1, n + 1)]
    return ranked.groupBy(key).agg(*places)


def recommend_for_items(neighbors: DataFrame, n: int) -> DataFrame:
    return as_top_columns(neighbors, "item", "neighbor", n)


def recommend_for_customers(top: DataFrame, n: int) -> DataFrame:
    return as_top_columns(top, "customer_id", "stock_code", n)


def lookup_recommendations(table: DataFrame, key: str, wanted, n: int, ignore_missing: bool = False) -> DataFrame:
    """First ``n`` recommendations of the wanted customers or items."""
    return keyed_lookup(table, key, wanted, [f"top_{k}" for k in range(1, n + 1)], ignore_missing)


def describe_items(lines: DataFrame) -> DataFrame:
    """Latest non-null description per stock code; ties go to the last invoice, then the last text."""
    newest = F.max(F.struct("invoice_date", "invoice", "description"))
    return (
        lines.where(F.col("description").isNotNull())
        .groupBy("stock_code")
        .agg(newest.alias("newest"))
        .select("stock_code", F.col("newest.description").alias("description"))
    )


def cart_recommendations(carts: DataFrame, neighbors: DataFrame, top: int = 3) -> DataFrame:
    """Items to show next to a cart: (cart_id, place, stock_code).

    Cart items are taken in order of ``position``. Each adds its best neighbor, or, if
    that is already shown, all of its other ``top`` neighbors that are not. A cart is one
    array, so the order-dependent fold stays inside a row.
    """
    near = (
        neighbors.where(F.col("rank") <= top)
        .groupBy("item")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "neighbor"))).alias("near"))
    )
    lists = (
        carts.join(near, carts.stock_code == near.item)
        .groupBy("cart_id")
        .agg(F.array_sort(F.collect_list(F.struct("position", "near"))).alias("rows"))
    )
    none_shown = F.array().cast("array<string>")

    def add(shown, row):
        codes = F.transform(row["near"], lambda x: x["neighbor"])
        rest = F.array_except(F.slice(codes, 2, top), shown)
        return F.when(F.array_contains(shown, codes[0]), F.concat(shown, rest)).otherwise(
            F.concat(shown, F.slice(codes, 1, 1))
        )

    shown = F.aggregate("rows", none_shown, add)
    return lists.select("cart_id", F.posexplode(shown).alias("place", "stock_code")).withColumn(
        "place", F.col("place") + 1
    )


def hit_rates(test: DataFrame, top: DataFrame, by: Sequence[str] = ("split_id",)) -> DataFrame:
    """Mean hit rate and reciprocal hit rate over the tested customers of each split.

    A hit is a held-out item among the recommendations. Customers without one count as 0.
    """
    by = list(by)
    hits = test.join(top, [*by, "customer_id", "stock_code"], "left")
    per_customer = hits.groupBy(*by, "customer_id").agg(
        (F.count("rank") / F.count("*")).alias("hit_rate"),
        (F.sum(F.coalesce(1 / F.col("rank"), F.lit(0.0))) / F.count("*")).alias("reciprocal_hit_rate"),
    )
    return per_customer.groupBy(*by).agg(
        F.avg("hit_rate").alias("hit_rate"), F.avg("reciprocal_hit_rate").alias("reciprocal_hit_rate")
    )


def mean_over_splits(rates: DataFrame) -> DataFrame:
    return rates.agg(
        F.avg("hit_rate").alias("hit_rate"), F.avg("reciprocal_hit_rate").alias("reciprocal_hit_rate")
    )
