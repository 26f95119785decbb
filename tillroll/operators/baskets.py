"""Which customer bought what, and how alike items are.

Item pairs are the result asked for here, so their number cannot be avoided, but no
basket is expanded in one piece: a basket is cut into slices of bounded size, pairs are
formed between slices, and the slice pairs of a large basket are spread over the cluster
before they are expanded. A pair is no row of a shuffle: the items that an item meets in a
basket travel as one array, and pairs are counted where the arrays of their item meet.
Where there are many pairs, the baskets are stored once instead, and groups of items read them
(operators/pages.py), so that no shuffle grows with the pairs.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from tillroll.operators.dictionary import dense_index
from tillroll.operators.pages import count_pairs, paged
from tillroll.session import settle

SLICE_ITEMS = 512
#: Buyers of an item from which its pairs are counted in several parts.
PART_BUYERS = 10_000
#: Pairs within baskets from which the baskets are stored as pages; pairs that a group of items counts, about.
MANY_PAIRS, GROUP_PAIRS = 4_000_000, 16_000_000
#: Items of the catalogue in a row of its pages, and pairs in a batch of results.
CODES_PER_ROW, BATCH = 10_000, 500_000


def customer_item_pairs(lines: DataFrame) -> DataFrame:
    return lines.select("customer_id", "stock_code").distinct()


def items_per_customer(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("customer_id").agg(F.count("*").alias("n_items"))


def customer_item_matrix(pairs: DataFrame, codes: Sequence[str] | None = None) -> DataFrame:
    """The 0/1 table of customers and items, as the coordinates of its ones: (customer_id, item_index, value).

    Items are numbered in code order (dense_index), by no list on the driver, so a catalogue may have any size.
    With ``codes`` the table is wide instead: a customer's row with a 0/1 column for each listed code.
    """
    if codes is not None:
        wide = pairs.groupBy("customer_id").pivot("stock_code", list(codes)).agg(F.max(F.lit(1)))
        return wide.fillna(0, list(codes))
    numbered = pairs.join(dense_index(pairs, "stock_code"), "stock_code")
    return numbered.select("customer_id", F.col("index").alias("item_index"), F.lit(1).alias("value"))


def _slices(pairs: DataFrame, by: list[str], slice_items: int) -> DataFrame:
    """Baskets in slices of about ``slice_items`` items, each item with its number of buyers."""
    buyers = pairs.groupBy(*by, "stock_code").agg(F.count("*").alias("buyers"))
    sizes = pairs.groupBy(*by, "customer_id").agg(
        F.ceil(F.count("*") / F.lit(slice_items)).cast("int").alias("n_slices")
    )
    slice_of = F.pmod(F.xxhash64("stock_code"), F.col("n_slices")).cast("int")
    return (
        pairs.join(buyers, [*by, "stock_code"])
        .join(sizes, [*by, "customer_id"])
        .withColumn("slice", slice_of)
        .groupBy(*by, "customer_id", "n_slices", "slice")
        .agg(F.collect_list(F.struct("stock_code", "buyers")).alias("items"))
    )


def _renamed(parts, carried, side):
    return parts.select(*carried, F.col("slice").alias(f"{side}_slice"), F.col("items").alias(side))


def _paged_pairs(pairs, by, group_pairs):
    """co_purchases by groups of items that read all baskets."""
    codes = dense_index(pairs, "stock_code")
    items = settle(pairs.groupBy(*by, "stock_code").agg(F.count("*").alias("value")).join(codes, "stock_code"))
    known = pairs.where(F.col("customer_id").isNotNull()).join(items, [*by, "stock_code"])
    # an item meets the items before it, so its pairs have it as the other one
    entry = F.struct(F.col("index").cast("long").alias("number"), F.col("index").cast("long").alias("reach"))
    baskets = known.groupBy(*by, "customer_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))

    def finish(other, item, together, catalogue):
        number, buyers, codes = catalogue
        for first in range(0, len(item), BATCH):
            part = slice(first, first + BATCH)
            a, b = np.searchsorted(number, item[part]), np.searchsorted(number, other[part])
            yield [codes.take(pa.array(a)), codes.take(pa.array(b)), buyers[a], buyers[b], together[part]]

    types = dict(items.dtypes)
    code = types["stock_code"]
    schema = ", ".join([*[f"{name} {types[name]}" for name in by], f"item {code}, other {code}, item_buyers bigint, other_buyers bigint, together bigint"])
    return count_pairs(paged(items, baskets, by, CODES_PER_ROW), by, finish, schema, group_pairs)


def co_purchases(
    pairs: DataFrame, by: Sequence[str] = (), slice_items: int = SLICE_ITEMS, part_buyers: int = PART_BUYERS,
    many_pairs: int = MANY_PAIRS, group_pairs: int = GROUP_PAIRS,
) -> DataFrame:
    """Customers who bought both items: (item, other, item_buyers, other_buyers, together), item < other.

    With more than ``many_pairs`` pairs in the baskets, these are read as pages. Pass a stored table.
    """
    by = list(by)
    sizes = pairs.groupBy(*by, "customer_id").agg(F.count("*").cast("double").alias("size"))
    if (sizes.agg(F.sum(F.col("size") * F.col("size"))).first()[0] or 0) / 2 > many_pairs:
        return _paged_pairs(pairs, by, group_pairs)
    slices = _slices(pairs, by, slice_items)
    carried = [*by, "customer_id"]
    whole = slices.where("n_slices = 1").select(F.col("items").alias("left"), F.col("items").alias("right"), *by)
    parts = slices.where("n_slices > 1")
    # pairs of slice numbers are tiny; the items join them by (customer, slice), so the work
    # of one large basket is spread over as many keys as it has slices
    numbers = (
        parts.select(*carried, "n_slices")
        .distinct()
        .withColumn("left_slice", F.explode(F.expr("sequence(0, n_slices - 1)")))
        .withColumn("right_slice", F.explode(F.expr("sequence(0, n_slices - 1)")))
        .drop("n_slices")
    )
    crossed = (
        numbers.join(_renamed(parts, carried, "left"), [*carried, "left_slice"])
        .join(_renamed(parts, carried, "right"), [*carried, "right_slice"])
        .select("left", "right", *by)
    )
    # what an item meets in a basket travels as one array; an item with many buyers has parts by the other's code
    met = whole.unionByName(crossed).select(*by, F.explode("left").alias("a"), "right")
    met = met.select(*by, "a", F.ceil(F.col("a.buyers") / F.lit(part_buyers)).cast("int").alias("parts"), F.expr("filter(right, b -> b.stock_code > a.stock_code)").alias("others"))
    met = met.where(F.size("others") > 0).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    mine = F.expr("CASE WHEN parts = 1 THEN others ELSE filter(others, b -> pmod(xxhash64(b.stock_code), parts) = part) END")
    keys = [*by, "item", "item_buyers", "part"]
    met = met.select(*by, F.col("a.stock_code").alias("item"), F.col("a.buyers").alias("item_buyers"), "part", mine.alias("others"))
    return (
        met.repartition(*keys)
        .select(*keys, F.explode("others").alias("b"))
        .groupBy(*keys, F.col("b.stock_code").alias("other"), F.col("b.buyers").alias("other_buyers"))
        .agg(F.count("*").alias("together"))
        .select(*by, "item", "other", "item_buyers", "other_buyers", "together")
    )


def item_similarity(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cosine of two items' buyer vectors, both directions, positive edges only.

    The buyer counts travel with the items, so no join is needed after the pair count.
    """
    by = list(by)
    cosine = F.col("together") / F.sqrt(F.col("item_buyers").cast("double") * F.col("other_buyers"))
    edges = co_purchases(pairs, by).select(*by, "item", "other", cosine.alias("similarity"))
    directions = F.explode(
        F.array(
            F.struct(F.col("item"), F.col("other").alias("neighbor")),
            F.struct(F.col("other").alias("item"), F.col("item").alias("neighbor")),
        )
    )
    return edges.select(*by, directions.alias("d"), "similarity").select(
        *by, "d.item", "d.neighbor", "similarity"
    )


def item_neighbors(edges: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` most similar items of every item; equal similarities in code order."""
    order = Window.partitionBy(*by, "item").orderBy(F.desc(F.round("similarity", 9)), "neighbor")
    return edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
