"""The nearest items by cosine, by a pruned search over all pairs.

cos(a, b) = together / sqrt(n_a n_b), where n is the number of buyers. Not all pairs are counted:

* A basket holds its items in the order of their buyers. Any basket of a with more than n items gives a
  n neighbors that share one buyer at least, so the n-th best cosine of a is at least 1 / sqrt(n_a m_a),
  where m_a is the least (n+1)-th smallest number of buyers in a's baskets. That takes no pairs to know.
* together is at most n_a, so b can enter a's list only if n_b <= m_a n_a^2; of those with just as many buyers
  only the ones in code order up to that (n+1)-th item. The items of a basket that a has to meet are thus a
  prefix of it, and for an item with few buyers, the long tail of a catalogue, a short one, however large the
  basket.

What is left is counted row by row of the similarity matrix, and never as rows of a table. The baskets are stored
once, and a group of items reads them and returns the n best of each of its items (operators/pages.py), so no
basket is copied by a shuffle.

Where the similarities of a cell stay with it (operators/scores.py), items are dealt to cells by their work (the
sizes of their baskets), an item with more work than a cell takes has several cells, each for a part of its
neighbors, and a cell receives the prefixes of its items' baskets as arrays. A basket travels in slices of
bounded size.
"""

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.dictionary import dense_index
from tillroll.operators.pages import count_pairs, paged
from tillroll.session import settle

#: Pairs that a group of items counts, about; 16 bytes each in its task.
GROUP_PAIRS = 16_000_000
#: Pairs that a cell counts, on average; items of a basket that travel together.
CELL_PAIRS, SLICE_ITEMS = 2_000_000, 4096
#: Items of a basket from which targets travel apart by their bounds, so that a wide bound does not widen others.
LARGE_BASKET = 64
#: More than the items of a catalogue.
INDEXES = 1 << 32
#: Below this product of buyers, cosines of other numbers of buyers differ by more than their rounding.
DISTINCT_NORM = 1e5


def _bounds(bought: DataFrame, n: int, by: list) -> DataFrame:
    """by, customer_id, size, reach: items of each basket, and the (n+1)-th of them in the order of buyers."""
    basket = [*by, "customer_id"]
    # the least n+1 are kept in each task before the shuffle
    place = F.row_number().over(Window.partitionBy(*basket).orderBy("at"))
    last = bought.withColumn("place", place).where(F.col("place") <= n + 1).where(F.col("place") == n + 1)
    sizes = bought.groupBy(*basket).agg(F.count("*").alias("size"))
    return sizes.join(last.select(*basket, F.col("at").alias("reach")), basket, "left")


def _dealt(pairs: DataFrame, n: int | None, by: list, cell_pairs: int):
    """(items, known, dealt): see cells. known: by, customer_id, at, size, reach."""
    spark = pairs.sparkSession
    basket = [*by, "customer_id"]
    codes = dense_index(pairs, "stock_code")
    items = settle(pairs.groupBy(*by, "stock_code").agg(F.count("*").alias("buyers")).join(codes, "stock_code"))
    at = (F.col("buyers") * F.lit(INDEXES) + F.col("index")).alias("at")
    bought = settle(pairs.join(items, [*by, "stock_code"]).select(*basket, at))
    baskets = settle(_bounds(bought, n, by) if n else bought.groupBy(*basket).agg(F.count("*").alias("size"), F.lit(None).cast("long").alias("reach")))
    totals = baskets.groupBy(*by).agg(F.sum(F.col("size").cast("double") * F.col("size")).alias("total"))
    n_blocks = max(2 * spark.sparkContext.defaultParallelism, math.ceil((totals.agg(F.max("total")).first()[0] or 0) / cell_pairs))
    known = bought.join(baskets, basket)
    work = known.groupBy(*by, "at").agg(F.sum("size").alias("cost"), F.min("reach").alias("reach"))
    own = F.shiftright("at", 32)
    exact = F.shiftright("reach", 32).cast("double") * own * own
    norm = own * exact
    # no bound where no basket has n other items; room for rounding where cosines lie close
    most = F.when(norm < DISTINCT_NORM, exact).otherwise(exact * (1 + 1e-8 * F.sqrt(norm)))
    last = F.when(norm < DISTINCT_NORM, F.col("reach").bitwiseAND(F.lit(INDEXES - 1))).otherwise(F.lit(INDEXES - 1))
    bound = F.when(most < float(1 << 31), F.floor(most) * F.lit(INDEXES) + last).otherwise(F.lit(2**63 - 1))
    parts = F.greatest(F.ceil(F.col("cost") / F.lit(cell_pairs)), F.lit(1)).cast("int")
    index = F.col("at").bitwiseAND(F.lit(INDEXES - 1))
    work = work.select(*by, "at", index.alias("index"), bound.alias("bound"), parts.alias("parts"))
    block = F.when(F.col("parts") > 1, F.col("index") + n_blocks).otherwise(F.pmod(F.xxhash64("index"), F.lit(n_blocks)))
    dealt = settle(work.withColumn("block", block))
    return items, known, dealt


def cells(pairs: DataFrame, n: int | None, by: Sequence[str] = (), cell_pairs: int = CELL_PAIRS, slice_items: int = SLICE_ITEMS):
    """(items, dealt, rows): the catalogue, the cells of its items, and the work: targets and the items they meet.

    items: by, stock_code, index, buyers. dealt: by, index, block, parts; a block beyond the first `blocks` is one
    item's own. rows: by, block, part, targets (at, bound of a neighbor's at), others (at). An item in work is one
    number, `at`: its buyers times 2^32, plus its index. Without n nothing is pruned: every item meets the whole of
    its baskets.
    """
    by, basket = list(by), [*by, "customer_id"]
    items, known, dealt = _dealt(pairs, n, by, cell_pairs)
    n_slices = F.ceil(F.col("size") / F.lit(slice_items)).cast("int")
    slice_of = F.pmod(F.xxhash64("at"), n_slices).cast("int").alias("slice")
    slices = known.groupBy(*basket, slice_of).agg(F.sort_array(F.collect_list("at")).alias("others"))
    numbers = F.explode(F.sequence(F.lit(0), n_slices - 1)).alias("slice")
    like = F.when(F.col("size") > LARGE_BASKET, F.floor(F.log(4.0, F.greatest(F.shiftright("bound", 32), F.lit(1))))).otherwise(0)
    targets = known.join(dealt, [*by, "at"]).groupBy(*basket, "block", "parts", "size", like.alias("like"))
    targets = targets.agg(F.collect_list(F.struct("at", "bound")).alias("targets"), F.max("bound").alias("widest"))
    met = targets.select(*basket, "block", "parts", "targets", "widest", numbers).join(slices, [*basket, "slice"])
    # most rows keep all others and are one part: no function runs over their arrays
    within = F.expr("CASE WHEN element_at(others, -1) <= widest THEN others ELSE filter(others, o -> o <= widest) END")
    met = met.withColumn("others", within)
    each = f"CASE WHEN parts = 1 THEN array(0) ELSE array_distinct(transform(others, o -> cast((o & {INDEXES - 1}) % parts as int))) END"
    rows = met.select(*by, "block", "parts", "targets", "others", F.explode(F.expr(each)).alias("part")).where("size(others) > 0")
    mine = f"CASE WHEN parts = 1 THEN others ELSE filter(others, o -> (o & {INDEXES - 1}) % parts = part) END"
    return items, dealt.drop("at"), rows.withColumn("others", F.expr(mine)).select(*by, "block", "part", "targets", "others")


def _together(table: pa.Table):
    """(items, item, neighbor, similarity): the pairs of a cell with their cosines, in the order of the items."""
    targets, others = (table[name].combine_chunks() for name in ("targets", "others"))
    (target, t_sizes), (other, o_sizes) = ((side.flatten(), side.value_lengths().to_numpy().astype(np.int64)) for side in (targets, others))
    a, bound = (target.field(name).to_numpy() for name in ("at", "bound"))
    names, first, local = np.unique(a & (INDEXES - 1), return_index=True, return_inverse=True)
    others, b = np.unique(other.to_numpy(), return_inverse=True)
    width = np.repeat(o_sizes, t_sizes)  # each target of a row meets the row's others
    start = np.repeat(np.cumsum(o_sizes) - o_sizes, t_sizes)
    met = b[np.arange(width.sum()) + np.repeat(start - np.cumsum(width) + width, width)]
    value = others[met]
    wanted = (value != np.repeat(a, width)) & (value <= np.repeat(bound, width))
    key, together = np.unique((np.repeat(local * len(others), width) + met)[wanted], return_counts=True)
    item, met = np.divmod(key, max(1, len(others)))
    similarity = together / np.sqrt((a[first] >> 32)[item].astype(float) * (others >> 32)[met])
    return names, item, others[met] & (INDEXES - 1), similarity


def _ranked(n: int):
    """The n best neighbors of each item, from its pairs."""

    def finish(item, other, together, catalogue):
        number, buyers, codes = catalogue
        item, other = np.searchsorted(number, item), np.searchsorted(number, other)
        similarity = together / np.sqrt(buyers[item].astype(float) * buyers[other])
        rounded = np.round(similarity, 9)
        # only what reaches an item's n-th value is sorted
        starts = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        size = np.diff(np.append(starts, len(item)))
        least = np.full(len(starts), -1.0)
        for i in np.flatnonzero(size > n):
            mine = rounded[starts[i] : starts[i] + size[i]]
            least[i] = np.partition(mine, len(mine) - n)[len(mine) - n]
        near = np.flatnonzero(rounded >= np.repeat(least, size))
        near = near[np.lexsort((other[near], -rounded[near], item[near]))]
        ranked = item[near]
        rank = np.arange(len(near)) - np.searchsorted(ranked, ranked) + 1
        best, rank = near[rank <= n], rank[rank <= n]
        yield [codes.take(pa.array(item[best])), codes.take(pa.array(other[best])), similarity[best], rank.astype(np.int32)]

    return finish


def nearest_items(pairs: DataFrame, n: int, by: Sequence[str] = (), cell_pairs: int = GROUP_PAIRS, slice_items: int = SLICE_ITEMS) -> DataFrame:
    """by, item, neighbor, similarity, rank: the n items most similar to each, equal similarities in code order.

    pairs: distinct by, customer_id, stock_code. Items without a common buyer are no neighbors, so an item may
    have fewer than n, or none. An empty table gives an empty result. A group of items counts about `cell_pairs`
    pairs; the catalogue is stored in rows of `slice_items`.
    """
    by = list(by)
    items, known, dealt = _dealt(pairs, n, by, cell_pairs)
    bounds = dealt.select(*by, "at", "bound")
    baskets = known.join(bounds, [*by, "at"]).groupBy(*by, "customer_id").agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("number"), F.col("bound").alias("reach")))).alias("entries"))
    pages = paged(items.withColumnRenamed("buyers", "value"), baskets, by, slice_items)
    types = dict(items.dtypes)
    code = types["stock_code"]
    schema = ", ".join([*[f"{name} {types[name]}" for name in by], f"item {code}, neighbor {code}, similarity double, rank int"])
    return count_pairs(pages, by, _ranked(n), schema, cell_pairs)
