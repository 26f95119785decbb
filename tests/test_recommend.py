import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.operators import baskets, pages as pages_module, recommend, sampling, scores as scores_module
from tillroll.operators.dictionary import dense_index
from tillroll.operators.neighbors import cells, nearest_items
from tillroll.operators.scores import candidate_scores
from tillroll.session import CLEAN_UP, store


def table(spark, items_of):
    data = [(c, i) for c, items in items_of.items() for i in items]
    return spark.createDataFrame(data, "customer_id long, stock_code string").repartition(4)


@pytest.fixture(scope="module")
def random_pairs():
    """60 customers, 40 items; one customer has bought every item."""
    rng = np.random.default_rng(3)
    items = [f"{k:03d}" for k in range(40)]
    bought = {c: sorted(rng.choice(items, rng.integers(1, 12), replace=False)) for c in range(1, 61)}
    bought[0] = items
    return {c: [str(i) for i in found] for c, found in bought.items()}


def dense(items_of):
    items = sorted({i for found in items_of.values() for i in found})
    matrix = np.array([[i in set(items_of[c]) for i in items] for c in sorted(items_of)], dtype=float)
    together = matrix.T @ matrix
    norm = np.sqrt(np.diag(together))
    similarity = together / np.outer(norm, norm)
    np.fill_diagonal(similarity, 0)
    return items, matrix, together, similarity


@pytest.mark.parametrize("slice_items", [4, 512])
def test_co_purchases_equal_the_matrix_product(spark, random_pairs, slice_items):
    items, _, together, _ = dense(random_pairs)
    found = baskets.co_purchases(table(spark, random_pairs), slice_items=slice_items)
    got = {(r.item, r.other): (r.item_buyers, r.other_buyers, r.together) for r in found.collect()}
    wanted = {
        (a, b): (together[i, i], together[j, j], together[i, j])
        for i, a in enumerate(items) for j, b in enumerate(items) if i < j and together[i, j] > 0
    }
    assert got == wanted
    assert found.count() == len(got)


@pytest.mark.parametrize("group_pairs", [40, 16_000_000])
def test_co_purchases_are_the_same_from_pages(spark, random_pairs, group_pairs):
    extra = spark.createDataFrame([(None, "003"), (None, "004"), (1, None), (0, "000")], "customer_id long, stock_code string")
    pairs = table(spark, random_pairs).unionByName(extra).withColumn("split_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(None)))).where("split_id = 1 OR customer_id % 3 > 0")
    found = baskets.co_purchases(pairs, ["split_id"], many_pairs=0, group_pairs=group_pairs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    wanted = baskets.co_purchases(pairs, ["split_id"])
    assert found.dtypes == wanted.dtypes and rows(found) == rows(wanted) != []


@pytest.mark.parametrize("part_buyers", [3, 10_000])
def test_pairs_of_items_travel_as_arrays(spark, random_pairs, part_buyers):
    pairs = table(spark, random_pairs)
    found = baskets.co_purchases(pairs, part_buyers=part_buyers)
    assert rows(found) == rows(baskets.co_purchases(pairs, slice_items=7))
    steps = found._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]
    assert steps.count("HashAggregate") == 2 and "Generate explode(others" in steps


@pytest.mark.parametrize("sizes", [{}, {"cell_pairs": 300, "slice_items": 5, "customers_per_copy": 20}])
def test_scores_equal_the_dense_formula(spark, random_pairs, sizes):
    items, matrix, _, similarity = dense(random_pairs)
    pairs = table(spark, random_pairs)
    edges = baskets.item_similarity(pairs)
    neighbors = baskets.item_neighbors(edges, 3)
    near = {}
    for r in neighbors.collect():
        near.setdefault(r.item, []).append(r.neighbor)
    wanted = {}
    for c, bought in random_pairs.items():
        member = sorted({n for i in bought for n in near.get(i, [])})
        index = [items.index(m) for m in member]
        sub = similarity[np.ix_(index, index)]
        has = np.array([m in bought for m in member], dtype=float)
        for k, m in enumerate(member):
            if not has[k] and sub[k].sum() > 0:
                wanted[(c, m)] = (sub @ has)[k] / sub[k].sum()
    scores = candidate_scores(pairs, neighbors, **sizes)
    got = {(r.customer_id, r.stock_code): r.score for r in scores.collect()}
    assert got.keys() == wanted.keys()
    assert all(abs(got[k] - wanted[k]) < 1e-12 for k in got)


@pytest.mark.parametrize("sizes", [{"stream": False, "cell_pairs": 300}, {"stream": True, "group_members": 50, "slice_items": 5}])
def test_scores_are_the_same_both_ways(spark, random_pairs, sizes):
    pairs = table(spark, random_pairs)
    pairs = pairs.withColumn("split_id", F.explode(F.array(F.lit(1), F.lit(2)))).where("split_id = 1 OR customer_id % 3 > 0")
    near = nearest_items(pairs, 3, ["split_id"])
    plainly = candidate_scores(pairs, near, ["split_id"])
    other = candidate_scores(pairs, near, ["split_id"], **sizes)
    found, wanted = ({(r.split_id, r.customer_id, r.stock_code): r.score for r in df.collect()} for df in (other, plainly))
    assert found.keys() == wanted.keys()
    assert all(abs(found[k] - wanted[k]) < 1e-12 for k in found)


@pytest.mark.parametrize("slice_items", [2, 4096])
def test_candidates_are_the_joined_neighbors_and_travel_as_arrays(spark, slice_items):
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "b"), (None, "a"), (3, "z")], "customer_id long, stock_code string")
    near = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "a"), ("b", "c"), ("c", None)], "item string, neighbor string")
    found = recommend.candidate_items(pairs, near, slice_items=slice_items)
    assert rows(found) == rows(spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "c"), (1, None), (2, "a"), (2, "c"), (None, "b"), (None, "c")], "customer_id long, stock_code string"))
    steps = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in steps.splitlines()[0] + steps.splitlines()[1]


def test_similarity_edges(spark):
    pairs = table(spark, {1: ["a", "b"], 2: ["a", "b"], 3: ["c"], 4: ["a", "d"]})
    edges = {(r.item, r.neighbor): round(r.similarity, 6) for r in baskets.item_similarity(pairs).collect()}
    assert edges[("a", "b")] == edges[("b", "a")] == round(2 / np.sqrt(6), 6)
    assert not any("c" in pair for pair in edges)  # no co-buyers: no edge


def test_ties_follow_the_code(spark):
    pairs = table(spark, {1: ["a", "b", "c"]})
    top = baskets.item_neighbors(baskets.item_similarity(pairs), 1)
    assert rows(top, "item", "neighbor") == [("a", "b"), ("b", "a"), ("c", "a")]


def test_holdout_needs_twenty_items(spark):
    pairs = table(spark, {n: [f"{k}" for k in range(n)] for n in (19, 20, 21)})
    train, test = sampling.holdout_items(pairs, splits=(1, 2), seed=1)
    assert rows(test.groupBy("split_id", "customer_id").count()) == [
        (1, 20, 10), (1, 21, 10), (2, 20, 10), (2, 21, 10),
    ]
    assert rows(train.groupBy("split_id", "customer_id").count())[0] == (1, 19, 19)
    assert train.join(test, ["split_id", "customer_id", "stock_code"]).count() == 0
    again = sampling.holdout_items(pairs, splits=(1, 2), seed=1)[1]
    assert rows(test) == rows(again)
    assert rows(sampling.holdout_items(pairs, splits=(1, 2), seed=2)[1]) != rows(test)


def test_hit_rates(spark):
    test = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (1, 2, "d")], "split_id int, customer_id long, stock_code string")
    top = spark.createDataFrame([(1, 1, "b", 2), (1, 1, "z", 1)], "split_id int, customer_id long, stock_code string, rank int")
    rate = recommend.hit_rates(test, top).first()
    assert (rate.hit_rate, rate.reciprocal_hit_rate) == (0.25, 0.125)


def test_cart_fold(spark):
    neighbors = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("a", "z", 3), ("b", "x", 1), ("b", "a", 2), ("b", "y", 3), ("c", "x", 1), ("c", "a", 2), ("c", "y", 3)],
        "item string, neighbor string, rank int",
    )
    carts = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "b"), (3, 1, "unknown")], "cart_id int, position int, stock_code string"
    )
    found = recommend.cart_recommendations(carts, neighbors).orderBy("cart_id", "place").collect()
    assert [(r.cart_id, r.place, r.stock_code) for r in found] == [(1, 1, "x"), (1, 2, "a"), (1, 3, "y"), (2, 1, "x")]


def test_lookup(spark):
    wide = spark.createDataFrame([(1, "a", "b")], "customer_id long, top_1 string, top_2 string")
    assert rows(recommend.lookup_recommendations(wide, "customer_id", 1, 2)) == [(1, "a", "b")]
    with pytest.raises(KeyError):
        recommend.lookup_recommendations(wide, "customer_id", [1, 99], 2)
    found = recommend.lookup_recommendations(wide, "customer_id", [1, 99], 1, ignore_missing=True)
    assert rows(found) == [(1, "a"), (99, None)]
    with pytest.raises(TypeError):
        recommend.lookup_recommendations(wide, "customer_id", "1", 2)


def test_latest_description(spark):
    lines = spark.createDataFrame(
        [("1", "a", "old", "2020-01-01"), ("2", "a", "new", "2020-01-02"), ("3", "a", None, "2020-01-03")],
        "invoice string, stock_code string, description string, invoice_date string",
    )
    assert rows(recommend.describe_items(lines)) == [("a", "new")]


def test_matrix(spark):
    wide = baskets.customer_item_matrix(table(spark, {1: ["a"], 2: ["a", "b"]}), ["a", "b"])
    assert rows(wide, "customer_id", "a", "b") == [(1, 1, 0), (2, 1, 1)]


def plain(df):
    return rows(df.withColumn("similarity", df.similarity.cast("decimal(12,9)")), "item", "neighbor", "similarity", "rank")


@pytest.mark.parametrize("n", [1, 3, 50])
@pytest.mark.parametrize("sizes", [{}, {"cell_pairs": 60, "slice_items": 5}])
def test_nearest_items_are_those_of_all_pairs(spark, random_pairs, n, sizes):
    pairs = table(spark, random_pairs)
    assert plain(nearest_items(pairs, n, **sizes)) == plain(baskets.item_neighbors(baskets.item_similarity(pairs), n))


def test_nearest_items_by_split(spark, random_pairs):
    parts = [table(spark, {c: i for c, i in random_pairs.items() if c % 2 == k}).selectExpr(f"{k} AS split_id", "*") for k in (0, 1)]
    pairs = parts[0].unionByName(parts[1])
    found = nearest_items(pairs, 3, ["split_id"], cell_pairs=100)
    for k in (0, 1):
        one = nearest_items(parts[k].drop("split_id"), 3)
        assert plain(found.where(f"split_id = {k}")) == plain(one)
    near = nearest_items(pairs, 3, ["split_id"])
    scores = candidate_scores(pairs, near, ["split_id"], cell_pairs=200)
    for k in (0, 1):
        own = candidate_scores(parts[k].drop("split_id"), near.where(f"split_id = {k}").drop("split_id"))
        got = {(r.customer_id, r.stock_code): r.score for r in scores.where(f"split_id = {k}").collect()}
        assert got == pytest.approx({(r.customer_id, r.stock_code): r.score for r in own.collect()})


def test_a_large_basket_of_rare_items_is_not_expanded(spark):
    """A guest account holds 600 items that hardly anyone else buys: 360,000 pairs, of which few are counted."""
    items = [f"{k:04d}" for k in range(600)]
    bought = {0: items} | {c: [items[c], items[c + 1], "popular"] for c in range(1, 40)}
    pairs = table(spark, bought)
    _, _, work = cells(pairs, 5)
    counted = work.selectExpr("sum(size(targets) * size(others))").first()[0]
    assert counted < 360_000 / 8
    assert plain(nearest_items(pairs, 5)) == plain(baskets.item_neighbors(baskets.item_similarity(pairs), 5))


def test_cells_carry_one_number_for_each_item(spark, random_pairs):
    pairs = table(spark, random_pairs)
    items, _, work = cells(pairs, 3)
    at = {r["index"] + (r.buyers << 32) for r in items.collect()}
    assert work.schema["others"].dataType.simpleString() == "array<bigint>"
    assert {n for r in work.collect() for n in r.others} <= at


def test_ties_of_items_with_other_numbers_of_buyers_follow_the_code(spark):
    """Between n's value and the next one stand many equal ones; the first by code are kept, whatever their buyers."""
    bought = {c: ["a", f"x{c:02d}"] for c in range(30)} | {c + 100: ["a", f"w{c // 4:02d}"] for c in range(32)}
    pairs = table(spark, bought | {c + 200: [f"w{c // 12:02d}"] for c in range(96)})
    assert plain(nearest_items(pairs, 9)) == plain(baskets.item_neighbors(baskets.item_similarity(pairs), 9))


def test_baskets_are_not_copied_for_every_shuffle_partition(spark, random_pairs, monkeypatch):
    monkeypatch.setattr(scores_module, "LEAST_MEMBERS", 1, raising=False)
    pairs = table(spark, random_pairs)
    near = nearest_items(pairs, 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(8 * spark.sparkContext.defaultParallelism))
    try:
        found = candidate_scores(pairs, near, stream=True)
        assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_neighbor_lists_and_own_items_reach_a_customer_in_one_exchange(spark, random_pairs, monkeypatch):
    plans, stored = [], scores_module.settle

    def spied(df):
        plans.append((df.columns[-1], df._jdf.queryExecution().optimizedPlan().toString()))
        return stored(df)

    monkeypatch.setattr(scores_module, "settle", spied)
    pairs = stored(table(spark, random_pairs))
    near = stored(nearest_items(pairs, 3))
    found = {sizes: rows(candidate_scores(pairs, near, slice_items=sizes).selectExpr("customer_id", "stock_code", "round(score, 12)")) for sizes in (3, 4096)}
    assert found[3] == found[4096] != []
    steps = [plan for column, plan in plans if column == "members"][0]
    assert steps.count("Join ") == 4 and steps.count("Aggregate ") == 3


def exchanges(df):
    """What the exchanges of a plan carry, and the groups that read the pages."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange"), df.rdd.getNumPartitions()


def test_groups_read_the_baskets_without_an_exchange(spark, random_pairs):
    pairs = table(spark, random_pairs)
    near = nearest_items(pairs, 3, cell_pairs=300)
    assert exchanges(near)[0] == 0 and exchanges(near)[1] > 2
    found = candidate_scores(pairs, near, stream=True, group_members=100)
    assert exchanges(found)[0] == 0 and exchanges(found)[1] > 2
    assert rows(found.select("customer_id", "stock_code")) == rows(candidate_scores(pairs, near, stream=False).select("customer_id", "stock_code"))


def test_pages_may_come_before_the_customers(spark, random_pairs, monkeypatch):
    pairs = table(spark, random_pairs).withColumn("split_id", F.explode(F.array(F.lit(1), F.lit(2))))
    near = nearest_items(pairs, 3, ["split_id"])

    def plainly():
        found = candidate_scores(pairs, near, ["split_id"], stream=True, group_members=400)
        return rows(found.select("split_id", "customer_id", "stock_code", F.round("score", 9)))

    wanted, streamer = plainly(), scores_module._streamer

    def turned(*given):
        return lambda batches: streamer(*given)(reversed([batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)]))

    monkeypatch.setattr(scores_module, "_streamer", turned)
    assert plainly() == wanted != []


@pytest.mark.parametrize("n", [1, 4, 100])
def test_best_scores_are_enough_for_the_top(spark, random_pairs, n):
    pairs = table(spark, random_pairs)
    near = nearest_items(pairs, 3)
    whole = candidate_scores(pairs, near, stream=True)
    some = candidate_scores(pairs, near, stream=True, group_members=100, best=n)
    columns = ["customer_id", "stock_code", F.round("score", 9), "rank"]
    assert rows(recommend.top_recommendations(some, n).select(columns)) == rows(recommend.top_recommendations(whole, n).select(columns))
    assert n == 100 or some.count() < whole.count()


def test_pairs_are_counted_in_parts(random_pairs, monkeypatch):
    items, matrix, together, _ = dense(random_pairs)
    for size in (20, 8_000_000):
        monkeypatch.setattr(pages_module, "PENDING", size)
        monkeypatch.setattr(pages_module, "CHUNK", size)
        counted = {}
        for group in range(3):
            pairs = pages_module._Pairs(group, 3)
            for basket in matrix:
                numbers = np.flatnonzero(basket).astype(np.uint32)
                pairs.meet(np.array([len(numbers)], np.int32), numbers, np.full(len(numbers), len(numbers), np.int32))
            counted |= {(int(a), int(b)): int(n) for a, b, n in zip(*pairs.result())}
        assert counted == {(a, b): together[a, b] for a in range(len(items)) for b in range(len(items)) if a != b and together[a, b]}


def test_shuffle_files_go_with_the_write_that_made_them(spark, tmp_path):
    numbers = spark.range(1000).repartition(3, "id")
    kept = numbers.count()
    for _ in range(2):
        store(numbers.groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path / f"t{_}"))
    assert spark.conf.get(CLEAN_UP, None) in (None, "false")
    assert numbers.count() == kept and spark.read.parquet(str(tmp_path / "t1")).count() == 7
    tracker = spark._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = tracker.size()
    store(numbers.groupBy((F.col("id") % 5).alias("k")).count(), str(tmp_path / "more"))
    assert tracker.size() <= before


def test_bought_items_without_neighbors_of_their_own_count(spark):
    pairs = table(spark, {1: ["a", "c"], 2: ["a", "c", "d"], 3: ["z"]})
    near = spark.createDataFrame([("a", "c"), ("a", "d")], "item string, neighbor string")
    assert rows(candidate_scores(pairs, near)) == [(1, "d", 1.0)]


def test_no_pairs_give_no_neighbors(spark):
    empty = spark.createDataFrame([], "customer_id long, stock_code string")
    assert nearest_items(empty, 3).count() == 0
    assert nearest_items(table(spark, {1: ["a"], 2: ["b"]}), 3).count() == 0
    near = spark.createDataFrame([], "item string, neighbor string")
    assert candidate_scores(table(spark, {1: ["a"]}), near).count() == 0


def test_dense_index_follows_the_order(spark):
    values = spark.createDataFrame([(v,) for v in ["b", "a", None, "a", "é", "B", "10", "9"] * 3], "v string").repartition(5)
    found = {r.v: r["index"] for r in dense_index(values, "v").collect()}
    assert found == {v: i for i, v in enumerate([None, "10", "9", "B", "a", "b", "é"])}


def test_matrix_coordinates_and_listed_codes(spark, random_pairs):
    items, matrix, *_ = dense(random_pairs)
    found = baskets.customer_item_matrix(table(spark, random_pairs)).collect()
    order = {c: k for k, c in enumerate(sorted(random_pairs))}
    got = np.zeros_like(matrix)
    for row in found:
        got[order[row.customer_id], row.item_index] += row.value
    assert (got == matrix).all()
    wide = baskets.customer_item_matrix(table(spark, random_pairs), ["003", "absent"]).collect()
    assert {(r.customer_id, r["003"], r["absent"]) for r in wide} == {(c, int("003" in i), 0) for c, i in random_pairs.items()}


def test_holdout_moves_pairs_once_and_keeps_repeated_and_unknown_ones(spark):
    rows = [(c, f"i{n}") for c in (1, 2) for n in range(8)] + [(3, "i1"), (1, "i3"), (1, "i4"), (None, "i1"), (None, "i2"), (None, None)] + [(2, None)]
    rows += [(None, f"i{n}") for n in range(9)]
    pairs = spark.createDataFrame(rows, "customer_id long, stock_code string")
    train, test = sampling.holdout_items(pairs, 4, (1, 2), seed=7)
    both = train.withColumn("side", F.lit(0)).unionByName(test.withColumn("side", F.lit(1)))
    found = both.collect()
    for split in (1, 2):
        held = [(r.customer_id, r.stock_code) for r in found if r.side and r.split_id == split]
        left = [(r.customer_id, r.stock_code) for r in found if not r.side and r.split_id == split]
        assert sorted(c for c, _ in held) == [1] * 4 + [2] * 4
        known = {pair for pair in held if None not in pair}
        assert sorted(left, key=str) == sorted([pair for pair in rows if pair not in known], key=str)
    plan = both._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.replace("ReusedExchange", "").count("Exchange hashpartitioning") <= 2 and "ReusedExchange" in plan
