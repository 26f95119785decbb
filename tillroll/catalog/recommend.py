"""Queries and oracles for baskets, similarities and recommendations."""

from pyspark.sql import functions as F

from tillroll.catalog.cleaning import lines
from tillroll.catalog.customers import customer_lines
from tillroll.catalog.oracle_base import CUSTOMER, INVOICES, with_ctes
from tillroll.catalog.registry import query
from tillroll.operators import baskets, recommend, sampling
from tillroll.operators.neighbors import nearest_items
from tillroll.operators.scores import candidate_scores
from tillroll.session import settle

NEIGHBORS = 15
SPLITS = (1, 2, 3, 4, 5)
BY = ["split_id"]

PAIRS = "\nbought AS (SELECT DISTINCT customer_id, stock_code FROM customer_lines)"
ONE_SPLIT = "\ntrain AS (SELECT 0 AS split_id, * FROM bought)"
HOLDOUT = """
splits AS (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS split_id),
hashed AS (
  SELECT split_id, customer_id, stock_code,
         row_number() OVER (PARTITION BY split_id, customer_id
           ORDER BY md5('7:' || split_id || ':' || customer_id || ':' || stock_code), stock_code) AS place
  FROM bought, splits
  WHERE customer_id IN (SELECT customer_id FROM bought GROUP BY customer_id HAVING count(*) >= 20)),
test AS (SELECT split_id, customer_id, stock_code FROM hashed WHERE place <= 10),
train AS (SELECT split_id, customer_id, stock_code FROM bought, splits
          EXCEPT SELECT split_id, customer_id, stock_code FROM test)"""
EDGES = """
buyers AS (SELECT split_id, stock_code, count(*) AS n FROM train GROUP BY split_id, stock_code),
together AS (
  SELECT a.split_id, a.stock_code AS item, b.stock_code AS neighbor, count(*) AS together
  FROM train a JOIN train b ON a.split_id = b.split_id AND a.customer_id = b.customer_id
    AND a.stock_code <> b.stock_code GROUP BY ALL),
edges AS (
  SELECT t.split_id, item, neighbor, together / sqrt(CAST(x.n AS DOUBLE) * y.n) AS similarity
  FROM together t JOIN buyers x ON x.split_id = t.split_id AND x.stock_code = item
    JOIN buyers y ON y.split_id = t.split_id AND y.stock_code = neighbor),
near AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split_id, item
                   ORDER BY round(similarity, 9) DESC, neighbor) AS place FROM edges) WHERE place <= 15)"""
SCORES = """
candidates AS (
  SELECT DISTINCT p.split_id, p.customer_id, neighbor AS stock_code
  FROM train p JOIN near n ON n.split_id = p.split_id AND n.item = p.stock_code),
members AS (
  SELECT c.*, p.stock_code IS NOT NULL AS has FROM candidates c LEFT JOIN train p
    ON p.split_id = c.split_id AND p.customer_id = c.customer_id AND p.stock_code = c.stock_code),
keyed AS MATERIALIZED (
  SELECT split_id * 100000000 + customer_id AS who,
         split_id * 100000000 + CAST(stock_code AS BIGINT) AS what, has FROM members),
links AS MATERIALIZED (
  SELECT split_id * 100000000 + CAST(item AS BIGINT) AS item,
         split_id * 100000000 + CAST(neighbor AS BIGINT) AS neighbor, similarity FROM edges),
sums AS (
  SELECT i.who, i.what, sum(CASE WHEN j.has THEN similarity ELSE 0 END) / sum(similarity) AS score
  FROM keyed i JOIN links e ON e.item = i.what JOIN keyed j ON j.who = i.who AND j.what = e.neighbor
  WHERE NOT i.has GROUP BY i.who, i.what),
scores AS (
  SELECT CAST(who // 100000000 AS INTEGER) AS split_id, who % 100000000 AS customer_id,
         CAST(what % 100000000 AS VARCHAR) AS stock_code, score FROM sums),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split_id, customer_id
                   ORDER BY round(score, 9) DESC, stock_code) AS place FROM scores) WHERE place <= 15)"""
WHOLE = (*CUSTOMER, PAIRS, ONE_SPLIT, EDGES, SCORES)
RATES = """
rates AS (
  SELECT split_id, avg(hits) AS hit_rate, avg(weighted) AS reciprocal_hit_rate FROM (
    SELECT t.split_id, t.customer_id, count(place) / count(*) AS hits,
           sum(COALESCE(1.0 / place, 0.0)) / count(*) AS weighted
    FROM test t LEFT JOIN top r ON r.split_id = t.split_id AND r.customer_id = t.customer_id
      AND r.stock_code = t.stock_code GROUP BY ALL) GROUP BY split_id)"""
SPLIT_RATES = (*CUSTOMER, PAIRS, HOLDOUT, EDGES, SCORES, RATES)


def top_sql(key, value, table):
    places = ", ".join(f"max(CASE WHEN place = {k} THEN {value} END) AS top_{k}" for k in range(1, 16))
    return f"SELECT {key}, {places} FROM {table} GROUP BY {key}"


def bought_pairs(spark, sf_dir):
    return settle(baskets.customer_item_pairs(customer_lines(spark, sf_dir)))


def near_items(spark, sf_dir):
    return nearest_items(bought_pairs(spark, sf_dir), NEIGHBORS)


def scored(spark, sf_dir, best=None):
    pairs = bought_pairs(spark, sf_dir)
    return candidate_scores(pairs, settle(nearest_items(pairs, NEIGHBORS)), best=best)


def best(spark, sf_dir):
    return recommend.top_recommendations(scored(spark, sf_dir, NEIGHBORS), NEIGHBORS)


@query("customer_item_pairs", with_ctes(*CUSTOMER, PAIRS) + "SELECT * FROM bought")
def pairs_query(spark, sf_dir):
    return baskets.customer_item_pairs(customer_lines(spark, sf_dir))


@query(
    "items_per_customer",
    with_ctes(*CUSTOMER, PAIRS) + "SELECT customer_id, count(*) AS n_items FROM bought GROUP BY customer_id",
)
def item_counts(spark, sf_dir):
    return baskets.items_per_customer(baskets.customer_item_pairs(customer_lines(spark, sf_dir)))


@query(
    "customer_item_matrix",
    with_ctes(*CUSTOMER, PAIRS)
    + """SELECT customer_id, dense_rank() OVER (ORDER BY stock_code) - 1 AS item_index, CAST(1 AS INTEGER) AS value FROM bought""",
)
def matrix(spark, sf_dir):
    return baskets.customer_item_matrix(bought_pairs(spark, sf_dir))


@query(
    "co_purchases",
    with_ctes(*CUSTOMER, PAIRS, ONE_SPLIT, EDGES)
    + """SELECT item, neighbor AS other, x.n AS item_buyers, y.n AS other_buyers, together
FROM together JOIN buyers x ON x.stock_code = item JOIN buyers y ON y.stock_code = neighbor
WHERE item < neighbor""",
)
def co_bought(spark, sf_dir):
    return baskets.co_purchases(bought_pairs(spark, sf_dir))


@query(
    "item_similarity",
    with_ctes(*CUSTOMER, PAIRS, ONE_SPLIT, EDGES)
    + "SELECT item, neighbor, round(similarity, 9) AS similarity FROM edges",
)
def similarity(spark, sf_dir):
    edges = baskets.item_similarity(bought_pairs(spark, sf_dir))
    return edges.withColumn("similarity", F.round("similarity", 9))


@query(
    "item_neighbors",
    with_ctes(*CUSTOMER, PAIRS, ONE_SPLIT, EDGES)
    + "SELECT item, neighbor, round(similarity, 9) AS similarity, CAST(place AS INTEGER) AS rank FROM near",
)
def neighbors_query(spark, sf_dir):
    return near_items(spark, sf_dir).withColumn("similarity", F.round("similarity", 9))


@query(
    "candidate_items",
    with_ctes(*CUSTOMER, PAIRS, ONE_SPLIT, EDGES, SCORES) + "SELECT customer_id, stock_code FROM candidates",
)
def candidates_query(spark, sf_dir):
    pairs = bought_pairs(spark, sf_dir)
    near = nearest_items(pairs, NEIGHBORS)
    return recommend.candidate_items(pairs, near)


@query("exclude_purchased", with_ctes(*WHOLE) + "SELECT customer_id, stock_code FROM members WHERE NOT has")
def new_candidates(spark, sf_dir):
    pairs = bought_pairs(spark, sf_dir)
    near = nearest_items(pairs, NEIGHBORS)
    candidates = recommend.candidate_items(pairs, near)
    return recommend.exclude_purchased(candidates, pairs)


@query(
    "recommendation_scores",
    with_ctes(*WHOLE) + "SELECT customer_id, stock_code, round(score, 9) AS score FROM scores",
)
def scores_query(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("score", F.round("score", 9))


@query(
    "top_recommendations",
    with_ctes(*WHOLE)
    + "SELECT customer_id, stock_code, round(score, 9) AS score, CAST(place AS INTEGER) AS rank FROM top",
)
def top_query(spark, sf_dir):
    return best(spark, sf_dir).withColumn("score", F.round("score", 9))


@query("recommend_for_customers", with_ctes(*WHOLE) + top_sql("customer_id", "stock_code", "top"))
def for_customers(spark, sf_dir):
    return recommend.recommend_for_customers(best(spark, sf_dir), NEIGHBORS)


@query(
    "recommend_for_items",
    with_ctes(*CUSTOMER, PAIRS, ONE_SPLIT, EDGES) + top_sql("item", "neighbor", "near"),
)
def for_items(spark, sf_dir):
    return recommend.recommend_for_items(near_items(spark, sf_dir), NEIGHBORS)


@query(
    "lookup_recommendations",
    with_ctes(*WHOLE, f"\nwide AS ({top_sql('customer_id', 'stock_code', 'top')})")
    + """SELECT c_custkey AS customer_id, top_1, top_2, top_3
FROM customer LEFT JOIN wide ON customer_id = c_custkey""",
)
def customer_lookup(spark, sf_dir):
    wanted = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("customer_id"))
    table = recommend.recommend_for_customers(best(spark, sf_dir), NEIGHBORS)
    return recommend.lookup_recommendations(table, "customer_id", wanted, 3, ignore_missing=True)


@query(
    "lookup_item_recommendations",
    with_ctes(*CUSTOMER, PAIRS, ONE_SPLIT, EDGES, f"\nwide AS ({top_sql('item', 'neighbor', 'near')})")
    + """SELECT code AS item, top_1, top_2, top_3
FROM (SELECT CAST(p_partkey AS VARCHAR) AS code FROM part) LEFT JOIN wide ON item = code""",
)
def item_lookup(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    wanted = parts.select(F.col("p_partkey").cast("string").alias("item"))
    table = recommend.recommend_for_items(near_items(spark, sf_dir), NEIGHBORS)
    return recommend.lookup_recommendations(table, "item", wanted, 3, ignore_missing=True)


@query(
    "describe_items",
    with_ctes(INVOICES)
    + """SELECT stock_code, description FROM (
  SELECT stock_code, description, row_number() OVER (PARTITION BY stock_code
    ORDER BY invoice_date DESC, invoice DESC, description DESC) AS place
  FROM invoices WHERE description IS NOT NULL) WHERE place = 1""",
)
def descriptions(spark, sf_dir):
    return recommend.describe_items(lines(spark, sf_dir, description=True))


@query(
    "cart_recommendations",
    with_ctes(
        *CUSTOMER, PAIRS, ONE_SPLIT, EDGES,
        """
lists AS (
  SELECT item, list(neighbor ORDER BY place) AS codes FROM near WHERE place <= 3 GROUP BY item),
cart AS (
  SELECT invoice, codes, row_number() OVER (PARTITION BY invoice ORDER BY stock_code) AS k
  FROM (SELECT DISTINCT invoice, stock_code FROM customer_lines) JOIN lists ON item = stock_code),
fold AS (
  SELECT DISTINCT invoice, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS shown FROM cart
  UNION ALL
  SELECT f.invoice, c.k,
         CASE WHEN list_contains(shown, codes[1])
              THEN list_concat(shown, list_filter(codes[2:3], lambda x: NOT list_contains(shown, x)))
              ELSE list_append(shown, codes[1]) END
  FROM fold f JOIN cart c ON c.invoice = f.invoice AND c.k = f.k + 1),
final AS (SELECT invoice, arg_max(shown, k) AS shown FROM fold GROUP BY invoice)""",
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    + """SELECT invoice AS cart_id, unnest(shown) AS stock_code,
       CAST(generate_subscripts(shown, 1) AS INTEGER) AS place FROM final""",
)
def carts_query(spark, sf_dir):
    table = settle(customer_lines(spark, sf_dir))
    carts = table.select(
        F.col("invoice").alias("cart_id"), "stock_code", F.col("stock_code").alias("position")
    ).distinct()
    neighbors = nearest_items(settle(baskets.customer_item_pairs(table)), NEIGHBORS)
    return recommend.cart_recommendations(carts, neighbors)


@query(
    "holdout_items",
    with_ctes(*CUSTOMER, PAIRS, HOLDOUT)
    + "SELECT 'train' AS side, * FROM train UNION ALL SELECT 'test', * FROM test",
)
def held_out(spark, sf_dir):
    train, test = sampling.holdout_items(bought_pairs(spark, sf_dir), splits=SPLITS, seed=7)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


def split_rates(spark, sf_dir):
    train, test = sampling.holdout_items(bought_pairs(spark, sf_dir), splits=SPLITS, seed=7)
    train = settle(train)
    scores = candidate_scores(train, settle(nearest_items(train, NEIGHBORS, BY)), BY, best=NEIGHBORS)
    return recommend.hit_rates(test, recommend.top_recommendations(scores, NEIGHBORS, BY), BY)


@query("hit_rate", with_ctes(*SPLIT_RATES) + "SELECT split_id, round(hit_rate, 9) AS hit_rate FROM rates")
def hits(spark, sf_dir):
    return split_rates(spark, sf_dir).select("split_id", F.round("hit_rate", 9).alias("hit_rate"))


@query(
    "reciprocal_hit_rate",
    with_ctes(*SPLIT_RATES)
    + "SELECT split_id, round(reciprocal_hit_rate, 9) AS reciprocal_hit_rate FROM rates",
)
def reciprocal_hits(spark, sf_dir):
    return split_rates(spark, sf_dir).select(
        "split_id", F.round("reciprocal_hit_rate", 9).alias("reciprocal_hit_rate")
    )


MEAN_RATES = (
    with_ctes(*SPLIT_RATES)
    + """SELECT round(avg(hit_rate), 9) AS hit_rate, round(avg(reciprocal_hit_rate), 9) AS reciprocal_hit_rate
FROM rates"""
)


@query("mean_over_splits", MEAN_RATES)
def mean_rates(spark, sf_dir):
    rates = recommend.mean_over_splits(split_rates(spark, sf_dir))
    return rates.select(*[F.round(c, 9).alias(c) for c in rates.columns])
