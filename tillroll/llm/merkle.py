"""Merkle dataset manifest: ternary hash trees whose nodes are kept as a postorder append log.

Leaves of a tree (one tree for each source) ascend by doc_id; every run of FAN neighbours is hashed
into a node (the last run may be shorter, even one node), again and again until one node is left,
the subroot; a lone leaf is its own. The subroots, in the order of their sources, are the leaves of
one more tree, whose last node is the root.

A builder gets one aligned block of FAN^LEVELS neighbours and appends their nodes in the order in
which they are completed, so a block's part of the log is written in one go; the blocks' last nodes
are the next round's leaves. Where a node stands in the log follows from the sizes of the subtrees
before it, in closed form, so siblings are addressed by their place and no node holds a link.

H is the lower-case hex SHA-256 of its inputs' concatenation. Null values are `-` in a leaf; a
null source is a tree of its own and comes first; null ids come first in their tree. Rows with the
same id are ordered by their leaf; repeated rows are leaves of their own, one beside the other.
An empty table has an empty log and no proofs. Columns other than FIELDS do not matter.

A task holds one block (729 nodes) at a time; a tree of any size, or a source that holds most rows,
is only more blocks. Ranks come from a range sort, in which equal rows still part.
"""

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import settle

FAN = 3
#: Levels that one builder raises: a block has FAN^LEVELS leaves.
LEVELS = 6
#: The columns of a leaf, in its order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

LOG = "tree long, position long, level int, index long, digest string"
PATH = "array<struct<place:int,siblings:array<string>>>"


def node_hash(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(**changed):
    """The leaf of a row as a column; `changed` replaces columns by other ones."""

    def told(name):
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[told(name) for name in FIELDS]), 256)


# ---------------------------------------------------------------- places in the log


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def subtree_size(leaves: int, level: int) -> int:
    """Nodes of a subtree of `level` levels above so many leaves, all levels filled up to its top."""
    return sum(-(-leaves // FAN**k) for k in range(level + 1))


def postorder(n: int, level: int, index: int) -> int:
    """Place of a node in the log of a tree of n leaves, from 0.

    Before it stand the nodes that its first leaf finds completed, and its own subtree.
    """
    span = FAN**level
    first = index * span
    before, k = 0, 1
    while k <= first:
        before, k = before + first // k, k * FAN
    return before + subtree_size(min(span, n - first), level) - 1


def run_of(n: int, level: int, index: int) -> range:
    """Indices of the node's run: itself and its siblings."""
    first = index - index % FAN
    return range(first, min(first + FAN, -(-n // FAN**level)))


# ---------------------------------------------------------------- order


def ranked(df: DataFrame, by: list, tree: str | None = None) -> DataFrame:
    """Rows with `index`, their place from 0 in the order `by`, and `n`, their number; per value of `tree` if given.

    A range sort of narrow rows: partition counts give the offsets. A last key unlike in all rows lets
    equal rows part, so no range is larger than its share.
    """
    keys = ([tree] if tree else []) + by
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    swept = marked.repartitionByRange(*[F.col(k).asc_nulls_first() for k in [*keys, "_row"]])
    swept = swept.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in [*keys, "_row"]])
    placed = settle(swept.drop("_row").withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    group = F.col(tree) if tree else F.lit(0)
    counts = placed.groupBy(group.alias("_tree"), "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # rows here: trees and partitions together at most
    earlier = Window.partitionBy("_tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tree",
        F.col("_part").alias("_p"),
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy("_tree")).alias("n"),
    )
    same = (placed["_part"] == offsets["_p"]) & group.eqNullSafe(offsets["_tree"])
    index = (F.col("_offset") + F.col("_at") - F.col("_first")).alias("index")
    return placed.join(offsets, same).select(*df.columns, index, "n")


def leaves_of(docs: DataFrame, **extra) -> tuple[DataFrame, DataFrame]:
    """(leaves, sources): each row's place in its tree with its leaf, and the trees by their sources' order.

    leaves: tree, index, n, doc_id, leaf and the `extra` columns, computed from the rows of docs.
    sources: tree, source, n.
    """
    columns = ["doc_id", "source", leaf_hash().alias("leaf"), *[value.alias(name) for name, value in extra.items()]]
    narrow = settle(docs.select(*columns))
    numbered = ranked(narrow, ["doc_id", "leaf"], "source")
    sources = settle(ranked(narrow.groupBy("source").agg(F.count("*").alias("rows")), ["source"]).select(F.col("index").alias("tree"), "source", F.col("rows").alias("n")))
    trees = sources.select("tree", F.col("source").alias("_source"))
    known = numbered.join(trees, numbered["source"].eqNullSafe(trees["_source"]))
    return settle(known.select("tree", "index", "n", "doc_id", "leaf", *extra)), sources


# ---------------------------------------------------------------- building


def _append(frame: pd.DataFrame, base: int, levels: int) -> pd.DataFrame:
    """Nodes above one block's leaves (nodes of level `base`) in the order of their completion."""
    frame = frame.sort_values("index")
    tree, n = int(frame["tree"].iloc[0]), int(frame["n"].iloc[0])
    top = min(levels, height(-(-n // FAN**base)))
    open_runs = [[] for _ in range(top + 1)]
    out = []
    last = int(frame["index"].iloc[-1])
    for index, digest in zip(frame["index"].tolist(), frame["digest"]):
        if base == 0:
            out.append((tree, postorder(n, 0, index), 0, index, digest))
        level, at = 0, index
        while level < top:
            open_runs[level].append(digest)
            if at % FAN != FAN - 1 and index != last:
                break
            digest = node_hash(open_runs[level])
            open_runs[level].clear()
            level, at = level + 1, at // FAN
            out.append((tree, postorder(n, base + level, at), base + level, at, digest))
    return pd.DataFrame(out, columns=["tree", "position", "level", "index", "digest"])


def append_logs(leaves: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The log of each tree of leaves (tree, index, n, digest), in parts: one for each round of `levels` levels."""
    block = F.expr(f"index div {FAN**levels}").alias("block")
    rounds, base = [], 0
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while base == 0 or largest > FAN**base:
        start = base
        nodes = leaves.select("tree", "index", "n", "digest", block)
        rounds.append(settle(nodes.groupBy("tree", "block").applyInPandas(lambda frame: _append(frame, start, levels), LOG)))
        base += levels
        sizes = leaves.select("tree", "n").distinct().where(F.col("n") > FAN**base)
        leaves = rounds[-1].where(F.col("level") == base).join(sizes, "tree").select("tree", "index", "n", "digest")
    return rounds


def subroots(log: list[DataFrame], sizes: DataFrame) -> DataFrame:
    """tree, digest: the last node of each tree's log. sizes: tree, n, a row for each tree."""
    whole = log[0]
    for part in log[1:]:
        whole = whole.unionByName(part)
    last = F.udf(lambda n: subtree_size(n, height(n)) - 1, "long")  # one row for each tree
    wanted = sizes.select("tree", last("n").alias("position"))
    return whole.join(wanted, ["tree", "position"]).select("tree", "digest")


# ---------------------------------------------------------------- proofs


_PATH = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))


def _paths(nodes: pa.Table, log: pa.Table, base: int, levels: int) -> list:
    """Paths of one block's leaves up to the tree's last node; siblings are looked up by their place."""
    indices, n = nodes["index"].to_pylist(), nodes["n"][0].as_py()
    top = min(levels, height(-(-n // FAN**base)))
    beyond = [path for path in log["path"].to_pylist() if path is not None]
    kept = dict(zip(log["position"].to_pylist(), log["digest"].to_pylist()))
    for index, digest in zip(indices, nodes["digest"].to_pylist()):
        kept[postorder(n, base, index)] = digest

    def step(level, at):
        siblings = [kept[postorder(n, base + level, i)] for i in run_of(n, base + level, at) if i != at]
        return {"place": at % FAN, "siblings": siblings}

    shared = {}  # steps of inner nodes, which many leaves pass
    paths = []
    for index in indices:
        path = [step(0, index)] if top else []
        for level in range(1, top):
            at = index // FAN**level
            if (level, at) not in shared:
                shared[level, at] = step(level, at)
            path.append(shared[level, at])
        paths.append(path + (beyond[0] if beyond else []))
    return paths


def _finder(base, levels, columns):
    def find(nodes: pa.Table, log: pa.Table) -> pa.Table:
        paths = _paths(nodes, log, base, levels) if len(nodes) else []
        return nodes.select(columns).append_column("path", pa.array(paths, _PATH))

    return find


def proofs(leaves: DataFrame, rounds: list[DataFrame], above: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """All columns of leaves (tree, index, n, digest and others) with path: the siblings level by level.

    rounds: the log's parts. above: tree, path from the tree's last node on, where the trees are leaves
    themselves. The highest round goes first, and each block takes the path of its own last node along once.
    """
    sizes = leaves.groupBy("tree").agg(F.max("n").alias("n"))
    paths = None
    for number in reversed(range(len(rounds))):
        base, span = number * levels, FAN ** ((number + 1) * levels)
        nodes = leaves
        if number:
            nodes = rounds[number - 1].where(F.col("level") == base).join(sizes.where(F.col("n") > FAN**base), "tree")
        columns = ["tree", "index", "n", "digest"] if number else leaves.columns
        nodes = nodes.select(*columns, F.expr(f"index div {FAN**levels}").alias("block"))
        raised = F.expr(f"index div cast(pow({FAN}, {levels + base} - level) as long)")  # an inner node's block
        log = rounds[number].where(F.col("level") > base)
        log = log.select("tree", raised.alias("block"), "position", "digest", F.lit(None).cast(PATH).alias("path"))
        beyond = [] if paths is None else [paths.select("tree", F.col("index").alias("block"), "path")]
        if above is not None:
            last = sizes.where((F.col("n") <= span) & (F.col("n") > (FAN**base if number else 0)))
            beyond.append(above.join(last, "tree").select("tree", F.lit(0).cast("long").alias("block"), "path"))
        for known in beyond:
            log = log.unionByName(known.withColumns({"position": F.lit(-1).cast("long"), "digest": F.lit("")}))
        by = ("tree", "block")
        schema = T.StructType([*nodes.drop("block").schema.fields, *log.select("path").schema.fields])
        paths = nodes.groupBy(*by).cogroup(log.groupBy(*by)).applyInArrow(_finder(base, levels, columns), schema)
    return paths


# ---------------------------------------------------------------- whole manifests


def manifest(docs: DataFrame, levels: int = LEVELS, **extra) -> DataFrame:
    """One row for each row of docs: doc_id, source, leaf, subroot, root, path and the `extra` columns.

    path leads from the leaf over its subroot to the root: for each level the place of the own node in its
    run and the other nodes of the run, left to right.
    """
    spark = docs.sparkSession
    leaves, sources = leaves_of(docs, **extra)
    nodes = leaves.withColumnRenamed("leaf", "digest")
    logs = append_logs(nodes, levels)
    n_sources = sources.count()
    size = F.lit(n_sources).cast("long").alias("n")
    heads = settle(subroots(logs, sources).join(sources.select("tree", "source"), "tree"))
    tops = heads.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), size, "digest", "source")
    top_logs = append_logs(tops, levels)
    root = subroots(top_logs, spark.range(min(1, n_sources)).select(F.col("id").alias("tree"), size)).first()
    above = settle(proofs(tops, top_logs, levels=levels).select(F.col("index").alias("tree"), "path", "source", F.col("digest").alias("subroot")))
    proven = proofs(nodes, logs, above.select("tree", "path"), levels).withColumnRenamed("digest", "leaf")
    proven = proven.join(above.drop("path"), "tree")
    return proven.select("doc_id", "source", "leaf", "subroot", F.lit(root and root.digest).alias("root"), "path", *extra)


def proof_text(path):
    """All siblings of a path, level by level and left to right, as one text."""
    return F.array_join(F.flatten(F.transform(path, lambda step: step["siblings"])), "")


def folded(leaf, path):
    """The root that a leaf and its siblings give."""

    def raise_one(digest, step):
        return F.sha2(F.array_join(F.array_insert(step["siblings"], step["place"] + 1, digest), ""), 256)

    return F.aggregate(path, leaf, raise_one)
