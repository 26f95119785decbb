import hashlib

import pytest
from pyspark.sql import functions as F

from tillroll.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, path int, index int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    told = [row[0], row[3], row[2], row[4], row[1]]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told))


def raised(nodes):
    """All levels of a tree, each a list."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 3
        out += [level[i] for i in range(first, min(first + 3, len(level))) if i != at]
        at //= 3
    return out


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf(row)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: raised([x[2] for x in sorted(trees[s])]) for s in order}
    top = raised([levels[s][-1][0] for s in order])
    out = []
    for number, s in enumerate(order):
        for at, (known, i, own) in enumerate(sorted(trees[s])):
            path = siblings(levels[s], at) + siblings(top, number)
            out.append((i if known else None, own, levels[s][-1][0], top[-1][0], "".join(path)))
    return sorted(out, key=str)


def result(df):
    kept = df.select("doc_id", "leaf", "subroot", "root", merkle.proof_text(F.col("path")), merkle.folded(F.col("leaf"), F.col("path")))
    found = [tuple(r) for r in kept.collect()]
    assert all(r[5] == r[3] for r in found)
    return sorted([r[:5] for r in found], key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 82, 100])
def test_places_in_the_log_are_those_of_a_postorder_walk(n):
    top = merkle.height(n)
    walk = []

    def visit(level, index):
        if level:
            for child in range(3 * index, min(3 * index + 3, -(-n // 3 ** (level - 1)))):
                visit(level - 1, child)
        walk.append((level, index))

    visit(top, 0)
    assert [merkle.postorder(n, *node) for node in walk] == list(range(len(walk)))
    assert len(walk) == merkle.subtree_size(n, top)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_proofs_equal_a_plain_tree(spark, levels):
    rows = [(i * 7 % 101, f"text {i}\nnext", "en", "hot", i, "x", 1, 2) for i in range(101)]
    rows += [(i, "t" * (i % 5), None, f"s{i % 4}", None, None, None, None) for i in range(40)]
    rows += [(None, None, None, None, None, None, None, None)] * 3 + [(None, "", "", "", 0, None, 3, 4), (5, "x" * 100_000, "é", "日本", 9, "", 0, 0)]
    rows += [(3, "same", "en", "hot", 4, "x", 1, 2)] * 4 + [(3, "other", "en", "hot", 5, "x", 1, 2)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(merkle.manifest(docs, levels=levels)) == brute(rows)


def test_one_row_is_its_own_root(spark):
    rows = [(1, "a", "en", "s", 1, None, None, None)]
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).first()
    assert found.leaf == found.subroot == found.root and found.path == []


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_altered_leaf_gives_another_root(spark):
    rows = [(i, f"a\nb{i}", "en", f"s{i % 2}", i, None, None, None) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(docs, other=merkle.leaf_hash(text=F.translate("text", "\n", "")))
    roots = found.select("root", merkle.folded(F.col("other"), F.col("path")).alias("folded"), merkle.folded(F.col("leaf"), F.col("path")).alias("own"))
    for row in roots.collect():
        assert row.root == row.own != row.folded


def test_log_is_written_in_the_order_of_completion(spark):
    leaves = spark.createDataFrame([(0, i, 30, digest(str(i))) for i in range(30)], "tree long, index long, n long, digest string")
    parts = merkle.append_logs(leaves, levels=2)
    assert len(parts) == 2
    nodes = sorted((r.position, r.level, r["index"]) for part in parts for r in part.collect())
    assert [p for p, _, _ in nodes] == list(range(merkle.subtree_size(30, merkle.height(30))))
    positions = [r.position for r in parts[0].where("index div 9 = 0 AND level = 0 OR level = 1 AND index < 3").collect()]
    assert positions == sorted(positions)
