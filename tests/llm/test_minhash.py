import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillroll.llm import minhash

SCHEMA = "doc_id long, text string, n_shingles string, key int"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return set()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    found = []
    for i, r in enumerate(rows):
        c = least.get(find(i)) if sets[i] else r[0]
        found.append((r[0], len(sets[i]), c, r[0] == c))
    return sorted(found, key=str)


def fixture(n=260, seed=3):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(800)]
    shared = draw.choices(vocabulary, k=60)
    rows = [(None, "no number at all here", "x", 1), (9001, None, "x", 1), (9002, " \t\x0b", "x", 1), (9003, "", None, 1)]
    rows += [(9004, "short Text", "x", 1), (9005, "SHORT text", "x", 1), (9006, "É short", "x", 1), (9007, "é short", "x", 1)]
    for i in range(n):
        kind = i % 4
        if kind and i > 10:
            words = (rows[draw.randrange(8, len(rows))][1] or "").split()
            for _ in range(draw.randint(0, max(1, len(words) // 25))):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
        else:
            words = draw.choices(vocabulary, k=draw.randint(5, 150)) + (shared if i % 8 == 0 else [])
        rows.append((i, " ".join(words), "x", 1))
    rows.append((500, " ".join(draw.choices(vocabulary, k=30_000)), "x", 1))
    rows.append((501, rows[-1][1] + " tail", "x", 1))
    return rows + [rows[20], rows[20]]


def test_components_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = fixture()
    found = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert found == brute(rows)


def test_chain_has_one_component(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(60)], "a binary, b binary")
    rows = minhash.components(spark, links).collect()
    assert len(rows) == 60 and {bytes(r.root) for r in rows} == {b"\0"}


def test_pair_without_the_smallest_class(spark):
    """Two classes that meet only next to a smaller class that neither is similar to."""
    draw = random.Random(1)
    words = [f"a{i}" for i in range(400)]
    common = draw.choices(words, k=100)
    one = common + draw.choices(words, k=45)
    two = one[:-3] + ["z"] * 3
    rows = [(1, " ".join(common)), (2, " ".join(one)), (3, " ".join(two)), (4, " ".join(common + draw.choices(words, k=50)))]
    rows = [(*r, "x", 1) for r in rows]
    found = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert found == brute(rows)


def test_empty(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None, "x", 1)], SCHEMA)
    assert minhash.near_duplicates(none).where(F.col("kept")).count() == 1


def test_documents_without_a_number(spark):
    """A null id shares a text, nearly shares one, and stands in a component of its own."""
    draw = random.Random(6)
    words = [f"w{i}" for i in range(120)]
    text, tail, alone = " ".join(words), " ".join(words + ["tail"]), " ".join(draw.sample(words, 60))
    rows = [(7, text), (None, text), (2, tail), (None, tail), (None, alone), (None, alone), (5, "other words entirely"), (5, "other words entirely")]
    found = minhash.near_duplicates(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert sorted([(r.doc_id, r.component_id, r.kept) for r in found], key=str) == sorted(
        [(7, 2, False), (None, 2, False), (2, 2, True), (None, 2, False), (None, None, True), (None, None, True), (5, 5, True), (5, 5, True)], key=str
    )


def test_many_alike_but_unlinked_documents_give_no_pair_rows(spark):
    """All share five sixths of their words with each other, at a similarity below the limit."""
    draw = random.Random(2)
    shared = [f"c{i}" for i in range(100)]
    rows = [(i, " ".join(shared + [f"d{i}x{k}" for k in range(24)]), "x", 1) for i in range(120)]
    rows += [(200 + i, rows[i][1] + " end", "x", 1) for i in range(6)]
    draw.shuffle(rows)
    found = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert found == brute(rows)


def test_a_bucket_returns_only_links_that_join_components():
    texts = [" ".join([f"c{i}" for i in range(100)] + [f"d{k // 4}x{i}" for i in range(25 + k % 4)]) for k in range(40)]
    made = [minhash.sketch(t) for t in texts]
    frame = pd.DataFrame({
        "bucket": made[0]["bands"][0], "key": [m["key"] for m in made], "root": [m["key"] for m in made], "n": [m["n"] for m in made], "block": 0, "lo": 0, "hi": 0,
        "minima": [m["minima"] for m in made], "bands": [np.array([made[0]["bands"][0], *m["bands"][1:]], np.int64).tobytes() for m in made],
        "shingles": [minhash.shingle_set(t).tobytes() for t in texts],
    })
    links = minhash._across(frame, 75)
    assert len(links) == 30  # ten groups of four
    assert len(minhash._across(frame.assign(root=[k // 4 for k in range(40)]), 75)) == 0
