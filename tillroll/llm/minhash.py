"""Near-duplicate groups: many universal hash minima, banding, verification, large-star and small-star.

A text's set holds the hashes of its distinct word shingles (ASCII letters lower-cased; with fewer
words than a shingle has, the whole sequence). Texts with equal sets form a class, and only
classes go on. Minima of HASHES universal functions are cut into BANDS; classes that agree on a
band share a bucket. Per bucket, each class is first checked against the smallest one, which is
linear in its size. After components are known, only buckets that still hold several components
are looked at again, in blocks: the classes travel with their sets, a task compares those of different
components, joins components as it finds links, and returns only links that joined some, so no row
is a pair that failed. Each pair has to agree on enough minima, then on the full sets; it is looked at in
the first band that it shares. Pairs inside one component need no check, so no component is lost.

A pair at the similarity limit is missed by all bands with probability (1 - 0.75^4)^32 = 5e-6.

Texts without words or null texts have an empty set and link with nothing. Repeated rows share a
class. A null doc_id is a document without a number: it never is the smallest one of a component that has
numbers, and the component of texts without any number is null. Columns other than doc_id and text do not matter.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrow import over_texts
from tillroll.llm.groups import with_group_min
from tillroll.session import Scratch, settle

SHINGLE = 5
HASHES, BANDS = 128, 32
#: Least share of equal minima of a pair whose full sets are compared: 5 standard errors below 0.75.
AGREEING = 0.55
#: Classes of a bucket, and shingles of them, that are compared with each other in one step, on average.
BLOCK, BLOCK_SHINGLES = 256, 2_000_000
#: Shingles that are hashed at a time.
CHUNK = 512
#: Shingles of the sets that a task remembers while it compares pairs (8 bytes each).
SETS = 4_000_000

_ROWS = HASHES // BANDS
_random = np.random.default_rng(20240229)
_A = (_random.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _random.integers(0, 2**32, HASHES, dtype=np.uint32)[:, None]
_POWERS = _random.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _random.integers(0, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SKETCH = "struct<n:bigint,key:binary,minima:binary,bands:array<bigint>>"
_SKETCH = pa.struct([("n", pa.int64()), ("key", pa.binary()), ("minima", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _mixed(values):
    values = values ^ (values >> np.uint64(31))
    values = values * _MIX[0]
    return values ^ (values >> np.uint64(29))


def shingle_set(text) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, a string or its UTF-8 bytes.

    On bytes, lower() changes A-Z alone, and split() parts at 0x20 and 0x09-0x0D.
    """
    raw = text.encode() if isinstance(text, str) else text
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total += hashed[i : i + len(total)] * _POWERS[i]
    total = np.sort(_mixed(total))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def minima_of(shingles: np.ndarray) -> np.ndarray:
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(high), CHUNK):
        hashed = _A * high[at : at + CHUNK]
        hashed += _B
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def sketch(text):
    shingles = shingle_set(text)
    if not len(shingles):
        return {"n": 0, "key": None, "minima": None, "bands": None}
    key = np.array([shingles.sum(dtype=np.uint64), _mixed(shingles ^ _MIX[1]).sum(dtype=np.uint64)], np.uint64)
    least = minima_of(shingles)
    parts = least.astype(np.uint64).reshape(BANDS, _ROWS)
    bands = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(_ROWS):
        bands = _mixed(bands * _POWERS[i] + parts[:, i])
    return {"n": len(shingles), "key": key.tobytes(), "minima": least.astype(np.uint16).tobytes(), "bands": bands.view(np.int64).tolist()}


def sketches(text):
    return over_texts(SKETCH, _SKETCH, lambda: lambda texts: [sketch(t) for t in texts], raw=True)(text)


def similar(left, right, percent: int = 75) -> bool:
    """Whether two full sets overlap enough."""
    few, many = sorted((left, right), key=len)
    both = 0
    if len(few):
        places = np.searchsorted(many, few)
        both = int(np.count_nonzero(many[np.minimum(places, len(many) - 1)] == few))
    return 100 * both >= percent * (len(left) + len(right) - both)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = 75) -> DataFrame:
    """Of pairs (a, b) of classes, those whose texts' full sets are similar. texts: key, text."""

    def check(batches):
        known, held = {}, 0

        def set_of(key, text):
            nonlocal held
            if key not in known:
                if held > SETS:
                    known.clear()
                    held = 0
                known[key] = shingle_set(text.as_py())
                held += len(known[key]) + 64
            return known[key]

        for batch in batches:
            keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
            kept = [similar(set_of(a, left), set_of(b, right), percent) for a, b, left, right in zip(*keys, *texts)]
            yield batch.filter(pa.array(kept, pa.bool_())).select([0, 1])

    sides = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("right")), "b")
    sides = sides.join(texts.select(F.col("key").alias("a"), F.col("text").alias("left")), "a")
    return sides.select("a", "b", "left", "right").mapInArrow(check, "a binary, b binary").distinct()


def _agree(a, b):
    """A Spark condition: enough of the minima of two sketches are equal."""

    def compare(batches):
        for left, right in batches:
            out = []
            for x, y in zip(left, right):
                same = np.frombuffer(x.as_py(), np.uint16) == np.frombuffer(y.as_py(), np.uint16)
                out.append(bool(same.mean() >= AGREEING))
            yield pa.array(out, pa.bool_())

    return F.arrow_udf(_two(compare), returnType="boolean")(a, b)


def _two(function):
    from typing import Iterator

    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return function(batches)

    return apply


def components(spark, links: DataFrame) -> DataFrame:
    """key, root of each linked class: alternating large-star and small-star until nothing changes."""
    with Scratch(spark) as scratch:
        edges = scratch.settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
        seen = None
        while True:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = with_group_min(both, "u", "v", "m", spread="v").withColumn("m", F.least("m", "u"))
            large = scratch.settle(large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
            small = with_group_min(large, "u", "v", "m", spread="v")
            small = small.select("m", F.explode(F.array("u", "v")).alias("u")).where("u != m")
            small = scratch.settle(small.select("u", F.col("m").alias("v")).distinct())
            scratch.drop(edges, large)
            edges = small
            mark = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
            if mark == seen:
                break
            seen = mark
        return settle(edges.select(F.col("u").alias("key"), F.col("v").alias("root")))


def _across(frame, percent):
    """Links between different components of a bucket's two blocks, as many as join components.

    A pair is compared if its sizes allow a link, its first shared band is this bucket's and enough of its minima agree.
    """
    frame = frame.drop_duplicates("key")
    low, high = frame["lo"].iloc[0], frame["hi"].iloc[0]
    keys, sizes, block = frame["key"].to_numpy(), frame["n"].to_numpy(), frame["block"].to_numpy()
    component = pd.factorize(frame["root"])[0]
    minima = np.stack([np.frombuffer(m, np.uint16) for m in frame["minima"]])
    bands = np.stack([np.frombuffer(b, np.int64) for b in frame["bands"]])
    sets, bucket, out = frame["shingles"].to_numpy(), frame["bucket"].iloc[0], []
    own = np.argmax(bands[0] == bucket)  # the band of this bucket
    rights = np.flatnonzero(block == high)
    for at in np.flatnonzero(block == low):
        others = rights[rights > at] if low == high else rights
        fit = 100 * np.minimum(sizes[others], sizes[at]) >= percent * np.maximum(sizes[others], sizes[at])
        others = others[fit & (component[others] != component[at])]
        others = others[~(bands[others, :own] == bands[at, :own]).any(axis=1)]
        others = others[np.count_nonzero(minima[others] == minima[at], axis=1) >= AGREEING * HASHES]
        for other in others:
            if component[other] != component[at]:
                if similar(np.frombuffer(sets[at], np.uint64), np.frombuffer(sets[other], np.uint64), percent):
                    component[component == component[other]] = component[at]
                    out.append((min(keys[at], keys[other]), max(keys[at], keys[other])))
    return pd.DataFrame(out, columns=["a", "b"], dtype=object)


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component) and kept of each row of docs."""
    spark = docs.sparkSession
    base = docs.select("doc_id", "text")
    drawn = settle(
        base.select("doc_id", F.md5("text").alias("content"), sketches(F.col("text")).alias("s")).select("doc_id", "content", "s.*")
    )
    classes = settle(
        drawn.where("n > 0").groupBy("key").agg(
            # numbered documents come before those without a number
            F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "content")).alias("first"), F.min("minima").alias("minima"), F.any_value("bands").alias("bands"), F.min("n").alias("n")
        )
    )
    # buckets of several classes, each with its smallest class
    rows = classes.select("key", F.explode("bands").alias("bucket"))
    members = settle(with_group_min(rows, "bucket", "key", "centre", spread="key").where("key != centre"))
    minima = classes.select("key", "minima", "n")
    pairs = members.select(F.col("centre").alias("a"), F.col("key").alias("b")).distinct()
    pairs = pairs.join(minima.select(F.col("key").alias("a"), F.col("minima").alias("left"), F.col("n").alias("n_a")), "a")
    pairs = pairs.join(minima.select(F.col("key").alias("b"), F.col("minima").alias("right"), F.col("n").alias("n_b")), "b")
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    pairs = settle(pairs.where(_agree(F.col("left"), F.col("right"))).select("a", "b"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    links = settle(confirm(pairs, texts_of(base, classes, wanted), percent))
    roots = components(spark, links)

    # the rest: buckets in which several components meet
    def rooted(df, key, name):
        known = roots.select(F.col("key").alias(key), F.col("root").alias(name))
        return df.join(known, key, "left").withColumn(name, F.coalesce(name, key))

    met = rooted(rooted(members, "key", "root"), "centre", "centre_root")
    open_buckets = met.where("root != centre_root").select("bucket").distinct()
    rest = settle(met.join(open_buckets, "bucket", "left_semi").select("bucket", "key", "root"))
    if not rest.isEmpty():
        shingles = over_texts("binary", pa.binary(), lambda: lambda texts: [shingle_set(t).tobytes() for t in texts], raw=True)
        bands = F.unhex(F.array_join(F.transform("bands", _little_endian), ""))
        wanted = rest.select("key").distinct()
        facts = classes.join(wanted, "key", "left_semi").select("key", "minima", "n", bands.alias("bands"))
        facts = settle(facts.join(texts_of(base, classes, wanted).select("key", shingles(F.col("text")).alias("shingles")), "key"))
        known = rest.join(facts.select("key", "n"), "key")
        sizes = known.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
        cut = sizes.where("size > 1").select("bucket", blocks.alias("blocks"))
        block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
        dealt = rest.join(cut, "bucket").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("bucket", "key", "root", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
        dealt = dealt.join(facts, "key")
        found = settle(dealt.groupBy("bucket", "lo", "hi").applyInPandas(lambda frame: _across(frame, percent), "a binary, b binary").distinct())
        if not found.isEmpty():
            roots = components(spark, links.unionByName(found))

    numbered = classes.select("key", F.col("first.doc_id").alias("least"))
    numbered = numbered.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    numbered = with_group_min(numbered, "root", "least", "component_id", spread="key").select("key", "component_id")
    # copies: rows of a class are dealt by (class, part), so a class may hold any share of the rows
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    spread = drawn.where("n > 0").select("doc_id", "n", "key", part.alias("part"))
    per_part = spread.select("key", "part").distinct().join(numbered, "key")
    linked = spread.join(per_part, ["key", "part"]).select("doc_id", "n", "component_id")
    alone = drawn.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _little_endian(value):
    """The bytes of a whole number from the lowest on, in hexadecimal, as numpy reads them."""
    told = F.lpad(F.hex(value), 16, "0")
    return F.concat(*[F.substring(told, 15 - 2 * i, 2) for i in range(8)])


def texts_of(base: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, text of the wanted classes: the text of their first document."""
    first = classes.join(wanted, "key", "left_semi").select("key", "first.doc_id", "first.content")
    same = first.doc_id.eqNullSafe(base.doc_id) & (first.content == F.md5(base.text))
    # repeated rows of that document are one text
    return settle(base.join(first, same, "inner").select("key", "text").dropDuplicates(["key"]))
