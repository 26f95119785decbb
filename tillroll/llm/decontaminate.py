"""Benchmark decontamination: passages of documents against a BM25 index of test items.

Each document is cut into overlapping passages, long enough that any item lies whole in one.
Each passage is a query: block-max WAND retrieves all items whose score is above the threshold.
A score is BM25 over the item's own (its score for itself), so 1 is a full match. An item counts
as leaked if the passage then has enough word shingles of its question and of its answer.

Before the search of a passage, the terms' maxima over short ranges of items are added up for all
passages of a document at once. A range's sum bounds the score of its items, so a passage without a
range above the threshold has no item to retrieve; almost none has.

An item's answer is what follows its last question mark; an item without a question mark, or with
words on one side of it only, is checked as one part. Items without words never match; null and
empty texts match nothing. Repeated items and rows are each reported; items without an id as null.
Document frequencies, mean and longest length are those of all items; they are counted in Spark. Items
travel to the tasks in blocks of bounded size, one after another, and blocks do not change a score.
Without items nothing is contaminated. A column leaked_items of docs is replaced.
"""

import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrow import over_texts
from tillroll.session import settle

K1, B = 1.2, 0.75
#: Least BM25 score, as a share of the item's own; least share of shingles of question and of answer.
THRESHOLD, OVERLAP = 0.6, 0.75
SHINGLE = 5
#: Postings under one maximum; items of a range; items of one index; UTF-8 bytes of one index's items.
POSTINGS, RANGE, BLOCK_ITEMS, BLOCK_BYTES = 16, 4, 20_000, 32 << 20
#: Sums of ranges that are held at a time (8 bytes each).
SUMS = 2_000_000
_WORDS = regex.compile(r"\w+").findall
_END = 1 << 60


def words_of(text) -> list:
    return _WORDS(text.lower()) if text else []


def shingles(words) -> set:
    width = min(SHINGLE, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def question_and_answer(text: str):
    """Words before and after the last question mark; all words and no answer if one of them has none."""
    before, _, after = text.rpartition("?")
    question, answer = words_of(before), words_of(after)
    return (question, answer) if question and answer else (words_of(text), [])


class Statistics:
    """What a score needs to know of all items: their number, mean and longest length, and items per word."""

    def __init__(self, n, mean, longest, frequency):
        self.n, self.mean, self.longest, self.frequency = n, mean, longest, frequency

    @classmethod
    def of(cls, texts):
        frequency = {}
        for words in texts:
            for word in set(words):
                frequency[word] = frequency.get(word, 0) + 1
        return cls(len(texts), sum(map(len, texts)) / max(1, len(texts)), max(map(len, texts), default=0), frequency)


class Index:
    """Postings of items with their share of the item's own score, and maxima per block of postings and per range of items."""

    def __init__(self, items, statistics=None):
        self.items = [(i, *question_and_answer(text)) for i, text in items if words_of(text)]
        texts = [q + a for _, q, a in self.items]
        known = statistics or Statistics.of(texts)
        self.longest, mean, frequency = known.longest, known.mean, known.frequency
        self.postings = {}  # term -> (items, shares)
        for at, words in enumerate(texts):
            weight = {}
            for word in set(words):
                idf = math.log(1 + (known.n - frequency[word] + 0.5) / (frequency[word] + 0.5))
                tf = words.count(word)
                weight[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            own = sum(weight.values())
            for word, value in weight.items():
                places, shares = self.postings.setdefault(word, ([], []))
                places.append(at)
                shares.append(value / own)
        self.blocks = {
            t: ([p[min(i + POSTINGS, len(p)) - 1] for i in range(0, len(p), POSTINGS)], [max(s[i : i + POSTINGS]) for i in range(0, len(p), POSTINGS)])
            for t, (p, s) in self.postings.items()
        }
        self.most = {t: max(s) for t, (_, s) in self.postings.items()}
        self.checks = [(shingles(q), shingles(a)) for _, q, a in self.items]
        # maxima of each term over ranges of RANGE items, as sparse rows
        self.names = list(self.postings)
        self.number = {t: i for i, t in enumerate(self.names)}
        self.n_ranges = -(-len(self.items) // RANGE)
        owners, ranges, maxima = [], [], []
        for number, (places, shares) in enumerate(self.postings.values()):
            best = {}
            for place, share in zip(places, shares):
                best[place // RANGE] = max(best.get(place // RANGE, 0.0), share)
            owners += [number] * len(best)
            ranges += best
            maxima += best.values()
        self.ranges, self.maxima = np.array(ranges, np.int64), np.array(maxima, float)
        self.row_starts = np.searchsorted(np.array(owners, np.int64), np.arange(len(self.names) + 1))

    def retrieve(self, terms, threshold=THRESHOLD) -> list:
        """All items whose score for the distinct terms is at least the threshold, by block-max WAND."""
        threshold -= 1e-9
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]  # place, position in the postings, term
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for n, cursor in enumerate(cursors):
                bound += self.most[cursor[2]]
                if bound >= threshold:
                    pivot = n
                    break
            if pivot is None:
                break
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            # bound by the blocks that hold the pivot's place
            shallow, ends = 0.0, _END
            for _, _, term in cursors[: pivot + 1]:
                lasts, maxima = self.blocks[term]
                block = bisect_left(lasts, at)
                if block < len(lasts):
                    shallow += maxima[block]
                    ends = min(ends, lasts[block])
            if shallow < threshold:
                beyond = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else _END
                target = min(ends + 1, beyond)
            else:
                score = 0.0
                for place, position, term in self._moved(cursors[: pivot + 1], at):
                    if place == at:
                        score += self.postings[term][1][position]
                if score >= threshold:
                    found.append(at)
                target = at + 1
            cursors = list(self._moved(cursors[: pivot + 1], target)) + cursors[pivot + 1 :]
        return found

    def _moved(self, cursors, target):
        for place, position, term in cursors:
            if place < target:
                places = self.postings[term][0]
                position = bisect_left(places, target, position)
                if position == len(places):
                    continue
                place = places[position]
            yield [place, position, term]

    def passages(self, words, threshold=THRESHOLD):
        """(start, distinct terms) of the passages that may hold an item above the threshold, by the sums of their ranges."""
        size = max(32, 2 * self.longest)
        step = size // 2
        n = max(1, -(-(len(words) - step) // step))  # passage k holds the words k * step to k * step + size
        ids = np.fromiter(map(self.number.get, words, [-1] * len(words)), np.int64, len(words))
        at = np.flatnonzero(ids >= 0)
        last = at // step
        owner = np.concatenate([last, last - 1])
        inside = (owner >= 0) & (owner < n)
        pairs = np.unique(owner[inside] * len(self.names) + np.concatenate([ids[at], ids[at]])[inside])
        owner, term = pairs // max(1, len(self.names)), pairs % max(1, len(self.names))
        bounds = np.searchsorted(owner, np.arange(n + 1))
        together = max(1, SUMS // max(1, self.n_ranges))
        for first in range(0, n, together):
            stop = min(n, first + together)
            own = slice(bounds[first], bounds[stop])
            width = self.row_starts[term[own] + 1] - self.row_starts[term[own]]
            place = np.repeat(self.row_starts[term[own]] - np.cumsum(width) + width, width) + np.arange(width.sum())
            cell = np.repeat(owner[own] - first, width) * self.n_ranges + self.ranges[place]
            sums = np.bincount(cell, self.maxima[place], (stop - first) * self.n_ranges).reshape(stop - first, self.n_ranges)
            for k in np.flatnonzero((sums >= threshold - 1e-9).any(axis=1)).tolist():
                found = term[bounds[first + k] : bounds[first + k + 1]]
                yield (first + k) * step, {self.names[t] for t in found.tolist()}

    def leaks(self, text) -> list:
        """Positions of the items that the text leaks."""
        words = words_of(text)
        if not words or not self.items:
            return []
        size, found = max(32, 2 * self.longest), set()
        for at, terms in self.passages(words):
            near = None
            for item in self.retrieve(terms):
                if item in found:
                    continue
                if near is None:
                    near = words[at : at + size]
                if all(self._overlaps(part, near) for part in self.checks[item]):
                    found.add(item)
        return sorted(found)

    @staticmethod
    def _overlaps(part, words):
        if not part:
            return True
        width = len(next(iter(part)))
        have = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        return len(part & have) >= OVERLAP * len(part)


_WORD_SETS = "struct<n:bigint,words:array<string>>"


def _statistics(items: DataFrame):
    """(items with their words, number, mean and longest length): counted over all items that have words."""

    def told(texts):
        words = [words_of(text) for text in texts]
        return [{"n": len(w), "words": sorted(set(w))} for w in words]

    kind = pa.struct([("n", pa.int64()), ("words", pa.list_(pa.string()))])
    known = settle(items.withColumn("w", over_texts(_WORD_SETS, kind, lambda: told)(F.col("text"))).where("w.n > 0"))
    n, mean, longest, size = known.agg(F.count("*"), F.avg("w.n"), F.max("w.n"), F.sum(F.octet_length("text"))).first()
    frequency = settle(known.select(F.explode("w.words").alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    return known, frequency, n, mean, longest, size or 0


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of docs, with leaked_items: ids of the items that each row leaks, in order."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    known, frequency, n, mean, longest, size = _statistics(items)
    blocks = max(1, -(-n // block_items), -(-size // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))

    def finder(block):
        own = known.where(part == block)
        rows = sorted(map(tuple, own.select("item_id", "text").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        words = own.select(F.explode("w.words").alias("word")).distinct()
        counts = dict(map(tuple, frequency.join(words, "word", "left_semi").collect()))
        shared = spark.sparkContext.broadcast(Index(rows, Statistics(n, mean, longest, counts)))
        return shared, over_texts("array<bigint>", pa.list_(pa.int64()), _finder(shared))(F.col("text"))

    if blocks == 1:
        return docs.withColumn("leaked_items", finder(0)[1])
    # blocks one after another: only one is held at a time, and only rows with leaks are kept of each
    marked = settle(docs.withColumn("_row", F.monotonically_increasing_id()))
    found = None
    for block in range(blocks):
        shared, column = finder(block)
        leaks = settle(marked.select("_row", column.alias("leaked")).where(F.size("leaked") > 0))
        shared.destroy()
        found = leaks if found is None else found.unionByName(leaks)
    order = F.array_sort(F.flatten(F.collect_list("leaked")))  # nulls last
    merged = found.groupBy("_row").agg(order.alias("_leaked"))
    nothing = F.array().cast("array<bigint>")
    return marked.join(merged, "_row", "left").withColumn("leaked_items", F.coalesce("_leaked", nothing)).drop("_row", "_leaked")


def _finder(shared):
    def prepare():
        index = shared.value
        return lambda texts: [[index.items[i][0] for i in index.leaks(text)] for text in texts]

    return prepare
