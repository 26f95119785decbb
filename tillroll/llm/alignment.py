"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes, over a corpus.

A text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B, which puts a space
before it). The byte offsets where tokens of both end cut the tokens into groups; in a group each
A token is linked with each B token. An array made once gives for each A id the B id of the same
bytes. A group of one A token and its same-bytes B token is regular: such links are counted in
vectors as long as the vocabulary, one for each task. Only the pairs of other groups are
shuffled, once for each document and pair. A pair's count is the number of documents that hold it.

Tokens never reach over the start of white space in either vocabulary (checked on the vocabularies),
so a text is the sequence of its runs "white space, then the rest up to the next white space", and a run
is encoded and aligned once in a task and remembered. Nothing of a text is left out.

Null and empty texts, and texts whose tokens' bytes differ from the text in A or B, have no tokens: zeros,
and an empty groups text. Repeated rows are documents of their own. Ties for the highest count all
count as highest. An empty table has an empty result.
"""

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tokens import byte_symbols
from tillroll.session import settle

#: Link weights that a Python worker remembers of runs (40 bytes or so each, runs included).
REMEMBERED = 3_000_000
#: Characters of the texts that are taken together; of new runs that are encoded in one piece.
TOGETHER, PIECE = 1 << 20, 1 << 15
#: Pairs that are formed at a time.
EXPANDED = 1 << 22

# fixed values: white space at which runs may start; anything like white space, which may not end a run
_STARTS = r" \t\n"
_ODD = r"\s\x00-\x20\x7f-\xa0 ᠎ -‏ -  -⁤▁　﻿"
_RUNS = regex.compile(rf"(?=.)(?:[{_STARTS}]*+[^{_STARTS}]*[{_ODD}](?=[{_STARTS}]))*+(?:[{_STARTS}]*+[^{_STARTS}]++|[{_STARTS}]++)?+", regex.S).findall
_PLAIN_RUNS = regex.compile(rf"[{_STARTS}]*+[^{_STARTS}]++|[{_STARTS}]++").findall
_ENDS_WELL = regex.compile(rf"[^{_STARTS}{_ODD}]\Z").search
_IS_ODD = regex.compile(rf"[[{_ODD}]--[{_STARTS}]]", regex.V1).search

_ALIGNED = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups", pa.string()),
        ("same", pa.list_(pa.int32())),
        ("same_links", pa.list_(pa.int64())),
        ("pairs", pa.list_(pa.int64())),
        ("pair_links", pa.list_(pa.int64())),
    ]
)
ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "same array<int>, same_links array<long>, pairs array<long>, pair_links array<long>"
)


def runs_of(text: str) -> list:
    """A text in runs that no token crosses."""
    return _RUNS(text) if _IS_ODD(text) else _PLAIN_RUNS(text)


class Vocabularies:
    """Both vocabularies from their files' content, the bytes of each token, and the identity map."""

    def __init__(self, byte_file: str, piece_file: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        spec = json.loads(byte_file)
        split = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or split["type"] != "ByteLevel" or not split["use_regex"] or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a byte-level vocabulary whose runs start at white space")
        self.a = Tokenizer.from_str(byte_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in name)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(regex.search(rf"[^{_STARTS}▁][{_STARTS}▁]|▁[\t\n]", piece) for piece in pieces):
            raise ValueError("a piece reaches over the start of white space")
        single = [self.b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in zip(pieces, single)]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, raw)), np.int64) for raw in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id("▁")
        # of several B ids with the same bytes: a written piece before a byte, then the lowest id
        written = {}
        for i in sorted(range(len(pieces)), key=lambda i: (single[i], i)):
            written.setdefault(self.b_bytes[i], i)
        self.same = np.array([written.get(raw, -1) for raw in self.a_bytes], np.int64)

    def encode(self, texts) -> list:
        """(A ids, B ids) of each text; a text's leading space is the one that B adds."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        left = self.a.encode_batch_fast(texts, add_special_tokens=False)
        spaced = [text.startswith(" ") for text in texts]
        right = self.b.encode([text[1:] if s else text for text, s in zip(texts, spaced)], num_threads=1)
        out = []
        for s, a, b in zip(spaced, left, right):
            if s:
                b = b or [self.space]
            else:
                b = b[1:] if b[:1] == [self.space] else None
            out.append((a.ids, b))
        return out

    def spells(self, a, b, raw) -> bool:
        """Whether both sequences spell the bytes."""
        return b is not None and b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b])


def _ends_well(run) -> bool:
    return "!" <= run[-1] <= "~" or bool(_ENDS_WELL(run))


def _expand(starts, lengths):
    """All indices of ranges, one range after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _distinct(owner, keys, weights):
    """Distinct (owner, key) in order with their summed weights."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])))[: len(keys)]
    return owner[first], keys[first], np.add.reduceat(weights[order], first) if len(first) else weights


def groups_of(a, b, a_sizes, b_sizes):
    """Number of the group of each token, between the byte offsets where tokens of both end, and the offsets."""
    a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    near = np.searchsorted(b_ends, a_ends)
    common = a_ends[b_ends[near] == a_ends]
    return np.searchsorted(common, a_ends), np.searchsorted(common, b_ends), common


def links_of(a, b, a_group, b_group, owner):
    """(owner, key, links): distinct pairs A id << 32 | B id of tokens that share a group, for each group's owner.

    Groups are expanded EXPANDED pairs at a time; ids that come again within a larger group are counted first.
    """
    n_a, n_b = np.bincount(a_group, minlength=len(owner)), np.bincount(b_group, minlength=len(owner))
    if (n_a * n_b > EXPANDED).any():  # a giant group: its distinct ids with their counts
        sides = [_distinct(g, ids, np.ones(len(ids), np.int64)) for g, ids in ((a_group, a), (b_group, b))]
    else:
        sides = [(g, ids, np.ones(len(ids), np.int64)) for g, ids in ((a_group, a), (b_group, b))]
    (a_group, a, a_times), (b_group, b, b_times) = sides
    n_a, n_b = np.bincount(a_group, minlength=len(owner)), np.bincount(b_group, minlength=len(owner))
    b_start = np.cumsum(n_b) - n_b
    width = n_b[a_group]  # each A token meets the B tokens of its group
    parts = np.cumsum(width) // EXPANDED
    found = []
    for part in np.unique(parts):
        own = np.flatnonzero(parts == part)
        left, right = np.repeat(own, width[own]), _expand(b_start[a_group[own]], width[own])
        found.append(_distinct(owner[a_group[left]], a[left] << 32 | b[right], a_times[left] * b_times[right]))
    if len(found) == 1:
        return found[0]
    return _distinct(*(np.concatenate(column) for column in zip(*found))) if found else (a, a, a)


_MARKS = np.array([",", "|", ";", "\n"], object)


def written(a, b, a_group, b_group, owner) -> list:
    """The groups of each owner as `a1,a2|b1;a3|b2,b3`."""
    n_a, n_b = np.bincount(a_group, minlength=len(owner)), np.bincount(b_group, minlength=len(owner))
    places = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[a_group], np.arange(len(b)) + np.cumsum(n_a)[b_group]
    ids, marks = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    ids[places[0]], ids[places[1]] = a, b
    last = np.cumsum(n_a + n_b) - 1
    marks[last - n_b] = 1
    marks[last] = np.where(np.append(owner[1:] != owner[:-1], True), 3, 2)
    told = [""] * (2 * len(ids))
    told[::2], told[1::2] = map(str, ids.tolist()), _MARKS[marks].tolist()
    return "".join(told).split("\n")[:-1]


class Aligner:
    """Aligns texts, remembering runs."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self._forget()

    def _forget(self):
        self.number = {}  # run -> its number, or -1 if a vocabulary does not spell it
        self.texts = []
        self.sizes = np.zeros((1024, 4), np.int64)  # tokens of A and of B, groups, links
        self.starts = np.zeros(1025, np.int64)
        self.keys, self.links = np.zeros(8192, np.int64), np.zeros(8192, np.int64)

    def _learn(self, runs):
        """Encode new runs, joined to pieces as they stand in texts; a run of a piece that is not spelled goes alone."""
        v = self.v
        alone, pieces, size = [], [[]], 0
        for run in runs:
            if not _ends_well(run):
                alone.append(run)
                continue
            if size > PIECE:
                pieces.append([])
                size = 0
            pieces[-1].append(run)
            size += len(run)
        pieces = [piece for piece in pieces if piece]
        for piece, (a, b) in zip(pieces, v.encode(["".join(piece) for piece in pieces])):
            raw = [run.encode() for run in piece]
            if v.spells(a, b, b"".join(raw)):
                self._add(piece, raw, a, b)
            else:
                alone += piece
        for run, (a, b) in zip(alone, v.encode(alone)):
            raw = run.encode()
            if v.spells(a, b, raw):
                self._add([run], [raw], a, b)
            else:
                self.number[run] = -1

    def _add(self, runs, raw, a, b):
        v, at, n = self.v, len(self.texts), len(runs)
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_group, b_group, common = groups_of(a, b, v.a_sizes, v.b_sizes)
        owner = np.searchsorted(np.cumsum([len(r) for r in raw]), common)
        run, keys, links = links_of(a, b, a_group, b_group, owner)
        start = self.starts[at]
        stop = start + len(keys)
        while stop > len(self.keys):
            self.keys, self.links = (np.concatenate([x, np.zeros_like(x)]) for x in (self.keys, self.links))
        while at + n >= len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.keys[start:stop], self.links[start:stop] = keys, links
        self.starts[at + 1 : at + n + 1] = start + np.searchsorted(run, np.arange(n), "right")
        for i, column in enumerate((owner[a_group], owner[b_group], owner)):
            self.sizes[at : at + n, i] = np.bincount(column, minlength=n)
        self.sizes[at : at + n, 3] = np.bincount(owner, np.bincount(a_group) * np.bincount(b_group), n)
        self.texts += written(a, b, a_group, b_group, owner)
        self.number.update(zip(runs, range(at, at + n)))

    def align(self, texts):
        """Sizes (a row for each text), groups texts, and (text, key, links) of the distinct pairs in order."""
        if self.starts[len(self.texts)] > REMEMBERED or len(self.number) > REMEMBERED:
            self._forget()
        runs = [runs_of(" " + text) if text else [] for text in texts]
        new = list({run for one in runs for run in one if run not in self.number})
        if new:
            self._learn(new)
        numbers = [np.fromiter(map(self.number.__getitem__, one), np.int64, len(one)) for one in runs]
        numbers = [n if not len(n) or n.min() >= 0 else n[:0] for n in numbers]
        groups = [";".join([self.texts[i] for i in n.tolist()]) for n in numbers]
        text = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
        used, times = np.unique(text << 32 | np.concatenate([np.empty(0, np.int64), *numbers]), return_counts=True)
        text, run = used >> 32, used & 0xFFFFFFFF
        sizes = np.zeros((len(texts), 4), np.int64)
        np.add.at(sizes, text, self.sizes[run] * times[:, None])
        # all pairs of each text's runs, then one row for each pair
        lengths = self.starts[run + 1] - self.starts[run]
        places = _expand(self.starts[run], lengths)
        weights = self.links[places] * np.repeat(times, lengths)
        return sizes, groups, *_distinct(np.repeat(text, lengths), self.keys[places], weights)


_ALIGNERS = {}


def _aligner(name, files) -> Aligner:
    """One aligner for each pair of vocabularies and Python worker, kept from task to task."""
    if name not in _ALIGNERS:
        _ALIGNERS[name] = Aligner(Vocabularies(*files))
    return _ALIGNERS[name]


def _lists(owner, n, values, kind):
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _together(texts):
    """Ranges of texts of at most TOGETHER characters, one text at least."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        if at > start and size + len(text or "") > TOGETHER:
            yield start, at
            start, size = at, 0
        size += len(text or "")
    if start < len(texts):
        yield start, len(texts)


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row for each row of docs: sizes, digest of the groups, links of regular ids and of other pairs."""
    spark = docs.sparkSession
    with open(byte_path, encoding="utf-8") as byte_file, open(piece_path, "rb") as piece_file:
        files = spark.sparkContext.broadcast((byte_file.read(), piece_file.read()))
    name = (byte_path, piece_path)

    def aligned(batches):
        aligner = _aligner(name, files.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start, stop in _together(texts):
                sizes, groups, owner, keys, links = aligner.align(texts[start:stop])
                regular = aligner.v.same[keys >> 32] == keys & 0xFFFFFFFF
                n, other = stop - start, ~regular
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, n),
                        batch.column(1).slice(start, n),
                        *[pa.array(sizes[:, i]) for i in range(4)],
                        pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
                        _lists(owner[regular], n, keys[regular] >> 32, pa.int32()),
                        _lists(owner[regular], n, links[regular], pa.int64()),
                        _lists(owner[other], n, keys[other], pa.int64()),
                        _lists(owner[other], n, links[other], pa.int64()),
                    ],
                    schema=_ALIGNED,
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(aligned, ALIGNED)


# ---------------------------------------------------------------- counts over the corpus


def _regular_counts(aligned: DataFrame, size: int) -> DataFrame:
    """id, count: documents that hold each regular link, summed in one vector of the vocabulary's length for each task."""

    def count(batches):
        vector = np.zeros(size, np.int64)
        for batch in batches:
            vector += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)  # a document has an id once
        held = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(vector[held])], names=["id", "count"])

    parts = aligned.select("same").mapInArrow(count, "id long, count long")
    return parts.groupBy("id").agg(F.sum("count").alias("count"))


def pair_counts(aligned: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(regular, other): documents of each linked pair, and whether that is the most of its A id.

    regular: id, count, best, at most `size` rows. other: key (A id << 32 | B id), count, best.
    """
    regular = settle(_regular_counts(aligned, size))
    other = settle(aligned.select(F.explode("pairs").alias("key")).groupBy("key").agg(F.count("*").alias("count")))
    owner = F.shiftrightunsigned("key", 32)
    most = regular.unionByName(other.select(owner.alias("id"), "count")).groupBy("id").agg(F.max("count").alias("most"))
    most = settle(most)  # one row for each A id at most

    def marked(counts, own):
        known = most.withColumnRenamed("id", "_id")
        return counts.join(F.broadcast(known), own == F.col("_id")).select(*counts.columns, (F.col("count") == F.col("most")).alias("best"))

    return marked(regular, F.col("id")), settle(marked(other, owner))


def corpus_links(aligned: DataFrame, regular: DataFrame, other: DataFrame, size: int) -> DataFrame:
    """row, n_best, count_sum: links of each document that are the best of their A id, and the counts of all its links."""
    spark = aligned.sparkSession
    counts, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in regular.collect():  # bounded by the vocabulary
        counts[row.id], best[row.id] = row["count"], row.best
    vectors = spark.sparkContext.broadcast((counts, best))

    def look_up(batches):
        counts, best = vectors.value
        for batch in batches:
            ids, links = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy())
            sums = [np.append(0, np.cumsum(links * vector[ids])) for vector in (best, counts)]
            sums = [pa.array(np.diff(total[np.append(0, ends)])) for total in sums]
            yield pa.RecordBatch.from_arrays([batch.column(0), *sums], names=["row", "n_best", "count_sum"])

    first = aligned.select("row", "same", "same_links").mapInArrow(look_up, "row long, n_best long, count_sum long")
    rest = aligned.select("row", F.explode(F.arrays_zip("pairs", "pair_links")).alias("p")).select("row", F.col("p.pairs").alias("key"), "p.pair_links")
    rest = rest.join(other, "key").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("pair_links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("pair_links") * F.col("count")).alias("count_sum"),
    )
    return first.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_corpus(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row for each row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and the groups' digest."""
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(byte_path).get_vocab_size()
    aligned = settle(align(docs, byte_path, piece_path))
    regular, other = pair_counts(aligned, size)
    sums = corpus_links(aligned, regular, other, size)
    return aligned.join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
