"""Token counts of a byte-pair vocabulary, by merging with a heap and a linked list.

A word starts as one symbol per byte (the last one marked as the end of its word). The adjacent
pair of lowest rank is popped from a heap again and again and becomes one symbol; the linked list
keeps the neighbours. The count is the number of initial symbols minus the merges done, so no
identifiers are made.

Rules of the vocabulary file that are honoured: canonical composition, white space and lower
case as its normalizer asks, the split pattern of its pre-tokenizer, and special strings, which
count as one token each wherever they stand in a text (the library's default). Null and empty
texts have 0 tokens. Rows, other columns and repeated rows pass through untouched.
"""

import heapq
import json
import unicodedata
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.llm.arrow import over_texts

#: Words remembered by a Python worker; the memory is emptied when full, so it stays bounded.
REMEMBERED = 400_000

# fixed values: the characters that the vocabulary's patterns count as white space
WHITE = r"\t-\r \x85\xa0  -     　"


def byte_symbols():
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    symbols, free = [], 256
    for byte in range(256):
        symbols.append(chr(byte) if byte in printable else chr(free))
        free += byte not in printable
    return symbols


@dataclass
class Merges:
    """What counting needs of a vocabulary file; small enough to travel with the function."""

    pairs: dict  # (left id << 32 | right id) -> (rank << 32 | merged id)
    inner: list  # id of each byte inside a word, -1 if the vocabulary lacks it
    last: list  # id of each byte at the end of a word
    pattern: str
    special: list
    key: str = field(default="")


def read_merges(path: str) -> Merges:
    """Read a byte-pair file of the tokenizers library.

    Raises ValueError for settings that this operator does not express.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, steps = spec["model"], spec["normalizer"]["normalizers"]
    split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
    known = (
        model["type"] == "BPE"
        and not (model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"))
        and not (spec["truncation"] or spec["padding"])
        and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": "\\s+"}
        and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
        and (byte_level["type"], byte_level["use_regex"]) == ("ByteLevel", False)
        and not byte_level["add_prefix_space"]
        and all(t["special"] and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    )
    if not known:
        raise ValueError(f"{path}: not a word-level byte-pair file this operator can count")
    vocabulary, end = model["vocab"], model.get("end_of_word_suffix") or ""
    pairs = {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        pairs[vocabulary[left] << 32 | vocabulary[right]] = rank << 32 | vocabulary[left + right]
    symbols = byte_symbols()
    return Merges(
        pairs,
        [vocabulary.get(s, -1) for s in symbols],
        [vocabulary.get(s + end, -1) for s in symbols],
        split["pattern"]["Regex"],
        [t["content"] for t in spec["added_tokens"]],
        path,
    )


def merged_length(symbols: list, pairs: dict) -> int:
    """Initial symbols minus merges of one word."""
    size = len(symbols)
    if size < 2:
        return size
    heap = []
    for at in range(size - 1):
        found = pairs.get(symbols[at] << 32 | symbols[at + 1])
        if found is not None:
            heap.append((found, at))
    if not heap:
        return size
    heapq.heapify(heap)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    left = size
    while heap:
        merge, at = heapq.heappop(heap)
        follower = after[at]
        if follower >= size or symbols[at] < 0 or pairs.get(symbols[at] << 32 | symbols[follower]) != merge:
            continue  # one of its two symbols has been merged meanwhile
        symbols[at] = merge & 0xFFFFFFFF
        symbols[follower] = -1
        left -= 1
        after[at] = following = after[follower]
        if following < size:
            before[following] = at
            found = pairs.get(symbols[at] << 32 | symbols[following])
            if found is not None:
                heapq.heappush(heap, (found, at))
        previous = before[at]
        if previous >= 0:
            found = pairs.get(symbols[previous] << 32 | symbols[at])
            if found is not None:
                heapq.heappush(heap, (found, previous))
    return left


def lower(text: str) -> str:
    """Lower case of each character by itself, as the vocabulary's normalizer has it."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class Pieces(dict):
    """Tokens of each pre-token, remembered."""

    def __init__(self, merges):
        super().__init__()
        self.pairs, self.inner, self.last = merges.pairs, merges.inner, merges.last

    def __missing__(self, piece):
        if len(self) >= REMEMBERED:
            self.clear()
        raw = piece.encode()
        symbols = [self.inner[b] for b in raw[:-1]]
        symbols.append(self.last[raw[-1]])
        if -1 in symbols:
            symbols = [s for s in symbols if s >= 0]
        self[piece] = n = merged_length(symbols, self.pairs)
        return n


class Counter(dict):
    """Tokens of each run of characters without white space, remembered.

    No pre-token crosses white space, and neither composition nor lower case look across it,
    so a text's count is the sum over these runs.
    """

    def __init__(self, merges):
        super().__init__()
        self.pieces = Pieces(merges)
        self.find = regex.compile(merges.pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None
        self.runs = regex.compile(f"[^{WHITE}]+").findall
        self.odd = regex.compile("[\x1c-\x1f]").search

    def plain(self, run):
        run = run if run.isascii() else unicodedata.normalize("NFC", run)
        return sum(map(self.pieces.__getitem__, self.find(lower(run))))

    def __missing__(self, run):
        if len(self) >= REMEMBERED:
            self.clear()
        if self.special and self.special.search(run):
            parts = self.special.split(run)
            n = len(parts) - 1 + sum(map(self.plain, parts))
        else:
            n = self.plain(run)
        if len(run) <= 64:  # long runs hardly come again
            self[run] = n
        return n

    def count(self, text):
        if not text:
            return 0
        # str.split() also splits at four control characters that the patterns keep
        runs = self.runs(text) if self.odd(text) else text.split()
        return sum(map(self.__getitem__, runs))


_COUNTERS = {}


def counter(merges: Merges) -> Counter:
    """One counter for each vocabulary and Python worker, kept from task to task."""
    if merges.key not in _COUNTERS:
        _COUNTERS[merges.key] = Counter(merges)
    return _COUNTERS[merges.key]


def token_counter(spark, path: str):
    """A function from a text column to its number of tokens (long)."""
    shared = spark.sparkContext.broadcast(read_merges(path))

    def prepare():
        count = counter(shared.value).count
        return lambda texts: [count(text) for text in texts]

    return over_texts("long", pa.int64(), prepare)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
