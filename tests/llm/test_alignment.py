import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillroll.llm import alignment
from tillroll.llm.tokens import byte_symbols

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a\r\nb \r", "tab\tx\t\t y", "<|endoftext|> <s></s><unk>", "x▁y", "▁",
    "\xa0\n", "s▁\n", "a​ b　c\x85 d", "日本語テキスト 日本", "🙂🙂 👩‍👩‍👧", "don't we'll", "=" * 200, "x" * 5000, "é é", "\x00 \x1c a", "ab" * 3000,
    "1" * 3000, "٣٤ ½", "end \n", "(){};\r\nreturn;",
]


class Plain:
    """Both libraries on whole texts, and groups by walking the offsets."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
        byte_of = {s: i for i, s in enumerate(byte_symbols())}
        self.a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in self.a.get_vocab().items()}
        size = self.b.get_piece_size()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(size))]

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(self.a_bytes[i] for i in a) != raw or b"".join(self.b_bytes[i] for i in b) != raw:
            return []
        cuts, sides = [], []
        for ids, spelled in ((a, self.a_bytes), (b, self.b_bytes)):
            at, ends = 0, []
            for i in ids:
                at += len(spelled[i])
                ends.append(at)
            cuts.append(set(ends))
            sides.append(list(zip(ids, ends)))
        out, before = [], 0
        for cut in sorted(cuts[0] & cuts[1]):
            out.append([[i for i, end in side if before < end <= cut] for side in sides])
            before = cut
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def told(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def brute(plain, rows):
    grouped = [(doc_id, plain.groups(text)) for doc_id, text in rows]
    linked = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in grouped]
    counts = Counter(pair for links in linked for pair in links)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (doc_id, groups), links in zip(grouped, linked):
        sizes = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()))
        best = sum(n for pair, n in links.items() if counts[pair] == most[pair[0]])
        digest = hashlib.sha256(told(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, *sizes, best, sum(n * counts[p] for p, n in links.items()), digest))
    return sorted(out, key=str)


def test_groups_are_those_of_the_whole_text(plain):
    aligner = alignment.Aligner(alignment.Vocabularies(open(BYTE, encoding="utf-8").read(), open(PIECE, "rb").read()))
    draw = random.Random(7)
    letters = "ab é日本\n\n  \t\r\x0b\x0c\x1c\x85\xa0 ​　﻿▁'sté1٣.,!;)🙂́\x00"
    texts = [t for t in ODD if t is None or len(t) < 300] + ["".join(draw.choices(letters, k=draw.randint(1, 14))) for _ in range(3000)]
    assert aligner.align(texts)[1] == [told(plain.groups(t)) for t in texts]


def test_runs_lose_nothing():
    draw = random.Random(8)
    for _ in range(3000):
        text = "".join(draw.choices("a \n\t\r\xa0▁​", k=draw.randint(0, 12)))
        assert "".join(alignment.runs_of(text)) == text


def test_corpus(spark, plain):
    draw = random.Random(9)
    vocabulary = ["the", "of", "thonre", "Éa", "日本", "x1", "can't", "=====", "qwrtzp"]
    rows = list(enumerate(ODD)) + [(i, " ".join(draw.choices(vocabulary, k=draw.randint(1, 60)))) for i in range(100, 160)]
    rows += [(100, "again of"), (None, "of the"), (7, "of the"), (7, "of the")]
    df = spark.createDataFrame([(i, t, "x", 1.5) for i, t in rows], "doc_id long, text string, pairs string, row double").repartition(3)
    found = alignment.align_corpus(df, BYTE, PIECE)
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute(plain, rows)


def test_empty_table(spark):
    assert alignment.align_corpus(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).count() == 0


def test_bounded_memory(plain, monkeypatch):
    for name, value in (("EXPANDED", 3), ("REMEMBERED", 5), ("PIECE", 4)):
        monkeypatch.setattr(alignment, name, value)
    aligner = alignment.Aligner(alignment.Vocabularies(open(BYTE, encoding="utf-8").read(), open(PIECE, "rb").read()))
    texts = ["===== " * 9 + "日本語テキスト", "thonre qwrtzp thonre", "=" * 77]
    for _ in range(2):
        sizes, groups, owner, keys, links = aligner.align(texts)
        for i, text in enumerate(texts):
            expected = Counter(x << 32 | y for a, b in plain.groups(text) for x in a for y in b)
            assert dict(zip(keys[owner == i].tolist(), links[owner == i].tolist())) == expected
            assert sizes[i][3] == sum(expected.values())
