import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "a", "don't we'll I'M 'sam", "<|endoftext|>", "x<|startoftext|>y<|endoftext|><|endoftext|>", "<|endoftext",
    "ΑΣ ΣΑΣ", "İstanbul", "é é ñ ß ẞ", "́ x́", "a\x1cb \x1f\x1e c\x85d\xa0e f　g", "１２３ ½ ² Ⅷ ٣",
    "日本語テキスト", "🙂🙂 👩‍👩‍👧", "!!!???###", "x" * 5000, "1" * 3000, "ab" * 2000 + "!" * 999, "​zero﻿width",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_counts_are_the_librarys(library):
    count = tokens.Counter(tokens.read_merges(PATH)).count
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEÉéñüß0123456789 \n\t.,'!?-_<|>#$"
    texts = ODD + ["".join(draw.choices(letters, k=draw.randint(1, 200))) for _ in range(1500)]
    for text in texts:
        assert count(text) == expected(library, text), text


def test_bounded_memory(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    count = tokens.Counter(tokens.read_merges(PATH)).count
    text = "one two three four five six seven one two " * 3
    assert count(text) == expected(library, text)


def test_column(spark, library):
    rows = [(i, text, "kept") for i, text in enumerate(ODD)] + [(0, None, "again")]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_tokens string")
    counted = df.withColumn("n", tokens.token_counter(spark, PATH)(F.col("text"))).collect()
    assert len(counted) == len(rows)
    assert all(r.n == expected(library, r.text) and r.n_tokens for r in counted)
    empty = df.where("false").withColumn("n", tokens.token_counter(spark, PATH)(F.col("text")))
    assert empty.count() == 0


def test_refuses_other_files():
    with pytest.raises((ValueError, KeyError, TypeError)):
        tokens.read_merges(public_tokenizers.path("byte_bpe_50k.json"))
