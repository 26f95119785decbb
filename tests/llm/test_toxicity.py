import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import toxicity


def corpus(n, seed):
    draw = random.Random(seed)
    calm, vile = [f"w{i}" for i in range(150)], ["idiot", "trash", "scum", "vile"]
    texts, labels = [], []
    for i in range(n):
        words = draw.choices(calm, k=draw.randint(5, 150))
        if i % 3 == 0:
            for word in draw.sample(vile, 2):
                words.insert(draw.randint(0, len(words)), word)
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_held_out_accuracy_and_column(spark):
    network = toxicity.train(*corpus(500, 1), rounds=4)
    texts, labels = corpus(300, 2)
    scores = toxicity.Scorer(network).scores(texts)
    assert np.mean([(s >= 0.5) == bool(t) for s, t in zip(scores, labels)]) > 0.95
    rows = [(1, None, "x"), (2, "", "x"), (3, "w1 " * 30_000 + "idiot scum", "x"), (4, "w1 " * 50, "x"), (4, "w1 " * 50, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = df.withColumn("s", toxicity.scorer(spark, network)(F.col("text"))).collect()
    assert [r.doc_id for r in found] == [1, 2, 3, 4, 4] and all(0 <= r.s <= 1 for r in found)
    assert found[2].s > 0.5 > found[3].s == found[4].s


def test_learns_from_other_rows_only(spark):
    ids = spark.range(500).select("id", toxicity.held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in ids)
    docs = spark.createDataFrame([(i, "some words") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, None) for i in range(50)], "doc_id long, toxic int")
    fresh = toxicity.Scorer(toxicity.Network()).scores(["some words"])
    assert toxicity.Scorer(toxicity.fit(docs, labels)).scores(["some words"]) == fresh


def test_slopes_are_those_of_differences():
    draw = np.random.default_rng(1)
    network = toxicity.Network()
    x = draw.standard_normal((2, 4, 6 * toxicity.HIDDEN)).astype(np.float32)
    mask, error = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], np.float32), np.array([0.7, -1.3], np.float32)
    _, d_x = network.gradients(x, mask, error, network.forward(x, mask, keep=True))
    for n, t, k in [(0, 0, 1), (0, 3, 20), (1, 1, 30), (1, 0, 47)]:
        moved, back = x.copy(), x.copy()
        moved[n, t, k] += 1e-2
        back[n, t, k] -= 1e-2
        slope = ((network.forward(moved, mask) - network.forward(back, mask)) * error).sum() / 2e-2
        assert abs(slope - d_x[n, t, k]) < 2e-3


def test_long_words_are_read_whole():
    calm = "-".join(f"w{i % 150}" for i in range(200))
    for place in (0, 30, 300, len(calm)):
        joined = calm[:place] + "-idiot-trash-scum-vile-" + calm[place:]
        grams = {g for step in toxicity.steps_of(joined) for g in toxicity.features(step)[1]}
        for word in ("idiot", "trash", "scum", "vile"):
            assert set(toxicity.features(word)[1][1:-1]) <= grams
        assert max(map(len, toxicity.steps_of(joined))) <= toxicity.PIECE
    network = toxicity.train(*corpus(500, 1), rounds=4)
    clean, toxic = toxicity.Scorer(network).scores([calm, calm + "-" + "-".join(["idiot", "trash", "scum", "vile"] * 8)])
    assert toxic > 0.5 > clean
    assert toxicity.steps_of("a b\n" + "c" * 40) == ["a", "b", "c" * 40] and toxicity.steps_of(None) == []


def test_trigrams_are_hashed_once_and_words_of_many_texts_looked_up_together(monkeypatch):
    calls = []
    digest = toxicity.xxhash.xxh32_intdigest

    class Counted:
        @staticmethod
        def xxh32_intdigest(*given):
            calls.append(given)
            return digest(*given)

    texts = [f"word{n} another{n % 7} word{n + 1}" for n in range(400)] + [None, ""]
    network = toxicity.Network()
    alone = [toxicity.Scorer(network).scores([text])[0] for text in texts]
    monkeypatch.setattr(toxicity, "xxhash", Counted)
    together = toxicity.Scorer(network).scores(texts)
    assert np.allclose(together, alone, atol=1e-6, rtol=0)
    words = {w for text in texts for w in toxicity.steps_of(text)}
    trigrams = {f"<{w}>"[i : i + 3] for w in words for i in range(len(w))}
    assert len(calls) <= len(words) + len(trigrams)


def test_scoring_looks_words_up_as_bytes_and_goes_step_by_step_with_the_results_of_training():
    odd = "<a> Ünïcode, É\x1cx a\xa0b  . ... 日本語テキスト \U0001f600! x idiot's İstanbul \x85 " + "long-" * 30
    assert [w.decode() for w in toxicity.bytes_of(odd)] == toxicity.steps_of(odd)
    assert [w.decode() for w in toxicity.bytes_of("a\x1cb\x85 \x0b\x0c c\xa0d\r\n")] == ["a\x1cb\x85", "c\xa0d"]
    assert toxicity.bytes_of(None) == toxicity.bytes_of("") == []
    network, words = toxicity.Network(), toxicity.steps_of(odd) * 2 + [f"w{i}" for i in range(5000)]
    rows = network.inputs_of_words(words)
    assert np.allclose(rows, network.inputs([toxicity.features(w) for w in words]), atol=1e-6, rtol=0)
    draw = np.random.default_rng(3)
    pieces = sorted([draw.integers(len(rows), size=n) for n in (0, 0, 1, 5, 48, 48, 17, 30)], key=len)
    for some in (pieces, pieces[:2], pieces[-2:]):
        ids, mask = toxicity.padded(some)
        assert np.allclose(network.logits(rows, some), network.forward(rows[ids], mask), atol=1e-5, rtol=0)
