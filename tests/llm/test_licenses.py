import random
import re

import pytest
from pyspark.sql import functions as F

from tillroll.llm import licenses

NAMES = [("a b", "ab"), ("b c a", "bca"), ("c", "c")]
TEMPLATES = [("one", "a b c a b d a c b a"), ("two", "d c b a a b c"), ("three", "b b b b a b")]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def stands(run, sequences):
    return any(run == s[i : i + len(run)] for s in sequences for i in range(len(s)))


def longest(text, sequences):
    out = []
    for end in range(1, len(text) + 1):
        out.append(next(n for n in range(end, -1, -1) if n == 0 or stands(text[end - n : end], sequences)))
    return out


def brute_spans(text, sequences, long, gap, share):
    """Best chains over all maximal matches, without windows."""
    stats = longest(text, [s for _, s in sequences])
    matches = [(e, n) for e, n in enumerate(stats) if n >= long and (e + 1 == len(stats) or stats[e + 1] <= n)]
    best = {}
    for t, (label, s) in enumerate(sequences):
        ends = []
        for e, n in matches:
            run = text[e - n + 1 : e + 1]
            for q in range(n - 1, len(s)):
                if s[q - n + 1 : q + 1] == run:
                    covered = n
                    for e2, q2, c2 in ends:
                        if e2 < e and q2 < q and e - n - e2 <= gap:
                            covered = max(covered, c2 + min(n, e - e2, q - q2))
                    ends.append((e, q, covered))
        top = max((c for _, _, c in ends), default=0)
        if top >= share * len(s):
            best[label] = max(best.get(label, 0), top / len(s))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_statistics_names_and_spans_equal_brute_force(seed):
    draw = random.Random(seed)
    built = licenses.automaton(TEMPLATES, NAMES)
    sequences = [(label, phrase.split()) for phrase, label in NAMES] + [(label, t.split()) for label, t in TEMPLATES]
    for _ in range(150):
        text = draw.choices("abcdx", [5, 5, 4, 3, draw.choice([0, 1])], k=draw.randint(0, 60))
        ids = [built.vocabulary.get(w.encode(), -1) for w in text]
        assert [n for _, n in licenses.matching_statistics(built, ids)] == longest(text, [s for _, s in sequences])
        found = licenses.scan(built, " ".join(text).encode(), long=3, gap=2, share=0.5)
        places = sorted((i, label) for phrase, label in NAMES for i in range(len(text)) if text[i : i + len(phrase.split())] == phrase.split())
        assert [(p["word"], p["label"]) for p in found["places"]] == places
        spans = {}
        for span in found["spans"]:
            spans[span["label"]] = max(spans.get(span["label"], 0), span["covered"])
        own = [s if n >= len(NAMES) else (s[0], []) for n, s in enumerate(sequences)]
        expected = brute_spans(text, sequences, 3, 2, 0.5)
        assert spans == {k: v for k, v in expected.items() if k in {label for label, s in own if s}}


def test_words():
    text = "MIT-License_v2.0 Ünï İ\x85x　日本 a1B2"
    assert [w.decode() for w in licenses.words_of(text)] == words(text)


def labels(spark, texts):
    df = spark.createDataFrame([(i, t, "kept", 7) for i, t in enumerate(texts)], "doc_id long, text string, found string, n_words int")
    scan = licenses.scanner(spark, licenses.automaton())
    return df.select("doc_id", scan(F.col("text")).alias("f")).select("doc_id", *licenses.summary(F.col("f"))).orderBy("doc_id").collect()


def test_licences_in_texts(spark):
    mit = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 300)
    isc = next(t for label, t in licenses.TEMPLATES if label == "isc").split()
    changed = " ".join(w if i % 9 else "word" for i, w in enumerate(isc))  # matches of 8 words with gaps
    texts = [
        None, "", "  \n", "no licence here at all", "The MIT License. mit\nLICENSE, apache: license",
        "x " * 50 + mit + " y" * 50, changed, "y " * 30_000 + "GNU General Public License", mit + " " + mit, "mit license " * 500,
        "Permission is hereby granted to go", mit,
    ]
    found = labels(spark, texts)
    assert [tuple(r)[1:] for r in found[:3]] == [(0, 0, None, None, "", "", 0.0)] * 3
    assert found[3].labels == "" and found[3].n_words == 5
    assert (found[4].n_base, found[4].first_word, found[4].last_word, found[4].base_labels) == (3, 1, 5, "apache,mit")
    assert found[5].labels == "mit" and found[5].base_labels == "" and found[5].score == 1.0
    assert found[6].labels == "isc" and 0.6 <= found[6].score < 1
    assert (found[7].first_word, found[7].n_words, found[7].labels) == (30_001, 30_004, "gpl")
    assert found[8].labels == "mit" and found[9].n_base == 500 and found[10].labels == ""
    assert tuple(found[11])[5:] == tuple(found[8])[5:]


def test_empty_table_and_template_without_words(spark):
    assert labels(spark, []) == []
    with pytest.raises(ValueError):
        licenses.automaton([("x", " - ")], [])


def test_spans_cover_the_licence(spark):
    mit = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 300)
    found = licenses.scan(licenses.automaton(), ("foreign words here " + mit + " foreign tail").encode())
    span = next(s for s in found["spans"] if s["covered"] == 1.0)
    assert (span["first"], span["last"]) == (3, 2 + len(words(mit)))
