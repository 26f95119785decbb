import random
import re

from tillroll.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    again = {i + k for found in windows.values() if len(found) > 1 for i in found for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), failed


def texts():
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)] + ["#", "<b>", "é🙂", "1%"]
    made = []
    for i in range(200):
        words = draw.choices(vocabulary[: draw.choice([3, 10, 44])], k=draw.randint(0, 120))
        made.append("".join(w + draw.choice([" ", " ", "\n", "\t\x0b ", "\r\n", "\n\n"]) for w in words))
    return made + [None, "", " \n ", "a", "a b c", "a a a a", "same\nsame\nsame ", "x" * 50_000, "long text here " * 10_000]


def test_measures_are_those_of_brute_force(spark):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts())]
    rows.append(rows[5])
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, f string").repartition(8)
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.judge(df, none).collect()
    assert len(found) == len(rows)
    for r in found:
        want = brute(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert r.kept == (not r.base_failed)


def test_rules_find_planted_junk(spark):
    draw = random.Random(7)
    rows, labels = [], []
    for i in range(400):
        junk = i % 5 == 0
        words = [f"w{draw.randrange(5000)}" + ("#|" if junk and draw.random() < 0.5 else "") for _ in range(draw.randint(60, 90))]
        rows.append((i, " ".join(words)))
        if i % 10 < 9:
            labels.append((i, None if i == 3 else 0 if junk else 1))
    labels += labels[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert sum(kept[i] == (i % 5 != 0) for i in kept) >= 396


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert quality.judge(none, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_low_rows_of_the_real_tables_are_rejected(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    judged = quality.judge(docs, labels).where("NOT base_failed").join(labels.where("quality IS NOT NULL"), "doc_id")
    found = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert found == {(0, False): 291, (1, True): 3243}
