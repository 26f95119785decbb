import hashlib
import random
import re

from pyspark.sql import functions as F

from tillroll.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m.group()):
                found.append((m.start(), place, m.end()))
    return sorted(found)


def texts():
    draw = random.Random(4)
    parts = ["a@b.c", "_d@e.f", "x@@y.z", "a@b@c.d", ".", "..", "1.2.3.4", "256.1.1.1", "001.2.3.4.5", "4111 1111 1111 1111", "4111-1111-11111111",
             "1 -2", "12  34", "+1 (487) 555-7209", "+49.30.1234567", "+", "-", " ", "é🙂", "\n", "79927398713", "0", "007", "(487) 555-7209", "call "]
    made = ["".join(draw.choices(parts, k=draw.randint(1, 14))) for _ in range(600)]
    return made + [None, "", "9" * 20_000, "a" * 20_000, "1 2-" * 5_000, "mail a@b.com " * 300, "call 487-555-7209, tel (487) 555-7209"]


def test_base_is_that_of_plain_patterns(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    rows.append(rows[3])
    df = spark.createDataFrame(rows, "doc_id long, text string, base string").repartition(8)
    found = pii.find_personal_data(df).withColumn("written", pii.written(F.col("base"))).collect()
    assert len(found) == len(rows)
    by_id = dict((r[0], r[1]) for r in rows)
    for row in found:
        base = [tuple(s) for s in row.base]
        assert base == brute(by_id[row.doc_id]), by_id[row.doc_id]
        assert set(base) <= {tuple(s) for s in row.spans}
        assert row.written == ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)


def test_learned_reliabilities_recover_planted_ones():
    draw = random.Random(1)
    rates = [(0.95, 0.1), (0.8, 0.2), (0.7, 0.1), (0.9, 0.3)]
    counts = {}
    for _ in range(20_000):
        truth = draw.random() < 0.4
        votes = tuple(int(draw.random() < (hit if truth else miss)) for hit, miss in rates)
        counts[votes] = counts.get(votes, 0) + 1
    patterns = sorted(counts.items())
    posterior = dict(zip([v for v, _ in patterns], pii.reliabilities(patterns)))
    assert posterior[1, 1, 1, 1] > 0.99 and posterior[0, 0, 0, 0] < 0.01
    weights = pii.train_classifier(patterns, [posterior[v] for v, _ in patterns])
    assert all(w > 0 for w in weights[:-1]) and weights[0] == max(weights)


def test_empty(spark):
    assert pii.find_personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]
