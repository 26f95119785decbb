"""Personal data in texts: base patterns, and further spans by weak supervision.

Candidates are everything that looks like an address or a number, well-formed or not. Four
labelers vote on each: the pattern's own check, a gazetteer of prefixes and domains, words in
front of it, and its shape. Expectation-maximisation estimates, per kind, how often each labeler
votes for true and for false candidates; the posteriors train a logistic span classifier. Both
need only counts per (kind, votes), a table of at most 80 rows. Candidates that the classifier
accepts and that touch no base span of their kind are added; base spans stay.

All positions are code points, ends exclusive. Null and empty texts have no spans. Repeated rows
each get their result. An empty table gives no rows.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.native import finds
from tillroll.session import settle

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("regex", "gazetteer", "context", "shape")
#: Probability from which the classifier adds a candidate.
ACCEPT = 0.9
ROUNDS = 50

# The guards (start of a run, or end of the last match) change no match; they keep long runs linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
CARD = r"[0-9][0-9\x20-]+"  # after separators without a following digit are masked
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
NATIONAL = r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

# fixed values: endings of common domains, first digits of card numbers, words before personal data
DOMAINS = r"(?i)\.(com|org|net|edu|gov|io|info|de|fr|es|uk|eu)$"
CARD_STARTS = r"^[3-6]"
BEFORE = {
    "email": r"(?i)(mail|contact|write|reach)",
    "ip": r"(?i)(\bip\b|host|address|server|login)",
    "card": r"(?i)(card|visa|master|amex|pay)",
    "phone": r"(?i)(call|phone|tel|fax|mobile|contact)",
}


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes; digits count from the right, every second one doubled."""

    def step(total, i):
        digit = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(number)), F.lit(0), step) % 10 == 0


def between(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value <= high)


def _votes(kind: str, m: Column) -> dict:
    hit, size = m["hit"], F.char_length(digits(m["hit"]))
    if kind == "email":
        return {"regex": F.lit(True), "gazetteer": hit.rlike(DOMAINS), "shape": hit.rlike("^[A-Za-z0-9]")}
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return {"regex": hit.rlike(rf"^{part}\.{part}\.{part}\.{part}$"), "gazetteer": ~hit.rlike("^0"), "shape": size >= 7}
    if kind == "card":
        good = F.when(between(size, 12, 19), luhn(digits(hit))).otherwise(False)
        return {"regex": good, "gazetteer": hit.rlike(CARD_STARTS), "shape": between(size, 15, 16)}
    if kind == "phone":
        return {"regex": between(size, 9, 15), "gazetteer": hit.rlike(r"^\+[1-9]"), "shape": between(size, 10, 13)}
    return {"regex": F.lit(False), "gazetteer": digits(hit).rlike("^[2-9]..[2-9]"), "shape": hit.rlike(r"^(\([0-9]{3}\) |[0-9]{3}-)[0-9]{3}-")}


def _candidates(text: Column, kind: str, pattern: str, place: int, rule: str, possible=None) -> Column:
    found = finds(text, pattern)
    if possible is not None:
        found = F.filter(found, possible)

    def one(m):
        votes = _votes(rule, m) | {"context": m["before"].rlike(BEFORE[kind])}
        return F.struct(
            m["s"].alias("s"), F.lit(place).alias("kind"), m["e"].alias("e"), votes["regex"].alias("base"),
            *[votes[name].cast("int").alias(name) for name in LABELERS],
        )

    return F.transform(found, one)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the sorted candidate spans of each row."""
    return docs.select("doc_id", candidates_of(F.col("text")).alias("found"))


def candidates_of(text: Column) -> Column:
    """The sorted candidate spans of a text."""

    def long_enough(m):
        return F.char_length(digits(m["hit"])) >= 9

    text = F.coalesce(text, F.lit(""))
    found = F.concat(
        _candidates(text, "email", EMAIL, 0, "email"),
        _candidates(text, "ip", IP, 1, "ip"),
        _candidates(F.regexp_replace(text, r"[\x20-](?![0-9])", "_"), "card", CARD, 2, "card", long_enough),
        _candidates(text, "phone", PHONE, 3, "phone"),
        _candidates(text, "phone", NATIONAL, 3, "national"),
    )
    return F.sort_array(found)


def reliabilities(patterns: list) -> list:
    """Posteriors of vote patterns [(votes, count)] by expectation-maximisation of a two-class model."""
    if not patterns:
        return []
    n = len(patterns[0][0])
    prior, hit, miss = 0.5, [0.8] * n, [0.2] * n
    total = sum(count for _, count in patterns)
    posterior = []
    for _ in range(ROUNDS):
        posterior = []
        for votes, _ in patterns:
            yes, no = prior, 1 - prior
            for v, h, m in zip(votes, hit, miss):
                yes *= h if v else 1 - h
                no *= m if v else 1 - m
            posterior.append(yes / (yes + no))
        weight = sum(p * c for p, (_, c) in zip(posterior, patterns))
        prior = (weight + 1) / (total + 2)
        for i in range(n):  # a pseudo-count keeps each labeler better than chance at the start
            on = sum(p * c for p, (v, c) in zip(posterior, patterns) if v[i])
            off = sum((1 - p) * c for p, (v, c) in zip(posterior, patterns) if v[i])
            hit[i] = (on + 0.8) / (weight + 1)
            miss[i] = (off + 0.2) / (total - weight + 1)
    return posterior


def train_classifier(patterns: list, posterior: list, steps: int = 500, rate: float = 0.5) -> list:
    """Weights (one per labeler, then the constant) of a logistic model that follows the posteriors."""
    if not patterns:
        return []
    weights = [0.0] * (len(patterns[0][0]) + 1)
    total = sum(c for _, c in patterns)
    for _ in range(steps):
        slope = [0.0] * len(weights)
        for (votes, count), target in zip(patterns, posterior):
            x = [*votes, 1]
            error = count / total * (1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, x)))) - target)
            slope = [s + error * v for s, v in zip(slope, x)]
        weights = [w - rate * s for w, s in zip(weights, slope)]
    return weights


def classifiers(found: DataFrame) -> dict:
    """Weights for each kind, from counts of vote patterns over all candidates."""
    each = found.select(F.explode("found").alias("c")).groupBy("c.kind", *[f"c.{name}" for name in LABELERS]).count()
    patterns = {}
    for row in each.collect():  # at most 4 kinds times 16 patterns
        patterns.setdefault(row["kind"], []).append((tuple(row[name] for name in LABELERS), row["count"]))
    learned = {}
    for kind, rows in patterns.items():
        rows.sort()
        learned[kind] = train_classifier(rows, reliabilities(rows))
    return learned


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of s, kind, e; base spans, and with the added ones) of each row."""
    return _decided(settle(candidates(docs)))


def _decided(found: DataFrame) -> DataFrame:
    learned = classifiers(found)

    def accepted(c):
        value = F.lit(False)
        for kind, weights in learned.items():
            score = F.lit(weights[-1])
            for name, weight in zip(LABELERS, weights):
                score = score + c[name] * weight
            value = F.when(c["kind"] == kind, score >= math.log(ACCEPT / (1 - ACCEPT))).otherwise(value)
        return value

    def span(c):
        return F.struct(c["s"].alias("s"), c["kind"].alias("kind"), c["e"].alias("e"))

    rows = found.withColumn("base", F.transform(F.filter("found", lambda c: c["base"]), span))

    def free(c):
        return ~F.exists("base", lambda b: (b["kind"] == c["kind"]) & (b["s"] < c["e"]) & (c["s"] < b["e"]))

    added = F.transform(F.filter("found", lambda c: ~c["base"] & accepted(c) & free(c)), span)
    return rows.withColumn("spans", F.sort_array(F.array_distinct(F.concat("base", added)))).drop("found")


def mask(docs: DataFrame) -> DataFrame:
    """docs with each span replaced by its kind in brackets; overlapping spans become one mask.

    All columns and rows stay; a null text stays null.
    """
    rows = settle(docs.select(F.struct(*docs.columns).alias("row"), candidates_of(F.col("text")).alias("found")))
    rows = _decided(rows)
    names = F.array(*[F.lit(f"[{kind}]") for kind in KINDS])
    text = F.col("row.text")

    def step(state, c):
        before = F.substring(text, state["at"] + 1, F.greatest(F.lit(0), c["s"] - state["at"]))
        fresh = c["s"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], F.array(before, F.get(names, c["kind"])))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], c["e"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    end = F.lit(2**31 - 1)
    masked = F.aggregate("spans", start, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, end)))
    changed = F.when(F.size("spans") > 0, masked).otherwise(text)
    return rows.select("row", changed.alias("_masked")).select(
        *[F.col("_masked").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    )


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["s"], c["e"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda c: c["kind"] == KINDS.index(kind))).cast("long")
