"""Quality rules: base measures of a text and a learned decision list over them.

Sequential covering learns rules that reject: each grows by the threshold condition with the best
information gain on the growing half of the labelled rows, is pruned to the prefix that is most
precise on the other half, and stays if it is precise enough. Rows that it covers leave before
the next rule. All statistics are counts per (feature, bin), a small table whatever the number of
rows. The list becomes one ordered conditional expression.

Null and empty texts have no words and fail the base rule. Rows with repeated labels use the
smallest; without labels the list is empty and rejects nothing. Repeated rows each get a result.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.native import WORD, bind, words_of
from tillroll.session import settle

#: Least share of low-quality rows among those a rule covers, and the least number it covers, per half.
PRECISION, COVERED = 0.95, 5
MOST_RULES, MOST_CONDITIONS, BINS = 6, 3, 16


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, the first included."""

    def windows(w):
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )

    def again(s):
        same = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda j: (F.get(s, j)["h"] == F.get(s, j - 1)["h"]) | (F.get(s, j)["h"] == F.get(s, j + 1)["h"]),
        )
        places = F.transform(same, lambda j: bind(F.get(s, j)["i"], lambda i: F.array(i, i + 1, i + 2)))
        return F.size(F.array_distinct(F.flatten(places)))

    counted = bind(words, lambda w: bind(F.sort_array(windows(w)), again))
    return F.when(F.size(words) >= 4, counted).otherwise(0).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the base measures of each row, with base_failed and the features of the list."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    bare = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    columns = docs.select("doc_id", text.alias("text")).select("doc_id", "text", words_of(F.col("text")).alias("words"))
    columns = columns.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(bare).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        bind(lines, F.size).alias("n_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.regexp_count("text", F.lit(r"[0-9]")).alias("n_digits"),
        F.regexp_count("text", F.lit(r"[!?.,;:]")).alias("n_marks"),
        bind(F.col("words"), lambda w: F.size(F.array_distinct(w))).alias("n_distinct"),
    )
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    features = {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / chars,
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "digits": F.col("n_digits") / chars,
        "marks": F.col("n_marks") / words,
        "distinct": F.col("n_distinct") / words,
    }
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return columns.select(*base, failed.alias("base_failed"), F.struct(*[v.alias(k) for k, v in features.items()]).alias("f"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(f"f.{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold


def holds(rule) -> Column:
    found = F.lit(True)
    for condition in rule:
        found = found & condition.column()
    return found


def _best(rows, cuts, bad, good):
    """The condition of highest gain from counts per (feature, bin); rows: feature, bin, bad, good."""
    before, found = math.log2((bad + 1) / (bad + good + 2)), (0.0, None)
    for feature, thresholds in cuts.items():
        counts = {r.bin: (r.bad, r.good) for r in rows if r.feature == feature}
        for i, threshold in enumerate(thresholds):
            low = [sum(c[k] for b, c in counts.items() if b <= i) for k in (0, 1)]
            for above, (p, n) in ((False, low), (True, [bad - low[0], good - low[1]])):
                gain = p * (math.log2((p + 1) / (p + n + 2)) - before)
                if p >= COVERED and gain > found[0] + 1e-9:
                    found = (gain, Condition(feature, above, threshold))
    return found[1]


def learn_rules(labelled: DataFrame) -> list:
    """The decision list for rows with f (features) and bad (boolean); each rule is a list of conditions."""
    names = labelled.schema["f"].dataType.names
    probabilities = [(i + 1) / BINS for i in range(BINS - 1)]
    quantiles = labelled.agg(*[F.percentile_approx(f"f.{n}", probabilities, 10_000).alias(n) for n in names]).first()
    cuts = {n: sorted(set(quantiles[n] or [])) for n in names}
    if not any(cuts.values()):
        return []
    binned = F.array(
        *[
            F.struct(
                F.lit(n).alias("feature"),
                sum([F.when(F.col(f"f.{n}") > cut, 1).otherwise(0) for cut in cuts[n]], F.lit(0)).alias("bin"),
            )
            for n in names
        ]
    )
    labelled = settle(labelled.select("f", "bad", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("grow"), binned.alias("bins")))
    rules, rest = [], labelled
    while len(rules) < MOST_RULES:
        rule, growing = [], rest.where("grow")
        while len(rule) < MOST_CONDITIONS:
            covered = growing.where(holds(rule))
            rows = covered.select("bad", F.explode("bins").alias("b")).groupBy("b.feature", "b.bin")
            rows = rows.agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
            first = [r for r in rows if r.feature == names[0]]
            bad, good = sum(r.bad for r in first), sum(r.good for r in first)
            condition = _best(rows, cuts, bad, good) if bad and good else None
            if condition is None:
                break
            rule.append(condition)
        if not rule:
            break
        prefixes = [rule[: i + 1] for i in range(len(rule))]
        counts = rest.where("NOT grow").agg(
            *[F.count_if(holds(p) & F.col("bad")).alias(f"bad{i}") for i, p in enumerate(prefixes)],
            *[F.count_if(holds(p)).alias(f"all{i}") for i, p in enumerate(prefixes)],
        ).first()
        best = max(range(len(prefixes)), key=lambda i: ((counts[f"bad{i}"] + 1) / (counts[f"all{i}"] + 2), -i))
        if counts[f"bad{best}"] < COVERED or counts[f"bad{best}"] < PRECISION * counts[f"all{best}"]:
            break
        rules.append(prefixes[best])
        rest = rest.where(~holds(prefixes[best]))
    return rules


def verdict(rules) -> Column:
    """The list as an ordered conditional: the first rule that holds rejects."""
    if not rules:
        return F.lit(True)
    found = F.when(holds(rules[0]), False)
    for rule in rules[1:]:
        found = found.when(holds(rule), False)
    return found.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base measures, base_failed and kept of each row of docs; labels: doc_id, quality (0 is low)."""
    measured = settle(measure(docs))
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    rules = learn_rules(measured.where("NOT base_failed").join(known, "doc_id"))
    return measured.withColumn("kept", ~F.col("base_failed") & verdict(rules)).drop("f")
