"""Small helpers for expressions over arrays within a row."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the characters that make a word
WORD = r"[^\x20\x09-\x0D]+"


def bind(value: Column, function) -> Column:
    """function(value) with the value computed once, as a variable of the expression."""
    return F.element_at(F.transform(F.array(value), function), 1)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def finds(text: Column, pattern: str) -> Column:
    """Matches as array<struct<s, e, hit, before>>: code points, end exclusive, and the text since the last match.

    Splitting at the pattern gives the gaps between its matches, whose lengths give the places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    nothing = F.array().cast("array<struct<s:int,e:int,hit:string,before:string>>")
    start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))

    def step(state, pair):
        s = state["at"] + F.char_length(pair["gap"])
        e = s + F.char_length(pair["hit"])
        found = F.struct(s.alias("s"), e.alias("e"), pair["hit"].alias("hit"), F.right(pair["gap"], F.lit(24)).alias("before"))
        return F.struct(e.alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

    pairs = F.zip_with(hits, gaps, lambda hit, gap: F.struct(hit.alias("hit"), gap.alias("gap")))
    matched = F.filter(pairs, lambda pair: pair["hit"].isNotNull())  # the last gap has no match
    return F.aggregate(matched, start, step, lambda state: state["out"])
