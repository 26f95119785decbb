from pyspark.sql import functions as F

from tillroll.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string"


def water_fill(sizes, most=3.0):
    """Targets by resharing in rounds, written plainly."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in above)
        open_ -= above
    return target


def rows():
    found = []
    for i in range(300):
        source = ["big", "b", "c", None, "tiny"][0 if i % 3 else min(i // 60, 4)]
        found.append((i, source, " ".join(["w"] * (i % 17)), "x"))
    return found + [(5, "b", None, "x"), (6, "tiny", "", None), (6, "tiny", "", None), (None, "c", "a\x0b b c", "x")]


def test_targets_and_taken(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    data = rows()
    mixed = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(mixed) == len(data)
    sizes = {}
    for _, source, text, _ in data:
        sizes[source] = sizes.get(source, 0) + len([w for w in (text or "").replace("\x0b", " ").split(" ") if w])
    want = water_fill(sizes)
    for source in sizes:
        mine = [r for r in mixed if r.source == source]
        assert all(r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - want[source]) <= 1
        assert all(r.taken <= 3 * r["size"] for r in mine)
    assert all((r.position is None) == (r.taken == 0) for r in mixed)
    assert all(0 <= r.position <= 1 for r in mixed if r.taken)


def test_reruns_agree_and_order(spark):
    df = spark.createDataFrame(rows(), SCHEMA).drop("size")
    first = mixing.mix_sizes(df)
    again = mixing.mix_sizes(df.repartition(7))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    positions = [r.position for r in mixing.in_training_order(first).collect()]
    assert positions == sorted(positions)


def test_schedule_is_inverted(spark):
    for slope in (-2.0, -0.5, 0.0, 1.0, 2.0):
        share = 0.3
        t = spark.range(1).select(mixing.time_of(F.lit(share), F.lit(slope))).first()[0]
        assert abs(t + slope * (t * t - t) / 2 - share) < 1e-9


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_round_has_a_position(spark):
    """A source mixed at three times its size is met along the whole schedule; all taken words are placed."""
    data = [(i, ["big", "small"][i % 20 == 0], "w " * (3 + i % 5), "x") for i in range(400)] + [(7, "big", "", "x"), (8, "small", None, "x")]
    mixed = mixing.mix(spark.createDataFrame(data, SCHEMA).drop("size"), weights=(1, 9), slopes=(0.0, 0.0)).cache()
    docs = {r.doc_id: r for r in mixed.where("taken > 0").collect()}
    occurrences = mixing.in_training_order(mixed).collect()
    assert [r.position for r in occurrences] == sorted(r.position for r in occurrences)
    assert sum(r.words for r in occurrences) == sum(r.taken for r in docs.values())
    assert all(0 < r.words <= r["size"] for r in occurrences)
    small = [r for r in occurrences if r.source == "small"]
    assert len(small) == 60 and len({(r.doc_id, r["round"]) for r in small}) == 60
    for k in range(3):
        assert all(k / 3 < r.position < (k + 1) / 3 for r in small if r["round"] == k)
    for source in ("big", "small"):  # with a flat schedule the words before a position are its share of the target
        done = 0
        for r in [r for r in occurrences if r.source == source]:
            assert abs(r.position - (done + r.words / 2) / r.target) < 1e-9
            done += r.words
    assert all(r.position == r.positions[0] for r in docs.values())


def test_rows_keep_all_their_columns(spark):
    """Repeated rows, nulls in different columns, and names that the mix uses itself."""
    data = [(1, "s", "a b", None), (1, "s", "a b", None), (1, "s", None, "a b"), (1, None, "a b", "s"), (2, "s", "a b", "x")]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string, position string").repartition(3)
    mixed = mixing.mix(docs)
    assert sorted([(r.doc_id, r.source, r.text) for r in mixed.collect()], key=str) == sorted([d[:3] for d in data], key=str)
    assert dict(mixed.dtypes)["position"] == "double"
