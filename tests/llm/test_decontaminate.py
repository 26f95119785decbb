import random

from tillroll.llm import decontaminate as d

SCHEMA = "doc_id long, text string, item_ids string"


def items(draw, n=60):
    vocabulary = [f"w{i}" for i in range(300)]
    made = []
    for i in range(n):
        words = draw.choices(vocabulary, k=draw.randint(4, 40))
        half = len(words) // 2
        made.append((i, " ".join(words[:half]) + draw.choice(["? ", ". ", " "]) + " ".join(words[half:])))
    return made


def test_wand_finds_all_items_above_the_threshold():
    draw = random.Random(3)
    index = d.Index(items(draw))
    for _ in range(400):
        terms = {w for w in draw.sample(sorted(index.postings), draw.randint(1, 80))}
        if draw.random() < 0.5:
            item = draw.choice(index.items)
            terms |= set(item[1] + item[2])
        for threshold in (0.2, 0.6, 0.95):
            score = {}
            for t in terms:
                for place, share in zip(*index.postings[t]):
                    score[place] = score.get(place, 0) + share
            want = sorted(p for p, s in score.items() if s >= threshold - 1e-9)
            assert sorted(index.retrieve(terms, threshold)) == want


def test_planted_items_are_found_and_clean_rows_left(spark):
    draw = random.Random(8)
    made = items(draw)
    rows, want = [(0, None, "x"), (1, "", "x"), (2, "short", "x")], {}
    for i in range(3, 120):
        words = [f"x{draw.randrange(4000)}" for _ in range(draw.randint(0, 900))]
        if i % 3 == 0:
            item = draw.choice(made)
            words.insert(draw.randint(0, len(words)), item[1])
            want[i] = [item[0]]
        rows.append((i, " ".join(words), "x"))
    rows.append((500, " ".join(f"x{i % 3000}" for i in range(40_000)) + " " + made[5][1], "x"))
    want[500] = [5]
    bench = spark.createDataFrame([*made, (900, None), (901, " .")], "item_id long, text string")
    found = d.find_leaks(spark.createDataFrame(rows, SCHEMA), bench).collect()
    assert {r.doc_id: list(r.leaked_items) for r in found if r.leaked_items} == want
    none = d.find_leaks(spark.createDataFrame(rows[:5], SCHEMA), bench.where("false")).collect()
    assert all(list(r.leaked_items) == [] for r in none) and len(none) == 5
    assert d.find_leaks(spark.createDataFrame([], SCHEMA), bench).count() == 0


def test_changed_and_cut_copies_are_found(spark):
    """Prose without a question mark is one part, whatever its last sentence; question and answer stay two."""
    body = [f"a{i}" for i in range(40)]
    asked = [f"q{i}" for i in range(20)]
    bench = [
        (1, " ".join(body[:20]) + ". " + " ".join(body[20:36]) + ". " + " ".join(body[36:]) + "."),
        (2, " ".join(asked) + "? yes indeed"), (3, "Whither, o splendid ship, thy white sails crowding?"),
    ]
    rows, want = [], {}
    for k in range(40):
        rows.append((k, " ".join([*body[:k], "changed", *body[k + 1 :]]), "x"))
        want[k] = [1]
    rows += [(50, " ".join(body[:36]), "x"), (51, " ".join(body[:24]), "x"), (52, " ".join(asked), "x")]
    rows += [(53, " ".join(asked) + " yes indeed", "x"), (54, "o splendid ship thy white sails crowding", "x")]
    want |= {50: [1], 53: [2], 54: [3]}
    found = d.find_leaks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {r.doc_id: list(r.leaked_items) for r in found if r.leaked_items} == want


def test_only_passages_that_may_hold_an_item_are_searched():
    """The sums of ranges bound the scores: no passage with an item above the threshold is left out, few others come."""
    draw = random.Random(4)
    made = items(draw)
    index = d.Index(made)
    size = max(32, 2 * index.longest)
    vocabulary = sorted(index.postings) + [f"x{i}" for i in range(600)]
    searched = passages = 0
    for _ in range(40):
        words = draw.choices(vocabulary, k=draw.randint(1, 700))
        if draw.random() < 0.6:
            item = draw.choice(index.items)
            at = draw.randint(0, len(words))
            words[at:at] = item[1] + item[2]
        near = dict(index.passages(words))
        for at in range(0, max(1, len(words) - size // 2), size // 2):
            terms = {w for w in words[at : at + size] if w in index.postings}
            passages += 1
            searched += at in near
            assert near.get(at, terms) == terms
            if index.retrieve(terms):
                assert at in near
    assert searched < passages / 2


def test_blocks_repeated_items_and_items_without_an_id(spark):
    draw = random.Random(11)
    made = [(i, t) for i, t in items(draw, 40)]
    bench = spark.createDataFrame([*made, made[3], (None, made[4][1]), (77, made[3][1])], "item_id long, text string")
    rows = [(i, " ".join(["other"] * (i % 7)) + " " + made[i % 40][1] + " tail", "x") for i in range(80)] + [(None, made[3][1], "x")] * 2
    docs = spark.createDataFrame(rows, SCHEMA)

    def leaks(**sizes):
        found = d.find_leaks(docs, bench, **sizes)
        assert found.columns == [*docs.columns, "leaked_items"]
        return sorted([(r.doc_id, tuple(r.leaked_items)) for r in found.collect()], key=str)

    whole = leaks()
    assert whole == leaks(block_items=15) == leaks(block_bytes=2000)
    by_id = dict(whole)
    assert by_id[3] == (3, 3, 77) == by_id[None] and by_id[4] == (4, None)


def test_blocks_do_not_change_a_score():
    draw = random.Random(12)
    made = items(draw, 30)
    whole = d.Index(made)
    known = d.Statistics.of([q + a for _, q, a in whole.items])
    parts = [d.Index(made[:11], known), d.Index(made[11:], known)]
    for _ in range(200):
        terms = set(draw.sample(sorted(whole.postings), 60))
        found = [{p.items[i][0] for i in p.retrieve({t for t in terms if t in p.postings}, 0.3)} for p in parts]
        assert {whole.items[i][0] for i in whole.retrieve(terms, 0.3)} == found[0] | found[1]
