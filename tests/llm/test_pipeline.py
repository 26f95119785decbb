import corpus_pipeline as pipeline
from tillroll.llm import pii, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "The river that crosses the old town flows north in winter. It ends in the sea of amber stones."


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_stages_decide(spark, tmp_path):
    base = words(60, "a")
    rows = [
        (1, base, "en", "s1", 0), (2, base + " tail", "en", "s2", 0), (2, base + " tail", "en", "s2", 0), (3, words(40, "c") + " " + ITEM, "en", "s1", 0),
        (4, "mail me at a@b.com or a@b.com@c.org " + words(30, "d"), "en", None, 0), (5, None, None, "s3", None), (6, "", "en", "s3", 0),
    ]
    labels = [(i, 1, 1 if i % 2 else 0) for i in range(100, 200)]
    rows += [(i, words(30, f"t{i}x") + (" vile idiot trash " if i % 2 else " ") + words(20, f"u{i}x"), "en", "s2", 0) for i in range(100, 200)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(7, ITEM), (8, None), (9, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    unique = pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in unique) == [1, 3, 4, 5, 6, *range(100, 200)]
    clean = pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path)).collect()
    assert len(clean) == len(rows) - 1 and 3 not in {r.doc_id for r in clean}
    masked = {r.doc_id: r for r in pipeline.mask_personal_data(spark, docs, str(tmp_path)).collect()}
    assert masked[4].text.startswith("mail me at [email] or [email]@c.org ") and masked[5].text is None
    assert masked[4].n_chars == len(masked[4].text)
    final = pipeline.run(spark, str(tmp_path))
    ids = {r.doc_id for r in final.collect()}
    assert 3 not in ids and 2 not in ids and 4 in ids
    assert len([i for i in ids if i >= 100 and i % 2]) <= 10 and len([i for i in ids if i >= 100 and not i % 2]) >= 40
    assert set(pipeline.COLUMNS) <= set(final.columns)


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    assert pii.mask(empty).columns == empty.columns


def test_near_duplicates_are_chosen_by_row(spark):
    """Ids that repeat with other texts, null ids with near texts, rows equal in all columns, a very long text."""
    base = words(60, "a")
    rows = [
        (4, base, "en", None, 1), (None, base + " more", "en", "s", 1), (None, base, "en", "s", 1), (4, words(50, "b"), "en", "s", 1),
        (4, words(50, "b"), "en", "s", 1), (3, words(50, "b") + " end", "en", "s", 1), (None, None, "en", None, None), (None, None, "en", None, None),
        (9, words(30_000, "c"), "en", "s", 1), (8, words(30_000, "c") + " tail", "en", "s", 1), (7, "", None, None, 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted([(r.doc_id, len(r.text or "")) for r in kept.collect()], key=str) == sorted(
        [(4, len(base)), (3, len(rows[5][1])), (None, 0), (8, len(rows[9][1])), (7, 0)], key=str
    )


def test_fitting_in_a_task_gives_the_same_network(spark):
    rows = [(i, words(20, f"t{i}x") + (" vile idiot" if i % 2 else " kind"), "en", "s", 0) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, SCHEMA)
    one, other = toxicity.fit(docs, labels), toxicity.fit_in_task(docs, labels)
    assert all((one.p[name] == other.p[name]).all() for name in one.p)
