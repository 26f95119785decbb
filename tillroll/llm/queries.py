"""The corpus queries, each over its whole table, and the SQL where SQL can express them."""

import public_tokenizers
from pyspark.sql import functions as F

from tillroll.llm import (
    alignment,
    chat,
    decontaminate,
    html,
    licenses,
    merkle,
    minhash,
    mixing,
    pii,
    quality,
    tokens,
    toxicity,
    warc,
)
from tillroll.session import new_path

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_token_counts")
def token_counts(spark, sf_dir, vocabulary="word_bpe_49k.json", limit=2048):
    count = tokens.token_counter(spark, public_tokenizers.path(vocabulary))
    counted = table(spark, sf_dir, "documents").select(
        "doc_id", tokens.text_bytes(F.col("text")).alias("n_bytes"), count(F.col("text")).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


CHAT_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), walked AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), '') AS before FROM said
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(length(regexp_replace(role || text, '[\\<>]', 'xx', 'g')) + 16)::BIGINT AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN before = '' WHEN 'user' THEN before IN ('', 'system', 'assistant')
           WHEN 'assistant' THEN before = 'user' ELSE false END) AS valid
FROM walked GROUP BY conv_id
"""


@query("op10_chat_format", CHAT_SQL)
def chat_format(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.read_conversations(chat.format_conversations(rows))


@query("op4_source_mix")
def source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    placed = mixing.mix_sizes(docs)
    return placed.select("doc_id", "size", "source_size", "target", "taken", "position", "positions").orderBy("position", "doc_id")


WARC_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
spelled AS (  -- base 32: five hexadecimal digits are four letters
  SELECT *, list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INTEGER + 1, 1) FOR k IN range(0, 32)],
    'string_agg', '') AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS first_id
  FROM payloads)
SELECT page_id, strlen(payload) AS payload_bytes, payload_digest,
  CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM spelled
"""


@query("op1_warc_round_trip", WARC_SQL)
def warc_round_trip(spark, sf_dir, min_bytes=0):
    path = new_path(spark, "settled") + ".warc.gz.d"
    warc.write_archive(warc.plan_records(table(spark, sf_dir, "pages"), min_bytes), path)
    records = warc.read_archive(spark, path, damaged="raise")
    return records.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op9_minhash_groups")
def minhash_groups(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_quality_rules")
def quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_personal_data")
def personal_data(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.counted(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    digest = F.sha2(pii.written(F.col("base")), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


@query("op6_toxicity")
def toxicity_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    score = toxicity.scorer(spark, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op7_benchmark_leaks")
def benchmark_leaks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    leaked = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return leaked.select("doc_id", F.col("leaked_items").alias("item_ids"), (F.size("leaked_items") > 0).alias("contaminated"))


@query("op5_main_text")
def main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    extract = html.extractor(spark, html.fit(pages))
    found = pages.select("page_id", "url", extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op13_license_scan")
def license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", licenses.scanner(spark, licenses.automaton())(F.col("text")).alias("found"))
    return found.select("doc_id", *licenses.summary(F.col("found")))


MERKLE_SQL = """
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    list_reduce(list_concat([4294967295::BIGINT], [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))) AS inverted_crc
  FROM documents
), leaves AS (
  SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN inverted_crc & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS altered,
    dense_rank() OVER (ORDER BY source COLLATE "C" NULLS FIRST) - 1 AS tree
  FROM hashed
), placed AS (
  SELECT *, sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS other,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, i, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1
  GROUP BY tree, level, i // 3, n
), subroots AS (
  SELECT tree, max(level) AS height, arg_max(digest, level) AS subroot FROM nodes GROUP BY tree
), tops AS (
  SELECT 0 AS level, tree AS i, (SELECT count(*) FROM subroots) AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 3, n
), runs AS (
  SELECT tree, level, i // 3 AS run, list(digest ORDER BY i) AS members FROM nodes WHERE n > 1 GROUP BY tree, level, i // 3
), top_runs AS (
  SELECT level, i // 3 AS run, list(digest ORDER BY i) AS members FROM tops WHERE n > 1 GROUP BY level, i // 3
), steps AS (
  SELECT tree, i, level, (i // power(3, level)::BIGINT) AS spot FROM placed JOIN subroots USING (tree), range(0, 40) r(level) WHERE level < height
), path AS (
  SELECT s.tree, s.i, s.level, s.spot % 3 AS place, members FROM steps s JOIN runs r ON r.tree = s.tree AND r.level = s.level AND r.run = s.spot // 3
  UNION ALL
  SELECT p.tree, p.i, 100 + r.level, (p.tree // power(3, r.level)::BIGINT) % 3, members
  FROM placed p JOIN top_runs r ON r.run = p.tree // power(3, r.level + 1)::BIGINT
), proofs AS (
  SELECT tree, i, list(struct_pack(place := place, members := members) ORDER BY level) AS steps,
    string_agg(list_aggregate(list_concat(members[1:place], members[place + 2:]), 'string_agg', ''), '' ORDER BY level) AS siblings
  FROM path GROUP BY tree, i
), folds AS (
  SELECT p.tree, p.i, 1 AS step, p.other AS digest, coalesce(f.steps, []) AS steps FROM placed p LEFT JOIN proofs f USING (tree, i)
  UNION ALL
  SELECT tree, i, step + 1, sha256(list_aggregate(list_concat(steps[step].members[1:steps[step].place], [digest], steps[step].members[steps[step].place + 2:]), 'string_agg', '')), steps
  FROM folds WHERE step <= len(steps)
), ends AS (
  SELECT tree, i, arg_max(digest, step) AS folded_root FROM folds GROUP BY tree, i
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (tree) JOIN ends USING (tree, i) LEFT JOIN proofs USING (tree, i)
CROSS JOIN (SELECT arg_max(digest, level) AS root FROM tops)
"""


@query("op11_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    text = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    kept = merkle.manifest(docs, presented=merkle.leaf_hash(text=text))
    folded = kept.withColumn("folded_root", merkle.folded(F.col("presented"), F.col("path")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op12_token_alignment")
def token_alignment(spark, sf_dir, byte_level="byte_bpe_50k.json", pieces="piece_bpe_32k.model"):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align_corpus(docs, public_tokenizers.path(byte_level), public_tokenizers.path(pieces))
