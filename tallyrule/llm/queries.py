"""One query per operator over the driver's tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallyrule.llm import (
    decontam,
    fingerprints,
    langid,
    linededup,
    periodic,
    prefixtrie,
    sentencepiece_fst,
    sharding,
    simhash,
    substring,
    topk,
    toxicity,
    urlfilter,
)
from tallyrule.llm.common import held_out

# Host, path and verdict of the listed rules.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
SHARDS, SHARD_SEED = 16, 17


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _sha(column):
    """SHA-256 of the UTF-8 bytes, lower-case hex; of a null, that of the empty text."""
    return F.sha2(F.coalesce(column, F.lit("")).cast("binary"), 256)


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "langs", "shares")


def op2_url_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    rules = spark.createDataFrame(URL_RULES, urlfilter.RULE_SCHEMA)
    return urlfilter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op3_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_products(vectors, F.col("vec_id") % 20 == 0)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    model = sentencepiece_fst.load_model(sentencepiece_fst.tokenizer_path())
    return sentencepiece_fst.round_trip(docs, model).select("doc_id", "ids", "n_ids", "exact")


def op5_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = substring.duplicate_spans(docs)
    return found.select("doc_id", "n_words", "n_removed", _sha(F.col("kept")).alias("kept_sha256"))


def op7_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    items = _table(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontam.find_contamination(docs, items)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        _sha(F.concat_ws(",", "items")).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op8_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.shard_rows(docs, ["doc_id", "size", "text_crc32"], SHARDS, SHARD_SEED)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", _sha(F.col("text")).alias("kept_sha256")
    )


def op10_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    rows = prefixtrie.turn_rows(turns, "conv_id", "turn", "role", "text")
    head = F.crc32(F.col("id").cast("string").cast("binary")) % 9
    return prefixtrie.prefix_trie(*prefixtrie.with_shared_heads(rows, head, F.col("id") - F.col("id") % 5, 8))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = periodic.collapse_runs(docs, edit=periodic.repeat_tail, key="doc_id")
    # greatest length, then smallest start, then smallest period
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.n").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(-1000 * F.col("longest.n") / F.col("longest.p")).cast("long").alias("exponent_milli"),
        _sha(F.array_join(line, "")).alias("runs_sha256"),
        _sha(F.col("text")).alias("collapsed_sha256"),
    )


def op13_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = fingerprints.fingerprint_edits(docs)
    own, edited = F.col("fingerprint"), F.col("edited_fingerprint")
    near = {
        "near_edited": fingerprints.likeness(own, edited),
        "near_next": fingerprints.likeness(own, F.col("next_fingerprint")),
    }
    return (
        found.withColumns(near)
        .withColumns({c: fingerprints.as_text(F.col(c)) for c in ("fingerprint", "edited_fingerprint")})
        .drop("next_fingerprint")
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_mixture,
        op2_url_bloom,
        op3_norm_buckets,
        op4_sentencepiece,
        op5_toxicity_nnpu,
        op6_lempel_ziv,
        op7_suffix_automaton,
        op8_feistel,
        op9_line_runs,
        op10_simhash_blocks,
        op11_prefix_trie,
        op12_periodic_runs,
        op13_multiset_hash,
        pipeline,
    )
}

# The CRC-32 of the digits of ``c``, bit by bit: 3988292384 is the reversed polynomial.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda acc, byte: list_reduce(list_concat([xor(acc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)"""

ORACLE = {
    "op11_prefix_trie": """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL
), s AS (
  SELECT c, count(*) AS n FROM t GROUP BY c
), i AS (
  SELECT c, c - c % 5 AS base, CRC32 % 9 AS h FROM s
), g AS (
  SELECT i.c, base, h, least(h, coalesce(n, 0)) AS m FROM i LEFT JOIN s ON s.c = base
), u AS (
  SELECT g.c, p AS pos, role, text FROM g JOIN t ON t.c = base AND p < h
  UNION ALL
  SELECT g.c, p - h + m, role, text FROM g JOIN t ON t.c = g.c AND p >= h
), q AS (
  SELECT c, list({'r': role, 't': text} ORDER BY pos) AS w FROM u GROUP BY c
), f AS (
  SELECT i.c, coalesce(w, []) AS w, coalesce(len(w), 0) AS n FROM i LEFT JOIN q ON i.c = q.c
), x AS (
  SELECT c, n, d, w[1:d] AS k FROM f, unnest(generate_series(0, n)) AS z(d)
), v AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs,
         string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d) AS ends,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(k[d]['t']) END AS own
  FROM x GROUP BY k, d
), e AS (
  SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM v WHERE d > 0 GROUP BY ALL
), l AS (
  SELECT v.k, v.d, v.own, e.n_children IS NULL AS leaf FROM v LEFT JOIN e ON v.d = e.d AND v.k = e.k
), a AS (
  SELECT l.k[1:y.d] AS k, y.d AS d, sum(own) AS saved, count(*) FILTER (WHERE leaf) AS n_leaves
  FROM l, unnest(generate_series(0, l.d)) AS y(d) GROUP BY ALL
)
SELECT v.conv_id, v.d AS depth, o.conv_id AS parent_conv_id, v.n_convs,
       coalesce(e.n_children, 0) AS n_children, a.n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN a ON v.d = a.d AND v.k = a.k LEFT JOIN e ON v.d = e.d AND v.k = e.k
LEFT JOIN v o ON v.d > 0 AND o.d = v.d - 1 AND o.k = v.k[1:v.d - 1]
""".replace("CRC32", _CRC32),
    "op2_url_bloom": """
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), r(h, q, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT page_id, host, path,
  (SELECT h || q FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
   ORDER BY length(h || q) DESC LIMIT 1) AS rule,
  coalesce((SELECT v FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
   ORDER BY length(h || q) DESC LIMIT 1), 'allow') AS verdict
FROM p
""",
    "op3_norm_buckets": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), k AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM k WHERE r <= 20
""",
    "op6_lempel_ziv": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS seed
  FROM d, unnest(generate_series(1, len(w) - 12)) AS t(i)
), h AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY seed) AS first FROM g) WHERE first < doc_id
), c AS (
  SELECT DISTINCT doc_id, i + k AS i FROM h, unnest(generate_series(0, 12)) AS t(k)
), gone AS (
  SELECT doc_id, list(i) AS cut FROM c GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, len(w) AS n, coalesce(len(cut), 0) AS m,
         CASE WHEN cut IS NULL THEN w
              ELSE list_transform(list_filter(list_zip(w, generate_series(1, len(w))), lambda z: NOT list_contains(cut, z[2])), lambda z: z[1])
         END AS left_
  FROM d LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(m AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(left_, ' '), '')) AS kept_sha256
FROM kept
""",
    "op9_line_runs": r"""
WITH l AS (
  SELECT doc_id, i, x AS line,
         translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
), k AS (
  SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT l.*, k.key IS NOT NULL AND doc_id <> last AS gone FROM l LEFT JOIN k ON l.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op7_suffix_automaton": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), v AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
  FROM b, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS t(i) WHERE len(w) > 0
), g AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT n FROM v), unnest(generate_series(1, len(w) - n + 1)) AS t(i)
), h AS (
  SELECT doc_id, i, g.n, item_id FROM g JOIN v ON g.n = v.n AND g.gram = v.gram
), c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM h, unnest(generate_series(0, n - 1)) AS t(k) GROUP BY doc_id
), m AS (
  SELECT doc_id, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM h GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
""",
}
