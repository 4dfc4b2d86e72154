"""The operators as queries over the test tables, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (exact_dedup, exact_search, filter_audit, fingerprints, language, licenses, mixing, near_dedup,
               sentencepiece_codec, spelling, suffix_dedup, token_counts, warc_audit)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the vocabulary files of public tokenizers lie on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    """Register ``fn(spark, folder)`` under its own name."""
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


@query()
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(mixing.mix_sql())
def op2_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every document by its number of copies, sources flattened by the square root of their size."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", F.col("_copy").alias("copy"))


@query()
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = licenses.scan(docs, licenses.fit(docs), keep=["doc_id"])
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["family"]))), ",")
    return found.select("doc_id", "n_paragraphs", F.size("matches").alias("n_matches"), families.alias("families"), "matches")


@query()
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", language.held_out())
    model = language.fit(docs.filter("not held_out"))
    return language.identify(docs, model, keep=["doc_id", "held_out"])


@query()
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    classes = near_dedup.near_classes(table(spark, folder, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "class_size", "n_links", "kept")


@query()
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_codec.encoded_digests(
        table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"])


@query("""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


@query("""
WITH bodies AS (
  SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS b,
    CASE WHEN page_id % 101 = 7 THEN NULL
      WHEN page_id % 97 = 5 THEN substr(coalesce(html, ''), 1, length(coalesce(html, '')) // 2) ELSE coalesce(html, '') END AS r,
    coalesce(page_id % 89 = 3 AND page_id % 97 <> 5, false) AS moved
  FROM pages),
records AS (
  SELECT page_id, 'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:md5:' || md5(u || ' ' || b) || '>' || e
    || 'WARC-Target-URI: ' || u || e || 'Content-Type: text/html' || e || 'Content-Length: ' || strlen(b)::varchar || e || e || b || e || e AS w,
    r IS NULL AS lost, r <> b AS cut, moved FROM bodies, (SELECT chr(13) || chr(10) AS e)),
digests AS (SELECT page_id, strlen(w) AS n_bytes, sha256(w) AS digest, lost, cut, moved FROM records),
ordered AS (SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, digest) - 1 AS leaf FROM digests),
placed AS (
  SELECT *, leaf // 4096 AS file, coalesce(sum(n_bytes) OVER (
    PARTITION BY leaf // 4096 ORDER BY leaf ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS offset FROM ordered),
ranges AS (
  SELECT file, "offset" >> 16 AS part, sha256(string_agg(
    concat_ws(':', file, "offset", n_bytes, digest), ',' ORDER BY "offset")) AS hash FROM placed GROUP BY ALL),
wide AS (
  SELECT file, part >> 8 AS part, sha256(string_agg(concat_ws(':', file, part, hash), ',' ORDER BY part)) AS hash FROM ranges GROUP BY ALL),
files AS (SELECT file, sha256(string_agg(concat_ws(':', file, part, hash), ',' ORDER BY part)) AS file_sha256 FROM wide GROUP BY file),
gone AS (
  SELECT leaf, digest, row_number() OVER (PARTITION BY digest ORDER BY file::varchar, "offset") AS nth FROM placed WHERE lost OR moved),
fresh AS (
  SELECT digest, file + 1000000 AS moved_file, "offset" AS moved_offset,
    row_number() OVER (PARTITION BY digest ORDER BY (file + 1000000)::varchar, "offset") AS nth FROM placed WHERE moved AND NOT lost)
SELECT page_id, n_bytes, p.digest AS record_sha256, p.file, p."offset", file_sha256, moved_file, moved_offset,
  CASE WHEN g.leaf IS NOT NULL THEN CASE WHEN moved_file IS NULL THEN 'missing' ELSE 'moved' END
    WHEN cut THEN 'changed' ELSE 'ok' END AS status
FROM placed p JOIN files USING (file) LEFT JOIN gone g ON g.leaf = p.leaf
LEFT JOIN fresh f ON f.digest = g.digest AND f.nth = g.nth""")
def op8_warc_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as WARC records beside a replica in which one page of 97 is cut in half, one of 101 is lost and one of 89 lies in
    another file; each with its place and the hash of its file's node."""
    body = F.coalesce("html", F.lit(""))
    damaged = (F.when(F.col("page_id") % 101 == 7, F.lit(None))
               .when(F.col("page_id") % 97 == 5, F.expr("substring(coalesce(html, ''), 1, int(length(coalesce(html, '')) div 2))"))
               .otherwise(body))
    records = warc_audit.stored(warc_audit.archive(table(spark, folder, "pages"), replica_body=damaged), "warc-records")
    elsewhere = (F.col("id") % 89 == 3) & (F.col("id") % 97 != 5)
    replica = records.filter("replica_digest is not null").select(
        F.when(elsewhere, F.col("file") + 1_000_000).otherwise(F.col("file")).alias("file"), "offset",
        F.col("replica_bytes").alias("n_bytes"), F.col("replica_digest").alias("digest"))
    levels = warc_audit.tree(records)
    files = levels[3].select(F.col("file").cast("long").alias("file"), F.col("hash").alias("file_sha256"))
    return warc_audit.audit(records, replica, levels).join(files, "file", "left").select(
        F.col("id").alias("page_id"), "n_bytes", F.col("digest").alias("record_sha256"), "file", "offset", "file_sha256",
        "moved_file", "moved_offset", "status")


@query()
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = token_counts.read_ranks(tokenizer_file("byte_bpe_50k.tiktoken"))
    return token_counts.count_tokens(table(spark, folder, "documents"), pieces, keep=["doc_id"])


@query(fingerprints.edited_sql())
def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


@query("""
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 10""")
def op11_exact_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    found = exact_search.search(vectors, vectors.filter("vec_id % 100 = 0"))
    return found.withColumnRenamed("id", "vec_id")


@query(filter_audit.audit_sql())
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove, part by part, in all 120 orders."""
    counts = filter_audit.masks(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return filter_audit.audit(counts)


@query(spelling.variants_sql())
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))
