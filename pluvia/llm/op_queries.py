"""The registered queries: each runs its operator over whole tables and derives the columns asked for."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm import decontamination, line_dedup, lm_scoring, packing, quality_classifier, quality_rules, secrets, simhash, spelling, substring_dedup, toxicity, warc, whitening
from pluvia.llm.common import bucket, map_batches, raw_texts, table
from pluvia.llm.labelled import FOLDS
from pluvia.llm.registry import checked_by, register

LINES_SQL = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
), k AS (
    SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l
), hot AS (
    SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE doc_id <> top) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE top IS NULL OR doc_id = top), '')) AS kept_sha256
FROM k LEFT JOIN hot USING (key) GROUP BY doc_id
"""


@checked_by(LINES_SQL)
def op7_line_dedup(spark, sf_dir) -> DataFrame:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            done = [line_dedup.kept_text(t, b) for t, b in zip(raw_texts(batch), batch["bitmap"].to_pylist(), strict=True)]
            yield {
                "doc_id": batch["doc_id"],
                "n_lines": [n for _, n, _ in done],
                "n_dropped": [d for _, _, d in done],
                "kept_sha256": [hashlib.sha256(t).hexdigest() for t, _, _ in done],
            }

    kept = line_dedup.with_bitmaps(table(spark, sf_dir, "documents"))
    return map_batches(kept, digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


@register
def op5_quality_classifier(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, forest).select(
        "doc_id",
        (bucket("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


@register
def op9_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, models).select(
        "doc_id",
        (bucket("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@register
def op3_quality_rules(spark, sf_dir) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op10_best_fit_packing(spark, sf_dir) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op4_simhash_near_dedup(spark, sf_dir) -> DataFrame:
    return simhash.fingerprint_components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@register
def op8_benchmark_decontamination(spark, sf_dir) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op6_substring_dedup(spark, sf_dir) -> DataFrame:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = zip(raw_texts(batch), batch["first"].to_pylist(), batch["spans"].to_pylist(), strict=True)
            done = [substring_dedup.kept_words(*r) for r in rows]
            yield {
                "doc_id": batch["doc_id"],
                "n_words": [n for _, n in done],
                "n_removed": [n - len(w) for w, n in done],
                "kept_sha256": [hashlib.sha256(b" ".join(w)).hexdigest() for w, _ in done],
            }

    found = substring_dedup.with_repeats(table(spark, sf_dir, "documents"))
    return map_batches(found, digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


@register
def op1_secret_scans(spark, sf_dir) -> DataFrame:
    of = lambda kind: F.filter("found", lambda x: x["kind"] == kind)
    base = F.filter("found", lambda x: x["kind"] != "random")
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return secrets.with_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        F.size(of("random")).cast("long").alias("n_random"),
    )


@register
def op2_lm_scoring(spark, sf_dir) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


PAGES_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     q AS (SELECT *, octet_length(encode(html)) AS size, max(page_id) OVER same AS top,
                  row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place
           FROM p WINDOW same AS (PARTITION BY html)),
     r AS (SELECT *, size >= 1000 AND place > 1 AS again FROM q)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to
FROM r
"""


@checked_by(PAGES_SQL)
def op12_warc(spark, sf_dir) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"
    )


@register
def op13_embedding_whitening(spark, sf_dir) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op11_spelling_variants(spark, sf_dir) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
