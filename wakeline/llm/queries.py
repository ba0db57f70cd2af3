"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import (byte_net, collocations, embeddings, licenses, line_alignment, minmax, mixing, packing, periods, quality, secrets, suffixes,
                          token_matrices)
from wakeline.llm.store import keep


def _tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_documents(spark, sf_dir), _tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_documents(spark, sf_dir)).drop("detections")


def line_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_alignment.shared_blocks(_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "partners", "blocks", F.sha2(F.encode(F.coalesce("clean_text", F.lit("")), "UTF-8"), 256)
                        .alias("kept_sha256"))


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def matrices_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keep(token_matrices.token_matrices(_documents(spark, sf_dir), _tokenizer()), "token-matrices")
    return rows.select("sequence_id", "n_tokens", F.length("ids").alias("n_bytes"), F.crc32("ids").alias("ids_crc32"),
                       "cu_seqlens", "position_resets", "doc_ids", "doc_starts")


def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"),
                        secrets.listed(F.col("secret_spans")).alias("spans"))


def embedding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def minmax_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_texts(_documents(spark, sf_dir), width=3, percent=85)


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.serve(_documents(spark, sf_dir).select("doc_id", "text", "source"))


def _replanted(rows):
    """Texts of which every tenth (by checksum of its id) repeats a stretch of its own words to the end."""
    import re
    import zlib

    import pyarrow as pa

    out = []
    for i, t in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if t and h % 10 == 0 and (words := re.findall(r"[^\x20\x09-\x0D]+", t)):
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = " ".join(words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a])
        out.append(t)
    return pa.array(out, pa.large_string())


def runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.word_runs(_documents(spark, sf_dir), least=6, times=4, prepare=_replanted)
    # greatest length, then smallest start, then smallest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.col2")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.col3")).alias("period"), F.expr("1000 * top.length div -top.col3").alias("exponent_milli"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))


def collocation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir), least=100, longest=5, top=2000, share=100)


def quality_net_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = byte_net.quality_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", F.coalesce(byte_net.remainder() == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def pipeline_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_packing": packing_query,
    "op2_license_scan": license_query,
    "op3_line_dedup": line_query,
    "op4_quality_rules": quality_query,
    "op5_token_matrices": matrices_query,
    "op6_suffix_dedup": suffix_query,
    "op7_secret_scan": secrets_query,
    "op8_embedding_near_dup": embedding_query,
    "op9_mixing": mixing_query,
    "op10_minmax_near_dup": minmax_query,
    "op11_word_runs": runs_query,
    "op12_collocations": collocation_query,
    "op13_quality_net": quality_net_query,
    "pipeline": pipeline_query,
}
#: Equal to the operator's order and targets: sources in code point order, queues by digest of the id.
MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix|' || CAST(doc_id AS VARCHAR)) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [1, 2, 3][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER w AS n, sum(weight) OVER (ORDER BY source_size * 6 // weight, encode(source) NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
             sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size * 6 // weight, encode(source) NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
      FROM s WINDOW w AS (ORDER BY source_size * 6 // weight, encode(source) NULLS LAST)),
f AS (SELECT min(n) AS n FROM o WHERE 3 * source_size * weights > weight * rest),
t AS (SELECT o.source, o.source_size, CASE WHEN o.n >= f.n THEN CAST(o.weight * g.rest AS DOUBLE) / CAST(g.weights AS DOUBLE)
             ELSE CAST(3 * o.source_size AS DOUBLE) END AS target
      FROM o, f LEFT JOIN o AS g ON g.n = f.n),
q AS (SELECT d.doc_id, d.source, d.size, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)
             - d.size AS ahead FROM d)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(
  greatest(0, least(size, floor(target) - ahead)) + greatest(0, least(size, floor(target) - source_size - ahead))
  + greatest(0, least(size, floor(target) - 2 * source_size - ahead)) AS BIGINT) AS taken
FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source"""

ORACLES: dict[str, str] = {"op9_mixing": MIXING_SQL}
