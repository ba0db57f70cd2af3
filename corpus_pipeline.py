"""A training corpus from the table of documents: quality rules, line dedup, near-duplicates, mixing, packing.

Each stage is a function of (session, documents, folder of the tables) and works on all its
predecessor kept.  Between stages the documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import line_alignment, minmax, mixing, packing, quality
from wakeline.llm.store import keep

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(quality.clean(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(line_alignment.delete_shared(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(minmax.one_of_each(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mix_sources", mix_sources), ("pack", pack)]
#: Tokens, min-max values and alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
