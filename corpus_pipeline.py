"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on every document its predecessor kept, and
returns the columns of documents; the last returns the packed pieces. Between stages the
documents are written as Parquet and read again, so a lost executor repeats one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from riskloom.llm.common import table
from riskloom.llm.queries import tokenizer_path
from riskloom.session import materialize

KEPT = 0.4


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-supervision verdict keeps."""
    counted, names = quality_rules.with_counts(docs)
    judged, out = quality_rules.judged(counted, names)
    return judged.where(F.col(out["kept"])).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a larger doc_id keeps; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("text").isNotNull(), size))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8."""
    return near_dedup.without_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target shares, of KEPT of the
    words at least, however rare a value is."""
    margins = {
        "source": F.col("source"),
        "lang": F.col("lang"),
        "topic": mixing.topic_of("text"),
    }
    mixed, names = mixing.mix(docs, margins, mixing.words_of("text"), least=KEPT, error=1e-6)
    return mixed.where(F.col(names["kept"])).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

# Expectation maximisation and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
