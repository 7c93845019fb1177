"""The queries registered for the operators: each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    spelling,
    suffix_dedup,
    token_counts,
    topk_search,
    warc,
)
from riskloom.llm.common import table, text_or_empty
from riskloom.session import materialize

# The share of the words that op10_mixing keeps at least, however rare a value is.
MIX_LEAST = 0.4

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tokenizer_path(name: str) -> str:
    """Where this machine, and every other one of the cluster, has a vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept. The contract asks for 4-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, shingle=4, percent=80)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted, names = quality_rules.with_counts(docs)
    counted = materialize(counted.drop("text"), "quality-counts")
    scored, _ = quality_rules.judged(counted, names)
    return scored.select(
        "doc_id", *quality_rules.COUNTS[:5], "base_failed", "kept", "quality"
    )


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(text_or_empty("text"), 256).alias("kept_sha256")
    )


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.read(warc.archive(pages), payloads=False).drop("url")


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs)


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, tokenizer_path("piece_bpe_32k.model")).drop("text")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    scored, _ = quality_classifier.classify(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_search.search(vectors, F.col("vec_id") % 20 == 0, k=20)


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    described = docs.select(
        "doc_id",
        "source",
        "lang",
        mixing.topic_of("text").alias("topic"),
        mixing.words_of("text").alias("n_words"),
    )
    described = materialize(described, "mix-documents")
    margins = {m: F.col(m) for m in ("source", "lang", "topic")}
    mixed, _ = mixing.mix(described, margins, F.col("n_words"), least=MIX_LEAST)
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", "probability", "kept")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    conversations = table(spark, sf_dir, "conversations")
    turns, lengths = prefix_trie.stitched(prefix_trie.ordered(conversations))
    return prefix_trie.trie(turns, lengths)


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut, names = suffix_dedup.without_repeats(docs, length=400)
    return cut.select(
        "doc_id",
        *(names[c] for c in ("n_bytes", "n_removed", "n_spans")),
        F.sha2(names["kept"], 256).alias("kept_sha256"),
    )


def _dropped(doc_id: str, word: str) -> str:
    """The word, or for one in 31 of a document's words, the word without a character."""
    mark = zlib.crc32(f"{doc_id}:{word}".encode())
    at = mark % len(word)
    return word if mark % 31 else word[:at] + word[at + 1 :]


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(docs, 7, 2, _dropped), ratio=10)
