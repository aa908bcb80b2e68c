"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    chat,
    embeddings,
    html_extract,
    lm,
    mixing,
    packing,
    preference,
    quality,
    secret_scan,
    simhash,
    trie,
    urls,
)
from tidemark.llm.common import cut, table

#: The filter's rules (action, host, path).
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, repeating."""
    docs = table(spark, sf_dir, "documents")
    size, digest = mixing.size_of(F.col("text")).alias("size"), F.md5("text").alias("digest")
    sized = cut(docs.select("doc_id", "source", size, digest))
    return mixing.mix(sized, digest="digest").select("doc_id", "size", "source_size", "target", "taken")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, read back from their formatted text."""
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], convs.schema)
    return chat.read_back(chat.formatted(convs.unionByName(own)), ordered=True)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", simhash.fp_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secret spans of every document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    n = lambda k: F.size(secret_scan.of_kind(F.col("spans"), k)).cast("long")
    base = secret_scan.spans_text(secret_scan.of_kind(F.col("spans"), 0, 1, 2))
    return found.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document."""
    return lm.score(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    rules = spark.createDataFrame(list(URL_RULES), "action string, host string, path string")
    return urls.judge(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(cut(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and verdict of every document."""
    return preference.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.3)


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens in every document."""
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), a, b)


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the rebuilt conversations, with its members and savings."""
    return trie.trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [v for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {f.__name__: f for f in found}
