"""The training-corpus pipeline: quality, near-duplicates, secrets, mix, packing.

Every stage takes what its predecessor kept, read again from Parquet. A stage
sees the documents' own columns only; what its operator adds is dropped, so
columns with clashing names pass through unchanged.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, packing, quality, secret_scan, simhash
from tidemark.llm.common import cut, table
from tidemark.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"


def _carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns an operator needs, and the whole row beside them."""
    return docs.select(*needed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def _rows_where(judged: DataFrame, passes: Column) -> DataFrame:
    """The whole rows that pass.

    A filter would be pushed below the operator's projection, with every
    measure written out again in it and evaluated once for each use. A
    generator stays above, so the measures are evaluated once.
    """
    some = F.explode(F.when(passes, F.array("_row")).otherwise(F.slice(F.array("_row"), 1, 0)))
    return judged.select(some.alias("_row")).select("_row.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (a null text fails)."""
    return _rows_where(quality.judge(_carried(docs, "text")), F.col("kept"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the least by id (nulls last), then by a hash of the text.

    A row's group is told by its text, not by its id: rows without an id, or
    with the same one, stay apart if their texts do. Rows that agree in id
    and text are told apart by a hash of all columns; of wholly equal rows
    one stays, and repeats meet in their tasks before they are dealt.
    """
    kept = simhash.one_of_each(docs, shingle=3, radius=3).withColumnRenamed("key", "_k")
    key = F.struct(*[c.alias(k) for k, c in simhash.row_key(docs).items()])
    rows = docs.select(key.alias("_k"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.dropDuplicates(["_k"]).join(kept, "_k", "left_semi").select("_row.*")


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no secret was found."""
    return _rows_where(secret_scan.scan(_carried(docs, "text")), F.size("spans") == 0)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document."""
    size, digest = mixing.size_of(F.col("text")).alias("size"), F.md5("text").alias("digest")
    mixed = mixing.mix(_carried(docs, "doc_id", "source", size, digest), digest="digest").filter("copies > 0")
    return mixed.withColumn("_n", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in a training sequence of 4096 tokens."""
    return packing.pack(cut(packing.pieces(docs, public_tokenizers.path(TOKENIZER))))


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("secret_scans", drop_secrets),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: XXH64 fingerprints and tokenizer ids are beyond SQL; the operators are tested in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
