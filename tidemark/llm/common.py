"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: A word is a run of characters other than these six.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def by_batch(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``, one batch after another.

    After each, memory that Arrow's pool holds unused goes back to the
    system: Python workers outlive their tasks, beside the next stage's JVM.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from run([b])
            del b
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()  # the last batch was still held by its reader

    return each


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, as an array (null or blank: empty)."""
    empty = F.array().cast("array<string>")
    return let(
        F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES)),
        lambda t: F.when(t == "", empty).otherwise(F.split(t, SPACE_RUN)),
    )
