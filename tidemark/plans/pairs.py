"""Source -> target pairs found by naming convention in a table registry.

A registry is a DataFrame ``(schema_name, object_name, type)`` with type
``U`` (table) or ``V`` (view): the session catalog's tables, or a directory
listing. The session catalog folds names to lower case, so its registry is
matched without regard to case (``any_case``).

* Silver: a source ``S.O`` (table or view) pairs with the tag table
  ``T.O<suffix>`` where ``T`` is ``S`` without ``_Derived`` plus ``_Tag``; the
  target must be a table.
* Gold: a table ``D.O`` in Dimension / Fact / Bridge / Cache pairs with the
  table or view ``Live.O``.

The pairs are numbered by target, which is the order the drivers run them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.constants import (
    DERIVED_SUFFIX,
    FIRST_SUFFIX,
    GOLD_SOURCE_SCHEMA,
    GOLD_TARGET_SCHEMAS,
    HISTORY_SUFFIX,
    LATEST_SUFFIX,
    SOURCE_OBJECT_TYPES,
    TABLE_TYPE,
    TAG_SCHEMA_SUFFIX,
    VIEW_TYPE,
)

TAG_SUFFIX = {"first": FIRST_SUFFIX, "latest": LATEST_SUFFIX, "history": HISTORY_SUFFIX}
PAIR_COLUMNS = ("i", "source_schema", "source_object", "target_schema", "target_object", "n_sources")


def registry_from_catalog(spark: SparkSession, databases: list[str] | None = None) -> DataFrame:
    """A registry from the session catalog: views are ``V``, tables ``U``.

    All namespaces of the current catalog by default. Temporary views are left
    out: they lie in no namespace, yet every namespace lists them.
    """
    rows = []
    for db in databases if databases is not None else [d.name for d in spark.catalog.listDatabases()]:
        for t in spark.catalog.listTables(db):
            if not t.isTemporary:
                rows.append((db, t.name, VIEW_TYPE if (t.tableType or "").upper() == "VIEW" else TABLE_TYPE))
    return spark.createDataFrame(rows, "schema_name string, object_name string, type string")


def _numbered(pairs: DataFrame) -> DataFrame:
    per_target = Window.partitionBy("target_schema", "target_object")
    order = Window.orderBy("target_schema", "target_object", "source_schema", "source_object")
    return pairs.select(
        F.row_number().over(order).alias("i"),
        "source_schema",
        "source_object",
        "target_schema",
        "target_object",
        F.count(F.lit(1)).over(per_target).alias("n_sources"),
    )


def _folded(names, any_case: bool):
    return F.lower(names) if any_case else names


def discover_silver_pairs(registry: DataFrame, kind: str, any_case: bool = False) -> DataFrame:
    """Source objects and their First / Latest / History tag tables.

    ``n_sources > 1`` flags a target claimed by two sources (``X.T`` and
    ``X_Derived.T``); the drivers refuse to load such a target.
    """
    suffix = TAG_SUFFIX[kind]
    src = registry.where(F.col("type").isin(*SOURCE_OBJECT_TYPES)).select(
        F.col("schema_name").alias("source_schema"), F.col("object_name").alias("source_object")
    )
    tgt = registry.where(F.col("type") == TABLE_TYPE).select(
        F.col("schema_name").alias("target_schema"), F.col("object_name").alias("target_object")
    )
    fold = lambda c: _folded(c, any_case)
    base = F.replace(fold(F.col("source_schema")), fold(F.lit(DERIVED_SUFFIX)), F.lit(""))
    tag_object = F.concat(F.col("source_object"), F.lit(suffix))
    cond = (fold(F.col("target_schema")) == F.concat(base, fold(F.lit(TAG_SCHEMA_SUFFIX)))) & (
        fold(F.col("target_object")) == fold(tag_object)
    )
    return _numbered(src.join(tgt, cond))


def discover_gold_pairs(registry: DataFrame, any_case: bool = False) -> DataFrame:
    """Gold tables and the same-named Live table or view that feeds them."""
    fold = lambda c: _folded(c, any_case)
    tgt = registry.where(
        (F.col("type") == TABLE_TYPE) & fold(F.col("schema_name")).isin(*[fold(F.lit(s)) for s in GOLD_TARGET_SCHEMAS])
    ).select(F.col("schema_name").alias("target_schema"), F.col("object_name").alias("target_object"))
    src = registry.where(
        F.col("type").isin(TABLE_TYPE, VIEW_TYPE) & (fold(F.col("schema_name")) == fold(F.lit(GOLD_SOURCE_SCHEMA)))
    ).select(F.col("schema_name").alias("source_schema"), F.col("object_name").alias("source_object"))
    return _numbered(tgt.join(src, fold(F.col("source_object")) == fold(F.col("target_object"))))
