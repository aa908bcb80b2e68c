"""Table descriptions and key checks.

Parquet has no unique keys of its own, so a target's business keys and, for
gold tables, its computed columns are kept as metadata of its columns
(``described``). Spark stores them with the schema in every file it writes, and
``TableSpec.of_schema`` reads them back; only a target that was never written
is described by hand.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names in a column's metadata: its place among the keys (from 1), the expression that computes it.
KEY = "tidemark.key"
COMPUTED = "tidemark.computed"


class KeyContractError(ValueError):
    """A change set violates the key contract of its target."""


@dataclass(frozen=True)
class TableSpec:
    """Name, business key and computed columns of a target table.

    ``computed`` maps a column name to the SQL expression that derives it;
    such columns are never copied from a source and are re-derived after an
    upsert.
    """

    name: str
    keys: tuple[str, ...]
    computed: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError(f"{self.name}: a target needs at least one key column")
        object.__setattr__(self, "keys", tuple(self.keys))

    @classmethod
    def of_schema(cls, name: str, schema: T.StructType) -> TableSpec:
        """The description that the columns' metadata hold; refused without a key."""
        keys = sorted((f for f in schema.fields if KEY in f.metadata), key=lambda f: f.metadata[KEY])
        computed = {f.name: f.metadata[COMPUTED] for f in schema.fields if COMPUTED in f.metadata}
        return cls(name, tuple(f.name for f in keys), computed)

    @property
    def candidate_key(self) -> str:
        """The first key column (the candidate key of the gold upsert)."""
        return self.keys[0]

    def non_key(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in self.keys and c not in self.computed]

    def stored(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in self.computed]


def described(schema: T.StructType, spec: TableSpec) -> T.StructType:
    """``schema`` with the keys and computed columns of ``spec`` as metadata (others' metadata stay)."""
    unknown = {*spec.keys, *spec.computed} - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"{spec.name}: no columns {sorted(unknown)}")
    fields = []
    for f in schema.fields:
        told = {k: v for k, v in f.metadata.items() if k not in (KEY, COMPUTED)}
        if f.name in spec.keys:
            told[KEY] = spec.keys.index(f.name) + 1
        if f.name in spec.computed:
            told[COMPUTED] = spec.computed[f.name]
        fields.append(T.StructField(f.name, f.dataType, f.nullable, told))
    return T.StructType(fields)


def column_rows(schema: T.StructType) -> list[tuple[str, int, int | None, str | None]]:
    """Column, position (from 1), place in the key and computing expression of each column."""
    return [(f.name, i, f.metadata.get(KEY), f.metadata.get(COMPUTED)) for i, f in enumerate(schema.fields, 1)]


def null_key_filter(keys: Sequence[str]):
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return cond


def assert_no_null_keys(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Reject NULL keys up front: SQL ``=`` never matches them."""
    if not df.where(null_key_filter(keys)).isEmpty():
        raise KeyContractError(f"{what}: NULL in key columns {list(keys)}")


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Reject a source that holds one key twice (it cannot be upserted)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    if not dup.isEmpty():
        raise KeyContractError(f"{what}: duplicate keys {list(keys)}")
