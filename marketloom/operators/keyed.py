"""Keyed relational operators composed from DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first under ascending ``order`` (NULLs last).

    A ``min`` over a struct merges on the map side, so a key with many rows is
    never gathered or sorted in one task.  Remaining columns break ties."""
    rest = [c for c in df.columns if c not in keys]
    tie = [c for c in rest if c not in order]
    fields = []
    for c in [*order, *tie]:
        fields += [F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(c)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c)
                         for c in df.columns])


def top_per_key(df: DataFrame, key: str, value: str, tie: str) -> DataFrame:
    """``row_number() over (partition by key order by value desc, tie) = 1``
    (NULL value first, NULL tie last) as a mergeable aggregate."""
    rest = [c for c in df.columns if c not in (key, value, tie)]
    order = [
        F.col(value).isNotNull().alias("_v0"),
        (-F.col(value)).alias("_v1"),
        F.col(tie).isNull().alias("_t0"),
        F.col(tie).alias(tie),
        F.col(value).alias(value),
        *[F.col(c).alias(c) for c in rest],
    ]
    best = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_r"))
    return best.select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c)
                         for c in df.columns])


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``target`` whose key is not in ``batch``, plus ``batch``."""
    kept = target.join(batch.select(key), key, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def missing_parents(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no match in ``parent.field``.

    Both sides are reduced to distinct keys first, so a hot key is one row."""
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_k"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(field).alias("_k")).distinct()
    return keys.join(known, "_k", "left_anti")
