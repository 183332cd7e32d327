"""Keyed relational operators: cleaning keys, keeping one row of a key, attaching, resuming, ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clean_key(key: Column) -> Column:
    """Trimmed key as text; blank, "nan" and "none" are missing."""
    text = F.regexp_replace(key.cast("string"), r"(?U)^\s+|\s+$", "")
    return F.when((text != "") & ~F.lower(text).isin("nan", "none"), text)


def drop_blank_rows(rows: DataFrame) -> DataFrame:
    """Rows with at least one column that is not missing, blank or "nan"."""
    return rows.where(F.coalesce(*[clean_key(rows[f"`{c}`"]) for c in rows.columns]).isNotNull())


def keep_one(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order; ties must be broken by the order."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def attach(rows: DataFrame, right: DataFrame, key: str, fill: str | None = "") -> DataFrame:
    """Left equi-join on ``key`` with missing text filled; ``right`` has one row per key."""
    joined = rows.join(right, key, "left")
    added = [c for c in right.columns if c != key]
    return joined if fill is None else joined.fillna(fill, added)


def only_left(rows: DataFrame, right: DataFrame, key: str, with_missing: bool) -> DataFrame:
    """Rows whose key is not in ``right``; rows without a key count if ``with_missing``."""
    kept = rows if with_missing else rows.where(F.col(key).isNotNull())
    return kept.join(right.select(key), key, "left_anti")


def inner_with_missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join in which missing keys match each other."""
    renamed = right.withColumnRenamed(key, "_key")
    return left.join(renamed, left[key].eqNullSafe(renamed["_key"])).drop("_key")


def top_k(rows: DataFrame, groups: list[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group; the limit is pushed below the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("rank") <= k)


def union_all(*frames: DataFrame, fill: str = "") -> DataFrame:
    """Union by name: columns of the first, then those only later ones have; missing text is filled."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out.fillna(fill)
