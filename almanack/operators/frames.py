"""Shapes of tables: which columns, in which order, filled and checked; partitions of rows and what they cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def insert_after(rows: DataFrame, after: str, name: str, value: Column) -> DataFrame:
    """A column right after another; last where that is missing.  A column of that name moves."""
    names = [c for c in rows.columns if c != name]
    at = names.index(after) + 1 if after in names else len(names)
    return rows.withColumn(name, value).select(*[_c(c) for c in [*names[:at], name, *names[at:]]])


def stable(rows: DataFrame, extra: list[str]) -> DataFrame:
    """All columns as text, those of ``extra`` that are missing added at the end, nothing null."""
    names = list(dict.fromkeys([*rows.columns, *extra]))
    return rows.select(*[F.coalesce(_c(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in names])


def keep_list(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns of ``names`` that exist, in that order."""
    return rows.select(*[_c(c) for c in names if c in rows.columns])


def without(rows: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Rows without some columns, others (``old=new``) renamed."""
    return rows.select(*[_c(c).alias(renamed.get(c, c)) for c in rows.columns if c not in names])


def has_text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def is_in(c: Column, values) -> Column:
    """Membership in any case."""
    return F.coalesce(F.lower(c).isin(*[v.lower() for v in values]), F.lit(False))


def head(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows in order; all if ``n`` is 0."""
    return rows.orderBy(*order).limit(n) if n else rows


def numbered(rows: DataFrame, *order: Column, name: str = "row_index") -> DataFrame:
    """Rows with their place in order, from 0, by two levels: counts of ranges, and places inside them; no task sees all rows."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))  # one row per range
    before = sizes.select("_part", "_first", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before", "_n")


def batches(rows: DataFrame, size: int, index: str = "row_index") -> DataFrame:
    """Rows with the number of their batch of ``size``, from 1."""
    return rows.withColumn("batch", (F.floor(F.col(index) / size) + 1).cast("int"))


def assign(rows: DataFrame, name: str, mask: Column, value: Column) -> DataFrame:
    """A column with ``value`` where ``mask`` holds and the column is blank."""
    return rows.withColumn(name, F.when(mask & ~has_text(_c(name)), value).otherwise(_c(name)))


# Labels that count as enough.
ENOUGH_CRAWL, ENOUGH_CV, STRICT = ("sufficient majors", "ok", "passed_ctrl_thresh"), ("passed_ctrl_thresh", "ok"), ("strict_raw", "strict_canonical")
SPLITS = (
    "01_inadequate_controls", "02_adequate_controls", "03_strict_match", "04_non_strict_match", "05_no_match__2013_empty__now_something", "06_no_match__2013_something__now_nothing",
    "07_no_match__2013_something__now_something_else",
)


def enough_controls(crawl: Column, cv: Column, total: Column | None = None, least: int | None = None) -> Column:
    """Whether the crawl or the third party saw enough subjects; with ``least`` their number counts too."""
    out = is_in(F.trim(crawl), ENOUGH_CRAWL)
    if least is not None:
        out = out | (F.coalesce(total.try_cast("double"), F.lit(0.0)) >= least)
    return out | is_in(F.trim(cv), ENOUGH_CV)


def review_splits(rows: DataFrame, enough: Column, level: str, reference: str, discovered: str) -> DataFrame:
    """Rows with ``splits``, the review sets they are in: too few subjects, or enough and one by how the reference was matched.

    Rows with enough subjects that match nothing, with no reference and nothing found, are in no set by match.
    """
    lv = F.trim(F.coalesce(_c(level), F.lit("")))
    no, then, now = lv == "NO_MATCH", has_text(_c(reference)), has_text(_c(discovered))
    by_match = (
        F.when(lv.isin(*STRICT), SPLITS[2]).when(~no & (lv != ""), SPLITS[3]).when(no & ~then & now, SPLITS[4]).when(no & then & ~now, SPLITS[5]).when(no & then & now, SPLITS[6])
    )
    sets = F.when(~enough, F.array(F.lit(SPLITS[0]))).otherwise(F.array_compact(F.array(F.lit(SPLITS[1]), by_match)))
    return rows.withColumn("splits", sets)


def check_partition(rows: DataFrame, keys: list[str], splits: str = "splits") -> DataFrame:
    """One row: how many keys, how many with enough subjects, in one set by match, in several, in none."""
    by_key = rows.groupBy(*keys).agg(F.array_distinct(F.flatten(F.collect_set(splits))).alias("s"))
    by_match = F.size(F.filter("s", lambda x: ~x.isin(*SPLITS[:2])))
    enough = F.array_contains("s", SPLITS[1])
    return by_key.agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if(enough).alias("n_adequate"), F.count_if(enough & (by_match == 1)).alias("n_once"), F.count_if(by_match > 1).alias("n_overlap"),
        F.count_if(enough & (by_match == 0)).alias("n_uncovered"),
    )


def fill_rates(rows: DataFrame) -> DataFrame:
    """``column, filled, total``: how many rows have text in each column."""
    counts = rows.agg(*[F.count_if(has_text(_c(c).cast("string"))).alias(c) for c in rows.columns], F.count(F.lit(1)).alias("_total"))
    each = F.array(*[F.struct(F.lit(c).alias("column"), _c(c).alias("filled")) for c in rows.columns])
    return counts.select(F.inline(each), "_total").withColumnRenamed("_total", "total") if rows.columns else counts


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """One row: rows with a key, distinct keys, and how many rows repeat one."""
    named = rows.where(has_text(_c(key).cast("string")))
    return named.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(_c(key)).alias("n_keys")).withColumn("n_repeats", F.col("n_rows") - F.col("n_keys"))


def union_with_columns(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both under the columns of the first and then those only the second has, as text, nothing null."""
    names = [*first.columns, *[c for c in second.columns if c not in first.columns]]
    return stable(first, names).select(*map(_c, names)).unionByName(stable(second, names).select(*map(_c, names)))


def annotated(rows: DataFrame, right: DataFrame, key: str, columns: list[str], *order: Column) -> DataFrame:
    """``rows`` whose key is in ``right``, with columns of its first row for the key."""
    first = right.select(key, *[_c(c) for c in columns], F.row_number().over(Window.partitionBy(key).orderBy(*order)).alias("_n")).where("_n = 1").drop("_n")
    return rows.join(first, key)
