"""From titles cells to evidence rows, roll-ups and the wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import rules as R
from ..functions.text import dashed_and, decoded


def split_cell(cell: Column) -> Column:
    """Titles of a pipe-joined cell in normal form, without blanks; of titles equal but for case the first.

    Entities and mis-decoded text are repaired in the whole cell before (:func:`..functions.text.decoded`).
    """
    parts = F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), r"\|"), dashed_and), lambda t: t != "")
    return F.aggregate(parts, F.array().cast("array<string>"), lambda kept, t: F.when(F.exists(kept, lambda k: F.lower(k) == F.lower(t)), kept).otherwise(F.concat(kept, F.array(t))))


def evidence(rows: DataFrame, cells: dict[str, str], keep: list[str]) -> DataFrame:
    """One row per title: ``keep``, ``source`` (key of ``cells``, in its order), ``pos`` and ``raw_title``."""
    clean = rows.withColumns({c: decoded(F.col(c), entities=True, repair="any") for c in cells.values()})
    listed = F.concat(*[F.transform(split_cell(F.col(c)), _sourced(source)) for source, c in cells.items()])
    return clean.select(*keep, F.posexplode(listed).alias("pos", "t")).select(*keep, "t.source", "pos", "t.raw_title")


def _sourced(source: str):
    return lambda t: F.struct(F.lit(source).alias("source"), t.alias("raw_title"))


def joined(column: str) -> Column:
    """Distinct values of a group that are not blank, sorted and pipe-joined."""
    return F.array_join(F.array_sort(F.collect_set(F.when(F.trim(column) != "", F.col(column)))), "|")


def provenance(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the sources, and whether crawl, cv or both are among them."""
    out = rows.groupBy(*keys).agg(joined("source").alias("sources_in_key"), *[F.max((F.col("source") == s).cast("int")).alias(f"has_{s}_in_key") for s in ("crawl", "cv")])
    return out.withColumn("has_both_in_key", F.col("has_crawl_in_key") * F.col("has_cv_in_key"))


def by_source(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Inventory per key, source and title: supporting raw titles, best confidence, its reasons."""
    return rows.groupBy(*keys, "source", "bucket", "canonical_title").agg(joined("raw_title").alias("supporting_raw_titles"), F.max("conf").alias("program_conf_max"), joined("conf_reason").alias("program_conf_reasons"))


def across_sources(inventory: DataFrame, keys: list[str]) -> DataFrame:
    """Inventory per key and title over all sources; both sources add ten points, up to 100."""
    out = inventory.groupBy(*keys, "bucket", "canonical_title").agg(joined("source").alias("sources"), F.max("program_conf_max").alias("program_conf_max"))
    out = out.withColumn("has_both_sources", F.col("sources") == "crawl|cv")
    return out.withColumn("program_conf_final", F.least(F.lit(100), F.col("program_conf_max") + F.when(F.col("has_both_sources"), 10).otherwise(0)))


_spill = ("any", [("is", "low", ""), *[("match", p) for p in (P.DESCRIPTOR, P.ADMIN, P.STORY, P.COURSE_PREFIX)], ("match", P.PROFILE_DASH, "title"), ("has", P.COURSE_PHRASES)])


def fold_to_anchor(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Spill-over titles of a key, bucket and source become evidence of its anchor title: the most frequent, then the first."""
    group = [*keys, "bucket", "source"]
    anchors = rows.where(F.col("canonical_title").isin(*P.ANCHOR_TITLES)).groupBy(*group, "canonical_title").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("at"))
    best = anchors.groupBy(*group).agg(F.min_by("canonical_title", F.struct(-F.col("n"), "at", "canonical_title")).alias("anchor"))
    spilt = R.column(_spill)
    out = rows.withColumn("low", F.lower("title")).join(best, group, "left")
    return out.withColumn("canonical_title", F.when(spilt & F.col("anchor").isNotNull(), F.col("anchor")).otherwise(F.col("canonical_title"))).drop("low", "anchor")


def expand_offers(rows: DataFrame) -> DataFrame:
    """A sentence "is offered as a major, minor, and concentration" stands for three programs."""
    low = F.lower("raw_title")
    offered = low.contains("is offered as") & low.contains("major") & low.contains("minor") & low.contains("concentration")
    three = F.array(*[F.concat("canonical_title", F.lit(f" ({s})")) for s in ("Major", "Minor", "Concentration")])
    return rows.withColumn("canonical_title", F.explode(F.when(offered, three).otherwise(F.array("canonical_title"))))


def once(rows: Column) -> Column:
    """Titles of (pos, t) structs in order of ``pos``, not blank; of titles equal but for case the first."""
    titles = F.transform(F.array_sort(rows), lambda x: F.trim(x["t"]))
    kept = F.filter(titles, lambda t, i: (t != "") & ~F.exists(F.slice(titles, F.lit(1), i), lambda u: F.lower(u) == F.lower(t)))
    return F.array_join(kept, "|")


def merged_cell(crawl: Column, cv: Column) -> Column:
    """``crawl:a|b || cv:c``, without sources that have nothing."""
    return F.concat_ws(" || ", F.when(crawl != "", F.concat(F.lit("crawl:"), crawl)), F.when(cv != "", F.concat(F.lit("cv:"), cv)))


def wide(rows: DataFrame, keys: list[str], value: str = "canonical_title") -> DataFrame:
    """One row per key: for each bucket the titles of both sources with their origin, the titles of each, and the buckets hit."""
    buckets = (*P.BUCKETS, "other")
    listed = {(b, s): once(F.collect_list(F.when((F.col("bucket") == b) & (F.col("source") == s), F.struct("pos", F.col(value).alias("t"))))) for b in buckets for s in ("crawl", "cv")}
    cells = rows.groupBy(*keys).agg(*[c.alias(f"program_bucket__{b}__{s}") for (b, s), c in listed.items()])
    for b in buckets:
        cells = cells.withColumn(f"program_bucket__{b}", merged_cell(F.col(f"program_bucket__{b}__crawl"), F.col(f"program_bucket__{b}__cv")))
    hits = F.concat_ws("|", *[F.when(F.col(f"program_bucket__{b}") != "", F.lit(b)) for b in buckets])
    return cells.withColumn("program_buckets_hit", hits)


def signal_cells(rows: DataFrame, keys: list[str], value: str = "canonical_title") -> DataFrame:
    """One cell per key for titles that are real but no programs: ``kind:bucket:source:a|b`` joined by `` || ``, in that order."""
    found = rows.where(F.col("title_kind").isin(*P.SIGNAL_KINDS)).withColumn("bucket", F.when(F.trim("bucket") == "", "other").otherwise(F.col("bucket")))
    each = found.groupBy(*keys, "title_kind", "bucket", "source").agg(once(F.collect_list(F.struct("pos", F.col(value).alias("t")))).alias("titles"))
    part = F.struct("title_kind", "bucket", "source", F.concat_ws(":", "title_kind", "bucket", "source", "titles").alias("text"))
    return each.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["text"]), " || ").alias("real_nonprogram_signals"))


def provenance_summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sources of each program bucket and of each kind of signal and its bucket, in one table by ``key_type`` and ``key``."""
    programs = provenance(rows.where("is_program = 1 and bucket != ''"), [*keys, "bucket"]).select(*keys, F.lit("bucket").alias("key_type"), F.col("bucket").alias("key"), F.lit("").alias("bucket"), "sources_in_key", *_HAS)
    signals = rows.where(F.col("title_kind").isin(*P.SIGNAL_KINDS)).withColumn("bucket", F.when(F.trim("bucket") == "", "other").otherwise(F.col("bucket")))
    signals = provenance(signals, [*keys, "title_kind", "bucket"]).select(*keys, F.lit("title_kind").alias("key_type"), F.col("title_kind").alias("key"), "bucket", "sources_in_key", *_HAS)
    return programs.unionByName(signals)


_HAS = ("has_crawl_in_key", "has_cv_in_key", "has_both_in_key")


def with_provenance(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with what :func:`provenance` says of their key, by a window: no join."""
    key = Window.partitionBy(*keys)
    flags = {f"has_{s}_in_key": F.max((F.col("source") == s).cast("int")).over(key) for s in ("crawl", "cv")}
    out = rows.withColumn("sources_in_key", F.array_join(F.array_sort(F.collect_set(F.when(F.col("source") != "", F.col("source"))).over(key)), "|")).withColumns(flags)
    return out.withColumn("has_both_in_key", F.col("has_crawl_in_key") * F.col("has_cv_in_key"))
