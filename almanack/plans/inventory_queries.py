"""Queries from titles cells to the inventory.

The generated tables hold no program titles, so golden titles are dealt by part key; an institution is a supplier,
its evidence the lines of orders.  SQL takes the classes of titles from the golden rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import titles
from ..operators import inventory
from ..sources.tables import parquet
from . import golden
from .base import literals, query, values

_N = len(golden.TITLES)
_GOLD = values(golden.TITLES, "raw_title", "source", "title_kind", "bucket", "canonical_title", "conf", "conf_reason")
_WITH = f"WITH rows AS (SELECT l_suppkey AS unitid, l_orderkey * 10 + l_linenumber AS pos, g.* FROM lineitem JOIN {_GOLD} g ON g.k = l_partkey % {_N}) "
_PROGRAMS = "SELECT * FROM rows WHERE title_kind = 'program' AND bucket <> ''"
_SIGNALS = "SELECT * EXCLUDE (bucket), CASE WHEN bucket = '' THEN 'other' ELSE bucket END AS bucket FROM rows WHERE title_kind IN ('center_institute', 'committee_admin', 'department_unit', 'program_signal')"
_JOINED = "coalesce(string_agg(DISTINCT {0}, '|' ORDER BY {0}) FILTER (trim({0}) <> ''), '')"
_FLAGS = "CAST(max(source = 'crawl') AS INT) AS has_crawl_in_key, CAST(max(source = 'cv') AS INT) AS has_cv_in_key, CAST(max(source = 'crawl') AND max(source = 'cv') AS INT) AS has_both_in_key"


def _titles(spark: SparkSession) -> DataFrame:
    return literals(spark, [(t[0], t[1]) for t in golden.TITLES], "raw_title string, source string")


def evidence(spark: SparkSession, d: str) -> DataFrame:
    lines = parquet(spark, d, "lineitem").select(F.col("l_suppkey").alias("unitid"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), (F.col("l_partkey") % _N).alias("k"))
    return lines.join(_titles(spark), "k").drop("k")


def _with_classes(rows: DataFrame) -> DataFrame:
    """``rows`` with the classes of their titles; each distinct title of a source is classified once."""
    known = titles.filled(titles.canonical_columns(titles.classified(rows.select("source", "raw_title").distinct())))
    # one aggregate over the same keys: later filters are not pushed into the rules, which would repeat them in the plan
    classes = [c for c in known.columns if c not in ("source", "raw_title")]
    known = known.groupBy(F.col("source").alias("_s"), F.col("raw_title").alias("_t")).agg(F.first(F.struct(*classes)).alias("c"))
    return rows.join(known, F.col("source").eqNullSafe(F.col("_s")) & F.col("raw_title").eqNullSafe(F.col("_t"))).select(*rows.columns, "c.*")


def classified(spark: SparkSession, d: str) -> DataFrame:
    """Evidence with classes."""
    return _with_classes(evidence(spark, d))


def _programs(spark: SparkSession, d: str) -> DataFrame:
    return classified(spark, d).where("is_program = 1 and bucket != ''")


@query(_WITH + "SELECT unitid, bucket, source, count(*) AS n_evidence, count(DISTINCT raw_title) AS n_titles FROM rows GROUP BY ALL")
def bucket_titles(spark: SparkSession, d: str) -> DataFrame:
    """Evidence and distinct titles per institution, bucket and source."""
    return classified(spark, d).groupBy("unitid", "bucket", "source").agg(F.count(F.lit(1)).alias("n_evidence"), F.count_distinct("raw_title").alias("n_titles"))


@query(f"SELECT p_partkey, raw_title, source, title_kind, bucket, canonical_title, conf, conf_reason, CAST(title_kind = 'program' AS INT) AS is_program FROM part JOIN {_GOLD} ON k = p_partkey % {_N}")
def title_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kind, bucket, label and confidence with its reasons of every title."""
    rows = parquet(spark, d, "part").select("p_partkey", (F.col("p_partkey") % _N).alias("k")).join(_titles(spark), "k")
    return _with_classes(rows).select("p_partkey", "raw_title", "source", "title_kind", "bucket", "canonical_title", "conf", "conf_reason", "is_program")


@query(_WITH + f"""SELECT unitid, 'bucket' AS key_type, bucket AS key, '' AS bucket, {_JOINED.format('source')} AS sources_in_key, {_FLAGS} FROM ({_PROGRAMS}) GROUP BY unitid, bucket
  UNION ALL SELECT unitid, 'title_kind', title_kind, bucket, {_JOINED.format('source')}, {_FLAGS} FROM ({_SIGNALS}) GROUP BY unitid, title_kind, bucket""")
def source_provenance(spark: SparkSession, d: str) -> DataFrame:
    """Which sources back each program bucket, and each kind and bucket of signals, of an institution."""
    return inventory.provenance_summary(classified(spark, d), ["unitid"])


@query(_WITH + f", programs AS ({_PROGRAMS}), backed AS (SELECT unitid, bucket, {_JOINED.format('source')} AS sources_in_key, {_FLAGS} FROM programs GROUP BY ALL) SELECT unitid, pos, bucket, canonical_title, sources_in_key, has_crawl_in_key, has_cv_in_key, has_both_in_key FROM programs JOIN backed USING (unitid, bucket)")
def provenance_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every program row with the sources that back its bucket."""
    rows = inventory.with_provenance(_programs(spark, d), ["unitid", "bucket"])
    return rows.select("unitid", "pos", "bucket", "canonical_title", "sources_in_key", "has_crawl_in_key", "has_cv_in_key", "has_both_in_key")


_BY_SOURCE = f"SELECT unitid, source, bucket, canonical_title, {_JOINED.format('raw_title')} AS supporting_raw_titles, max(conf) AS program_conf_max, {_JOINED.format('conf_reason')} AS program_conf_reasons FROM ({{0}}) GROUP BY ALL"


@query(_WITH + _BY_SOURCE.format(_PROGRAMS))
def inventory_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Programs per institution and source with their evidence."""
    return inventory.by_source(_programs(spark, d), ["unitid"])


_ACROSS = f"""SELECT *, contains(sources, 'crawl') AND contains(sources, 'cv') AS has_both_sources,
  greatest(0, least(100, program_conf_max + CASE WHEN contains(sources, 'crawl') AND contains(sources, 'cv') THEN 10 ELSE 0 END)) AS program_conf_final
  FROM (SELECT unitid, bucket, canonical_title, {_JOINED.format('source')} AS sources, max(program_conf_max) AS program_conf_max FROM base GROUP BY ALL)"""


@query(_WITH + f", base AS ({_BY_SOURCE.format(_PROGRAMS)}) " + _ACROSS)
def inventory_across_sources(spark: SparkSession, d: str) -> DataFrame:
    """Programs per institution over both sources with the final confidence."""
    return inventory.across_sources(inventory.by_source(_programs(spark, d), ["unitid"]), ["unitid"])


#: Programs among the golden titles that read as courses, administration or profiles.
_DEMOTED = "('Seminar in Black Studies Major', 'Introduction to the Africana Studies Major', 'Black and Latino Studies - Minor', 'Ａfrican\u00a0Studies – Minor')"
_FOLDED = _WITH + f""", programs AS ({_PROGRAMS}),
  anchors AS (SELECT unitid, bucket, source, canonical_title, count(*) AS n, min(pos) AS first_at FROM programs
    WHERE canonical_title IN ('Black Studies', 'Africana Studies', 'African Studies', 'Ethnic Studies', 'African and African American Studies', 'African-American/Black Studies') GROUP BY ALL),
  best AS (SELECT unitid, bucket, source, canonical_title AS anchor FROM anchors QUALIFY row_number() OVER (PARTITION BY unitid, bucket, source ORDER BY n DESC, first_at, canonical_title) = 1),
  folded AS (SELECT p.* EXCLUDE (canonical_title), CASE WHEN anchor IS NOT NULL AND raw_title IN {_DEMOTED} THEN anchor ELSE canonical_title END AS canonical_title FROM programs p LEFT JOIN best USING (unitid, bucket, source)),
  grown AS (SELECT * EXCLUDE (canonical_title), unnest(CASE WHEN raw_title = 'Ethnic Studies is offered as a major, minor, and concentration'
    THEN [canonical_title || ' (Major)', canonical_title || ' (Minor)', canonical_title || ' (Concentration)'] ELSE [canonical_title] END) AS canonical_title FROM folded) """ + _BY_SOURCE.format("SELECT * FROM grown")


@query(_FOLDED)
def inventory_folded(spark: SparkSession, d: str) -> DataFrame:
    """Inventory after spill-over titles are folded into anchors and offers are expanded."""
    return inventory.by_source(inventory.expand_offers(inventory.fold_to_anchor(_programs(spark, d), ["unitid"])), ["unitid"])


def _wide_sql() -> str:
    buckets = ("black", "africana", "mena", "african", "minority", "ethnic", "race", "other")
    each = [f"coalesce(string_agg(canonical_title, '|' ORDER BY pos) FILTER (bucket = '{b}' AND source = '{s}'), '') AS program_bucket__{b}__{s}" for b in buckets for s in ("crawl", "cv")]
    both = [f"concat_ws(' || ', CASE WHEN program_bucket__{b}__crawl <> '' THEN 'crawl:' || program_bucket__{b}__crawl END, CASE WHEN program_bucket__{b}__cv <> '' THEN 'cv:' || program_bucket__{b}__cv END) AS program_bucket__{b}" for b in buckets]
    hits = ", ".join(f"CASE WHEN program_bucket__{b}__crawl <> '' OR program_bucket__{b}__cv <> '' THEN '{b}' END" for b in buckets)
    first = f"SELECT unitid, source, bucket, canonical_title, pos FROM ({_PROGRAMS}) QUALIFY row_number() OVER (PARTITION BY unitid, source, bucket, lower(canonical_title) ORDER BY pos) = 1"
    return _WITH + f", firsts AS ({first}), cells AS (SELECT unitid, {', '.join(each)} FROM firsts GROUP BY unitid) SELECT *, {', '.join(both)}, concat_ws('|', {hits}) AS program_buckets_hit FROM cells"


@query(_wide_sql())
def bucket_pivot_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per institution: titles of each bucket with their origin, of each source, and the buckets hit.

    Titles that repeat are left out before the lists are gathered, so that a list is as long as what it shows.
    """
    low = F.lower("canonical_title")
    firsts = _programs(spark, d).groupBy("unitid", "source", "bucket", low.alias("low")).agg(F.min(F.struct("pos", "canonical_title")).alias("f"))
    return inventory.wide(firsts.select("unitid", "source", "bucket", "f.*"), ["unitid"])


@query(_WITH + f""", firsts AS (SELECT * FROM ({_SIGNALS}) QUALIFY row_number() OVER (PARTITION BY unitid, title_kind, bucket, source, lower(canonical_title) ORDER BY pos) = 1),
  parts AS (SELECT unitid, title_kind, bucket, source, title_kind || ':' || bucket || ':' || source || ':' || string_agg(canonical_title, '|' ORDER BY pos) AS part FROM firsts GROUP BY unitid, title_kind, bucket, source)
  SELECT unitid, string_agg(part, ' || ' ORDER BY title_kind, bucket, source) AS real_nonprogram_signals FROM parts GROUP BY unitid""")
def signal_cells(spark: SparkSession, d: str) -> DataFrame:
    """One cell per institution for units and offices: kind, bucket, source and titles."""
    rows = classified(spark, d).where(F.col("title_kind").isin(*P.SIGNAL_KINDS))
    firsts = rows.groupBy("unitid", "title_kind", "bucket", "source", F.lower("canonical_title").alias("low")).agg(F.min(F.struct("pos", "canonical_title")).alias("f"))
    return inventory.signal_cells(firsts.select("unitid", "title_kind", "bucket", "source", "f.*"), ["unitid"])


#: Cells of two sources, and the rows they are split into.
_CELLS = (
    ("African &amp; African American Studies| Ethnic Studies |ethnic studies", "Africana|", (("crawl", "African and African American Studies"), ("crawl", "Ethnic Studies"), ("cv", "Africana"))),
    ("", None, ()),
    ("Women’s Studies – Minor|Ｂlack Studies", "A & B", (("crawl", "Women’s Studies - Minor"), ("crawl", "Black Studies"), ("cv", "A and B"))),
    ("x||x|X|y", "x", (("crawl", "x"), ("crawl", "y"), ("cv", "x"))),
)
_SPLIT = [(k, i, s, t) for k, (_, _, rows) in enumerate(_CELLS) for i, (s, t) in enumerate(rows)]


@query(f"SELECT s_suppkey AS unitid, source, pos, raw_title FROM supplier JOIN {values(_SPLIT, 'cell', 'pos', 'source', 'raw_title')} ON cell = s_suppkey % {len(_CELLS)}")
def evidence_split(spark: SparkSession, d: str) -> DataFrame:
    """Cells of titles split into rows, in normal form, equal ones once."""
    cells = literals(spark, [c[:2] for c in _CELLS], "crawl string, cv string")
    rows = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"), (F.col("s_suppkey") % len(_CELLS)).alias("k")).join(cells, "k")
    return inventory.evidence(rows, {"crawl": "crawl", "cv": "cv"}, ["unitid"])
