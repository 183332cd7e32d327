"""Queries of keyed joins, cleaning, review sets and shapes of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import cells, frames, keys
from ..sources.tables import fresh_or_slow, parquet
from .base import query


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return parquet(spark, d, "customer").select(F.col("c_custkey").alias("unitid"), F.col("c_name").alias("name"))


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def compact_keep_last(spark: SparkSession, d: str) -> DataFrame:
    """Progress log compacted to the last row of each key."""
    return keys.keep_one(parquet(spark, d, "events"), ["user_id"], F.col("ts").desc(), F.col("event_id").desc()).select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def dedupe_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """First row of each key."""
    return keys.keep_one(parquet(spark, d, "events"), ["user_id", "event_type"], F.col("event_id").asc()).select("user_id", "event_type", "event_id")


@query("SELECT c_custkey AS unitid, c_name AS name, count(*) AS n_orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL")
def cohort_inner(spark: SparkSession, d: str) -> DataFrame:
    """Cohort rows found in the baseline."""
    found = parquet(spark, d, "orders").groupBy(F.col("o_custkey").alias("unitid")).agg(F.count(F.lit(1)).alias("n_orders"))
    return _customers(spark, d).join(found, "unitid")


_KEYED = "CASE WHEN {0} % 10 = 0 THEN ' nan ' WHEN {0} % 10 = 1 THEN '' WHEN {0} % 10 = 2 THEN 'None' ELSE ' ' || CAST({0} AS VARCHAR) || ' ' END"
_CLEAN = "CASE WHEN {0} % 10 < 3 THEN NULL ELSE CAST({0} AS VARCHAR) END"


def _messy(rows: DataFrame, key: str) -> DataFrame:
    c = F.col(key)
    text = F.when(c % 10 == 0, " nan ").when(c % 10 == 1, "").when(c % 10 == 2, "None").otherwise(F.concat(F.lit(" "), c.cast("string"), F.lit(" ")))
    return rows.withColumn("unitid", keys.clean_key(text))


@query(f"WITH a AS (SELECT {_CLEAN.format('s_suppkey')} AS unitid, s_name FROM supplier WHERE s_suppkey <= 20), b AS (SELECT {_CLEAN.format('c_custkey')} AS unitid, c_name FROM customer WHERE c_custkey <= 20) SELECT a.unitid, s_name, c_name FROM a JOIN b ON a.unitid IS NOT DISTINCT FROM b.unitid")
def missing_keys_meet(spark: SparkSession, d: str) -> DataFrame:
    """Inner join of two cohorts on cleaned keys, in which missing keys match each other."""
    a = _messy(parquet(spark, d, "supplier").where("s_suppkey <= 20"), "s_suppkey").select("unitid", "s_name")
    b = _messy(parquet(spark, d, "customer").where("c_custkey <= 20"), "c_custkey").select("unitid", "c_name")
    return keys.inner_with_missing(a, b, "unitid")


@query("SELECT c_custkey AS unitid, c_name AS name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def left_only_anti(spark: SparkSession, d: str) -> DataFrame:
    """Cohort rows without a finished order."""
    done = parquet(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("unitid"))
    return keys.only_left(_customers(spark, d), done, "unitid", with_missing=False)


@query(f"WITH a AS (SELECT {_CLEAN.format('c_custkey')} AS unitid, CASE WHEN c_custkey % 20 = 1 THEN '  ' ELSE c_name END AS name FROM customer) SELECT unitid, name, row_number() OVER (ORDER BY unitid IS NOT NULL, unitid, name) AS place FROM a WHERE (unitid IS NULL OR CAST(unitid AS BIGINT) % 2 = 0) AND NOT (unitid IS NULL AND trim(name) = '')")
def baseline_only_sorted(spark: SparkSession, d: str) -> DataFrame:
    """Baseline rows outside the cohort, those without a key too and first, blank rows left out."""
    rows = _messy(parquet(spark, d, "customer"), "c_custkey").select("unitid", F.when(F.col("c_custkey") % 20 == 1, "  ").otherwise(F.col("c_name")).alias("name"))
    cohort = rows.where("try_cast(unitid as long) % 2 = 1").select("unitid")
    left = keys.drop_blank_rows(keys.only_left(rows, cohort, "unitid", with_missing=True))
    order = (F.col("unitid").isNull().desc(), F.col("unitid"), F.col("name"))
    return frames.numbered(left, *order, name="place").withColumn("place", F.col("place") + 1)


@query("SELECT c_custkey AS unitid, c_name AS name, coalesce(label, '') AS baseline FROM customer LEFT JOIN (SELECT o_custkey, trim(substr(t, strpos(t, ',') + 1)) AS label FROM (SELECT o_custkey, 'clerk ' || o_orderstatus || ', ' || o_orderpriority || ', x' AS t, o_totalprice, o_orderkey FROM orders) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1) ON o_custkey = c_custkey")
def baseline_attach(spark: SparkSession, d: str) -> DataFrame:
    """Cohort with the label of its last baseline row, what follows the first comma, blank where there is none."""
    rows = parquet(spark, d, "orders").withColumn("t", F.concat(F.lit("clerk "), "o_orderstatus", F.lit(", "), "o_orderpriority", F.lit(", x")))
    last = keys.keep_one(rows, ["o_custkey"], F.col("o_totalprice").desc(), F.col("o_orderkey").desc())
    label = last.select(F.col("o_custkey").alias("unitid"), F.trim(F.split("t", ",", 2)[1]).alias("baseline"))
    return keys.attach(_customers(spark, d), label, "unitid")


@query("SELECT c_custkey AS unitid, CASE WHEN c_custkey % 3 = 0 THEN 'www.fast' || c_custkey || '.edu' WHEN c_custkey % 3 = 1 THEN 'www.slow' || c_custkey || '.edu' ELSE '' END AS web_address FROM customer")
def website_attach(spark: SparkSession, d: str) -> DataFrame:
    """Web address of each institution: as first read, or as read again more slowly."""
    k, rows = F.col("unitid"), _customers(spark, d).select("unitid")
    fast = rows.withColumn("web_address", F.when(k % 3 == 0, F.concat(F.lit("www.fast"), k.cast("string"), F.lit(".edu"))).otherwise(" "))
    slow = rows.where("unitid % 3 != 2").withColumn("web_address", F.concat(F.lit("www.slow"), k.cast("string"), F.lit(".edu")))
    return fresh_or_slow(fast, slow, "unitid", "web_address")


@query("SELECT c_custkey AS unitid, c_name AS name, coalesce(CAST(n AS VARCHAR), '') AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def characteristics_enrich(spark: SparkSession, d: str) -> DataFrame:
    """Cohort with characteristics of its key, blank where there are none."""
    found = parquet(spark, d, "orders").groupBy(F.col("o_custkey").alias("unitid")).agg(F.count(F.lit(1)).cast("string").alias("n_orders"))
    return cells.enrich(_customers(spark, d), found.unionByName(found), "unitid")


@query("SELECT s_suppkey AS unitid, s_name AS name, '' AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Two cohorts under one header, missing columns blank."""
    a = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"), F.col("s_name").alias("name"))
    b = parquet(spark, d, "customer").select(F.col("c_custkey").alias("unitid"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return keys.union_all(a, b)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS unitid, s_name AS name, '' AS segment, '' AS note FROM supplier UNION ALL SELECT CAST(c_custkey AS VARCHAR), '', coalesce(c_mktsegment, ''), '' FROM customer")
def union_of_cohorts(spark: SparkSession, d: str) -> DataFrame:
    """Two cohorts as text under the columns of the first, then the second's, then an extra one, nothing null."""
    a = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"), F.col("s_name").alias("name"))
    b = parquet(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("unitid"))
    return frames.stable(frames.union_with_columns(a, b), ["note"])


@query("SELECT c_custkey AS unitid, c_name AS name, first_order FROM customer JOIN (SELECT o_custkey, min(o_orderkey) AS first_order FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def annotated_inner(spark: SparkSession, d: str) -> DataFrame:
    """Cohort rows that were annotated, with their first annotation."""
    right = parquet(spark, d, "orders").select(F.col("o_custkey").alias("unitid"), F.col("o_orderkey").alias("first_order"))
    return frames.annotated(_customers(spark, d), right, "unitid", ["first_order"], F.col("first_order"))


_LEVEL = "CASE WHEN doc_id % 6 = 0 THEN 'strict_raw' WHEN doc_id % 6 = 1 THEN 'fuzzy_syn' WHEN doc_id % 6 = 5 THEN '' ELSE 'NO_MATCH' END"
_CRAWL = "CASE WHEN doc_id % 4 = 0 THEN 'Sufficient majors' ELSE 'warning_10_MajorsFound' END"
_CV = "CASE WHEN doc_id % 5 = 0 THEN 'passed_ctrl_thresh' ELSE 'cv_unresolved' END"
_THEN, _NOW = "CASE WHEN doc_id % 7 < 3 THEN 'Ethnic Studies' ELSE ' ' END", "CASE WHEN doc_id % 3 = 0 THEN 'Black Studies' ELSE '' END"
_REVIEWED = f"SELECT doc_id, {_LEVEL} AS match_level, {_CRAWL} AS crawl, {_CV} AS cv, {_THEN} AS reference, {_NOW} AS discovered FROM documents"
_SPLITS = f"""SELECT doc_id, unnest(CASE WHEN NOT enough THEN ['01_inadequate_controls'] WHEN s IS NULL THEN ['02_adequate_controls'] ELSE ['02_adequate_controls', s] END) AS split FROM (
  SELECT doc_id, lower(crawl) = 'sufficient majors' OR cv = 'passed_ctrl_thresh' AS enough,
    CASE WHEN match_level = 'strict_raw' THEN '03_strict_match' WHEN match_level = 'fuzzy_syn' THEN '04_non_strict_match' WHEN match_level = '' THEN NULL
      WHEN trim(reference) = '' AND discovered <> '' THEN '05_no_match__2013_empty__now_something' WHEN trim(reference) <> '' AND discovered = '' THEN '06_no_match__2013_something__now_nothing'
      WHEN trim(reference) <> '' AND discovered <> '' THEN '07_no_match__2013_something__now_something_else' END AS s FROM ({_REVIEWED}))"""


def _reviewed(spark: SparkSession, d: str) -> DataFrame:
    rows = parquet(spark, d, "documents").select("doc_id", *[F.expr(e).alias(n) for e, n in ((_LEVEL, "match_level"), (_CRAWL, "crawl"), (_CV, "cv"), (_THEN, "reference"), (_NOW, "discovered"))])
    return frames.review_splits(rows, frames.enough_controls(F.col("crawl"), F.col("cv")), "match_level", "reference", "discovered")


@query(f"SELECT split, count(*) AS n FROM ({_SPLITS}) GROUP BY split")
def qa_splits(spark: SparkSession, d: str) -> DataFrame:
    """Review sets and their sizes."""
    return _reviewed(spark, d).select(F.explode("splits").alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH s AS ({_SPLITS}), k AS (SELECT doc_id, bool_or(split = '02_adequate_controls') AS enough, count(*) FILTER (split NOT IN ('01_inadequate_controls', '02_adequate_controls')) AS n FROM s GROUP BY doc_id) SELECT count(*) AS n_keys, count(*) FILTER (enough) AS n_adequate, count(*) FILTER (enough AND n = 1) AS n_once, count(*) FILTER (n > 1) AS n_overlap, count(*) FILTER (enough AND n = 0) AS n_uncovered FROM k")
def qa_partition(spark: SparkSession, d: str) -> DataFrame:
    """How far the review sets are a partition: keys in one set, in several, in none."""
    return frames.check_partition(_reviewed(spark, d), ["doc_id"])


@query("SELECT 'lang' AS \"column\", count(*) FILTER (trim(coalesce(lang, '')) <> '') AS filled, count(*) AS total FROM documents UNION ALL SELECT 'source', count(*) FILTER (trim(coalesce(source, '')) <> ''), count(*) FROM documents")
def fill_rates(spark: SparkSession, d: str) -> DataFrame:
    """How many rows have text in each column."""
    return frames.fill_rates(parquet(spark, d, "documents").select("lang", "source"))


@query("SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_keys, count(*) - count(DISTINCT user_id) AS n_repeats FROM events WHERE user_id IS NOT NULL")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Rows, distinct keys and repeats."""
    return frames.duplicate_keys(parquet(spark, d, "events"), "user_id")


@query("SELECT l_suppkey AS unitid, string_agg(DISTINCT l_returnflag || l_linestatus, '|' ORDER BY l_returnflag || l_linestatus) AS modes, CAST(max(l_linenumber >= 5) AS INT) AS any_late, CASE WHEN count(DISTINCT l_returnflag || l_linestatus) < 4 THEN 'warning_4_MajorsFound' ELSE 'sufficient majors' END AS label FROM lineitem GROUP BY l_suppkey")
def union_sets(spark: SparkSession, d: str) -> DataFrame:
    """What the pages of an institution name together, and whether it is enough."""
    from ..functions.pages import sufficiency

    modes = F.array_sort(F.collect_set(F.concat("l_returnflag", "l_linestatus")))
    found = parquet(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("unitid")).agg(modes.alias("m"), F.max((F.col("l_linenumber") >= 5).cast("int")).alias("any_late"))
    return found.select("unitid", F.array_join("m", "|").alias("modes"), "any_late", sufficiency(F.size("m"), 4).alias("label"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 100 + 1 AS INT) AS batch FROM orders")
def row_batches(spark: SparkSession, d: str) -> DataFrame:
    """Rows numbered in order, and their batches of a hundred."""
    return frames.batches(frames.numbered(parquet(spark, d, "orders").select("o_orderkey"), F.col("o_orderkey")), 100)


@query("SELECT l_orderkey, l_linenumber, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS any_returned FROM lineitem")
def group_flags(spark: SparkSession, d: str) -> DataFrame:
    """Rows with whether any row of their group has a mark."""
    flag = F.max(F.col("l_returnflag") == "R").over(Window.partitionBy("l_orderkey"))
    return parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", flag.alias("any_returned"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def head_sample(spark: SparkSession, d: str) -> DataFrame:
    """The first twenty rows, as the sampling operator takes them."""
    return frames.head(parquet(spark, d, "orders").select("o_orderkey", "o_totalprice"), 20, F.col("o_orderkey"))


@query("SELECT c_custkey AS unitid, c_name AS name, lower(c_name) AS label, '' AS note FROM customer")
def shaped_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns kept, renamed, inserted after another and added, in a stable order."""
    rows = frames.without(parquet(spark, d, "customer"), "c_comment", c_custkey="unitid", c_name="name")
    return frames.keep_list(frames.insert_after(rows, "name", "label", F.lower("name")).withColumn("note", F.lit("")), ["unitid", "name", "label", "absent", "note"])


@query("SELECT c_custkey, lower(c_mktsegment) IN ('building', 'machinery') AS wanted, CASE WHEN c_custkey % 4 = 0 AND c_custkey % 3 <> 0 THEN 'filled' WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS bucket FROM customer")
def masked_assign(spark: SparkSession, d: str) -> DataFrame:
    """Membership in any case, and a blank column filled where a mask holds."""
    rows = parquet(spark, d, "customer").withColumn("bucket", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise(""))
    filled = frames.assign(rows, "bucket", F.col("c_custkey") % 4 == 0, F.lit("filled"))
    return filled.select("c_custkey", frames.is_in(F.col("c_mktsegment"), ("Building", "MACHINERY")).alias("wanted"), "bucket")


@query(r"""SELECT c_custkey, cell, regexp_matches(trim(cell), '^[$]?\s*\d[\d,]*(\.\d+)?\s*%?$') AS is_number FROM (SELECT c_custkey, unnest([c_name, '$' || CAST(c_custkey AS VARCHAR) || ',000', CAST(c_nationkey AS VARCHAR) || ' %', c_mktsegment]) AS cell FROM customer)""")
def numericish_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a table and whether they read as numbers."""
    listed = F.array("c_name", F.concat(F.lit("$"), F.col("c_custkey").cast("string"), F.lit(",000")), F.concat(F.col("c_nationkey").cast("string"), F.lit(" %")), "c_mktsegment")
    return parquet(spark, d, "customer").select("c_custkey", F.explode(listed).alias("cell")).withColumn("is_number", U.numericish(F.col("cell")))
