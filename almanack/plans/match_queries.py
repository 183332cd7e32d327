"""Queries that compare titles: keys and flags, candidates, the match ladder, alignment, schools and majors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions import pages as T
from ..operators import candidates, ladder, matching, schools
from ..sources.tables import parquet
from . import golden
from .base import literals, query, values

_COMPARED = ("title", "strict_key", "loose_key", "bare", "with_synonyms", "tokens", "families", "flags", "class_third_party", "without_prefix", "page_key", "page_loose_key")
_FLAGS = (
    ("signal", C.is_signal), ("credential", C.has_credential), ("strong", C.is_strong), ("rename", C.is_rename_family), ("navigation", C.is_navigation), ("nonprogram", C.is_nonprogram), ("year", C.has_year),
    ("mega", C.is_mega), ("boilerplate", C.is_boilerplate), ("fragment", C.is_fragment), ("taxonomy", C.is_taxonomy_label), ("academic", C.is_academic_ref), ("organisation", C.is_organisation),
)


def _dealt(spark: SparkSession, d: str, n: int) -> DataFrame:
    return parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"), (F.col("s_suppkey") % n).alias("k"))


@query(f"SELECT s_suppkey AS unitid, {', '.join(_COMPARED)} FROM supplier JOIN {values(golden.COMPARED, *_COMPARED)} ON k = s_suppkey % {len(golden.COMPARED)}")
def compared_titles(spark: SparkSession, d: str) -> DataFrame:
    """Keys, tokens, families, flags and class of titles as they are compared."""
    t = F.col("title")
    rows = _dealt(spark, d, len(golden.COMPARED)).join(literals(spark, [(g[0],) for g in golden.COMPARED], "title string"), "k")
    made = [
        t, C.strict_key(t), C.loose_key(t), C.canonical(t, parentheses=False), C.with_synonyms(t), F.array_join(F.array_sort(C.tokens(t)), "|"), F.array_join(C.families(t), "|"),
        F.concat_ws("|", *[F.when(rule(t), F.lit(name)) for name, rule in _FLAGS]), C.title_class(t, F.lit(True)), C.without_prefix(t), T.strict_key(t), T.loose_key(t),
    ]
    return rows.select("unitid", *[c.alias(name) for c, name in zip(made, _COMPARED)])


@query(f"SELECT s_suppkey AS unitid, pos, title, source, kind FROM supplier JOIN {values(golden.CANDIDATES, 'cell', 'pos', 'title', 'source', 'kind')} ON cell = s_suppkey % {len(golden.CELLS)}")
def candidate_titles(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of the cells of three sources, recombined ones first."""
    cells = literals(spark, golden.CELLS, "ref string, crawl string, cv string, signals string")
    rows = _dealt(spark, d, len(golden.CELLS)).join(cells, "k")
    found = candidates.candidate_rows(rows, ["unitid"], "ref", "crawl", "cv", "signals")
    return found.where("pos is not null").select("unitid", "pos", "title", "source", "kind")


_MATCHED = ("best_title", "best_source", "best_kind", "match_level", "match_score", "detail")


@query(f"SELECT s_suppkey AS unitid, ref, best_title, best_source, best_kind, match_level, round(match_score, 9) AS match_score, detail FROM supplier JOIN {values([(m[0], *m[2]) for m in golden.MATCHES], 'ref', *_MATCHED)} ON k = s_suppkey % {len(golden.MATCHES)}")
def match_ladder(spark: SparkSession, d: str) -> DataFrame:
    """The candidate of each institution that continues its reference title, by the whole ladder."""
    listed = [(k, ref, "", pos, *c) for k, (ref, some, _) in enumerate(golden.MATCHES) for pos, c in enumerate(some)]
    found = F.broadcast(spark.createDataFrame(listed, "k long, ref string, added string, pos int, title string, source string, kind string"))
    rows = _dealt(spark, d, len(golden.MATCHES)).join(found, "k").drop("k")
    out = ladder.matched(rows, ["unitid"])
    return out.select("unitid", "ref", *_MATCHED[:-2], F.round("match_score", 9).alias("match_score"), "detail")


_DISCOVERED = (
    "ref", *_MATCHED, "is_signal_ref", "recombined_added", "discovered_crawl", "discovered_cv", "discovered_signals", "discovered_all", "discovered_new_unmatched", "discovered_new_when_best_signal",
)


@query(f"SELECT s_suppkey AS unitid, {', '.join(_DISCOVERED)} FROM supplier JOIN {values(golden.DISCOVERED, *_DISCOVERED)} ON k = s_suppkey % {len(golden.CELLS)}")
def match_rows(spark: SparkSession, d: str) -> DataFrame:
    """The match of each institution and all else that was discovered, from its cells."""
    cells = literals(spark, golden.CELLS, "ref string, crawl string, cv string, signals string")
    rows = _dealt(spark, d, len(golden.CELLS)).join(cells, "k")
    return ladder.assembled(candidates.candidate_rows(rows, ["unitid"], "ref", "crawl", "cv", "signals"), ["unitid"])


_ASCII = [(t[0],) for t in golden.TITLES if t[0] and t[0].isascii() and "&" not in t[0]]
_PAGE_KEY = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\b(program|department|major|minor|concentration|certificate|track|option)\b', ' ', 'g'), '\b(the|of|in|for|and|to|a|an)\b', ' ', 'g'), '[^\w\s-]', ' ', 'g'), '\s+', ' ', 'g'))"
_TOKENS = "list_distinct(list_filter(regexp_split_to_array({0}, '[\\s_-]+'), lambda w: length(w) >= 3))"


@query(f"""WITH t AS {values(_ASCII, 'title')}, pairs AS (SELECT l_suppkey AS unitid, a.title AS "left", b.title AS "right" FROM
    (SELECT DISTINCT l_suppkey, l_partkey % {len(_ASCII)} AS x, l_orderkey % {len(_ASCII)} AS y FROM lineitem) JOIN t a ON a.k = x JOIN t b ON b.k = y),
  sets AS (SELECT *, {_TOKENS.format(_PAGE_KEY.format('lower("left")'))} AS a, {_TOKENS.format(_PAGE_KEY.format('lower("right")'))} AS b FROM (SELECT DISTINCT * FROM pairs))
  SELECT unitid, "left", "right", CASE WHEN least(len(a), len(b)) = 0 THEN 0.0 ELSE CAST(len(list_intersect(a, b)) AS DOUBLE) / least(len(a), len(b)) END AS overlap FROM sets""")
def token_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Shared words of pairs of titles, as a part of the shorter's."""
    t = literals(spark, _ASCII, "title string")
    # equal titles have one number, so numbers are made distinct instead of texts
    number = F.array(*[F.lit(_ASCII.index(row)) for row in _ASCII])
    lines = parquet(spark, d, "lineitem")
    x, y = (F.get(number, (F.col(key) % len(_ASCII)).cast("int")) for key in ("l_partkey", "l_orderkey"))
    met = matching.distinct_rows(lines.select(F.col("l_suppkey").alias("unitid"), (x * len(_ASCII) + y).alias("xy")), lines.count())
    left, right = t.select(F.col("k").alias("x"), F.col("title").alias("left")), t.select(F.col("k").alias("y"), F.col("title").alias("right"))
    pairs = met.join(left, F.floor(F.col("xy") / len(_ASCII)) == F.col("x")).join(right, F.col("xy") % len(_ASCII) == F.col("y")).select("unitid", "left", "right")
    return matching.scored_pairs(pairs, "left", "right", synonyms=False).select("unitid", "left", "right", "overlap")


#: Titles of two sources, and the pairs they make: left, right, score.
_LEFT = ("Black Studies", "Ethnic Studies Program", "Department of Music", "Women's Studies")
_RIGHT = ("Ethnic Studies", "Africana Studies", "Women Studies", "Physics")
_PAIRS = (("Black Studies", "Africana Studies", 1.0), ("Ethnic Studies Program", "Ethnic Studies", 1.0), ("Women's Studies", "Women Studies", 1.0))


@query(f"""SELECT s_suppkey AS unitid, p."left", p."right", score FROM supplier, {values(_PAIRS, '"left"', '"right"', 'score')} p""")
def aligned_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles of two sources of an institution paired one to one."""
    sides = [literals(spark, [(t,) for t in side], f"{name} string").withColumnRenamed("k", at) for side, name, at in ((_LEFT, "left", "i"), (_RIGHT, "right", "j"))]
    ids = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"))
    pairs = ids.join(sides[0]).join(sides[1])  # two short lists of an institution
    return matching.align(pairs, ["unitid"], 0.80).select("unitid", "left", "right", "score")


@query("""SELECT s_suppkey AS unitid, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END AS concordant,
  CASE WHEN s_suppkey % 2 = 0 THEN 'inst="Ethnic Studies" ~ other="ethnic studies program" score=1.00' ELSE '' END AS detail FROM supplier""")
def title_concordance(spark: SparkSession, d: str) -> DataFrame:
    """Whether the titles of two sources of an institution agree somewhere, and where."""
    ids = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"))
    other = F.when(F.col("unitid") % 2 == 0, "ethnic studies program").otherwise("Physics")
    pairs = ids.select("unitid", F.lit("Ethnic Studies").alias("left"), F.explode(F.array(other, F.lit("Zoology"))).alias("right"))
    return matching.concordance(matching.best_pair(pairs, ["unitid"], "left", "right", F.col("right"))).select("unitid", "concordant", "detail")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS strict, CASE WHEN p_partkey % 3 < 2 THEN 1 ELSE 0 END AS loose FROM part""")
def key_concordance(spark: SparkSession, d: str) -> DataFrame:
    """Whether a field and a list of titles share one: as it is, and without levels and stop-words."""
    field = F.when(F.col("p_partkey") % 3 == 0, "Music; Ethnic Studies!").when(F.col("p_partkey") % 3 == 1, "The Ethnic Studies Program|Art").otherwise("A, B, C")
    a, b = T.split_field(field), F.array(F.lit("ethnic studies"), F.lit("Latin"))
    return parquet(spark, d, "part").select("p_partkey", T.concordant(T.key_set(a), T.key_set(b)).alias("strict"), T.concordant(T.key_set(a, True), T.key_set(b, True)).alias("loose"))


#: Third-party schools, and names with the school they come to.
_SCHOOLS = (("s1", "albion-college", "Albion College"), ("s2", "augustana-college", "Augustana College"), ("s3", "asa-college", "ASA College"), ("s4", "the-ohio-state-university", "Ohio State University"))
_NAMES = (("Albion College", "s1"), ("Augustana College (IL)", "s2"), ("Nowhere Institute", None), ("Ohio State Univ", "s4"))


@query(f"SELECT s_suppkey AS unitid, school_id FROM supplier JOIN {values(_NAMES, 'name', 'school_id')} ON k = s_suppkey % {len(_NAMES)} WHERE school_id IS NOT NULL")
def resolved_schools(spark: SparkSession, d: str) -> DataFrame:
    """The third-party school of each institution's name, by slug or by likeness among those with a word in common."""
    names = _dealt(spark, d, len(_NAMES)).join(literals(spark, [(n,) for n, _ in _NAMES], "name string"), "k")
    return schools.resolve(names, spark.createDataFrame(_SCHOOLS, "id string, slug string, name string"), "unitid", "name").select("unitid", "school_id")


_SLUGS = (
    ("The Ohio State University (Main Campus)", "the-ohio-state-university-main-campus|the-ohio-state-university|the-ohio-main|ohio-state-university-main-campus"),
    ("St. John's College", "st-johns-college|st-johns"), ("", ""), ("Texas A&M", "texas-a-and-m"),
)


@query(f"SELECT s_suppkey AS unitid, slugs FROM supplier JOIN {values(_SLUGS, 'name', 'slugs')} ON k = s_suppkey % {len(_SLUGS)}")
def school_slugs(spark: SparkSession, d: str) -> DataFrame:
    """Ways in which a school's name may stand in addresses."""
    names = _dealt(spark, d, len(_SLUGS)).join(literals(spark, [(n,) for n, _ in _SLUGS], "name string"), "k")
    return names.select("unitid", F.array_join(T.slug_candidates(F.col("name")), "|").alias("slugs"))


_MAJORS = ((None, "05.0101", None, "African Studies"), ("05.0200", None, None, "Ethnic Studies"), (None, None, "26", "Biology and Chemistry"), ("05.0200", None, None, "Ethnic Studies Major"), (None, None, None, "Nameless"))


@query("""SELECT s_suppkey AS unitid, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS control_hits, CASE WHEN s_suppkey % 2 = 0 THEN 'African Studies' ELSE 'Ethnic Studies Major' END AS titles, 1 AS site FROM supplier""")
def third_party_majors(spark: SparkSession, d: str) -> DataFrame:
    """Subjects and program titles among the majors of each school, by their codes."""
    entries = spark.createDataFrame([(*m, i) for i, m in enumerate(_MAJORS)], "cipCode string, cip string, id string, name string, ord int")
    codes = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("26"), F.lit("05.0101"), F.lit("99"))).otherwise(F.array(F.lit("05.0200"), F.lit("05.0200")))
    own = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("school_id"), codes.alias("codes"))
    listed = schools.majors_of(own, schools.majors_table(entries))
    out = schools.third_party(own, listed)
    return out.select(F.col("school_id").alias("unitid"), "control_hits", F.array_join("titles", "|").alias("titles"), "site")
