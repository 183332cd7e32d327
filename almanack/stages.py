"""The stages of an inventory from end to end, each from tables to tables, with the columns that users know.

Every stage is lazy but for the tables that its operators settle.  Cohorts have a ``unitid`` (text) and a ``name``;
rows keep all their columns and their order is that of ``row_index`` where one is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import pages as T
from .functions import titles, urls
from .functions.text import squeezed, title_text
from .operators import candidates, cells, crawl, frames, inventory, keys, ladder, schools
from .operators import pages as P
from .sources.html import parse_profiles, website_column
from .sources.tables import kept

UNIT, NAME, WEB, REFERENCE = "unitid", "name", "Web_address", "2013_program_name"
CRAWLED, THIRD_PARTY, SIGNALS = "program_titles_found", "college_vine_program_titles_found", "real_nonprogram_signals"
PROFILE_SITE = "nces.ed.gov"


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn(UNIT, keys.clean_key(F.col(UNIT)))


def merge_cohorts(cohort: DataFrame, baseline: DataFrame) -> dict[str, DataFrame]:
    """Stage 0a: rows of both (missing keys match each other), of the baseline alone (those without a key first), of the cohort alone."""
    a, b = _keyed(keys.drop_blank_rows(cohort)), _keyed(keys.drop_blank_rows(baseline))
    shared = [c for c in b.columns if c != UNIT and c in a.columns]
    right = b.select(*[F.col(f"`{c}`").alias(f"{c}_2013comp" if c in shared else c) for c in b.columns])
    only = keys.only_left(b, a.where(F.col(UNIT).isNotNull()), UNIT, with_missing=True)
    return {
        "inner": keys.inner_with_missing(a, right, UNIT),
        "baseline_only": only.orderBy(F.col(UNIT).isNull().desc(), UNIT, *[F.col(f"`{c}`") for c in only.columns if c != UNIT]),
        "cohort_only": keys.only_left(a, b, UNIT, with_missing=False),
    }


def attach_websites(cohort: DataFrame, profiles: DataFrame, slow: DataFrame | None = None, after: str = NAME) -> DataFrame:
    """Stage 0b: ``Web_address`` from the text of profile pages (``unitid, body_text``), read again where the first reading has none."""

    def found(pages: DataFrame) -> DataFrame:
        out = pages.select(keys.clean_key(F.col(UNIT)).alias("_u"), urls.address_in_text(F.coalesce("body_text", F.lit(""))).alias("_w")).where("_u is not null")
        return out.groupBy("_u").agg(F.min(F.when(F.col("_w") != "", F.col("_w"))).alias("_w"))

    first = found(profiles)
    if slow is not None:
        first = first.join(found(slow).withColumnRenamed("_w", "_s"), "_u", "full").select("_u", F.coalesce("_w", "_s").alias("_w"))
    joined = _keyed(cohort).join(first, F.col(UNIT) == F.col("_u"), "left")
    return frames.insert_after(joined.drop("_u"), after, WEB, F.coalesce("_w", F.lit(""))).drop("_w")


def websites_from_html(cohort: DataFrame, responses: DataFrame, after: str = NAME) -> DataFrame:
    """Stage 0b over raw pages (``unitid, http_status, html``; null status: the request failed): ``Web_address`` and ``web_status``."""
    read = responses.select(keys.clean_key(F.col(UNIT)).alias("_u"), F.col("http_status").alias("_h"), website_column(F.col("html"), PROFILE_SITE).alias("_w"))
    joined = _keyed(cohort).join(read, F.col(UNIT) == F.col("_u"), "left")
    good = (F.col("_h") == 200) & (F.coalesce(F.trim("_w"), F.lit("")) != "")
    status = F.when(F.col(UNIT).isNull(), "missing_unitid").when(good, "ok").when(F.col("_h") == 200, "no_web_found").when(F.col("_h").isNotNull(), F.concat(F.lit("http_"), F.col("_h").cast("string"))).otherwise("exception")
    out = joined.withColumn("web_status", status)
    return frames.insert_after(out, after, WEB, F.when(good, F.trim("_w")).otherwise("")).drop("_u", "_h", "_w")


def attach_baseline(cohort: DataFrame, baseline: DataFrame) -> DataFrame:
    """Stage 0c: ``2013_program_name``, what follows the first comma of the baseline's name; of a key's rows one with such a name, the last by text."""
    label = F.coalesce(F.trim(F.get(F.split(F.coalesce(NAME, F.lit("")), ",", 2), F.lit(1))), F.lit(""))
    rows = baseline.select(keys.clean_key(F.col(UNIT)).alias("_u"), label.alias("_p")).where("_u is not null")
    last = rows.groupBy("_u").agg(F.max_by("_p", F.struct(F.col("_p") != "", "_p")).alias("_p"))
    joined = _keyed(cohort).join(last, F.col(UNIT) == F.col("_u"), "left")
    return frames.insert_after(joined, NAME, REFERENCE, F.coalesce("_p", F.lit(""))).drop("_u", "_p")


def crawl_sites(cohort: DataFrame, snapshot: DataFrame, sitemaps: DataFrame | None = None, statuses: DataFrame | None = None, third_party: DataFrame | None = None, strictness: int = 3) -> DataFrame:
    """Stage A: the computed columns of each institution, over a page snapshot (``url, html``).

    ``statuses`` (``unitid, code``) are answers met while the snapshot was taken; ``third_party`` is what
    :func:`third_party_titles` gives.
    """
    sites = _keyed(cohort).select(UNIT, F.col(WEB)).where(F.col(UNIT).isNotNull()).groupBy(UNIT).agg(F.max(WEB).alias(WEB))
    found = crawl.inventory(sites, snapshot, UNIT, WEB, sitemaps, strictness)
    found = found.withColumnsRenamed({"best_url": "best_guess_inventory_url", "best_reason": "best_guess_inventory_reason", "alt_urls": "alt_candidate_urls"})
    if statuses is not None:
        seen = found.select(UNIT, F.col("best_guess_inventory_url").alias("_b")).join(statuses.select(keys.clean_key(F.col(UNIT)).alias(UNIT), "code"), UNIT, "left")
        found = found.join(P.status_label(seen, [UNIT], "code", "_b").withColumnRenamed("label", "url_tag"), UNIT, "left")
    if third_party is not None:
        found = found.join(third_party, UNIT, "left")
    out = _keyed(cohort).join(found.drop(WEB), UNIT, "left")
    extra = [
        "best_guess_inventory_url", "best_guess_inventory_reason", "url_tag", "alt_candidate_urls", "any_control_found", "struct_hits_union", ">0_struct_hits_found", "program_title_count", CRAWLED, "pdf_hits",
        "total_controls_found", "controls_sufficiency", "status", "error_detail", "college_vine_site", "college_vine_url", "college_vine_ctrl_status", "college_vine_program_title_count", THIRD_PARTY,
        *[f"{k}_matches" for k in T.TARGET_TOKENS], *T.CONTROL_TERMS,
    ]
    return frames.stable(out, [*cohort.columns, *extra])


def third_party_titles(cohort: DataFrame, known: DataFrame, majors: DataFrame, blocked: Column | None = None, base_url: str = "https://www.collegevine.com/schools", strictness: int = 3) -> DataFrame:
    """``unitid`` and the third-party columns: the school of each name in ``known`` (``id, slug, name, codes``), the titles among its majors (entries of ``majors``)."""
    names = _keyed(cohort).select(UNIT, squeezed(F.col(NAME)).alias(NAME)).where(F.col(UNIT).isNotNull()).dropDuplicates([UNIT, NAME])
    resolved = schools.resolve(names, known, UNIT, NAME)
    own = known.select(F.col("id").cast("string").alias("school_id"), "codes")
    found = schools.third_party(own, schools.majors_of(own, schools.majors_table(majors)), strictness=strictness)
    out = names.join(resolved, UNIT, "left").join(found, "school_id", "left")
    slug = F.coalesce(F.when(F.col("school_slug") != "", F.col("school_slug")), F.get(T.slug_candidates(F.col(NAME)), F.lit(0)))
    site = F.coalesce("site", F.lit(0))
    return out.select(
        UNIT, site.cast("string").alias("college_vine_site"), F.when(slug.isNull(), "").otherwise(F.concat(F.lit(base_url + "/"), slug, F.lit("/majors"))).alias("college_vine_url"),
        P.third_party_status(F.lit(False) if blocked is None else blocked, site, F.coalesce("control_hits", F.lit(0)), F.lit(False)).alias("college_vine_ctrl_status"),
        F.coalesce("title_count", F.lit(0)).alias("college_vine_program_title_count"), F.coalesce(F.array_join("titles", "|"), F.lit("")).alias(THIRD_PARTY),
    )


def bucket_titles(rows: DataFrame, *order: Column) -> dict[str, DataFrame]:
    """Stage B: the wide table and the long ones: all evidence, signals, provenance, programs by source and over both.

    Rows are numbered by ``order``, else by all their columns.
    """
    base = frames.stable(rows, [CRAWLED, THIRD_PARTY])
    base = base.withColumn(REFERENCE, title_text(F.col(f"`{REFERENCE}`"))) if REFERENCE in base.columns else base
    base = kept(frames.numbered(base, *(order or [F.col(f"`{c}`") for c in base.columns])))
    evidence = inventory.evidence(base, {"crawl": CRAWLED, "cv": THIRD_PARTY}, ["row_index", UNIT])
    known = titles.filled(titles.canonical_columns(titles.classified(evidence.select("source", "raw_title").distinct())))
    long = kept(evidence.join(known, ["source", "raw_title"]))
    programs, units = long.where("is_program = 1 and bucket != ''"), ["row_index", UNIT]
    folded = inventory.expand_offers(inventory.fold_to_anchor(programs.withColumn("pos", F.struct("row_index", "pos")), [UNIT]))
    by_source = inventory.by_source(folded, [UNIT])
    signals = long.where(F.col("title_kind").isin(*titles.P.SIGNAL_KINDS))
    wide = base.join(inventory.wide(programs, ["row_index"]), "row_index", "left").join(inventory.signal_cells(long, ["row_index"]), "row_index", "left")
    shown = {"conf": "program_conf", "conf_reason": "program_conf_reason", "is_program": "is_program_title"}
    return {
        "wide": wide.drop("row_index").fillna(""), "long": long.drop("title", "n_words").withColumnsRenamed(shown), "long_signals": signals.drop("title", "n_words").withColumnsRenamed(shown),
        "long_bucket_summary": inventory.provenance_summary(long, units), "long_programs": by_source, "long_programs_agg": inventory.across_sources(by_source, [UNIT]),
    }


_MATCH = {
    "best_title": "match_2013__best_title", "best_source": "match_2013__best_source", "best_kind": "match_2013__best_kind", "match_level": "match_2013__match_level", "match_score": "match_2013__match_score",
    "detail": "match_2013__detail", "is_signal_ref": "match_2013__is_signal_marker_in_2013", "recombined_added": "debug__recombined_candidates_added", "discovered_crawl": "discovered__program_titles__crawl",
    "discovered_cv": "discovered__program_titles__cv", "discovered_signals": "discovered__signal_titles", "discovered_all": "discovered__all_titles", "discovered_new_unmatched": "discovered__new_titles_unmatched",
    "discovered_new_when_best_signal": "discovered__new_program_titles_when_best_signal",
}


def match_titles(wide: DataFrame, fuzzy: float = ladder.FUZZY, categories: bool = False) -> DataFrame:
    """Stage C: the wide table with the match of each row's reference title and what else was discovered."""
    missing = [c for c in (UNIT, REFERENCE, CRAWLED, THIRD_PARTY) if c not in wide.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    rows = kept(wide.withColumn("_row", F.monotonically_increasing_id()))
    found = candidates.candidate_rows(rows, ["_row"], REFERENCE, CRAWLED, THIRD_PARTY, SIGNALS if SIGNALS in wide.columns else None)
    matched = ladder.assembled(found, ["_row"], fuzzy, categories).drop("ref").withColumnsRenamed(_MATCH)
    return rows.join(matched, "_row").drop("_row")


def review(matched: DataFrame, least_controls: int | None = None) -> DataFrame:
    """Stage D: rows with the review sets they are in (``splits``)."""
    rows = frames.stable(matched, ["controls_sufficiency", "college_vine_ctrl_status", "total_controls_found", "match_2013__match_level", REFERENCE, "discovered__all_titles"])
    enough = frames.enough_controls(F.col("controls_sufficiency"), F.col("college_vine_ctrl_status"), F.col("total_controls_found"), least_controls)
    return frames.review_splits(rows, enough, "match_2013__match_level", REFERENCE, "discovered__all_titles")


def add_characteristics(rows: DataFrame, workbooks: DataFrame, profiles: DataFrame) -> DataFrame:
    """Stage E: tuition, enrolment and shares of each key from its workbook's cells (``unitid, sheet, row, col, value``), else its profile page (``unitid, html``)."""
    fields = cells.preferred(cells.workbook_fields(workbooks, [UNIT], UNIT), parse_profiles(profiles, [UNIT]), [UNIT]).drop("used")
    return cells.enrich(rows, fields, UNIT)


def final_tables(first: DataFrame, second: DataFrame, annotations: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """Stage F: both cohorts under one header, and of the annotated ones their first annotation."""
    every = frames.union_with_columns(first, second)
    order = [F.col(f"`{c}`") for c in columns]
    return {"all": every, "annotated": frames.annotated(every, frames.stable(annotations, columns), UNIT, columns, *order)}


def bootstrap(pages: DataFrame, html: str = "html", marker: str = "window.CV.pathInfo.endpoints") -> DataFrame:
    """``pages`` with the token and the addresses (``csrf``, ``endpoints``) that a third-party page hands to its scripts."""
    from .functions.text import balanced_object

    token = F.regexp_extract(html, r"""(?is)<meta[^>]*name=["']csrf-token["'][^>]*content=["']([^"']*)""", 1)
    return pages.withColumn("csrf", F.coalesce(token, F.lit(""))).withColumn("endpoints", F.from_json(balanced_object(F.col(html), marker), "map<string,string>"))


def workbook_links(logs: DataFrame, message: str = "message") -> DataFrame:
    """``url``: addresses of workbooks in a browser's log of requests and answers, each once."""
    body = F.from_json(message, "message struct<method:string,params:struct<request:struct<url:string>,response:struct<url:string,mimeType:string>>>")
    m = logs.select(body.alias("m")).select("m.message.*")
    url = F.trim(F.when(F.col("method") == "Network.requestWillBeSent", F.col("params.request.url")).when(F.col("method") == "Network.responseReceived", F.col("params.response.url")))
    kind = F.lower(F.coalesce("params.response.mimeType", F.lit("")))
    found = m.select(url.alias("url"), kind.alias("kind")).where("url != ''")
    return found.where(F.lower("url").rlike(r"\.xlsx|excel|export") | F.col("kind").rlike("spreadsheet|excel")).select("url").distinct()


def number_rows(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with ``row_index``; ties of ``order`` are broken by all columns."""
    return frames.numbered(rows, *order, *[F.col(f"`{c}`") for c in rows.columns])


def last_of_each(progress: DataFrame, key: str = UNIT, order: str = "ord") -> DataFrame:
    """Progress compacted: rows with a key, the last of each."""
    ranked = _keyed(progress).where(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc())))
    return ranked.where("_n = 1").drop("_n")


def run(spark: SparkSession, cohort: DataFrame, baseline: DataFrame, snapshot: DataFrame, profiles: DataFrame) -> DataFrame:
    """From a cohort to reviewed matches, over a snapshot of sites and the text of profile pages."""
    named = attach_baseline(attach_websites(cohort, profiles), baseline)
    return review(match_titles(bucket_titles(crawl_sites(named, snapshot))["wide"]))
