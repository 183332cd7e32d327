"""Pages of institutions' sites: what kind of page each is, its score, the best of each site, and what they say together.

Pages come from a snapshot that :func:`..sources.html.parse_pages` has read; ``base`` is the institution's host.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pages as T
from ..functions import urls as U
from ..functions.text import squeezed

# Limits, points and labels of this block.
LEAST_VISIBLE, LEAST_MAIN = 900, 650
TOP_K, WITHIN, SUBSITE_PENALTY = 6, 60, 80
TIER_POINTS = {"inventory": 240, "catalog": 130, "bulletin": 85}
YEAR = "(2025\\s*[-–—_/]?\\s*2026)|(\\b2526\\b)|(\\b202526\\b)|(\\b20252026\\b)|(\\b25\\s*[-–—_/]\\s*26\\b)"
SOFT_404 = r"\b(page\s+not\s+found|404|not\s+found|we\s+can'?t\s+find|does\s+not\s+exist)\b"
UNDERGRADUATE = r"\b(undergraduate|majors\s+and\s+minors|majors-minors|bachelor|B\.?A\.?|B\.?S\.?)\b"
PDF_WORDS = r"\b(major|minor|program|undergrad)\b"
FOLLOW_LINKS, FOLLOW_PAGES, PDFS = 40, 18, 2
FLAGS = (
    ("grad_penalty", "grad"), ("profile_penalty", "profile"), ("irrelevant_penalty", "irrelevant"), ("admissions_penalty", "admissions"), ("archive_penalty", "archive"), ("awards_penalty", "awards"),
    ("compliance_penalty", "compliance"), ("year_hit", "yearHit"), ("thin", "thin"), ("soft404", "soft404"), ("subsite_like", "subsiteLike"), ("hard_subsite_block", "hardSubsiteBlock"),
    ("too_specific", "tooSpecific"),
)


def is_thin() -> Column:
    return (F.length("page.visible_text") < LEAST_VISIBLE) & (F.length("page.main_text") < LEAST_MAIN)


def is_soft_404() -> Column:
    """Whether a page that was delivered says that there is none, or says next to nothing."""
    n = F.length("page.main_text")
    heads = squeezed(F.concat_ws(" ", "page.html_title", "page.h1", F.array_join(F.slice("page.title_like", 1, 5), " ")))
    return T.has(heads, SOFT_404) | ((n < 600) & T.has(F.col("page.visible_text"), SOFT_404)) | ((n < 250) & (F.size("page.anchors") < 5))


def is_script_hub(url: Column) -> Column:
    """Whether a page lists programs by scripts only, so that the sitemap must be asked."""
    host = U.netloc(url)
    listing = U.is_inventory(url) | host.startswith("majors.") | host.startswith("programs.")
    return is_thin() & listing & (F.size("page.links") <= 60) & ((F.col("page.js_hint") == 1) | (F.length("page.json_blob") >= 200))


def _hubness(rows: DataFrame) -> DataFrame:
    """Adds ``hub_sig`` (0 to 6) and the counts it is made of, by the links to single programs."""
    listed = F.filter("page.links", lambda x: U.same_domain(x["url"], F.col("base")) & U.is_listing(x["url"]))
    out = rows.withColumn("_listed", listed)
    slugs = F.array_distinct(F.filter(F.transform("_listed", lambda x: F.regexp_extract(F.lower(U.path(x["url"])), "([^/]+)/*$", 1)), lambda s: s != ""))
    texts = F.array_distinct(F.filter(F.transform("_listed", lambda x: F.lower(x["text"])), lambda t: F.length(t) >= 6))
    heads = F.size(F.filter("page.title_like", lambda t: F.length(t) >= 6))
    out = out.withColumns({"listing_links": F.size("_listed"), "slug_diversity": F.size(slugs), "distinct_anchor": F.size(texts), "li_like": heads}).drop("_listed")
    signs = [F.col("listing_links") >= 12, F.col("listing_links") >= 25, F.col("slug_diversity") >= 8, F.col("slug_diversity") >= 16, F.col("distinct_anchor") >= 18, (F.col("li_like") >= 40) & (F.col("listing_links") >= 10)]
    return out.withColumn("hub_sig", sum((s.cast("int") for s in signs), F.lit(0)))


def signals(rows: DataFrame) -> DataFrame:
    """Adds the signals by which pages are scored, one column each, to rows with ``url``, ``base`` and a read ``page``."""
    u = F.col("url")
    heads = squeezed(F.concat_ws(" ", "page.html_title", "page.h1"))
    low = F.lower(u)
    out = _hubness(rows).withColumn("_heads", heads)
    h = F.col("_heads")
    columns = {
        "tier": U.tier(u), "soft404": is_soft_404(), "thin": is_thin(), "canonical_hub": U.is_canonical_hub(u),
        "struct_hits": T.hits(F.col("corpus_any"), T.STRUCT_TERMS), "control_hits": T.hits(F.col("corpus_structured"), T.CONTROL_TERMS),
        "year_hit": T.has(u, YEAR) | T.has(h, YEAR), "undergrad_title_boost": T.has(h, UNDERGRADUATE),
        "grad_penalty": T.has(low, U.GRADUATE) | T.has(h, r"\bgraduate\b"), "profile_penalty": T.has(low, U.PROFILE) | T.has(h, r"\bfaculty directory\b"),
        "irrelevant_penalty": T.has(low, U.IRRELEVANT), "admissions_penalty": T.has(low, U.ADMISSIONS), "archive_penalty": T.has(low, U.ARCHIVE), "awards_penalty": T.has(low, U.AWARDS),
        "compliance_penalty": T.has(low, U.COMPLIANCE), "subsite_like": U.is_subsite(u, F.col("base")), "hard_subsite_block": U.is_hard_block(u, F.col("base")),
        "too_specific": U.is_too_specific(u) & ~U.is_canonical_hub(u), "js_hub_hint": (F.col("page.js_hint") == 1) & (F.length("page.json_blob") >= 200),
    }
    flags = {k: v if k in ("tier", "struct_hits", "control_hits") else v.cast("int") for k, v in columns.items()}
    return out.withColumns(flags).withColumn("control_unique_structured", F.size("control_hits")).drop("_heads")


def _on(name: str) -> Column:
    return F.col(name) == 1


def scored(rows: DataFrame, subsite_penalty: int = SUBSITE_PENALTY) -> DataFrame:
    """Adds ``score`` and ``reason`` to rows with signals; what can't be right has -10000."""
    thin_hubless = _on("thin") & (F.col("hub_sig") == 0)
    proper = ~_on("soft404") & ~(thin_hubless & (F.size("struct_hits") < 2))
    points = [
        (F.lit(True), F.when(F.col("tier") == "inventory", 240).when(F.col("tier") == "catalog", 130).when(F.col("tier") == "bulletin", 85).otherwise(40)),
        (F.lit(True), 85 * F.col("hub_sig") + 10 * F.size("struct_hits") + 4 * F.col("control_unique_structured")),
        (_on("canonical_hub") & proper, F.lit(160)), (_on("undergrad_title_boost"), F.lit(35)),
        (_on("year_hit") & F.col("tier").isin("catalog", "bulletin") & U.is_catalog(F.col("url")), F.lit(70)),
        (_on("profile_penalty"), F.lit(-260)), (_on("grad_penalty"), F.lit(-170)), (_on("irrelevant_penalty"), F.lit(-260)), (_on("admissions_penalty"), F.lit(-160)),
        (_on("archive_penalty"), F.lit(-220)), (_on("awards_penalty"), F.lit(-200)), (_on("compliance_penalty"), F.lit(-150)), (_on("subsite_like"), F.lit(-subsite_penalty)),
        (_on("too_specific"), F.lit(-240)),
        (U.is_detail(F.col("url")), F.when(F.col("hub_sig") <= 1, -220).when(F.col("hub_sig") == 2, -90).otherwise(-25)),
        (thin_hubless, F.when(_on("js_hub_hint") & U.is_inventory(F.col("url")), -20).otherwise(-180)),
    ]
    total = reduce(lambda a, b: a + b, [F.when(rule, n).otherwise(0) for rule, n in points])
    out = rows.withColumn("score", F.when(_on("soft404") | _on("hard_subsite_block"), -10_000).otherwise(total))
    flags = F.concat_ws(",", *[F.when(_on(c), F.lit(name)) for c, name in FLAGS])
    parts = (("score", "score"), ("tier", "tier"), ("hubSig", "hub_sig"), ("listingLinks", "listing_links"), ("slugDiv", "slug_diversity"))
    said = [F.concat(F.lit(f"{label}="), F.col(c).cast("string")) for label, c in parts]
    said += [F.concat(F.lit("structHits="), F.size("struct_hits").cast("string")), F.concat(F.lit("ctrlStructured="), F.col("control_unique_structured").cast("string"))]
    return out.withColumn("reason", F.concat_ws(";", *said, F.concat(F.lit("canonicalHub="), F.col("canonical_hub").cast("string")), F.concat(F.lit("flags="), flags)))


def best_pages(rows: DataFrame, keys: list[str], *order: Column, k: int = TOP_K, within: int = WITHIN) -> DataFrame:
    """The ``k`` best pages of each key with their ``rank``: cut first, then a canonical hub within ``within`` of the best comes first.

    ``order`` breaks ties of the score; the limit is pushed below the shuffle.
    """
    top = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), *order))).where(F.col("rank") <= k)
    of_key = Window.partitionBy(*keys)
    near = (F.col("canonical_hub") == 1) & (F.max("score").over(of_key) - F.col("score") <= within)
    first = F.min(F.when(near, F.col("rank"))).over(of_key)
    moved = F.when(first.isNull(), F.col("rank")).when(F.col("rank") == first, 1).when(F.col("rank") < first, F.col("rank") + 1).otherwise(F.col("rank"))
    return top.withColumn("rank", moved)


def page_titles(rows: DataFrame, keys: list[str], strictness: int = 3, context: str = "hub") -> DataFrame:
    """``keys, title``: phrases of links and headings that read as program titles."""
    found = rows.select(*keys, F.explode(F.concat("page.anchors", "page.anchor_attrs", "page.title_like")).alias("title"))
    return found.where((F.col("title") != "") & T.is_program_title(F.col("title"), strictness, context)).distinct()


def follow_links(top: DataFrame, keys: list[str], strictness: int = 3) -> DataFrame:
    """``keys, url, place``: links of the best pages to programs, each once in the order of pages and links, up to the limit."""
    links = top.select(*keys, "rank", "base", F.posexplode("page.links").alias("pos", "x")).select(*keys, "rank", "base", "pos", F.col("x.text").alias("text"), F.col("x.url").alias("url"))
    low, u = F.lower("url"), F.col("url")
    fit = (u != "") & U.same_domain(u, F.col("base")) & ~(T.has(low, U.IRRELEVANT) | T.has(low, U.ADMISSIONS) | T.has(low, U.PROFILE) | low.contains("grad"))
    fit = fit & (T.is_program_title(F.col("text"), strictness) | U.is_program_detail(u))
    once = links.where(fit).groupBy(*keys, "url").agg(F.min(F.struct("rank", "pos")).alias("at"))
    placed = once.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("at")))
    return placed.where(F.col("place") <= min(FOLLOW_LINKS, FOLLOW_PAGES)).select(*keys, "url", "place")


def pdf_links(top: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, url, place``: PDFs of the best pages that are of the year or name programs, up to the limit."""
    links = top.select(*keys, "rank", F.posexplode("page.links").alias("pos", "x"))
    low, text = F.lower("x.url"), F.lower("x.text")
    fit = low.rlike(r"(?i)\.pdf(\?|$)") & (T.has(low, YEAR) | T.has(text, YEAR) | T.has(text, PDF_WORDS))
    once = links.where(fit).groupBy(*keys, F.col("x.url").alias("url")).agg(F.min(F.struct("rank", "pos")).alias("at"))
    return once.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("at"))).where(F.col("place") <= PDFS).select(*keys, "url", "place")


def summary(top: DataFrame, followed: DataFrame, keys: list[str], strictness: int = 3) -> DataFrame:
    """One row per key: terms and words over its best pages, titles also over the pages followed, and whether enough subjects were seen."""
    every = top.select(*keys, "corpus_any").unionByName(followed.select(*keys, "corpus_any"))
    words = every.groupBy(*keys).agg(*[F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(T.token_matches(F.col("corpus_any"), f))))), "|").alias(f"{f}_matches") for f in T.TARGET_TOKENS])
    terms = top.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("struct_hits")))), "|").alias("struct_hits_union"), F.max((F.col("control_unique_structured") > 0).cast("int")).alias("any_control_found"),
        *[F.max(F.array_contains("control_hits", name).cast("int")).alias(name) for name in T.CONTROL_TERMS],
        F.max(F.when(F.col("rank") == 1, F.col("url"))).alias("best_url"), F.max(F.when(F.col("rank") == 1, F.col("reason"))).alias("best_reason"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") > 1, F.struct("rank", "url")))), lambda x: x["url"]), "|").alias("alt_urls"),
    )
    terms = terms.withColumn(">0_struct_hits_found", (F.col("struct_hits_union") != "").cast("int")).withColumn("total_controls_found", reduce(lambda a, b: a + b, [F.col(n) for n in T.CONTROL_TERMS]))
    terms = terms.withColumn("controls_sufficiency", T.sufficiency(F.col("total_controls_found")))
    titles = page_titles(top, keys, strictness).unionByName(page_titles(followed, keys, strictness, "follow")).distinct()
    named = T.clean_titles(titles, keys, strictness=strictness).groupBy(*keys).agg(F.array_sort(F.collect_list("title")).alias("t"))
    named = named.select(*keys, F.size("t").alias("program_title_count"), F.array_join("t", "|").alias("program_titles_found"))
    return terms.join(words, keys).join(named, keys, "left").fillna({"program_title_count": 0, "program_titles_found": ""})


def status_label(statuses: DataFrame, keys: list[str], code: str, best_url: str) -> DataFrame:
    """What stood in the way of reading a site: 403, 429, 5xx, failures (-1), other 4xx, then nothing found; else ok."""
    c = F.col(code)
    seen = (("403_forbidden_seen", c == 403), ("429_rate_limited_seen", c == 429), ("5xx_seen", (c >= 500) & (c < 600)), ("exceptions_seen", c == -1), ("4xx_seen", (c >= 400) & (c < 500)))
    counted = statuses.groupBy(*keys).agg(F.max(best_url).alias("_best"), *[F.max(rule.cast("int")).alias(name) for name, rule in seen])
    label = reduce(lambda out, name: out.when(F.col(f"`{name}`") == 1, name), [name for name, _ in seen], F.when(F.lit(False), ""))
    return counted.select(*keys, label.when(F.coalesce("_best", F.lit("")).isin("", "N/A"), "no_candidate").otherwise("ok").alias("label"))


def third_party_status(blocked: Column, site: Column, controls: Column, failed: Column, least: int = T.SUFFICIENT_CONTROLS) -> Column:
    """Label of the third-party look-up: error, blocked, passed or failed by the number of subjects, or unresolved."""
    return F.when(failed, "cv_error").when(blocked, "cv_blocked").when(site == 1, F.when(controls >= least, "passed_ctrl_thresh").otherwise("failed_ctrl_thresh")).otherwise("cv_unresolved")
