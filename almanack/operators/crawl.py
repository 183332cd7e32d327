"""Finding an institution's program pages in a page snapshot: rounds of joins instead of requests.

The snapshot (``url, html``) stands for the web.  The frontier of all institutions moves together: a round takes
the most promising addresses of each that are not read yet, joins them to the snapshot, reads and scores what is there,
and adds the links of what was read.  Budgets are row numbers per institution, so nothing runs on the driver but
the rounds, of which there are as many as levels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..sources.html import parse_pages
from ..sources.tables import kept
from . import pages as P

# Budgets and addresses of this block.
INVENTORY_TRIED, CATALOG_TRIED, HOME_LINKS, PAGES, LEVELS, LINKS = 18, 10, 22, 55, 3, 70
SITEMAP_HUB, SITEMAP_WEAK, SITEMAP_MOST, SITEMAP_FILES, SITEMAP_URLS = 120, 50, 240, 5, 2500
INVENTORY_PATHS = (
    "/academics/programs", "/academics/programs/", "/programs", "/programs/", "/academics/majors-minors", "/academics/majors-minors/", "/majors-minors", "/majors-minors/", "/academics/majors",
    "/academics/majors/", "/majors", "/majors/", "/undergraduate/majors", "/undergraduate/majors/", "/departments-and-programs", "/departments-and-programs/",
    "/academics/departments-and-programs", "/academics/departments-and-programs/", "/departments", "/departments/", "/academics/departments", "/academics/departments/", "/areas-of-study",
    "/areas-of-study/", "/fields-of-study", "/fields-of-study/", "/academic-programs", "/academic-programs/", "/academics/academic-programs", "/academics/academic-programs/", "/find-your-program",
    "/en/find-your-program", "/en/find-your-program/",
)
CATALOG_PATHS = (
    "/college-catalog", "/college-catalog/", "/course-catalog", "/course-catalog/", "/catalog", "/catalog/", "/catalogue", "/catalogue/", "/bulletin", "/bulletin/", "/academics/catalog", "/academics/catalog/",
)
ROOT_PATHS = ("/programs", "/majors", "/majors-minors", "/academics/programs", "/departments-and-programs")


def seeds(sites: DataFrame, key: str = "unitid", address: str = "web_address") -> DataFrame:
    """``key, base, url, phase``: the addresses tried first on each site: its start, usual paths, catalogues of the year, subdomains."""
    start = sites.withColumn("start", U.with_scheme(F.col(address))).where("start != ''").withColumn("base", U.netloc(F.col("start")))
    usual = F.array(*[U.joined(F.col("start"), p) for p in INVENTORY_PATHS[:INVENTORY_TRIED]])
    catalog = F.array(*[U.joined(F.col("start"), p) for p in CATALOG_PATHS[:CATALOG_TRIED]])
    years = F.slice(U.year_candidates(F.col("start")), 1, CATALOG_TRIED)
    roots = U.subdomain_roots(F.col("start"))
    deeper = F.flatten(F.transform(roots, lambda r: F.array(*[U.joined(r, p) for p in ROOT_PATHS])))

    def phased(urls: Column, phase: int) -> Column:
        return F.transform(urls, lambda u, i: F.struct(u.alias("url"), F.lit(phase).alias("phase"), i.alias("place")))

    every = F.concat(phased(F.array("start"), 0), phased(usual, 1), phased(years, 1), phased(catalog, 1), phased(roots, 3), phased(deeper, 4))
    rows = start.select(key, "base", F.inline(every))
    return rows.groupBy(key, "base", "url").agg(F.min(F.struct("phase", "place")).alias("at")).select(key, "base", "url", "at.phase", "at.place")


def read(frontier: DataFrame, snapshot: DataFrame, subsite_penalty: int = P.SUBSITE_PENALTY) -> DataFrame:
    """Addresses of the frontier that the snapshot has, read and scored.  A page is parsed once per address, whoever asks for it."""
    wanted = snapshot.join(frontier.select("url").distinct(), "url", "left_semi").dropDuplicates(["url"])
    found = frontier.join(parse_pages(wanted.select("url", "html")), "url")
    return P.scored(P.signals(found), subsite_penalty)


def links_of(rows: DataFrame, key: str, most: int, subsite_penalty: int = P.SUBSITE_PENALTY) -> DataFrame:
    """``key, base, url``: of each page the ``most`` promising links to its own site."""
    links = rows.select(key, "base", F.col("url").alias("page_url"), F.posexplode("page.links").alias("pos", "x")).select(key, "base", "page_url", "pos", F.col("x.text").alias("text"), F.col("x.url").alias("url"))
    own = links.where(U.same_domain(F.col("url"), F.col("base")) & (F.col("url") != "")).withColumn("r", U.link_rank(F.col("text"), F.col("url"), F.col("base"), subsite_penalty))
    ranked = own.withColumn("n", F.row_number().over(Window.partitionBy(key, "page_url").orderBy("r", "pos"))).where(F.col("n") <= most)
    return ranked.select(key, "base", "url").distinct()


def sitemap_urls(sitemaps: DataFrame, sites: DataFrame, key: str = "unitid") -> DataFrame:
    """``key, url``: addresses in sitemaps (``url, xml``) of each site that may be programs, up to the limit.

    Index files lead to others; only addresses of the same site count, without fragments, each once.
    """
    def locations(rows: DataFrame) -> DataFrame:
        found = F.regexp_extract_all("xml", F.lit(r"(?is)<(?:\w+:)?loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:\w+:)?loc>"), F.lit(1))
        return rows.select(key, "base", F.col("xml").rlike(r"(?is)<(?:\w+:)?sitemapindex").alias("is_index"), F.posexplode(found).alias("pos", "loc")).withColumn("loc", F.replace("loc", F.lit("&amp;"), F.lit("&")))

    start = sites.select(key, "base", U.joined(F.col("start"), "/sitemap.xml").alias("url"))
    first = locations(start.join(sitemaps, "url"))
    own = first.where(U.same_domain(F.col("loc"), F.col("base")))
    inner = own.where("is_index").withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where(F.col("n") < SITEMAP_FILES)
    second = locations(inner.select(key, "base", F.col("loc").alias("url")).join(sitemaps, "url")).where("not is_index")
    every = own.where("not is_index").unionByName(second.where(U.same_domain(F.col("loc"), F.col("base")))).withColumn("url", U.defragged(F.col("loc")))
    once = every.groupBy(key, "url").agg(F.min("pos").alias("pos"))
    listed = once.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("pos", "url"))).where(F.col("n") <= SITEMAP_URLS)
    fit = listed.where(U.is_sitemap_candidate(F.col("url"))).withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("pos", "url")))
    return fit.where(F.col("n") <= SITEMAP_MOST).select(key, "url")


def discover(sites: DataFrame, snapshot: DataFrame, key: str = "unitid", address: str = "web_address", sitemaps: DataFrame | None = None, levels: int = LEVELS, subsite_penalty: int = P.SUBSITE_PENALTY) -> DataFrame:
    """All pages read of each site, scored, with the ``phase`` in which they were found; each address once per site.

    First the usual addresses and the links of the start page, then, if the best so far lists programs by scripts
    or is weak, the sitemap's; then level by level the most promising links, up to the budget of pages.
    Each level ends in a table, so that a lost executor costs one level.
    """
    tried = kept(seeds(sites, key, address))
    found = [kept(read(tried, snapshot, subsite_penalty))]
    home = found[0].where("phase = 0")
    more = links_of(home, key, HOME_LINKS, subsite_penalty).join(tried.select(key, "url"), [key, "url"], "left_anti").withColumns({"phase": F.lit(1), "place": F.lit(100)})
    more = kept(more.select(tried.columns))
    found.append(kept(read(more, snapshot, subsite_penalty)))
    tried = tried.unionByName(more)
    if sitemaps is not None:
        start = sites.withColumn("start", U.with_scheme(F.col(address))).where("start != ''").select(key, "start", U.netloc(U.with_scheme(F.col(address))).alias("base"))
        best = reduce(DataFrame.unionByName, found).groupBy(key).agg(F.max_by(F.struct("thin", "hub_sig", "url"), "score").alias("b"), F.max(P.is_script_hub(F.col("url")).cast("int")).alias("hub"))
        limit = F.when(F.col("hub") == 1, SITEMAP_HUB).when(((F.col("b.thin") == 1) | (F.col("b.hub_sig") == 0)) & U.is_inventory(F.col("b.url")), SITEMAP_WEAK).otherwise(0)
        wanted = sitemap_urls(sitemaps, start, key).withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("url"))).join(best.select(key, limit.alias("most")), key).where("n <= most")
        extra = wanted.join(start.select(key, "base"), key).select(key, "base", "url", F.lit(2).alias("phase"), F.col("n").alias("place")).join(tried.select(key, "url"), [key, "url"], "left_anti")
        extra = kept(extra.select(tried.columns))
        found.append(kept(read(extra, snapshot, subsite_penalty)))
        tried = tried.unionByName(extra)
    last, budget = reduce(DataFrame.unionByName, found), PAGES
    for level in range(1, levels + 1):
        new = links_of(last, key, LINKS, subsite_penalty).join(tried.select(key, "url"), [key, "url"], "left_anti")
        new = new.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(U.prior(F.col("url"), F.col("base"), subsite_penalty).desc(), "url"))).where(F.col("place") <= budget)
        new = kept(new.withColumn("phase", F.lit(4 + level)).select(tried.columns))
        last = kept(read(new, snapshot, subsite_penalty))
        found.append(last)
        tried = tried.unionByName(new)
    return reduce(DataFrame.unionByName, found)


def inventory(sites: DataFrame, snapshot: DataFrame, key: str = "unitid", address: str = "web_address", sitemaps: DataFrame | None = None, strictness: int = 3) -> DataFrame:
    """One row per site of ``sites``: status, the best pages, the terms and titles they hold, as far as the snapshot goes."""
    found = discover(sites, snapshot, key, address, sitemaps)
    top = kept(P.best_pages(found, [key], F.col("phase"), F.col("place"), F.col("url")))
    links = P.follow_links(top, [key], strictness).join(top.select(key, "url"), [key, "url"], "left_anti")
    followed = links.join(parse_pages(snapshot.join(links.select("url").distinct(), "url", "left_semi").select("url", "html")), "url")
    said = P.summary(top, followed, [key], strictness)
    out = sites.select(key, address).join(said, key, "left")
    status = F.when(F.trim(F.coalesce(address, F.lit(""))) == "", "error_missing_web_address").when(F.col("best_url").isNull(), "no_candidates").otherwise("ok")
    return out.withColumn("status", status)
