"""Queries over pages and addresses: what kind of page each is, its score, the best of a site, and what texts say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages as T
from ..functions import urls as U
from ..operators import cells, crawl
from ..operators import pages as P
from ..sources.html import FIELDS, parse_pages, parse_profiles, website_column
from ..sources.tables import parquet
from .base import literals, query, values

#: Addresses as colleges have them; the generated pages have none like these.
ADDRESSES = (
    "https://www.example.edu/", "https://www.example.edu", "https://www.example.edu/programs", "https://www.example.edu/academics/programs/", "https://www.example.edu/programs/ethnic-studies",
    "https://www.example.edu/programs/ethnic-studies/courses", "https://catalog.example.edu/2025-2026/index", "https://bulletin.example.edu/graduate/ma", "https://other.org/programs",
    "https://www.example.edu/faculty/jane", "https://www.example.edu/news/2025", "https://www.example.edu/admissions/apply/", "https://nwo.example.edu/programs", "https://www.example.edu/majors/history.html",
    "https://www.example.edu/about/awards", "https://www.example.edu/archive/past/majors-minors", "https://library.example.edu/find-your-program#top", "https://www.example.edu/consumer-information?x=1#y",
    "https://www.example.edu/departments/english/", "https://www.example.edu/center/undergraduate-programs", "https://www.example.edu/x/bulletin/catalogue", "mailto:someone@example.edu", "",
)
BASE = "www.example.edu"
_LIST = "[" + ", ".join("'" + a + "'" for a in ADDRESSES) + "]"
_N = len(ADDRESSES)
_U = f"WITH u AS (SELECT page_id, {_LIST}[CAST(1 + page_id % {_N} AS INT)] AS url FROM pages), p AS (SELECT *, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1) AS path, lower(url) AS low FROM u) "


def _addresses(spark: SparkSession, d: str) -> DataFrame:
    dealt = parquet(spark, d, "pages").select("page_id", (F.col("page_id") % _N).alias("k"))
    return dealt.join(literals(spark, [(a,) for a in ADDRESSES], "url string"), "k").drop("k")


_HUBS = "'/programs', '/academics/programs', '/majors-minors', '/academics/majors-minors', '/majors', '/academics/majors', '/departments-and-programs', '/academics/departments-and-programs', '/departments', '/academics/departments', '/areas-of-study', '/fields-of-study', '/academic-programs', '/academics/academic-programs'"
_INVENTORY = "regexp_matches(low, '/programs|/academics/programs|/majors-minors|/majors|/departments-and-programs|/departments|/areas-of-study|/fields-of-study|/academic-programs|find-your-program')"
_HUB = f"regexp_replace(lower(path), '/+$', '') IN ({_HUBS})"
_LISTING = r"regexp_matches(lower(path), '/programs/[^/]+/?$|/majors-minors/[^/]+/?$|/majors/[^/]+(\.html|\.shtml)?$|/majors-programs/[^/]+|/departments-and-programs/[^/]+/?$|/departments/[^/]+/?$')"
_DETAIL = r"regexp_matches(lower(path), '/programs/[^/]+/.+|/majors-minors/[^/]+/.+|/departments-and-programs/[^/]+/.+|/departments/[^/]+/.+|/majors/[^/]+(\.html|\.shtml)?$|/majors-programs/[^/]+|/academiclife/departments/[^/]+/?$|/content/.*/departments/[^/]+\.html$')"


@query(_U + rf"""SELECT page_id, url, host, path, regexp_replace(url, '#.*$', '') AS address,
  CASE WHEN path IN ('', '/') THEN 'homepage' WHEN {_INVENTORY} THEN 'inventory' WHEN contains(low, 'bulletin') THEN 'bulletin' WHEN contains(low, 'catalog') THEN 'catalog' ELSE 'other' END AS tier,
  {_HUB} AS canonical_hub, {_LISTING} AS listing, {_DETAIL} AS detail, regexp_matches(lower(path), '/departments?/[a-z0-9_-]+|/departments-and-programs/[a-z0-9_-]+|/programs?/[a-z0-9_-]+|/academics/.+/(major|minors|programs)\b') AS too_specific,
  ends_with(host, 'www.example.edu') AS same_domain FROM p""")
def url_features(spark: SparkSession, d: str) -> DataFrame:
    """Parts, tier and kind of every address."""
    u = F.col("url")
    return _addresses(spark, d).select(
        "page_id", "url", U.netloc(u).alias("host"), U.path(u).alias("path"), U.defragged(u).alias("address"), U.tier(u).alias("tier"), U.is_canonical_hub(u).alias("canonical_hub"),
        U.is_listing(u).alias("listing"), U.is_detail(u).alias("detail"), U.is_too_specific(u).alias("too_specific"), U.same_domain(u, F.lit(BASE)).alias("same_domain"),
    )


_SITED = r"""s AS (SELECT *, CASE WHEN trim(url) = '' THEN '' WHEN regexp_matches(url, '(?i)^https?://') THEN url ELSE 'https://' || url END AS full_url FROM p),
  h AS (SELECT * EXCLUDE (host, path), lower(regexp_extract(full_url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_extract(full_url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM s),
  f AS (SELECT *, host || lower(path) AS words, regexp_extract(regexp_replace(regexp_replace(regexp_replace(host, '^www\.', ''), '^m\.', ''), '^web\.', ''), '([^.]+\.[^.]+)$', 1) AS root FROM h),
  k AS (SELECT *, full_url = '' OR root <> 'example.edu' OR regexp_matches(words, 'nwo|cge') AS hard_block,
    full_url = '' OR root <> 'example.edu' OR (host <> 'www.example.edu' AND regexp_extract(host, '^([^.]+)', 1) NOT IN ('www', 'majors', 'programs', 'catalog', 'bulletin', 'courses'))
      OR regexp_matches(words, 'center|centre|institute|office|community|belonging|extension|continuing-ed|professional|outreach|nwo|cge') AS subsite FROM f)"""
_PRIOR = rf"""CASE WHEN {_INVENTORY} THEN 200 ELSE 0 END + CASE WHEN regexp_matches(low, 'academic|program|major|minor|depart|areas-of-study|fields-of-study') THEN 90 ELSE 0 END
  + CASE WHEN contains(low, 'catalog') THEN 35 ELSE 0 END - CASE WHEN contains(low, 'bulletin') THEN 20 ELSE 0 END
  - CASE WHEN regexp_matches(low, '/news/|/events?/|/calendar/|/press/|/alumni/|/giving/|/donate/|/commencement|/story/|/blog/|/announcement/') THEN 260 ELSE 0 END
  - CASE WHEN regexp_matches(low, '/admissions/|/apply/|/visit/|/financial-aid/|/tuition/|/request-info/') THEN 160 ELSE 0 END
  - CASE WHEN regexp_matches(low, '/people/|/person/|/faculty/|/faculty-directory/|/staff/|/directory/|/profiles?/|/bio/|/biography/') THEN 320 ELSE 0 END
  - CASE WHEN regexp_matches(low, '\barchive\b|/past-|/past/') THEN 140 ELSE 0 END
  - CASE WHEN regexp_matches(low, 'consumer-information|disclosures?|cip\b|gainful-employment|institutional-research') THEN 90 ELSE 0 END
  - CASE WHEN regexp_matches(low, '\b(awards?|honors?)\b') THEN 160 ELSE 0 END
  - CASE WHEN regexp_matches(low, '\b(graduate|grad-studies|gradstudies|master|masters|doctoral|phd|mba|mfa|ms|ma)\b') THEN 180 ELSE 0 END
  - CASE WHEN hard_block THEN 10000 ELSE 0 END - CASE WHEN subsite THEN 80 ELSE 0 END"""


@query(_U + f", {_SITED}, o AS (SELECT page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1) AS path FROM u) SELECT k.page_id, url, hard_block, subsite, CAST({_PRIOR} + CASE WHEN {_HUB.replace('path', 'o.path')} THEN 160 ELSE 0 END AS INT) AS prior FROM k JOIN o USING (page_id)")
def url_priors(spark: SparkSession, d: str) -> DataFrame:
    """Whether an address leaves its site, and how promising it is before it is read."""
    u, base = F.col("url"), F.lit(BASE)
    return _addresses(spark, d).select("page_id", "url", U.is_hard_block(u, base).alias("hard_block"), U.is_subsite(u, base).alias("subsite"), U.prior(u, base).alias("prior"))


_NON_ACADEMIC = "news|event|calendar|giving|alumni|advancement|athletics|sports|tickets|shop|bookstore|it|its|help|support|login|privacy|accessibility|admissions|apply|visit|tuition|financial-aid|student-life|housing|dining|library|about|contact|directory|people|faculty|staff|press|media|magazine|blog|policy"


@query(_U + rf""", {_SITED} SELECT page_id, url, CASE WHEN full_url = '' OR regexp_matches(words, '{_NON_ACADEMIC}') THEN 'Wrong non-academic'
  WHEN root <> 'example.edu' OR regexp_matches(words, 'center|centre|institute|office|community|belonging|extension|continuing-ed|professional|outreach|nwo|cge') THEN 'Wrong subsite'
  WHEN regexp_matches(lower(path), 'majors|minors|programs|degrees|department|academic|catalog|bulletin|undergraduate|courses|areas-of-study') THEN
    CASE WHEN regexp_matches(lower(path), '/departments?/[a-z0-9_-]+|/departments-and-programs/[a-z0-9_-]+|/programs?/[a-z0-9_-]+|/academics/.+/(major|minors|programs)\b') THEN 'Correct-ish but too specific' ELSE 'Correct hub' END
  WHEN regexp_matches(lower(path), 'academ') THEN 'Correct-ish but too specific' ELSE 'Wrong subsite' END AS tag FROM f""")
def url_tags(spark: SparkSession, d: str) -> DataFrame:
    """What kind of page the best address of an institution is, by its words."""
    return _addresses(spark, d).select("page_id", "url", U.row_tag(F.lit("www.example.edu"), F.col("url")).alias("tag"))


@query(_U + r"""SELECT page_id, url FROM p WHERE regexp_matches(low, '/academics/majors-minors/[^/]+/index\.html?$|/majors-minors/[^/]+/?$|/programs/[^/]+/?$|/departments-and-programs/[^/]+/?$|/departments/[^/]+/?$')
  AND NOT contains(low, 'grad') AND NOT regexp_matches(low, '/news/|/events?/|/admissions/|/apply/|/faculty/|/people/|/staff/|\barchive\b|/past')""")
def sitemap_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of sitemaps that are worth reading."""
    return _addresses(spark, d).where(U.is_sitemap_candidate(F.col("url"))).select("page_id", "url")


@query("""SELECT s_suppkey AS unitid, 'https://s' || s_suppkey || '.edu/' || p || '/' || y AS url FROM supplier,
  (SELECT unnest(['catalog', 'catalogue', 'college-catalog', 'course-catalog', 'academic-catalog', 'bulletin', 'academics/catalog', 'academiclife/college-catalog']) AS p),
  (SELECT unnest(['2526', '20252026', '2025-2026', '2025–2026', '2025—2026', '2025_2026', '202526', '25-26', '25–26', '25_26']) AS y)
  UNION ALL SELECT s_suppkey, 'https://' || s || '.s' || s_suppkey || '.edu/' FROM supplier, (SELECT unnest(['majors', 'programs', 'catalog', 'bulletin']) AS s)""")
def tried_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Catalogues of the year and subdomains that are tried on each site."""
    base = F.concat(F.lit("https://s"), F.col("s_suppkey").cast("string"), F.lit(".edu/start"))
    rows = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"), base.alias("base"))
    return rows.select("unitid", F.explode(F.concat(U.year_candidates(F.col("base")), U.subdomain_roots(F.col("base")))).alias("url"))


@query(r"""WITH t AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Visit WWW.Example.edu/about now, or www.b.org' WHEN 1 THEN 'see https://dept.example.edu/x for more' WHEN 2 THEN 'nothing here' ELSE '' END AS body FROM pages)
  SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'WWW.Example.edu/about' WHEN 1 THEN 'dept.example.edu/x' ELSE '' END AS web_address FROM t""")
def addresses_in_texts(spark: SparkSession, d: str) -> DataFrame:
    """The web address in a page's text."""
    k = F.col("page_id") % 4
    body = F.when(k == 0, "Visit WWW.Example.edu/about now, or www.b.org").when(k == 1, "see https://dept.example.edu/x for more").when(k == 2, "nothing here").otherwise("")
    return parquet(spark, d, "pages").select("page_id", U.address_in_text(body).alias("web_address"))


@query(rf"""WITH t AS (SELECT page_id, url, CAST(100 - 7 * (page_id % 23) AS INT) AS score, CAST(page_id % 5 = 0 AS INT) AS canonical_hub, regexp_extract(url, '([^./]+\.[^./]+)(?:/|$)', 1) AS site FROM pages),
  cut AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY score DESC, page_id) AS n FROM t QUALIFY n <= 6),
  near AS (SELECT *, max(score) OVER (PARTITION BY site) - score <= 60 AND canonical_hub = 1 AS close FROM cut),
  lifted AS (SELECT *, min(CASE WHEN close THEN n END) OVER (PARTITION BY site) AS first_close FROM near)
  SELECT site, page_id, score, CAST(row_number() OVER (PARTITION BY site ORDER BY CASE WHEN n = first_close THEN 0 ELSE 1 END, n) AS INT) AS rank FROM lifted""")
def page_topk(spark: SparkSession, d: str) -> DataFrame:
    """The six best pages of each site; a hub among them and near the best comes first."""
    scored = parquet(spark, d, "pages").select("page_id", (100 - 7 * (F.col("page_id") % 23)).cast("int").alias("score"), (F.col("page_id") % 5 == 0).cast("int").alias("canonical_hub"), F.regexp_extract("url", r"([^./]+\.[^./]+)(?:/|$)", 1).alias("site"))
    return P.best_pages(scored, ["site"], F.col("page_id")).select("site", "page_id", "score", F.col("rank").cast("int").alias("rank"))


_SCORED = ("page_id", "score", "tier", "hub_sig", "thin", "soft404", "control_unique_structured", "reason")


@query()
def page_scores(spark: SparkSession, d: str) -> DataFrame:
    """Signals and score of every page of the snapshot, read from its HTML."""
    pages = parse_pages(parquet(spark, d, "pages")).withColumn("base", U.netloc(F.col("url")))
    return P.scored(P.signals(pages)).select(*_SCORED)


@query()
def site_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Each site crawled in the snapshot from its start page: status, best pages, terms and titles."""
    pages = parquet(spark, d, "pages")
    sites = pages.select(U.netloc(F.col("url")).alias("unitid"), F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1).alias("web_address")).groupBy("unitid").agg(F.min("web_address").alias("web_address"))
    return crawl.inventory(sites, pages.select("url", "html")).select("unitid", "status", "best_url", "best_reason", "alt_urls", "program_titles_found", "total_controls_found", "controls_sufficiency")


#: Phrases of pages: text, whether each is a title (strictness 3 on a hub, 5 on a hub, 3 further on), and the families of words in it.
_PHRASES = (
    ("African Studies Program", True, False, True, "African", ""), ("Ethnic Studies", True, False, True, "", "Ethnic"), ("Black Student Union", False, False, False, "", ""), ("AFAM 101 Black History", False, False, False, "", ""),
    ("Explore African art and learn how communities prepare for change", False, False, False, "African", ""), ("Mathematics", False, False, False, "", ""), ("Jane Black", False, False, False, "", ""), ("Black", False, False, False, "", ""),
    ("www.black.edu Studies", False, False, False, "", ""), ("Toggle Ethnic Studies menu", False, False, False, "", "Ethnic"), ("Pan-African and Afro-American ethnic-minority studies", True, True, True, "Afro-American|Pan-African", "ethnic-minority"),
    ("Race in America", True, False, False, "", ""),
)


@query(f"SELECT page_id, phrase, hub, strict, follow, afri, ethnic FROM pages JOIN {values(_PHRASES, 'phrase', 'hub', 'strict', 'follow', 'afri', 'ethnic')} ON k = page_id % {len(_PHRASES)}")
def program_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Which phrases of a page are program titles, and the words of two families in them."""
    t = F.col("phrase")
    rows = parquet(spark, d, "pages").select("page_id", (F.col("page_id") % len(_PHRASES)).alias("k")).join(literals(spark, [(p[0],) for p in _PHRASES], "phrase string"), "k")
    words = {f: F.array_join(T.token_matches(t, f), "|").alias(f) for f in ("afri", "ethnic")}
    return rows.select("page_id", "phrase", T.is_program_title(t).alias("hub"), T.is_program_title(t, 5).alias("strict"), T.is_program_title(t, context="follow").alias("follow"), *words.values())


_RAW = ("Welcome to African Studies | Home", "AFRICAN STUDIES", "African Studies: BA", "AFAM 201 Black Lit", "Ethnic Studies / Black Studies Minor", "https://x.edu/black", "Black Studies announces a lecture", "/ethnic-studies")
#: The variants that stay: of equal keys the better worded, the shorter, the first.
_CLEAN = ("AFRICAN STUDIES", "Black Studies Minor", "Black Studies announces a lecture", "Ethnic Studies", "Welcome to African Studies")


@query(f"SELECT s_suppkey AS unitid, title FROM supplier, {values([(t,) for t in _CLEAN], 'title')}")
def cleaned_titles(spark: SparkSession, d: str) -> DataFrame:
    """Program titles of each institution from raw phrases: pieces, without courses and addresses, the best variant of each."""
    rows = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"), F.explode(F.array(*map(F.lit, _RAW))).alias("title"))
    return T.clean_titles(rows, ["unitid"])


_TERMS = ("Majors: History, English, CS and Computer Science, B.A.", "Mathematics; Biochemistry; Psychology minors", "Engineering Physics degrees", "nothing", "")
_HITS = (("history|english|computer_science", "majors|BA"), ("math|psychology", "minors"), ("engineering|physics", "degrees"), ("", ""), ("", ""))


@query(f"SELECT page_id, controls, structure, CASE WHEN n < 2 THEN 'warning_2_MajorsFound' ELSE 'sufficient majors' END AS label FROM (SELECT page_id, controls, structure, CASE WHEN controls = '' THEN 0 ELSE len(string_split(controls, '|')) END AS n FROM pages JOIN {values(_HITS, 'controls', 'structure')} ON k = page_id % {len(_TERMS)})")
def term_hits(spark: SparkSession, d: str) -> DataFrame:
    """Subjects and words of structure that a text names, and whether the subjects are enough."""
    rows = parquet(spark, d, "pages").select("page_id", (F.col("page_id") % len(_TERMS)).alias("k")).join(literals(spark, [(t,) for t in _TERMS], "text string"), "k")
    found = rows.select("page_id", T.hits(F.col("text"), T.CONTROL_TERMS).alias("c"), T.hits(F.col("text"), T.STRUCT_TERMS).alias("s"))
    return found.select("page_id", F.array_join("c", "|").alias("controls"), F.array_join("s", "|").alias("structure"), T.sufficiency(F.size("c"), 2).alias("label"))


@query("""WITH codes AS (SELECT user_id, event_id, unnest([CASE WHEN event_id % 97 = 0 THEN 403 ELSE 200 END, CASE WHEN event_id % 89 = 0 THEN 429 ELSE 200 END, CASE WHEN event_id % 83 = 0 THEN 503 ELSE 200 END, CASE WHEN event_id % 79 = 0 THEN -1 ELSE 200 END, CASE WHEN event_id % 73 = 0 THEN 404 ELSE 200 END]) AS code FROM events)
  SELECT user_id, CASE WHEN count(*) FILTER (code = 403) > 0 THEN '403_forbidden_seen' WHEN count(*) FILTER (code = 429) > 0 THEN '429_rate_limited_seen' WHEN count(*) FILTER (code BETWEEN 500 AND 599) > 0 THEN '5xx_seen'
    WHEN count(*) FILTER (code = -1) > 0 THEN 'exceptions_seen' WHEN count(*) FILTER (code BETWEEN 400 AND 499) > 0 THEN '4xx_seen' WHEN user_id % 7 = 0 THEN 'no_candidate' ELSE 'ok' END AS label FROM codes GROUP BY user_id""")
def status_tag(spark: SparkSession, d: str) -> DataFrame:
    """One label per institution of what stood in the way of reading it, by priority."""
    codes = [F.when(F.col("event_id") % m == 0, v).otherwise(200) for m, v in ((97, 403), (89, 429), (83, 503), (79, -1), (73, 404))]
    best = F.when(F.col("user_id") % 7 != 0, "https://x.edu/programs")
    rows = parquet(spark, d, "events").select("user_id", best.alias("best_url"), F.explode(F.array(*codes)).alias("code"))
    return P.status_label(rows, ["user_id"], "code", "best_url")


@query("""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'cv_error' WHEN event_id % 7 = 0 THEN 'cv_blocked' WHEN event_id % 2 = 1 THEN 'cv_unresolved' WHEN event_id % 20 >= 10 THEN 'passed_ctrl_thresh' ELSE 'failed_ctrl_thresh' END AS label FROM events""")
def third_party_label(spark: SparkSession, d: str) -> DataFrame:
    """How the third-party look-up of each institution ended."""
    e = F.col("event_id")
    return parquet(spark, d, "events").select("event_id", P.third_party_status(e % 7 == 0, (e % 2 == 0).cast("int"), e % 20, e % 11 == 0).alias("label"))


_HTML = (
    '<h2>Tuition and required fees for full-time students</h2><table><thead><tr><th>Level</th><th>2023-24</th><th>2024-25</th></tr></thead><tbody><tr><td>Undergraduate</td><td>$1</td><td>$12,345</td></tr><tr><td>Graduate</td><td>$2</td><td>$20,000</td></tr></tbody></table>'
    '<h2>Enrollment by gender</h2><table><tr><th></th><th>Total</th></tr><tr><td>Men</td><td>1,234</td></tr><tr><td>Women</td><td>2,000</td></tr><tr><td>Total</td><td>3,234</td></tr></table>'
    '<h2>Percent of all students enrolled</h2><table><tr><th>Group</th><th>Percent</th></tr><tr><td>Asian</td><td>12.5 %</td></tr><tr><td>White</td><td>40 %</td></tr></table><p>Website: <a href="https://www.example.edu">here</a></p>'
)


@query("""SELECT s_suppkey AS unitid, '$12,345' AS tuition_fees_ug_2024_25, '$12,345' AS tuition_fees_grad_2024_25, '3234' AS enrollment_total, '1234' AS enrollment_men, '2000' AS enrollment_women, '12.5 %' AS pct_Asian, '40 %' AS pct_White, 'https://www.example.edu' AS website FROM supplier""")
def profile_pages(spark: SparkSession, d: str) -> DataFrame:
    """Tuition, enrolment, shares and website from profile pages; "Graduate" is first found in "Undergraduate", as rows are taken that hold a label."""
    pages = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid"), F.lit(_HTML).alias("html"))
    found = parse_profiles(pages.withColumn("website", website_column(F.col("html"), "profiles.example.org")), ["unitid", "website"])
    return found.select("unitid", *FIELDS[:5], "pct_Asian", "pct_White", "website")


#: A workbook's cells: sheet, row, column, value.
_SHEET = (
    (0, 1, 1, "7 - Example College"), (0, 3, 2, "Tuition and required fees for full-time students, by level"), (0, 4, 2, "Level of student"), (0, 4, 3, "Tuition and required fees"), (0, 5, 2, "Undergraduate"),
    (0, 5, 3, "$12,345"), (0, 6, 2, "Graduate"), (0, 6, 3, "n/a"), (1, 1, 1, "Enrollment by gender, 2023"), (1, 3, 2, "Total"), (1, 3, 3, "Men"), (1, 3, 4, "Women"), (1, 4, 1, "All students"), (1, 4, 2, "3,234"),
    (1, 4, 3, "1234"), (1, 4, 4, " 2000 "),
)


@query("SELECT s_suppkey AS unitid, '$12,345' AS tuition_fees_ug_2024_25, '' AS tuition_fees_grad_2024_25, '3,234' AS enrollment_total, '1234' AS enrollment_men, '2000' AS enrollment_women, '' AS pct_Asian FROM supplier")
def workbook_fields(spark: SparkSession, d: str) -> DataFrame:
    """Tuition and enrolment from the cells of workbooks."""
    sheet = literals(spark, _SHEET, "sheet int, row int, col int, value string").drop("k")
    rows = parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("unitid")).join(sheet)  # a workbook for each
    found = cells.workbook_fields(rows, ["unitid"])
    return found.select("unitid", *FIELDS[:5], "pct_Asian")
