"""URLs: parts, what their paths say of a page, and how promising a link is, as expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hints, patterns and points of this block.
INVENTORY_HINTS = (
    "/programs", "/academics/programs", "/majors-minors", "/majors", "/departments-and-programs", "/departments", "/areas-of-study", "/fields-of-study", "/academic-programs", "find-your-program",
)
CATALOG_HINTS = ("catalog", "catalogue", "college-catalog", "course-catalog", "bulletin")
CANONICAL_HUBS = (
    "/programs", "/academics/programs", "/majors-minors", "/academics/majors-minors", "/majors", "/academics/majors", "/departments-and-programs", "/academics/departments-and-programs",
    "/departments", "/academics/departments", "/areas-of-study", "/fields-of-study", "/academic-programs", "/academics/academic-programs",
)
LISTING = (
    r"/programs/[^/]+/?$", r"/majors-minors/[^/]+/?$", r"/majors/[^/]+(\.html|\.shtml)?$", r"/majors-programs/[^/]+", r"/departments-and-programs/[^/]+/?$",
    r"/academics/departments-and-programs/[^/]+/?$", r"/departments/[^/]+/?$", r"/academiclife/departments/[^/]+/?$",
)
DETAIL = (
    r"/programs/[^/]+/.+", r"/majors-minors/[^/]+/.+", r"/departments-and-programs/[^/]+/.+", r"/departments/[^/]+/.+", r"/majors/[^/]+(\.html|\.shtml)?$", r"/majors-programs/[^/]+",
    r"/academiclife/departments/[^/]+/?$", r"/content/.*/departments/[^/]+\.html$",
)
SITEMAP_PROGRAM = (
    r"/academics/majors-minors/[^/]+/index\.html?$", r"/academics/majors-minors/[^/]+/?$", r"/programs/[^/]+/?$", r"/departments-and-programs/[^/]+/?$",
    r"/academics/departments-and-programs/[^/]+/?$", r"/departments/[^/]+/?$",
)
TOO_SPECIFIC = (r"/departments?/[a-z0-9_-]+", r"/departments-and-programs/[a-z0-9_-]+", r"/programs?/[a-z0-9_-]+", r"/academics/.+/(major|minors|programs)\b")
HUB_PATHS = (
    "majors", "minors", "programs", "degrees", "department", "departments", "departments-and-programs", "academics", "academic", "catalog", "bulletin", "undergraduate",
    "undergraduate-programs", "courses", "areas-of-study",
)
NON_ACADEMIC = (
    "news", "event", "calendar", "giving", "alumni", "advancement", "athletics", "sports", "tickets", "shop", "bookstore", "it", "its", "help", "support", "login", "privacy", "accessibility",
    "admissions", "apply", "visit", "tuition", "financial-aid", "student-life", "housing", "dining", "library", "about", "contact", "directory", "people", "faculty", "staff", "press", "media",
    "magazine", "blog", "policy",
)
SUBSITE = ("center", "centre", "institute", "office", "community", "belonging", "extension", "continuing-ed", "continuing-education", "professional", "outreach", "nwo", "cge")
HARD_BLOCKS = ("nwo", "cge")
ACADEMIC_SUBDOMAINS = ("www", "majors", "programs", "catalog", "bulletin", "courses")
ROOT_PREFIXES = ("www.", "m.", "web.")
GRADUATE = r"\b(graduate|grad-studies|gradstudies|master|masters|doctoral|phd|mba|mfa|ms|ma)\b"
PROFILE = r"(/people/|/person/|/faculty/|/faculty-directory/|/staff/|/directory/|/profiles?/|/bio/|/biography/)"
IRRELEVANT = r"(/news/|/events/|/event/|/calendar/|/press/|/alumni/|/giving/|/donate/|/commencement|/story/|/blog/|/announcement/)"
ADMISSIONS = r"(/admissions/|/apply/|/visit/|/financial-aid/|/tuition/|/request-info/)"
ARCHIVE = r"\barchive\b|/past-|/past/"
AWARDS = r"\b(awards?|honors?)\b"
COMPLIANCE = r"(consumer-information|disclosures?|cip\b|gainful-employment|institutional-research)"
PRIOR_WORDS = ("academics", "academic", "program", "major", "minor", "depart", "areas-of-study", "fields-of-study")
YEAR_TOKENS = ("2526", "20252026", "2025-2026", "2025\u20132026", "2025\u20142026", "2025_2026", "202526", "25-26", "25\u201326", "25_26")
YEAR_PATHS = (
    "/catalog/{y}", "/catalogue/{y}", "/college-catalog/{y}", "/course-catalog/{y}", "/academic-catalog/{y}", "/bulletin/{y}", "/academics/catalog/{y}", "/academiclife/college-catalog/{y}",
)
SUBDOMAINS = ("majors", "programs", "catalog", "bulletin")
WWW = r"\bwww\.[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?:/[^\s]*)?"
EDU = r"\b(?:https?://)?(?:www\.)?[A-Za-z0-9.-]+\.edu(?:/[^\s]*)?"


def _any(words) -> str:
    return "|".join(re.escape(w) for w in words)


def _matches(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike("(?i)" + pattern), F.lit(False))


def with_scheme(url: Column) -> Column:
    """The URL, "https://" put before it where it has no web scheme; blank stays blank."""
    text = F.trim(F.coalesce(url, F.lit("")))
    return F.when(text == "", "").when(text.rlike("(?i)^https?://"), text).otherwise(F.concat(F.lit("https://"), text))


def netloc(url: Column) -> Column:
    """Lower-cased host, with port; blank for text without a scheme."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """Path as written, without query and fragment."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def site(url: Column) -> Column:
    """The last two labels of the host."""
    return last_labels(netloc(with_scheme(url)))


def root_domain(host: Column) -> Column:
    out = F.lower(F.trim(host))
    for prefix in ROOT_PREFIXES:
        out = F.when(out.startswith(prefix), F.substring(out, len(prefix) + 1, 1 << 30)).otherwise(out)
    return out


def last_labels(host: Column) -> Column:
    """The last two labels, about what is registered."""
    labels = F.filter(F.split(root_domain(host), r"\."), lambda x: x != "")
    return F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(root_domain(host))


def defragged(url: Column) -> Column:
    return F.regexp_replace(url, r"#.*$", "")


def depth(url: Column) -> Column:
    return F.size(F.filter(F.split(path(url), "/"), lambda p: p != ""))


def joined(base: Column, to: str) -> Column:
    """An absolute path on the site of ``base``."""
    return F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.lit(to))


def same_domain(url: Column, base: Column) -> Column:
    """Whether the host ends in that of ``base`` (a host)."""
    return netloc(url).endswith(F.lower(base))


def is_hard_block(url: Column, base: Column) -> Column:
    u = with_scheme(url)
    full = F.concat(netloc(u), F.lower(path(u)))
    return (u == "") | (last_labels(netloc(u)) != last_labels(base)) | full.rlike(_any(HARD_BLOCKS))


def is_subsite(url: Column, base: Column) -> Column:
    """Whether a URL is of an office, a centre or another site than ``base`` (a host)."""
    u = with_scheme(url)
    host = netloc(u)
    first = F.regexp_extract(host, r"^\.*([^.]+)", 1)
    other = (host != F.lower(base)) & (first != "") & ~first.isin(*ACADEMIC_SUBDOMAINS)
    return (u == "") | (last_labels(host) != last_labels(base)) | other | F.concat(host, F.lower(path(u))).rlike(_any(SUBSITE))


def is_too_specific(url: Column) -> Column:
    return F.lower(path(url)).rlike("|".join(TOO_SPECIFIC))


def is_inventory(url: Column) -> Column:
    return F.lower(url).rlike(_any(INVENTORY_HINTS))


def is_catalog(url: Column) -> Column:
    return F.lower(url).rlike(_any(CATALOG_HINTS))


def is_canonical_hub(url: Column) -> Column:
    return F.regexp_replace(F.lower(path(url)), "/+$", "").isin(*CANONICAL_HUBS)


def is_detail(url: Column) -> Column:
    return _matches(path(url), "|".join(DETAIL))


def is_listing(url: Column) -> Column:
    return _matches(path(url), "|".join(LISTING))


def is_program_detail(url: Column) -> Column:
    return is_listing(url) | _matches(path(url), "/majors-programs/[^/]+")


def tier(url: Column) -> Column:
    low, p = F.lower(url), path(url)
    return F.when(p.isin("", "/"), "homepage").when(is_inventory(url), "inventory").when(low.contains("bulletin"), "bulletin").when(low.rlike(_any(CATALOG_HINTS[:-1])), "catalog").otherwise("other")


def row_tag(address: Column, best: Column) -> Column:
    """What kind of page the best URL of an institution is, by its words."""
    base, u = netloc(with_scheme(address)), with_scheme(best)
    host, p = netloc(u), F.lower(path(u))
    full = F.concat(host, p)
    return (
        F.when((u == "") | (best == "N/A") | full.rlike(_any(NON_ACADEMIC)), "Wrong non-academic")
        .when(((base != "") & (last_labels(host) != last_labels(base))) | full.rlike(_any(SUBSITE)), "Wrong subsite")
        .when(p.rlike(_any(HUB_PATHS)), F.when(p.rlike("|".join(TOO_SPECIFIC)), "Correct-ish but too specific").otherwise("Correct hub"))
        .when(p.rlike("academ|catalog|bulletin"), "Correct-ish but too specific").otherwise("Wrong subsite")
    )


def _points(rules) -> Column:
    out = F.lit(0)
    for rule, n in rules:
        out = out + F.when(rule, n).otherwise(0)
    return out


def prior(url: Column, base: Column, subsite_penalty: int = 80) -> Column:
    """How promising a URL is before it is read."""
    low = F.lower(url)
    return _points([
        (low.rlike(_any(INVENTORY_HINTS)), 200), (low.rlike(_any(PRIOR_WORDS)), 90), (low.rlike("catalog|catalogue"), 35), (low.contains("bulletin"), -20),
        (_matches(low, IRRELEVANT), -260), (_matches(low, ADMISSIONS), -160), (_matches(low, PROFILE), -320), (_matches(low, ARCHIVE), -140), (_matches(low, COMPLIANCE), -90),
        (_matches(low, AWARDS), -160), (_matches(low, GRADUATE), -180), (is_hard_block(url, base), -10_000), (is_subsite(url, base), -subsite_penalty), (is_canonical_hub(url), 160),
    ])


def link_rank(anchor: Column, url: Column, base: Column, subsite_penalty: int = 80) -> Column:
    """Order of links of a page, the most promising first; links to other sites last."""
    text = F.lower(F.coalesce(anchor, F.lit("")))
    score = prior(url, base, subsite_penalty) + _points([
        (text.rlike(r"\b(majors|minors|programs|departments|areas|fields|undergraduate)\b"), 45), (text.rlike(r"\b(admissions|apply|visit)\b"), -90), (text.rlike(r"\b(faculty|staff|directory)\b"), -140),
    ])
    return F.when(same_domain(url, base), -score).otherwise(10_000)


def year_candidates(base: Column) -> Column:
    """Catalogue addresses of the year on a site, each once, in order."""
    return F.array_distinct(F.array(*[joined(base, p.replace("{y}", y)) for y in YEAR_TOKENS for p in YEAR_PATHS]))


def subdomain_roots(base: Column) -> Column:
    root = root_domain(netloc(base))
    return F.when(root.contains("."), F.array(*[F.concat(F.lit(f"https://{s}."), root, F.lit("/")) for s in SUBDOMAINS])).otherwise(F.array().cast("array<string>"))


def is_sitemap_candidate(url: Column) -> Column:
    """Whether an address of a sitemap is worth reading."""
    low = F.lower(url)
    skipped = _matches(low, IRRELEVANT) | _matches(low, ADMISSIONS) | _matches(low, PROFILE) | _matches(low, ARCHIVE) | low.contains("grad")
    return ~skipped & _matches(low, "|".join(SITEMAP_PROGRAM))


def address_in_text(text: Column) -> Column:
    """The web address in a page's text: the first with "www.", else the first ".edu" without its scheme."""
    www, edu = F.regexp_extract(text, "(?i)" + WWW, 0), F.regexp_extract(text, "(?i)" + EDU, 0)
    return F.when(www != "", www).otherwise(F.regexp_replace(F.coalesce(edu, F.lit("")), "(?i)^https?://", ""))


def numericish(value: Column) -> Column:
    """Whether a cell reads as a number: optional dollar sign, digits with commas, decimals, percent."""
    return F.coalesce(F.trim(value).rlike(r"^[$]?\s*\d[\d,]*(\.\d+)?\s*%?$"), F.lit(False))
