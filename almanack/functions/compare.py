"""Scalars by which two program titles are compared, as expressions over titles in plain form (:func:`.text.plain_text`).

Nothing here needs Python workers but :func:`sequence_ratio`, for which there is no built-in.
"""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import squeezed

# All word lists, patterns and numbers of this block.
TO_SPACE = "[\\t\\n\\r\\f\\x0B\u2010\u2011\u2012\u2013\u2014\u2212_/]+"
QUOTES = "[\"'\u2019]"
LOOSE_DROPS = (
    r"\b(b\.?a\.?|b\.?s\.?|ba|bs|m\.?a\.?|m\.?s\.?|ma|ms|ph\.?d\.?|phd)\b",
    r"\b(bachelor|master|masters|doctorate|doctoral)\b",
    r"\b(major|minor|certificate|concentration|track|option|emphasis)\b",
    r"\b(in|of|and|for|the|a|an)\b",
)
LEADING_DEGREE = r"^(ba|bs|b\.a\.|b\.s\.|ma|ms|m\.a\.|m\.s\.|master of arts|master of science|bachelor of arts|bachelor of science)\s+in\s+"
GENERIC_TOKENS = ("other", "misc", "general")
SYNONYMS = (
    ("&", " and "),
    (r"\bdept\.?\b", " department "),
    (r"\bprog\.?\b", " program "),
    ("\\bafrican\\s*[-\u2013\u2014]\\s*american\\b", " african american "),
    ("\\bafro\\s*[-\u2013\u2014]?\\s*american\\b", " african american "),
    (r"\bafricology\b", " africana studies "),
    ("\\bpan\\s*[-\u2013\u2014]?\\s*african\\b", " pan african "),
    (r"\bpan\s+african\s+studies\b", " africana studies "),
    (r"\bblack\s+studies\b", " africana studies "),
    ("\\bwomen['\u2019]s\\b", " women "),
    (r"\bgender\s+and\s+sexuality\b", " gender sexuality "),
    (r"\bcarribbean\b", " caribbean "),
)
SIGNAL_MARKER = r"\b(department|dept\.?|school|college|division|faculty|center|centre|institute|program\b\s+in|committee|council|office|administration|administrative|unit)\b"
STRUCTURED_KINDS = ("department_unit", "center_institute", "committee_admin", "other_nonprogram", "junk", "course", "event_news", "maybe_program", "program")
CREDENTIAL = r"\b(minor|major|certificate|concentration)\b"
PRIMARY_ACADEMIC = r"\b(program|major|minor|department|dept\.?|studies)\b"
SECONDARY_ORG = r"\b(center|centre|institute|committee|council|association)\b"
BOILERPLATE = r"\b(check\s+out|prospective\s+students\s*:|welcome\s+to|read\s+more|learn\s+more|please\s+visit|click\s+here|find\s+out\s+more|explore\s+the)\b"
BOILERPLATE_SAFE = r"\b(studies|department|dept\.?|program|major|minor|concentration|certificate)\b"
NONPROGRAM_PREFIX = r"^(why|about|welcome|visit|check\s+out|read\s+more|learn\s+more|prospective\s+students)\b"
NONPROGRAM_WORD = r"\b(news|event|events|donate|faculty|staff|calendar|meeting|committee\s+meeting|committee|updated|please\s+visit|note\s*:|curriculum\s+review)\b"
YEARISH = "\\b(19\\d{2}|20\\d{2})(?:\\s*[-/\u2010-\u2015]\\s*\\d{2,4})?\\b"
MEGA_NAVIGATION = r"\b(welcome\s+to|prospective\s+students|check\s+out|read\s+more|learn\s+more|visit)\b"
MEGA_CREDENTIAL = r"\b(ba|b\.?a\.?|bs|b\.?s\.?|ma|m\.?a\.?|ms|m\.?s\.?|phd|ph\.?d\.?|bachelor|master|doctoral|major|minor|certificate|concentration|degree\s+type)\b"
MEGA_TOKENS, MEGA_ALWAYS = 22, 30
BETWEEN = "[\\s\\-\u2010\u2011\u2012\u2013\u2014\u2212]+"
AFRICAN_AMERICAN = rf"\bafrican(?:{BETWEEN})american\b"
AFRO_AMERICAN = rf"\bafro(?:{BETWEEN})american\b"
STRONG = rf"\b(black|africana|{AFRICAN_AMERICAN}|{AFRO_AMERICAN})\b"
RENAME_FAMILY = rf"\b(africana|black|pan{BETWEEN}?african|{AFRICAN_AMERICAN}|{AFRO_AMERICAN})\b|\bafrican\s+and\s+african\s+american\b"
RESCUE_ANCHOR = r"\b(race|racial|ethnic|ethnicity|diaspora|african|africana|black|latinx|indigenous|sovereignty|queer|gender|women)\b"
FAMILY_DASHES = "[\u2010\u2011\u2012\u2013\u2014\u2015\u2212]"
FAMILIES = {
    "black": (r"\bblack\b", AFRICAN_AMERICAN, AFRO_AMERICAN, r"\bblack\s+diaspor", r"\bpan[-\s]?african\b"),
    "africana": (r"\bafricana\b", r"\bpan[-\s]?african\b", r"\bafrican\s+diaspor"),
    "african": (r"\bafrican\b", r"\bafrica\b"),
    "ethnic": (
        r"\bethnic\b", r"\bethnicity\b", r"\bmulticultural(?:ism)?\b", r"\bmulti[-\s]?cultural(?:ism)?\b", r"\bmulti[-\s]?ethnic\b", r"\binter[-\s]?cultural\b",
        r"\bcultural\s+minority\b", r"\bmigration\b", r"\bchicanx\b", r"\blatinx\b", r"\basian\s+american\b", r"\bnative\s+american\b",
    ),
    "race": (r"\brace\b", r"\bracial\b", r"\bjustice\b", r"\bequity\b"),
}
RELATED = {
    "black": ("black", "africana", "african"),
    "africana": ("africana", "black", "african"),
    "african": ("african", "africana", "black"),
    "ethnic": ("ethnic", "race"),
    "race": ("race", "ethnic"),
}
TAXONOMY_LABELS = (
    "Ethnic Studies", "Race and Ethnicity", "African American Studies", "Africana Studies", "African Studies", "Black Studies", "Gender Studies", "Women's Studies",
    "Women and Gender Studies", "Latinx Studies", "Chicanx Studies", "Asian American Studies", "Native American Studies", "Indigenous Studies", "Queer Studies", "LGBTQ Studies",
)
ENTITY_PENALTY, BOILERPLATE_PENALTY = 0.15, 0.25


def has(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike("(?iU)" + pattern), F.lit(False))


def without(text: Column, pattern: str, by: str = " ") -> Column:
    return F.regexp_replace(text, "(?iU)" + pattern, by)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def strict_key(title: Column) -> Column:
    """Key of titles that are the same: "and" for ampersands, dashes, slashes and underscores as spaces, no quotes, lower case."""
    out = F.regexp_replace(F.regexp_replace(title, "&", " and "), TO_SPACE, " ")
    return F.lower(squeezed(F.regexp_replace(out, QUOTES, "")))


def loose_key(title: Column) -> Column:
    """The strict key without degrees, levels and stop-words."""
    return squeezed(reduce(without, LOOSE_DROPS, strict_key(title)))


def canonical(title: Column, parentheses: bool = True) -> Column:
    """Title without a leading degree phrase, and without what is in parentheses if these are not to stay."""
    out = squeezed(F.regexp_replace(title, "&", " and "))
    if not parentheses:
        out = squeezed(F.regexp_replace(out, r"(?U)\s*\([^)]*\)\s*", " "))
    return squeezed(without(out, LEADING_DEGREE, ""))


def with_synonyms(title: Column) -> Column:
    """Title with equivalent names made one; for partial comparison only."""
    return squeezed(reduce(lambda out, rule: without(out, *rule), SYNONYMS, title))


def tokens(title: Column) -> Column:
    """Distinct content words of three letters or more."""
    words = F.split(loose_key(title), r"(?U)[\s_-]+")
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*GENERIC_TOKENS)))


def overlap(a: Column, b: Column, guarded: bool = True) -> Column:
    """Shared share of the smaller token set; a single token against three or more counts against the larger set if ``guarded``."""
    both, low, high = F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    out = F.when(low == 0, 0.0)
    return (out.when((low == 1) & (high >= 3), both / high) if guarded else out).otherwise(both / low)


def coverage(a: Column, b: Column) -> Column:
    """Share of the tokens of ``a`` that ``b`` has."""
    return F.when(F.size(a) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratio of matching blocks (Ratcliff and Obershelp) of two strings; 0 if either is empty or null."""

    def ratios(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, s, t).ratio() if s and t else 0.0 for s, t in zip(x, y)], dtype="float64")

    # made here, so that workers get it by value and need no copy of this package
    return F.pandas_udf(ratios, T.DoubleType())(a, b)


def families(title: Column) -> Column:
    """The subject families a title names, in the order of ``FAMILIES``."""
    text = squeezed(F.regexp_replace(title, FAMILY_DASHES, "-"))
    return F.array_compact(F.array(*[F.when(has(text, "(?:" + "|".join(patterns) + ")"), F.lit(name)) for name, patterns in FAMILIES.items()]))


def related(a: Column, b: Column) -> Column:
    """Whether a family of ``a`` is related to one of ``b``."""
    every = reduce(lambda x, y: x | y, [F.array_contains(a, name) & F.arrays_overlap(b, F.array(*map(F.lit, kin))) for name, kin in RELATED.items()])
    return F.coalesce(every, F.lit(False))


def is_signal(title: Column) -> Column:
    return has(title, SIGNAL_MARKER)


def has_credential(title: Column) -> Column:
    return has(title, CREDENTIAL)


def is_strong(title: Column) -> Column:
    return has(title, STRONG)


def is_rename_family(title: Column) -> Column:
    return has(title, RENAME_FAMILY)


def is_navigation(title: Column) -> Column:
    return has(title, NONPROGRAM_PREFIX)


def is_nonprogram(title: Column) -> Column:
    return (title == "") | is_navigation(title) | has(title, NONPROGRAM_WORD) | title.endswith("?")


def has_year(title: Column) -> Column:
    return has(title, YEARISH)


def is_boilerplate(title: Column) -> Column:
    """Boilerplate without an academic word: dropped."""
    return (title == "") | (has(title, BOILERPLATE) & ~has(title, BOILERPLATE_SAFE))


def boilerplate_penalty(title: Column) -> Column:
    """Share of its score that boilerplate with an academic word loses."""
    return F.when(title == "", 1.0).when(has(title, BOILERPLATE) & has(title, BOILERPLATE_SAFE), BOILERPLATE_PENALTY).otherwise(0.0)


def is_mega(title: Column) -> Column:
    """Whether a title is a whole page run together."""
    n = F.size(_words(strict_key(title)))
    credentials = F.regexp_count(title, F.lit("(?iU)" + MEGA_CREDENTIAL))
    return (title == "") | (n >= MEGA_ALWAYS) | ((n >= MEGA_TOKENS) & (has(title, MEGA_NAVIGATION) | (credentials >= 2)))


def is_fragment(title: Column) -> Column:
    """Whether a title is a piece left by splitting."""
    return (title == "") | has(title, r"^(and|or|&)\b") | (F.length(title) < 10) | (F.size(tokens(title)) < 2)


def _ends_in_studies(title: Column, most: int | None = None, least: int = 1) -> Column:
    words = _words(strict_key(title))
    out = F.coalesce(F.get(words, F.size(words) - 1) == "studies", F.lit(False)) & (F.size(words) >= least)
    return out if most is None else out & (F.size(words) <= most)


def is_taxonomy_label(title: Column) -> Column:
    """Whether a third-party title reads as a category, not a program."""
    known = [label.lower().replace("'", "") for label in TAXONOMY_LABELS]
    return (title != "") & ~has_credential(title) & ~is_signal(title) & (strict_key(title).isin(known) | _ends_in_studies(title, most=3))


def is_academic_ref(title: Column) -> Column:
    return has_credential(title) | has(title, PRIMARY_ACADEMIC) | _ends_in_studies(title)


def is_organisation(title: Column) -> Column:
    return has(title, SECONDARY_ORG)


def title_class(title: Column, only_third_party: Column) -> Column:
    """taxonomy, secondary_org, primary_academic or other."""
    return (
        F.when(title == "", "other").when(only_third_party & is_taxonomy_label(title), "taxonomy").when(is_organisation(title), "secondary_org")
        .when(has(title, PRIMARY_ACADEMIC) | has_credential(title) | _ends_in_studies(title, most=3, least=2), "primary_academic").otherwise("other")
    )


def rescue_anchor(title: Column) -> Column:
    return F.lower(F.regexp_extract(title, "(?iU)" + RESCUE_ANCHOR, 1))


def without_prefix(title: Column) -> Column:
    """The title in ``kind:bucket:source:Title`` of a known kind; other text as it is."""
    kinds = "|".join(STRUCTURED_KINDS)
    whole = rf"(?iU)^({kinds})\s*:\s*[^:]*\s*:\s*(crawl|cv)\s*:\s*(.+)$"
    head = F.lower(F.trim(F.split(title, ":", 2)[0]))
    parts = F.split(title, ":")
    return F.when(title.rlike(whole), squeezed(F.regexp_extract(title, whole, 3))).when(head.isin(*STRUCTURED_KINDS) & (F.size(parts) >= 4), squeezed(F.get(parts, F.size(parts) - 1))).otherwise(title)
