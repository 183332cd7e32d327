"""What the text of a page says: terms it names, and which of its phrases are program titles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import squeezed

# Terms, patterns and points of this block.
CONTROL_TERMS = {
    "anthropology": r"\banthropolog[a-z]*\b",
    "math": r"\bmath[a-z]*\b",
    "linguistics": r"\blinguist[a-z]*\b",
    "chem": r"\bchem(?:istry|ical)?\b",
    "architect": r"\barchitect[a-z]*\b",
    "economics": r"\beconomics?\b",
    "psychology": r"\bpsycholog[a-z]*\b",
    "sociology": r"\bsociolog[a-z]*\b",
    "history": r"\bhistory\b",
    "english": r"\benglish\b",
    "political_science": r"\bpolitical\s+science\b|\bpolisci\b",
    "philosophy": r"\bphilosoph[a-z]*\b",
    "computer_science": r"\bcomputer\s+science\b|\bcomp\s+sci\b|\bcs\b(?![a-z])",
    "engineering": r"\bengineering\b",
    "physics": r"\bphysics\b",
    "geology": r"\bgeolog[a-z]*\b",
    "statistics": r"\bstatistic[a-z]*\b",
    "neuroscience": r"\bneuroscien[a-z]*\b",
}
STRUCT_TERMS = {
    "majors": r"\bmajors?\b", "minors": r"\bminors?\b", "degrees": r"\bdegrees?\b", "programs": r"\bprograms?\b", "bachelor": r"\bbachelor(?:'s)?\b", "BA": r"\bB\.?A\.?\b", "BS": r"\bB\.?S\.?\b",
}
TARGET_TOKENS = {
    "afri": r"\b(africa(?:n|na)?|pan[-\s]?african|african[-\s]?american|afro[-\s]?american|africology)\b",
    "ethnic": r"\b(ethnic[a-z\-]*|ethnicity)\b",
    "black": r"\bblack[a-z\-]*\b",
    "race": r"\b(race|racial)\b",
}
TARGET_ANY = r"\b(africa(?:n|na)?|pan[-\s]?african|african[-\s]?american|afro[-\s]?american|africology|ethnic[a-z\-]*|ethnicity|black[a-z\-]*|race|racial)\b"
NEGATIVE_CONTEXT = r"\b(student\s+union|black\s+student|history\s+month|cultural\s+center|lives\s+matter|alumni|news|event|calendar|office)\b"
COURSE_CODE = r"^\s*[A-Z]{2,6}(?:/[A-Z]{2,6})*\s*[-]?\s*\d{1,3}[A-Za-z]?\b"  # case counts
COURSE_WORDS = r"\b(units?|credits?|semester|fall|spring|course(s)?|syllabus)\b"
PERSON_NAME = r"^[A-Z][a-z]+(?:\s+[A-Z]\.)?(?:\s+[A-Z][a-z]+){1,2}$"  # case counts
PROGRAM_KEYWORDS = r"\b(studies|program|department|major|minor|concentration|track|certificate|center)\b"
URL_LIKE = r"(https?://|www\.|\b[a-z0-9\-]+\.(edu|com|org|net)(/|\b))"
PROSE_VERBS = r"\b(define|apply|enrich|explore|learn|prepare|prepares|focus(es)?|offers|provides|designed|helps|aims)\b"
PLATFORMS = r"\b(facebook|instagram|twitter|linkedin|youtube|blackboard|canvas|email|login)\b"
SLUG_LIKE = r"^[a-z0-9\-]{10,}$"  # case counts
HARD_DROPS = r"\b(lecturer\s+pool|job|position|apply\b|hiring\b|employment\b)\b"
CONTENT_WORDS = r"\b(discusses|announces|becomes|celebrate|event|workshop|lecture|seminar|news|story|profile|alumni|upcoming)\b"
TITLE_YEARISH = "\\b(20\\d{2}|\\d{2}\\s*[-\u2013\u2014/]\\s*\\d{2})\\b"
DEGREE_LABEL = r"\b(B\.?A\.?|B\.?S\.?|BA|BS)\b"
SALVAGED = (
    r"^\s*welcome\s+to\s+(.+)$", r"^\s*about\s+(?:the\s+)?(?:program|department)\s+(?:in|of)\s+(.+)$", r"^\s*view\s+(.+)$", r"^\s*connect\s+with\s+(.+)$",
    r"^\s*prospective\s+students\s*:\s*(.+)$", r"^\s*learn\s+more\s+about\s+(.+)$", r"^\s*explore\s+(.+)$",
)
KEY_DROPS = (r"\b(program|department|major|minor|concentration|certificate|track|option)\b", r"\b(the|of|in|for|and|to|a|an)\b")
SYNONYMS = (
    ("&", " and "), (r"\bdept\.?\b", " department "), (r"\bprog\.?\b", " program "), ("\\bafrican\\s*[-\u2013\u2014]\\s*american\\b", " african american "),
    ("\\bafro\\s*[-\u2013\u2014]?\\s*american\\b", " african american "), (r"\bblack\s+studies\b", " africana studies "), ("\\bwomen['\u2019]s\\b", " women "),
    (r"\bgender\s+and\s+sexuality\b", " gender sexuality "), (r"\bcarribbean\b", " caribbean "),
)
CAMPUS = r"\b(main\s+campus|downtown\s+campus|online|global\s+campus)\b"
SCHOOL_SUFFIX = r"\b(university|college|institute|school|state\s+university|community\s+college|polytechnic|campus)\b"
SUFFICIENT_CONTROLS = 10


def has(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike("(?iU)" + pattern), F.lit(False))


def hits(text: Column, terms: dict[str, str]) -> Column:
    """Names of the terms a text has, in their order."""
    return F.array_compact(F.array(*[F.when(has(text, p), F.lit(name)) for name, p in terms.items()]))


def token_matches(text: Column, family: str) -> Column:
    """The distinct words of a family in a text, as written, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("(?iU)" + TARGET_TOKENS[family]), F.lit(0))))


def sufficiency(n_controls: Column, least: int = SUFFICIENT_CONTROLS) -> Column:
    return F.when(n_controls < least, f"warning_{least}_MajorsFound").otherwise("sufficient majors")


def has_intent(title: Column) -> Column:
    """Whether a title is worded as a program."""
    low = F.lower(title)
    return has(title, PROGRAM_KEYWORDS) | low.rlike(r" studies( program)?$") | low.rlike("^(department of |center for |centre for )")


def is_program_title(title: Column, strictness: int = 3, context: str = "hub") -> Column:
    """Whether a phrase of a page is a program title; ``context`` is "hub" or "follow" for pages one link further."""
    n, low = F.length(title), F.lower(title)
    keyed, studies = has(title, PROGRAM_KEYWORDS), low.contains("studies")
    no = (n < 6) | (n > 140) | has(title, URL_LIKE) | low.contains("toggle") | ~has(title, TARGET_ANY) | title.rlike(COURSE_CODE) | has(title, COURSE_WORDS)
    no = no | (title.contains(". ") & (n >= 40)) | (title.contains(": ") & (n >= 55) & ~keyed & ~has(title, DEGREE_LABEL))
    if context == "follow" or strictness >= 3:
        no = no | (has(title, PROSE_VERBS) & (n >= 45))
    no = no | ((n > 90) & (F.length(title) - F.length(F.replace(title, F.lit(","))) >= 2) & ~keyed)
    if context == "follow":
        no = no | (~keyed & ~studies)
    if strictness >= 3:
        no = no | (title.rlike(PERSON_NAME) & ~keyed)
    if strictness >= 4:
        no = no | (~keyed & ~studies)
    if strictness >= 5:
        no = no | has(title, NEGATIVE_CONTEXT) | title.rlike(PERSON_NAME)
    return F.coalesce(~no, F.lit(False))


def salvaged(title: Column) -> Column:
    """The title, and what follows phrases such as "welcome to"."""
    tails = [F.when(title.rlike("(?iU)" + p), squeezed(F.regexp_extract(title, "(?iU)" + p, 1))) for p in SALVAGED]
    return F.filter(F.array_compact(F.array(title, *tails)), lambda t, i: (t != "") & ((i == 0) | (t != title)))


def chunks(title: Column) -> Column:
    """Pieces of a breadcrumb or of titles run together."""
    parts = F.split(F.regexp_replace(title, " / ", "|"), "[|\u2022\u00b7\u2013\u2014]")
    return F.filter(F.transform(parts, squeezed), lambda t: t != "")


def without_degree(title: Column) -> Column:
    """Title without ": BA" and a degree at its end."""
    out = F.regexp_replace(title, r"(?iU)\s*:\s*(B\.?A\.?|B\.?S\.?|BA|BS)\b\s*", " ")
    return squeezed(F.regexp_replace(out, r"(?iU)\s+\b(B\.?A\.?|B\.?S\.?|BA|BS)\b\s*$", ""))


def variant_score(title: Column) -> Column:
    """How well a variant of a title reads as a name."""
    low, n, intent = F.lower(title), F.length(title), has_intent(title)
    rules = [
        (intent, 40), (has(title, r"\b(major|minor|concentration|certificate)\b"), 15), (low.startswith("department of "), 8), (low.endswith(" studies"), 10), (has(title, HARD_DROPS), -200),
        (has(title, TITLE_YEARISH), -80), (has(title, CONTENT_WORDS) & ~intent, -120), (has(title, r"^(about|welcome|view|connect|prospective\s+students)\b"), -40), ((n >= 8) & (n <= 80), 5), (n > 110, -25),
    ]
    return reduce(lambda a, b: a + b, [F.when(rule, points).otherwise(0) for rule, points in rules])


def is_dropped(title: Column, strictness: int = 3) -> Column:
    """Whether a piece of a title is no title: platforms, addresses, courses, prose, or out of scope."""
    n, intent = F.length(title), has_intent(title)
    out = (title == "") | has(title, PLATFORMS) | title.rlike(r"^/\s*") | title.rlike(SLUG_LIKE) | has(title, URL_LIKE) | has(title, HARD_DROPS) | title.rlike(COURSE_CODE) | has(title, COURSE_WORDS)
    out = out | ~has(title, TARGET_ANY) | (title.contains(". ") & (n >= 40)) | (title.contains(": ") & (n >= 60) & ~intent)
    return out | ((has(title, CONTENT_WORDS) | has(title, PROSE_VERBS)) & ~intent) if strictness >= 3 else out


def strict_key(title: Column) -> Column:
    """Key of page titles that are the same: only letters, digits, underscores, spaces, hyphens and "and"."""
    return squeezed(F.regexp_replace(F.regexp_replace(F.lower(title), r"(?U)[^\w\s&-]", ""), "&", " and "))


def loose_key(title: Column) -> Column:
    """The strict key without levels, units and stop-words; other signs become spaces."""
    out = F.regexp_replace(F.lower(title), "&", " and ")
    for pattern in KEY_DROPS:
        out = F.regexp_replace(out, "(?iU)" + pattern, " ")
    return squeezed(F.regexp_replace(out, r"(?U)[^\w\s-]", " "))


def with_synonyms(title: Column) -> Column:
    return squeezed(reduce(lambda out, rule: F.regexp_replace(out, "(?iU)" + rule[0], rule[1]), SYNONYMS, title))


def tokens(title: Column) -> Column:
    """Distinct words of the loose key of three letters or more."""
    return F.array_distinct(F.filter(F.split(loose_key(title), r"(?U)[\s_-]+"), lambda w: F.length(w) >= 3))


def split_field(text: Column) -> Column:
    """Titles of a field: split at pipes, semicolons, and at commas where a part has two or more."""
    from ..operators.candidates import _count, listed

    parts = F.flatten(F.transform(listed(text, "[|;]"), lambda p: F.when(_count(p, ",") >= 2, listed(p, ",")).otherwise(F.array(p))))
    return F.transform(parts, squeezed)


def key_set(titles: Column, loose: bool = False) -> Column:
    """Distinct keys of an array of titles."""
    keyed = F.transform(titles, lambda t: loose_key(with_synonyms(t)) if loose else strict_key(t))
    return F.array_distinct(F.filter(keyed, lambda k: k != ""))


def concordant(a: Column, b: Column) -> Column:
    """1 if two sets of keys share one."""
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False)).cast("int")


def clean_titles(rows: DataFrame, keys: list[str], title: str = "title", strictness: int = 3) -> DataFrame:
    """``keys, title``: the best variant of each program title of a key, by score, then shortness, then text."""
    pieces = rows.select(*keys, F.explode(salvaged(F.col(title))).alias("t")).select(*keys, F.explode(chunks(F.col("t"))).alias("t"))
    named = pieces.select(*keys, without_degree(F.col("t")).alias("t")).where(~is_dropped(F.col("t"), strictness)).withColumn("k", strict_key(F.col("t"))).where("k != ''")
    best = named.groupBy(*keys, "k").agg(F.min_by("t", F.struct(-variant_score(F.col("t")), F.length("t"), "t")).alias("title"))
    return best.select(*keys, "title")


def slug(name: Column) -> Column:
    """A school's name as it stands in addresses."""
    out = F.regexp_replace(F.regexp_replace(F.lower(name), "&", " and "), "[\"']", "")
    out = F.replace(squeezed(F.regexp_replace(out, r"[^a-z0-9\s-]", " ")), F.lit(" "), F.lit("-"))
    return F.regexp_replace(F.regexp_replace(out, "-+", "-"), "^-|-$", "")


def slug_candidates(name: Column) -> Column:
    """Up to four ways a school's name may stand in addresses, the likeliest first."""
    campus = squeezed(F.regexp_replace(F.regexp_replace(name, r"(?U)\s*\([^)]*\)\s*", " "), "(?iU)" + CAMPUS, " "))
    short = squeezed(F.regexp_replace(name, "(?iU)" + SCHOOL_SUFFIX, " "))
    bare = squeezed(F.regexp_replace(name, r"(?iU)^the\s+", ""))
    return F.slice(F.array_distinct(F.filter(F.array(*map(slug, (name, campus, short, bare))), lambda s: s != "")), 1, 4)


