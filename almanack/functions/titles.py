"""Classification of program titles: bucket, confidence and kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P
from . import rules as R
from .text import squeezed, title_text


def _match(pattern: str, *where: str) -> tuple:
    return ("match", pattern, *where)


_african_american = ("any", [_match(r"\bafrican[-\s]?american\b"), _match(r"\bafricana\b"), ("has", P.MENA_TERMS)])


def bucket_cases() -> list[tuple[tuple, str]]:
    cases = [(("has", P.FALSE_POSITIVES), "other")] + [(_match(p), b) for p, b in P.OVERRIDES]
    for bucket in P.BUCKETS:
        found = _match("|".join(P.BUCKET_PATTERNS[bucket]))
        cases.append((("all", [found, ("not", _african_american)]) if bucket == "african" else found, bucket))
    return cases


_in_scope = ("not", ("is", "bucket", "other"))
_studies_program = ("not", ("any", [_match(P.ADMIN), _match(P.STORY), _match(P.DESCRIPTOR)]))
_course = ("any", [_match(P.COURSE_PREFIX), ("has", P.COURSE_PHRASES)])
_from_cv = ("is", "source", "cv")

#: (condition, points, flag), over the columns title, low, n_words, source and bucket.
CONFIDENCE = [
    (("all", [_from_cv, _match(P.CV_TAXONOMY)]), 70, "cv_taxonomy_target"),
    (_match(P.STRONG_TOKEN), 60, "strong_token"),
    (_match(P.DEGREE_TOKEN), 40, "degree_token"),
    (_match(P.DEGREE_PHRASE), 60, "degree_phrase"),
    (_match(P.MAJOR_MINOR), 40, "major_minor_shorthand"),
    (("all", [_match(P.BARE_STUDIES), ("most", "n_words", 6), _in_scope]), 60, "bare_studies_name"),
    (("has", P.ANCHOR_PHRASES), 20, "anchor_phrase"),
    (("all", [("has", (" and ",)), ("has", P.ANCHOR_PHRASES), _studies_program]), 40, "compound_anchor"),
    (_in_scope, 10, "bucket_match:{bucket}"),
    (("all", [_from_cv, ("any", [("has", ("/",)), ("all", [("has", ("studies",)), ("most", "n_words", 8)])])]), 20, "cv_bonus"),
    (_match(P.ADMIN), -60, "admin_marker"),
    (_match(P.STORY), -60, "story_marker"),
    (("all", [_match(P.PROFILE_DASH, "title"), ("not", _match(P.DASH_SUFFIX))]), -60, "profile_dash"),
    (_match(P.DESCRIPTOR), -80, "descriptor_nonprogram"),
    (("all", [_course, ("not", _match(P.STRONG_TOKEN)), ("not", _match(P.MAJOR_MINOR))]), -80, "course_like"),
    (("all", [("over", "n_words", 12), ("not", _match(P.STRONG_TOKEN)), ("not", _match(P.DEGREE_TOKEN))]), -50, "sentence_like"),
]

_junk = ("any", [
    _match(P.YEAR), _match(P.CLASS_YEAR), ("has", P.JUNK_PHRASES),
    ("all", [("over", "n_words", 15), ("not", ("has", P.PROGRAM_TOKENS)), ("not", ("has", ("studies",)))]),
])
_degree = ("any", [_match(P.DEGREE_TOKEN), _match(P.DEGREE_PHRASE)])
_program_word = ("any", [("has", P.PROGRAM_TOKENS), _match(P.MAJOR_MINOR)])

#: (condition, kind), over the columns above and conf.
KINDS = [
    (("is", "low", ""), "junk"),
    (("all", [_from_cv, _match(P.CV_TAXONOMY)]), "program"),
    (_junk, "junk"),
    (("all", [("has", P.FALSE_POSITIVES), ("not", ("has", ("black studies", "african-american", "african american")))]), "junk"),
    (_match(P.DESCRIPTOR), "program_signal"),
    (("all", [_match(r"\bdepartment\b"), ("not", _degree)]), "department_unit"),
    (_match(P.COURSE_NUMBER), "course"),
    (("has", P.CENTERS), "center_institute"),
    (("has", P.COMMITTEES), "committee_admin"),
    (("has", P.TRIP_VERBS), "event_news"),
    (("all", [("has", P.COUNTRIES), ("not", _program_word)]), "event_news"),
    (("all", [_course, ("not", _program_word)]), "course"),
    (("over", "conf", 69), "program"),
    (("over", "conf", 39), "maybe_program"),
]


def _cut(text: Column, pattern: str) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "(?iU)" + pattern, ""), r"(?U)^\s+|\s+$", "")


def _without_track(title: Column) -> Column:
    """Title without its last parentheses, unless they name a track: "studies" or a subject of a bucket; acronyms always go."""
    track = F.trim(F.regexp_extract(title, "(?U)" + P.TRACK, 1))
    named = F.lower(track).contains("studies") | track.rlike("(?iU)" + "|".join(p for b in P.BUCKETS for p in P.BUCKET_PATTERNS[b]))
    acronym = track.rlike("^[A-Z]{2,6}$")
    return F.when(track == "", title).when(acronym, F.regexp_replace(title, r"(?U)\s*\((?:[A-Z]{2,6})\)\s*$", "")).when(named, title).otherwise(_cut(title, r"\s*\((?:[^)]*)\)\s*$"))


def _combined(title: Column) -> Column:
    """The label of a title that joins several subjects by "and"."""
    low = F.lower(title)
    out = F.when(~low.contains(" and "), title)
    mena = low.rlike("|".join(P.MENA_TERMS)) & low.contains("studies")
    long, short = "Middle Eastern and North African Studies", "Middle East and North Africa Studies"
    out = out.when(mena, F.when(low.contains("middle eastern"), long).when(low.contains("middle east"), short).when(low.contains("north african"), long).otherwise(title))
    out = out.when(low.rlike(r"(?U)\brace\s+and\s+ethnic\s+studies\b"), "Race and Ethnic Studies")
    for label in P.COMBINED:
        found = low.contains(label.lower())
        if label == "African Studies":
            found = found & ~low.rlike("|".join(P.NOT_AFRICAN))
        out = out.when(found, label)
    return out.otherwise(title)


def _halved(title: Column) -> Column:
    """The first half of a title that says the same twice, of six words or more."""
    words = F.split(title, " ")
    half = F.floor(F.size(words) / 2).cast("int")
    first, rest = F.array_join(F.slice(words, F.lit(1), half), " "), F.array_join(F.slice(words, half + 1, F.greatest(F.size(words) - half, F.lit(0))), " ")
    return F.when((F.size(words) >= 6) & (F.lower(first) == F.lower(rest)), first).otherwise(title)


def canonical_columns(rows: DataFrame, title: str = "title", name: str = "canonical_title") -> DataFrame:
    """Adds the label that variants of a program share, of titles in normal form.

    One step is one column, so that no step's text is repeated in the plan.
    """
    steps = [lambda t: _cut(_cut(_cut(t, P.NAVIGATION_PREFIX), P.PAGE_PREFIX), r"\s*" + P.MAJOR_MINOR + r"\s*$"), _without_track, lambda t: _cut(t, r"\s+(home|overview)\b")]
    steps += [lambda t, p=p: _cut(t, p) for p in (*P.UNIT_PREFIXES, *P.DEGREE_PREFIXES)]
    steps += [lambda t: F.when(F.lower(t) == "africana", "Africana Studies").otherwise(t)]
    steps += [lambda t, p=p: _cut(t, p) for p in P.LEVEL_SUFFIXES]
    steps += [_combined, lambda t: F.when(F.lower(t).rlike("(?U)" + P.CARIBBEAN), "African, Black and Caribbean Studies").otherwise(t), lambda t: squeezed(t), _halved, lambda t: F.regexp_replace(t, r"(?U)[\s,:;]+$", "")]
    out = rows.withColumn(name, F.col(title))
    for step in steps:
        out = out.withColumn(name, step(F.col(name)))
    return out


def classified(rows: DataFrame, title: str = "raw_title") -> DataFrame:
    """Adds ``title`` (normal form), ``n_words``, ``bucket``, ``conf``, ``conf_reason`` and ``title_kind``.

    ``rows`` has ``title`` and ``source``.  Null titles count as empty; everything is one
    narrow expression per column, no shuffle.
    """
    out = rows.withColumn("title", title_text(F.col(title))).withColumn("low", F.lower("title"))
    out = out.withColumn("n_words", F.when(F.col("title") == "", 0).otherwise(F.size(F.split("title", " "))))
    out = out.withColumn("bucket", R.first_of(bucket_cases(), "other"))
    out = out.withColumn("conf", F.greatest(F.lit(0), F.least(F.lit(100), R.points(CONFIDENCE)))).withColumn("conf_reason", R.flags(CONFIDENCE))
    return out.withColumn("title_kind", R.first_of(KINDS, "other_nonprogram")).drop("low")


def filled(rows: DataFrame) -> DataFrame:
    """Bucket and label are blank for titles that are neither in scope nor programs nor units; adds ``is_program``."""
    kept = F.col("title_kind").isin("program", "maybe_program", *P.SIGNAL_KINDS) | (F.col("bucket") != "other")
    out = rows.withColumn("canonical_title", F.when(kept, F.col("canonical_title")).otherwise("")).withColumn("bucket", F.when(kept, F.col("bucket")).otherwise(""))
    return out.withColumn("is_program", (F.col("title_kind") == "program").cast("int"))


