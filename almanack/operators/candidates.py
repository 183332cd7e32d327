"""Title cells of an institution to candidate rows: splitting, recombining, and where each title came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions.text import plain_text, squeezed

# Last segments of categories, and segments cut from the end of a list run together.
CATEGORY_ENDS = ("other", "overview", "general", "misc")
TRAILING = ("other", "overview", "general", "misc", "programs", "program", "more", "learn more", "details", "information")

def none() -> Column:
    return F.array().cast("array<string>")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def listed(text: Column, separator: str) -> Column:
    """What lies between separators, trimmed, without blanks."""
    return F.filter(F.transform(F.split(text, separator), lambda x: F.trim(x)), lambda x: x != "")


def _count(text: Column, c: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(c)))


def _ends_as_category(segments: Column) -> Column:
    return F.coalesce(F.lower(F.get(segments, F.size(segments) - 1)).isin(*CATEGORY_ENDS), F.lit(False))


def _trimmed(segments: Column) -> Column:
    """Segments without the trailing ones that name no program."""
    kept = F.transform(segments, lambda x, i: F.when(~F.lower(x).isin(*TRAILING), i + 1).otherwise(0))
    return F.slice(segments, F.lit(1), F.coalesce(F.array_max(kept), F.lit(0)))


def recombined(text: Column) -> Column:
    """The segments of a pipe list of three or more as one title, and the same without trailing words, where that is another."""

    def joined(segments: Column) -> Column:
        full, cut = F.array_join(segments, " "), _trimmed(segments)
        both = F.when((F.size(cut) > 0) & (F.size(cut) < F.size(segments)), F.array(full, F.array_join(cut, " "))).otherwise(F.array(full))
        return F.when((F.size(segments) >= 3) & text.contains("|"), both).otherwise(none())

    return _let(listed(text, r"\|"), joined)


def split_field(text: Column, categories: bool = False) -> Column:
    """Titles of a field in plain form, recombined ones first.

    Separators are pipes, semicolons, and commas where a part has two or more.
    With ``categories`` a field that reads as a category of a taxonomy stays whole.
    """

    def parts(segments: Column) -> Column:
        commas = listed(text, ",")
        whole = F.lit(False)
        in_commas = F.lit(False)
        if categories:
            studies = F.exists(segments, lambda x: F.lower(x).contains("studies"))
            whole = text.contains("|") & (F.size(segments) >= 3) & (_ends_as_category(segments) | studies)
            in_commas = ~text.contains("|") & (_count(text, ",") >= 2) & (F.size(commas) >= 3) & _ends_as_category(commas) & F.lower(text).contains("studies")
        first = F.when(whole, F.array(F.array_join(segments, " / "))).when(text.contains("|"), segments).otherwise(F.array(text))
        second = F.flatten(F.transform(first, lambda p: F.when(p.contains(";"), listed(p, ";")).otherwise(F.array(p))))
        third = F.flatten(F.transform(second, lambda p: F.when(~whole & ~in_commas & (_count(p, ",") >= 2), listed(p, ",")).otherwise(F.array(p))))
        return F.filter(F.transform(third, squeezed), lambda x: x != "")

    def with_recombined(found: Column) -> Column:
        keys = F.transform(found, C.strict_key)
        new = F.filter(recombined(text), lambda r: ~F.array_contains(keys, C.strict_key(r)))
        once = F.filter(new, lambda r, i: (i == 0) | (C.strict_key(r) != C.strict_key(F.get(new, F.lit(0)))))
        return F.concat(once, found)

    return F.when(text == "", none()).otherwise(_let(_let(listed(text, r"\|"), parts), with_recombined))


def distinct_by_key(titles: Column) -> Column:
    """Titles without those whose strict key came before or is blank."""

    def first(keys: Column) -> Column:
        return F.filter(F.transform(titles, lambda t, i: F.when((F.get(keys, i) != "") & (F.array_position(keys, F.get(keys, i)) == i + 1), t)), lambda t: t.isNotNull())

    return _let(F.transform(titles, C.strict_key), first)


def _signal_title(title: Column) -> Column:
    bare = C.without_prefix(title)
    sourced = r"(?iU)^(crawl|cv)\s*:\s*(.+)$"
    return C.without_prefix(F.when(bare.rlike(sourced), squeezed(F.regexp_extract(bare, sourced, 2))).otherwise(bare))


def _as(kind: str, source: str, titles: Column) -> Column:
    return F.transform(titles, lambda t: F.struct(t.alias("title"), F.lit(source).alias("source"), F.lit(kind).alias("kind")))


def _noted(text: Column) -> Column:
    """What was recombined from a field, for review; an array of one or none."""
    made = recombined(text)
    said = F.concat(F.lit("recombined_from_pipe: "), text, F.lit(" => "), F.array_join(made, ", "))
    return F.when(F.size(made) > 0, F.array(said)).otherwise(none())


def candidate_rows(rows: DataFrame, keys: list[str], ref: str, crawl: str, cv: str, signals: str | None = None) -> DataFrame:
    """``keys, ref, pos, title, source, kind`` for every candidate; rows without any have null from ``pos`` on.

    ``pos`` runs through crawl titles, third-party titles, signals, and then crawl and third-party
    titles that read as units once more, as signals.  ``added`` lists the recombined titles, for review.
    """
    cells = {"c": crawl, "v": cv} | ({"s": signals} if signals else {})
    base = rows.select(*keys, plain_text(F.col(ref)).alias("ref"), *[plain_text(F.col(c)).alias(f"_{k}") for k, c in cells.items()])
    base = base.withColumn("_crawl", split_field(F.col("_c"))).withColumn("_cv", split_field(F.col("_v"), categories=True))
    base = base.withColumn("_signals", F.transform(split_field(F.col("_s")), _signal_title) if signals else none())
    also = F.filter(F.concat("_crawl", "_cv"), C.is_signal)
    every = F.concat(_as("program", "crawl", F.col("_crawl")), _as("program", "cv", F.col("_cv")), _as("signal", "signal", F.col("_signals")), _as("signal", "signal", also))
    notes = [_noted(F.col(f"_{k}")) for k in cells]
    added = F.array_join(distinct_by_key(F.concat(*notes)), "||").alias("added")
    return base.select(*keys, "ref", added, F.posexplode_outer(every).alias("pos", "x")).select(*keys, "ref", "added", "pos", "x.*")
