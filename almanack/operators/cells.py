"""Values from worksheets: cells as rows (``keys, sheet, row, col, value``), sections, headers and labels found by aggregates.

``sheet``, ``row`` and ``col`` number what they name; ``value`` is text as it reads, empty cells are no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squeezed
from ..functions.urls import numericish
from ..sources.html import FIELDS, RACE_KEYS

# Sizes of sections, how far headers and labels are looked for, titles of sections.
BLOCK_ROWS, BLOCK_COLS, LABEL_ROWS = 140, 70, 120
SECTION_TUITION, SECTION_ENROLLMENT, SECTION_RACE = "Tuition and required fees for full-time students", "Enrollment by gender", "Percent of all students enrolled"
CRITICAL = FIELDS[:5]


def _low(c: str = "value") -> Column:
    return F.lower(F.trim(F.col(c)))


def first_holding(cells: DataFrame, keys: list[str], needle: str) -> DataFrame:
    """``keys, sheet, row, col`` of the first cell, by sheet, row and column, whose text holds ``needle`` in any case."""
    found = cells.where(F.lower("value").contains(needle.lower())).groupBy(*keys).agg(F.min(F.struct("sheet", "row", "col")).alias("at"))
    return found.select(*keys, "at.sheet", "at.row", "at.col")


def block(cells: DataFrame, keys: list[str], title: str, rows: int = BLOCK_ROWS, cols: int = BLOCK_COLS) -> DataFrame:
    """``keys, r, c, value``: the cells of the rectangle that begins under the cell that holds ``title``, numbered from 0."""
    at = first_holding(cells, keys, title).select(*keys, "sheet", F.col("row").alias("top"), F.col("col").alias("left"))
    inside = cells.join(at, [*keys, "sheet"]).withColumn("r", F.col("row") - F.col("top") - 1).withColumn("c", F.col("col") - F.col("left"))
    return inside.where(F.col("r").between(0, rows - 1) & F.col("c").between(0, cols - 1)).select(*keys, "r", "c", "value")


def header(cells: DataFrame, keys: list[str], names: list[str], rows: int = 15) -> DataFrame:
    """``keys, r, columns``: the first row that holds every name in some cell, and for each name the first such column."""
    places = [F.min(F.when(_low().contains(name.lower()), F.col("c"))) for name in names]
    found = cells.where(F.col("r") < rows).groupBy(*keys, "r").agg(F.array(*places).alias("columns"))
    whole = found.where(~F.exists("columns", lambda c: c.isNull()))
    return whole.groupBy(*keys).agg(F.min_by(F.struct("r", "columns"), "r").alias("h")).select(*keys, "h.r", "h.columns")


def labelled_row(cells: DataFrame, keys: list[str], label: str, after: DataFrame, rows: int = LABEL_ROWS) -> DataFrame:
    """``keys, r``: the first row below ``after`` (``keys, r``) whose first cell that isn't blank is ``label`` in any case."""
    first = cells.where(F.trim("value") != "").groupBy(*keys, "r").agg(F.min_by("value", "c").alias("value"))
    below = first.join(after.select(*keys, F.col("r").alias("top")), keys).where((F.col("r") > F.col("top")) & (F.col("r") <= F.col("top") + rows))
    return below.where(_low() == label.lower()).groupBy(*keys).agg(F.min("r").alias("r"))


def _section(cells: DataFrame, keys: list[str], title: str, names: list[str], rows: int, wanted: list[tuple[str, str, int]]) -> DataFrame:
    """``keys`` and one column for each (name, row label, number of a header) of ``wanted``: what stands there if it is a number."""
    inside = block(cells, keys, title)
    top = header(inside, keys, names, rows)
    out = top.select(*keys)
    for label in dict.fromkeys(label for _, label, _ in wanted):
        at = labelled_row(inside, keys, label, top).join(top.select(*keys, "columns"), keys)
        row = inside.join(at, [*keys, "r"])
        values = [F.max(F.when((F.col("c") == F.get("columns", F.lit(k))) & numericish(F.col("value")), squeezed(F.col("value")))).alias(f"`{name}`".strip("`")) for name, own, k in wanted if own == label]
        out = out.join(row.groupBy(*keys).agg(*values), keys, "left")
    return out


def belongs(cells: DataFrame, keys: list[str], key: str) -> DataFrame:
    """``keys, valid``: whether some cell names the key as sheets of its owner do, "<key> -"."""
    return cells.groupBy(*keys).agg(F.max(F.contains(F.col("value"), F.concat(F.col(key).cast("string"), F.lit(" -"))).cast("int")).alias("valid"))


def workbook_fields(cells: DataFrame, keys: list[str], key: str | None = None) -> DataFrame:
    """Tuition, enrolment and shares by race of every workbook, blank where it doesn't say; with ``key`` only of workbooks that are its own."""
    every = cells.select(*keys).distinct()
    if key:
        own = belongs(cells, keys, key).where("valid = 1").select(*keys)
        cells = cells.join(own, keys, "left_semi")
        every = own
    tuition = _section(cells, keys, SECTION_TUITION, ["Level of student", "Tuition and required fees"], 20, [(FIELDS[0], "Undergraduate", 1), (FIELDS[1], "Graduate", 1)])
    people = _section(cells, keys, SECTION_ENROLLMENT, ["Total", "Men", "Women"], 25, [(FIELDS[2 + k], "All students", k) for k in range(3)])
    shares = _section(cells, keys, SECTION_RACE, list(RACE_KEYS), 25, [(f"pct_{name}", "Enrollment by race/ethnicity", k) for k, name in enumerate(RACE_KEYS)])
    out = every.join(tuition, keys, "left").join(people, keys, "left").join(shares, keys, "left")
    return out.select(*keys, *[F.coalesce(F.col(f"`{f}`"), F.lit("")).alias(f) for f in FIELDS])


def preferred(workbooks: DataFrame, profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Fields of the workbook, or of the page where there is no workbook or all its critical fields are blank; ``used`` says which."""
    w, p = workbooks.alias("w"), profiles.alias("p")
    joined = w.join(p, keys, "full")
    blank = reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(f"w.`{f}`")), F.lit("")) == "" for f in CRITICAL])
    return joined.select(*keys, *[F.coalesce(F.when(~blank, F.col(f"w.`{f}`")), F.col(f"p.`{f}`"), F.col(f"w.`{f}`"), F.lit("")).alias(f) for f in FIELDS], F.when(blank, "page").otherwise("workbook").alias("used"))


def enrich(rows: DataFrame, fields: DataFrame, key: str) -> DataFrame:
    """``rows`` with the fields of their key, blank where there are none; of a key's fields the first by their text."""
    added = [c for c in fields.columns if c != key]
    once = fields.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(f"`{c}`") for c in added]))).where("_n = 1").drop("_n")
    joined = rows.join(once, key, "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in added])
