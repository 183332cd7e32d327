"""Rules as data, rendered as Spark columns.

A condition is a small tree: ``("match", pattern)``, ``("has", words)``,
``("any" | "all", conditions)``, ``("not", condition)``, ``("is", column, value)``
or ``("most" | "over", column, number)``.  Titles are classified by
ordered lists of (condition, value); scores by lists of (condition, points,
flag).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(rule: tuple, text: str = "low") -> Column:
    """The condition over a frame that has the columns it names."""
    kind, *rest = rule
    if kind == "match":
        return F.col(rest[1] if len(rest) > 1 else text).rlike("(?U)" + rest[0])
    if kind == "has":
        return F.col(text).rlike("|".join(map(re.escape, rest[0])))  # one pass, and a small plan
    if kind in ("any", "all"):
        return reduce((lambda a, b: a | b) if kind == "any" else (lambda a, b: a & b), [column(r, text) for r in rest[0]])
    if kind == "not":
        return ~column(rest[0], text)
    if kind == "is":
        return F.col(rest[0]) == rest[1]
    return F.col(rest[0]) <= rest[1] if kind == "most" else F.col(rest[0]) > rest[1]


def first_of(cases: list[tuple[tuple, object]], otherwise) -> Column:
    """The value of the first condition that holds."""
    out = None
    for rule, value in cases:
        out = F.when(column(rule), F.lit(value)) if out is None else out.when(column(rule), F.lit(value))
    return out.otherwise(F.lit(otherwise))


def points(scores: list[tuple[tuple, int, str]]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(column(rule), n).otherwise(0) for rule, n, _ in scores])


def flags(scores: list[tuple[tuple, int, str]], bucket: str = "bucket") -> Column:
    """Flags of the conditions that hold, in order; ``{bucket}`` in a flag is the bucket."""
    return F.concat_ws("|", *[F.when(column(rule), F.concat(F.lit(f.replace("{bucket}", "")), F.col(bucket)) if "{bucket}" in f else F.lit(f)) for rule, _, f in scores])
