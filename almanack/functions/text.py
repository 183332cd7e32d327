"""Normal forms of text.

What has no built-in (entities, mis-decoded bytes, Unicode compatibility forms) is one pandas UDF over Arrow
batches, which gets only the values that could change: plain ASCII never leaves the JVM.  Everything after it is
expressions.  The UDFs are closures, so workers need no copy of this package.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's ``\s`` has it.
SPACE = r"[\s\x1C-\x1F\x85]"


def squeezed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends; null is empty."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "(?U)" + SPACE + "+", " "), "^ | $", "")


def _decoded(entities: bool, repair: str):
    """UDF: HTML entities, repair of mis-decoded UTF-8 ("any": what comes out clean; "better": what has fewer marks of it), then NFKC."""

    def run(values: pd.Series) -> pd.Series:
        import html
        import unicodedata

        # fixed values: what shows that UTF-8 was read as another encoding
        any_marks = ("‚Ä", "Ã", "Â", "�")
        better_marks = ("‚Ä", "Ã", "â", "Â")

        def repaired(s: str) -> str:
            if repair == "any" and any(m in s for m in any_marks):
                for encoding in ("cp1252", "latin1"):
                    new = s.encode(encoding, "ignore").decode("utf-8", "ignore")
                    if new and new != s and "�" not in new:
                        return new
            if repair == "better":
                before = sum(s.count(m) for m in better_marks)
                new = s.encode("latin1", "ignore").decode("utf-8", "ignore") if before else ""
                if new and sum(new.count(m) for m in better_marks) < before:
                    return new
            return s

        def one(s):
            if s is None:
                return None
            s = html.unescape(s) if entities else s
            return unicodedata.normalize("NFKC", repaired(s))

        return values.map(one)

    return F.pandas_udf(run, T.StringType())


def decoded(text: Column, entities: bool = False, repair: str = "") -> Column:
    """``text`` without entities and mis-decoded bytes if asked for, in compatibility form (NFKC); null is empty."""
    odd = text.rlike(r"[^\x00-\x7F]|&[#A-Za-z]" if entities else r"[^\x00-\x7F]")
    return F.coalesce(_decoded(entities, repair)(F.when(odd, text)), text, F.lit(""))


def title_text(text: Column) -> Column:
    """Normal form of titles in the inventory: entities, mis-decoded text, NFKC, hyphens, "and" for ampersands, single spaces."""
    return dashed_and(decoded(text, entities=True, repair="any"))


def dashed_and(text: Column) -> Column:
    """The part of :func:`title_text` that needs no UDF."""
    return squeezed(F.regexp_replace(F.regexp_replace(text, "[‐-—]", "-"), "&", " and "))


def plain_text(text: Column) -> Column:
    """Normal form of titles that are compared: NFKC and single spaces; dashes and quotes stay."""
    return squeezed(decoded(text))


#: Dashes and quotes that page text is rid of.
PAGE_DASHES, PAGE_SINGLE, PAGE_DOUBLE = "‐‑‒–—−\u00ad", "‘’", "“”"


def page_text(text: Column) -> Column:
    """Normal form of text from pages: mis-decoded text where repair helps, NFKC, one kind of dash and quote, single spaces."""
    return unified(decoded(text, repair="better"))


def name_text(text: Column) -> Column:
    """Normal form of institutions' names: as page text, but mis-decoded text stays."""
    return unified(decoded(text))


def unified(text: Column) -> Column:
    out = F.regexp_replace(text, f"[{PAGE_DASHES}]", "-")
    return squeezed(F.regexp_replace(F.regexp_replace(out, f"[{PAGE_SINGLE}]", "'"), f"[{PAGE_DOUBLE}]", '"'))


def balanced_object(text: Column, marker: str) -> Column:
    """The first ``{...}`` after ``marker``, braces in strings not counted; blank where there is none."""

    def run(values: pd.Series) -> pd.Series:
        import re

        step = re.compile(r'"(?:\\.|[^"\\])*"|[{}]', re.S)

        def one(s):
            at = (s or "").find(marker)
            first = s.find("{", at) if at >= 0 else -1
            if first < 0:
                return ""
            depth = 0
            for m in step.finditer(s, first):
                depth += {"{": 1, "}": -1}.get(m.group(), 0)
                if depth == 0:
                    return s[first : m.end()]
            return ""

        return values.map(one)

    return F.pandas_udf(run, T.StringType())(text)
