"""Files as columns: bytes as text, workbooks as cells, the text of PDFs, data in web answers.

Workers get this module's functions by value, so they need no copy of the package.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most bytes of a page, starts of a page that was sent in place of data.
MOST_BYTES = 2_000_000
INTERSTITIAL = r"(?is)^\s*(<!doctype|<html)"
CELLS = "sheet int, sheet_name string, row int, col int, value string"


def binary(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of every file of a glob."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def decoded(content: Column) -> Column:
    """The first ``MOST_BYTES`` bytes as UTF-8 with what isn't replaced; null stays null."""

    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b[:MOST_BYTES]).decode("utf-8", "replace"))

    return F.pandas_udf(run, T.StringType())(content)


def is_interstitial(text: Column) -> Column:
    """Whether an answer is a page, not data."""
    return F.coalesce(text.rlike(INTERSTITIAL) | F.lower(F.substring(F.ltrim(text), 1, 400)).contains("<head"), F.lit(False))


def data_rows(answers: DataFrame, schema: str, text: str = "text") -> DataFrame:
    """Answers with ``data`` read by ``schema`` and ``status``: 0, -3 for pages sent in place of data, -2 for what isn't data."""
    out = answers.withColumn("data", F.when(~is_interstitial(F.col(text)), F.from_json(text, schema)))
    broken = F.expr(f"try_parse_json({text})").isNull() | ~F.ltrim(text).startswith("{")
    return out.withColumn("status", F.when(is_interstitial(F.col(text)), -3).when(F.coalesce(broken, F.lit(True)), -2).otherwise(0))


def _name(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def workbook(content: bytes) -> Iterator[tuple[int, str, int, int, str]]:
    """(number of sheet, its name, row, column, value as it reads) of every cell that isn't empty, in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())

        def tree(path):
            return ElementTree.fromstring(book.read(path))

        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter() if _name(t.tag) == "t") for si in tree("xl/sharedStrings.xml") if _name(si.tag) == "si"]
        targets = {r.get("Id"): r.get("Target") for r in tree("xl/_rels/workbook.xml.rels")}
        sheets = [(s.get("name"), next(v for k, v in s.attrib.items() if _name(k) == "id")) for s in tree("xl/workbook.xml").iter() if _name(s.tag) == "sheet"]
        for number, (name, rid) in enumerate(sheets):
            path = targets[rid].lstrip("/")
            path = path if path.startswith("xl/") else "xl/" + path
            for c in (x for x in tree(path).iter() if _name(x.tag) == "c"):
                kind = c.get("t", "n")
                value = next((x.text or "" for x in c if _name(x.tag) == "v"), None)
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter() if _name(t.tag) == "t")
                elif value is not None and kind == "s":
                    value = shared[int(value)]
                elif value is not None and kind == "n":
                    number_read = float(value)
                    value = str(int(number_read)) if number_read.is_integer() and not re.search(r"[.eE]", value) else repr(number_read)
                elif value is not None and kind == "b":
                    value = str(value == "1")
                if value is None:
                    continue
                letters, digits = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r")).groups()
                column = 0
                for letter in letters:
                    column = column * 26 + ord(letter) - 64
                yield number, name, int(digits), column, value


def workbook_cells(files: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """``keys`` and the cells of every workbook; what is no workbook has none."""
    schema = T.StructType([*files.select(*keys).schema.fields, *T._parse_datatype_string(CELLS).fields])
    names = schema.names

    def run(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                try:
                    cells = list(workbook(bytes(row[content])))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, TypeError):
                    cells = []
                if cells:
                    out = pd.DataFrame(cells, columns=names[len(keys) :])
                    for k in keys:
                        out[k] = row[k]
                    yield out[names]

    return files.select(*keys, content).mapInPandas(run, schema)


def pdf_bytes_text(content: bytes) -> str:
    """The text that a PDF shows, as far as its fonts are plain: strings of its streams, in order."""
    out = []
    for m in re.finditer(rb"stream\r?\n(.*?)\r?\nendstream", content or b"", re.S):
        raw = m.group(1)
        try:
            raw = zlib.decompress(raw)
        except zlib.error:
            pass
        for block in re.findall(rb"BT(.*?)ET", raw, re.S):
            shown = []
            for line in re.findall(rb"\[(.*?)\]\s*TJ|(\((?:\\.|[^\\)])*\))\s*(?:Tj|'|\")", block, re.S):
                parts = re.findall(rb"\(((?:\\.|[^\\)])*)\)", line[0] or line[1], re.S)
                shown.append(b"".join(re.sub(rb"\\([()\\])", rb"\1", p) for p in parts).decode("latin1"))
            out.append(" ".join(shown))
    return " ".join(" ".join(out).split())


def pdf_text(content: Column) -> Column:
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda b: pdf_bytes_text(bytes(b)) if b is not None else "")

    return F.pandas_udf(run, T.StringType())(content)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
