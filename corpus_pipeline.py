"""Prepares the training corpus: ``documents`` through the operators of ``almanack.llm``, one stage after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame: all but the
last the columns of ``documents``, the last where each piece of each document
goes.  Every stage works on all that the one before it kept, written and read again.

Odd inputs: null and empty texts pass all stages but the first, if the classifier rejects them, and have no
piece in the last; rows equal in id and text become one in line dedup; among equal texts the smallest id
stays; columns beyond those of ``documents`` pass unread, whatever their names; empty tables give no
rows; long texts are read whole.

The tables that a stage needs until its result is written are removed afterwards:
by :func:`run` when the result is settled, and by the next stage when stages are
called one by one, so that a result must be written before the next call.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanack.llm import lines, mixing, ngrams, packing, quality
from almanack.llm.common import Tables, settle, table

_alone = Tables()
_running: list[bool] = []


def _stage(f):
    @functools.wraps(f)
    def called(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _running:
            return f(spark, docs, sf_dir)
        _alone.drop()
        with _alone:
            return f(spark, docs, sf_dir)

    return called


@_stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; equal rows share their fate."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of like lines, over all documents."""
    return _counted(lines.dedup_lines(docs))


@_stage
def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at 0.8 or more."""
    return ngrams.first_of_each(docs, n=5, percent=80)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the weights of their sources ask for."""
    return mixing.mixed_documents(docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now, in the column's own type."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL can't express the fitted classifier, fuzzy lines or best-fit search; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), Tables()
    _running.append(True)
    try:
        for _, stage in STAGES:
            own, result = Tables(), Tables()
            with own:
                docs = stage(spark, docs, sf_dir)
            if stage is STAGES[-1][1]:  # its tables and its input stay until the application ends
                own.hand_over()
                last.hand_over()
                break
            with result:
                docs = settle(docs, "stage")
            own.drop()
            last.drop()
            last = result
    finally:
        _running.pop()
    return docs
