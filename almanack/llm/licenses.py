"""Operator 3: license scans by a positional rare-token index.

Method: license templates are word sequences.  The index holds, for each
template word that is not a function word, its templates and positions, and its
weight: the inverse document frequency over all scanned files.  A file's hits
are its occurrences of index words with their positions; a hit at ``p`` of
a word at ``q`` in a template votes for that template starting at ``p - q``.
The rarest word of each template's mandatory key phrase is looked up first: a
start is a candidate only if that word votes for it, which none with a whole key
phrase lacks.  A candidate is a finding when every word of the key phrase
votes for the same start; its score is the found share of the template's
weight.

Everything is DataFrame and SQL functions.  One pass reads the texts and keeps
hits of the texts that hold all words of a key or base phrase, without which nothing can be found, and of all texts the distinct
index words, for their frequencies; the index is a constant of a few hundred rows.

A null or empty text has no words, no places (null positions), no labels
and score 0; a very long one is read whole.  Rows may repeat; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settle, table

#: What separates words, before lower-casing A-Z (same words as after).
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Base phrases: their places are reported one by one.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, mandatory key phrase, template (from the public wording of license notices).
TEMPLATES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "lesser general public license", "licensed under the gnu lesser general public license"),
    ("agpl", "affero general public license", "licensed under the gnu affero general public license"),
    ("cc-by", "cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc0", "cc0 1 0", "released under cc0 1 0 universal public domain dedication"),
    ("bsd", "bsd license", "released under the bsd license"),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license version 2 0"),
    ("reserved", "all rights reserved", "all rights reserved"),
)
#: Template words too common to be looked up.
FUNCTION_WORDS = ("a", "all", "and", "any", "are", "by", "in", "is", "of", "or", "the", "this", "to", "under", "with")
def index_rows(templates=TEMPLATES) -> list[tuple[int, str, str, int, bool]]:
    """(template, label, word, position, in the key phrase) for every word of every template but function words outside keys."""
    rows = []
    for t, (label, key, text) in enumerate(templates):
        words, keys = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(keys)] == keys)
        rows += [(t, label, w, i, at <= i < at + len(keys)) for i, w in enumerate(words) if at <= i < at + len(keys) or w not in FUNCTION_WORDS]
    return rows


def _index(spark: SparkSession, templates) -> DataFrame:
    values = ", ".join(f"({t}, '{label}', '{w}', {p}, {str(k).lower()})" for t, label, w, p, k in index_rows(templates))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(template, label, word, q, is_key)")


def _fold(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hits(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Settled ``row_id, doc_id, n_words, hits, seen``: per row of ``docs`` the positions of index words, in order, and the distinct ones.

    Only texts with all words of some key phrase of ``templates``, or of a base phrase, have hits; ``seen`` is there for all.
    """
    vocabulary = sorted({w for _, _, w, _, _ in index_rows(templates)} | {w for phrase in BASE for w in phrase.split()})
    words = F.split(F.coalesce("text", F.lit("")), SEPARATOR)
    # a separator before the first or after the last word leaves an empty string
    lead = F.when(F.get("_w", F.lit(0)) == "", 1).otherwise(0)
    trail = F.when((F.size("_w") > 1) & (F.element_at("_w", -1) == ""), 1).otherwise(0)
    placed = F.transform("_w", lambda w, i: F.struct((i - F.when(F.col("_lead") == 1, 1).otherwise(0)).cast("long").alias("p"), _fold(w).alias("w")))
    found = F.filter(placed, lambda x: x["w"].isin(vocabulary))
    none = F.array().cast("array<struct<p:bigint,w:string>>")
    rows = docs.select("doc_id", words.alias("_w")).withColumn("_lead", lead)
    rows = rows.select("doc_id", (F.size("_w") - F.col("_lead") - trail).cast("long").alias("n_words"), found.alias("_found"))
    rows = rows.withColumn("seen", F.array_distinct(F.transform("_found", lambda x: x["w"])))
    # places are wanted only where a phrase can be whole; every text's words count in the statistics
    phrases = sorted({frozenset(key.split()) for _, key, _ in templates} | {frozenset(phrase.split()) for phrase in BASE}, key=sorted)
    may_hold = reduce(lambda a, b: a | b, [F.size(F.array_intersect("seen", F.array(*map(F.lit, sorted(phrase))))) == len(phrase) for phrase in phrases])
    rows = rows.select("doc_id", "n_words", F.when(may_hold, F.col("_found")).otherwise(none).alias("hits"), "seen")
    return settle(rows.withColumn("row_id", F.monotonically_increasing_id()), "hits")


def _places(phrase: str) -> Column:
    """Starts of the phrase, from adjacent hits: all its words are index words."""
    words = phrase.split()

    def starts(i: Column) -> Column:
        first = F.get("hits", i)
        ok = first["w"] == words[0]
        for k, w in enumerate(words[1:], 1):
            here = F.get("hits", i + k)
            ok = ok & F.coalesce((here["w"] == w) & (here["p"] == first["p"] + k), F.lit(False))
        return ok

    some = F.filter(F.sequence(F.lit(0), F.size("hits") - 1), starts)
    return F.when(F.size("hits") >= len(words), F.transform(some, lambda i: F.get("hits", i)["p"])).otherwise(F.array().cast("array<bigint>"))


def _labelled(phrase: str, label: str) -> Column:
    return F.transform(_places(phrase), lambda p: F.struct(p.alias("start"), F.lit(label).alias("label")))


def findings(found: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``row_id, label, start, score`` of every verified template in the hits of :func:`hits`."""
    spark = found.sparkSession
    each = found.where(F.size("hits") > 0).select("row_id", F.explode("hits").alias("h")).select("row_id", "h.p", F.col("h.w").alias("word"))
    index = _index(spark, templates)
    n_files = found.agg(F.count(F.lit(1)).alias("n"))
    df = found.select(F.explode("seen").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(1.0) + F.col("n") / (F.coalesce("df", F.lit(0)) + F.lit(1.0)))
    # one row per template word: a constant size
    weighed = index.join(df, "word", "left").crossJoin(n_files).withColumn("idf", idf).drop("df", "n")
    whole = Window.partitionBy("template")
    weighed = weighed.withColumn("total", F.sum("idf").over(whole)).withColumn("n_key", F.sum(F.col("is_key").cast("int")).over(whole))
    # the rarest key word of each template is looked up first
    rarest = F.row_number().over(Window.partitionBy("template").orderBy(F.col("idf").desc(), "word", "q"))
    leads = weighed.where("is_key").withColumn("_rank", rarest).where("_rank = 1").select("word", "template", "q")
    starts = each.join(F.broadcast(leads), "word").select("row_id", "template", (F.col("p") - F.col("q")).alias("start")).distinct()
    votes = each.join(F.broadcast(weighed), "word").withColumn("start", F.col("p") - F.col("q")).join(starts, ["row_id", "template", "start"], "left_semi")
    votes = votes.groupBy("row_id", "template", "start").agg(
        F.first("label").alias("label"), F.sum("idf").alias("weight"), F.first("total").alias("total"),
        F.sum(F.col("is_key").cast("int")).alias("keys"), F.first("n_key").alias("n_key"),
    )
    verified = votes.where("keys = n_key")
    return verified.select("row_id", "label", "start", F.least(F.lit(1.0), F.col("weight") / F.col("total")).alias("score"))


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, places`` (start and label of each base place), ``base_labels, labels, score``."""
    found = hits(docs, templates)
    places = F.concat(*[_labelled(phrase, label) for phrase, label in BASE.items()])
    based = found.withColumn("places", F.when(F.size("hits") > 0, F.array_sort(places)).otherwise(F.array().cast("array<struct<start:bigint,label:string>>")))
    own = findings(found, templates).groupBy("row_id").agg(F.collect_set("label").alias("own"), F.max("score").alias("score"))
    none = F.array().cast("array<string>")
    base = F.array_distinct(F.transform("places", lambda x: x["label"]))
    return based.join(own, "row_id", "left").select(
        "doc_id", "n_words", "places", F.array_sort(base).alias("base_labels"),
        F.array_sort(F.array_union(base, F.coalesce("own", none))).alias("labels"),
        F.greatest(F.coalesce("score", F.lit(0.0)), F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"),
    )


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License scan of all documents."""
    starts = F.transform("places", lambda x: x["start"])
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


QUERIES = {"op3_license_scans": op3_license_scans}
SQL: dict[str, str] = {}
