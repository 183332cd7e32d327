"""Third-party schools and majors: resolving an institution's name, its majors by code, and the titles among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions import pages as T
from ..functions.text import squeezed
from .candidates import none

# Words that name no school, the least length of one that does, and what is accepted.
STOP = ("the", "of", "in", "for", "and", "to", "a", "an", "at", "university", "college", "institute", "school", "campus", "state", "community", "polytechnic")
LEAST, SEARCHED, LISTED = 4, 0.74, 0.78
CODES = ("cipCode", "cip", "code", "id")


def plain_name(name: Column) -> Column:
    return squeezed(F.regexp_replace(F.lower(name), r"[^a-z0-9\s-]", " "))


def key_tokens(name: Column) -> Column:
    """Distinct words that tell a school from others."""
    return F.array_distinct(F.filter(F.split(F.replace(plain_name(name), F.lit("-"), F.lit(" ")), " "), lambda w: (F.length(w) >= LEAST) & ~w.isin(*STOP)))


def resolve(names: DataFrame, schools: DataFrame, key: str, name: str, threshold: float = LISTED) -> DataFrame:
    """``key, school_id, school_slug, score``: the school (``id, slug, name``) of each name that has one.

    A school whose slug is that of the name wins; else the most alike of those whose name or slug holds a key
    word of the name, from ``threshold`` on.  Candidates meet by the words of schools' names that hold a key word, so no name is
    compared with all schools.
    """
    asked = names.select(key, F.col(name).alias("n"), T.slug(F.col(name)).alias("slug"), plain_name(F.col(name)).alias("plain"), key_tokens(F.col(name)).alias("tokens"))
    known = schools.select(F.col("id").cast("string").alias("school_id"), F.lower(squeezed(F.coalesce("slug", F.lit("")))).alias("school_slug"), F.lower(squeezed(F.coalesce("name", F.lit("")))).alias("school_name"))
    exact = asked.where("slug != ''").join(known, F.col("slug") == F.col("school_slug")).groupBy(key).agg(F.min("school_id").alias("school_id"), F.min("school_slug").alias("school_slug")).withColumn("score", F.lit(1.0))
    words = known.select("school_id", "school_slug", "school_name", F.explode(F.array_distinct(F.split(F.concat_ws(" ", "school_name", "school_slug"), "[ -]+"))).alias("word")).where(F.length("word") >= LEAST)
    vocabulary = words.select("word").distinct()
    left = asked.join(exact.select(key), key, "left_anti")
    # words of schools that hold a key word: both lists are of distinct words
    tokens = left.select(F.explode("tokens").alias("token")).distinct()
    grams = vocabulary.select("word", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - LEAST + 1), lambda i: F.substring("word", i, F.lit(LEAST))))).alias("g"))
    holds = tokens.join(grams, F.substring("token", 1, LEAST) == F.col("g")).where(F.contains("word", "token")).select("token", "word").distinct()
    met = left.select(key, "slug", "plain", F.explode("tokens").alias("token")).join(holds, "token").join(words, "word").select(key, "slug", "plain", "school_id", "school_slug", "school_name").distinct()
    scored = met.withColumn("score", F.greatest(C.sequence_ratio(F.col("slug"), F.col("school_slug")), C.sequence_ratio(F.col("plain"), F.col("school_name"))))
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.col("score").desc(), "school_id"))).where((F.col("r") == 1) & (F.col("score") >= threshold))
    return exact.unionByName(best.select(key, "school_id", "school_slug", "score"))


def majors_table(entries: DataFrame) -> DataFrame:
    """``code, major`` from entries (``name`` and any of ``CODES``): the first code an entry has, of equal codes the last entry by ``ord``."""
    code = F.coalesce(*[F.col(c).cast("string") for c in CODES if c in entries.columns])
    named = entries.where((F.coalesce("name", F.lit("")) != "") & code.isNotNull()).select(code.alias("code"), F.col("name").alias("major"), "ord")
    return named.groupBy("code").agg(F.max_by("major", "ord").alias("major"))


def majors_of(schools: DataFrame, majors: DataFrame, key: str = "school_id") -> DataFrame:
    """``key, pos, major``: the majors of each school (``key, codes``) by code, in order; unknown codes are dropped, of names equal but for case the first stays."""
    first = schools.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.to_json(F.struct("codes"))))).where("_n = 1") if "ord" not in schools.columns else schools.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("ord"))).where("_n = 1")
    listed = first.select(key, F.posexplode("codes").alias("pos", "code")).withColumn("code", F.col("code").cast("string")).join(majors, "code")
    named = listed.withColumn("major", squeezed(F.col("major"))).where("major != ''")
    return named.groupBy(key, F.lower("major").alias("low")).agg(F.min(F.struct("pos", "major")).alias("m")).select(key, "m.pos", "m.major")


def third_party(schools: DataFrame, listed: DataFrame, key: str = "school_id", strictness: int = 3) -> DataFrame:
    """One row per school: how many subjects its majors name, and the program titles among them."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "major"))), lambda x: x["major"]), " ")
    controls = listed.groupBy(key).agg(F.size(T.hits(text, T.CONTROL_TERMS)).alias("control_hits"))
    titles = T.clean_titles(listed.where(T.has(F.col("major"), T.TARGET_ANY)), [key], "major", strictness).groupBy(key).agg(F.array_sort(F.collect_list("title")).alias("titles"))
    out = schools.select(key).distinct().join(controls, key, "left").join(titles, key, "left").withColumn("site", F.col("control_hits").isNotNull().cast("int"))
    out = out.withColumn("control_hits", F.coalesce("control_hits", F.lit(0))).withColumn("titles", F.coalesce("titles", none()))
    return out.withColumn("title_count", F.size("titles"))
