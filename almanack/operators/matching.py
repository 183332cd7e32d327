"""Titles of two sources inside an institution: how alike pairs are, whether lists agree, and which titles pair up.

Keys and tokens are made once per distinct title, scores once per distinct pair; only pairs over the threshold go back to
their institutions.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pages as T
from ..functions.compare import overlap, sequence_ratio


#: Rows of a task that holds distinct rows in memory.
TASK_ROWS = 1 << 19


def distinct_rows(rows: DataFrame, n: int) -> DataFrame:
    """The distinct of ``rows``, about ``n`` before they are made distinct: a task gets a bounded number, however many there are.

    Nothing is gathered where rows are read: there a task's share grows with the table.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    return rows.repartition(tasks, *rows.columns).distinct()


def title_features(titles: DataFrame, synonyms: bool) -> DataFrame:
    """``title`` (distinct) with ``loose`` key and ``tokens``."""
    text = T.with_synonyms(F.col("title")) if synonyms else F.col("title")
    return titles.select("title", T.loose_key(text).alias("loose"), T.tokens(text).alias("tokens"))


def scored_pairs(pairs: DataFrame, a: str, b: str, synonyms: bool = True, threshold: float = 0.0) -> DataFrame:
    """``pairs`` that score ``threshold`` or more, with ``overlap``, ``ratio`` and ``score``, the larger of the two.

    Pairs with a blank title have no score and are left out.
    """
    named = pairs.where((F.col(a) != "") & (F.col(b) != ""))
    distinct = named.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct()
    features = title_features(distinct.select(F.col("_a").alias("title")).union(distinct.select(F.col("_b").alias("title"))).distinct(), synonyms)
    x, y = (features.select(F.col("title").alias(f"_{s}"), F.col("loose").alias(f"_l{s}"), F.col("tokens").alias(f"_t{s}")) for s in "ab")
    met = distinct.join(x, "_a").join(y, "_b").withColumn("overlap", overlap(F.col("_ta"), F.col("_tb"), guarded=False))
    ratios = met.select("_la", "_lb").distinct().withColumn("ratio", sequence_ratio(F.col("_la"), F.col("_lb")))
    scored = met.join(ratios, ["_la", "_lb"]).withColumn("score", F.greatest("overlap", "ratio")).where(F.col("score") >= threshold)
    scored = scored.select(F.col("_a").alias(a), F.col("_b").alias(b), "overlap", "ratio", "score")
    return named.join(scored, [a, b])


def best_pair(pairs: DataFrame, group: list[str], a: str, b: str, *order: Column, synonyms: bool = False) -> DataFrame:
    """``group, a, b, score``: the pair with the highest score over 0 of each group, the first by ``order`` of equals."""
    rows = scored_pairs(pairs, a, b, synonyms).where("score > 0")
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(F.col("score").desc(), *order)))
    return ranked.where("_r = 1").select(*group, a, b, "score")


def concordance(best: DataFrame, threshold: float = 0.80, a: str = "left", b: str = "right") -> DataFrame:
    """Adds ``concordant`` (1 from ``threshold`` on) and what agrees to the best pairs of groups."""
    ok = F.col("score") >= threshold
    said = F.concat(F.lit('inst="'), F.col(a), F.lit('" ~ other="'), F.col(b), F.lit('" score='), F.format_string("%.2f", "score"))
    return best.withColumn("concordant", ok.cast("int")).withColumn("detail", F.when(ok, said).otherwise(""))


def align(pairs: DataFrame, group: list[str], threshold: float = 0.80, synonyms: bool = True) -> DataFrame:
    """Greedy one-to-one alignment inside each group of ``left`` (place ``i``) and ``right`` (``j``): best score first, then place.

    Pairs come sorted, so one pass takes them as they stream by; only the places taken in the group at hand are kept.
    """
    rows = scored_pairs(pairs, "left", "right", synonyms, threshold).select(*group, "i", "j", "left", "right", "score")
    keyed = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*group, "i", "j")]))
    ordered = keyed.repartition(*group).sortWithinPartitions(*group, F.col("score").desc(), "i", "j")

    def greedy(batches):
        at, of_i, of_j = None, {}, {}
        for batch in batches:
            keep = []
            for key, i, j in zip(zip(*[batch.column(c).to_pylist() for c in group]), batch.column("i").to_pylist(), batch.column("j").to_pylist()):
                if key != at:
                    at, of_i, of_j = key, {}, {}
                free = i not in of_i and j not in of_j
                if free:
                    of_i[i], of_j[j] = j, i
                keep.append(free or of_i.get(i) == j)  # rows of one place stay together
            yield batch.filter(pa.array(keep, pa.bool_()))

    return ordered.mapInArrow(greedy, rows.schema)


def unpaired(titles: DataFrame, aligned: DataFrame, group: list[str], place: str) -> DataFrame:
    """Titles of one side that no pair took."""
    return titles.join(aligned.select(*group, place), [*group, place], "left_anti")


def alignment_text(aligned: DataFrame, group: list[str]) -> DataFrame:
    """``group, alignment``: the pairs of a group as text, best first."""
    part = F.concat(F.lit('a="'), F.col("left"), F.lit('" ~ b="'), F.col("right"), F.lit('" score='), F.format_string("%.2f", "score"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "i", "j", part.alias("t"))))
    return aligned.groupBy(*group).agg(F.array_join(F.transform(listed, lambda x: x["t"]), "|").alias("alignment"))
