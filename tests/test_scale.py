"""Steps whose cost must not grow faster than their input."""

import os
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from almanack.operators import matching
from almanack.plans import golden, inventory_queries, match_queries, registry
from almanack.sources import html

D = "/root/testdata/sf0.001"


def _plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_alignment_streams_and_equals_brute_force(spark):
    names, rng = ["Black Studies", "Black Studies Minor", "Africana Studies", "Ethnic Studies", "Latin"], random.Random(3)
    lists = {u: [[rng.choice(names) for _ in range(rng.randrange(5))] for _ in "lr"] for u in range(30)}
    listed = [(u, i, a, j, b) for u, (left, right) in lists.items() for i, a in enumerate(left) for j, b in enumerate(right)]
    pairs = spark.createDataFrame([*listed, listed[0]], "unitid int, i int, left string, j int, right string")
    got = matching.align(pairs, ["unitid"])
    assert "FlatMapGroupsInPandas" not in _plan(got)  # a call of Python for each institution
    want, taken = [], set()
    for r in sorted(matching.scored_pairs(pairs, "left", "right", threshold=0.80).collect(), key=lambda r: (r["unitid"], -r["score"], r["i"], r["j"])):
        place = (r["unitid"], r["i"], r["j"])
        if place in {w[:3] for w in want} or not taken & {("i", *place[:2]), ("j", place[0], place[2])}:
            want.append((*place, r["left"], r["right"], r["score"]))
            taken |= {("i", *place[:2]), ("j", place[0], place[2])}
    assert sorted(map(tuple, got.select("unitid", "i", "j", "left", "right", "score").collect())) == sorted(want)


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
def test_each_distinct_title_is_classified_once(spark, monkeypatch):
    asked, classified = [], inventory_queries.titles.classified
    monkeypatch.setattr(inventory_queries.titles, "classified", lambda rows: asked.append(rows.count()) or classified(rows))
    assert inventory_queries.title_kinds(spark, D).count() == spark.read.parquet(f"{D}/part.parquet").count()
    assert asked == [len({t[:2] for t in golden.TITLES})]


def test_missing_titles_stay(spark):
    rows = spark.createDataFrame([(1, "crawl", None), (2, "crawl", "Ethnic Studies"), (3, "crawl", None)], "p int, source string, raw_title string")
    got = inventory_queries._with_classes(rows).orderBy("p").collect()
    assert [(r["p"], r["raw_title"], r["title_kind"]) for r in got] == [(1, None, "junk"), (2, "Ethnic Studies", "program"), (3, None, "junk")]


def test_titles_that_are_equal_have_one_number(spark, tmp_path):
    """What a task holds doesn't grow with the table: nothing is made distinct where lines are read, and no task gets more than its share."""
    rows = spark.range(3000).selectExpr("id % 7 as l_suppkey", "id * 5 as l_partkey", "id * 3 as l_orderkey").union(spark.sql("select null, 1L, 2L union all select 1L, null, 2L union all select 1L, -1L, 2L"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = match_queries.token_overlap(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.execute(registry.SQL["token_overlap"]).fetchall()))
    assert "REPARTITION_BY_NUM" in _plan(got)


def test_distinct_rows_are_dealt_by_their_number(spark):
    rows = spark.range(40).selectExpr("id % 7 as k")
    assert sorted(r["k"] for r in matching.distinct_rows(rows, 40).collect()) == list(range(7))
    assert ", 100), REPARTITION_BY_NUM" in _plan(matching.distinct_rows(rows, 100 * matching.TASK_ROWS))


def test_pages_are_parsed_in_lots(spark):
    sources = ["<h1>a</h1>" + "x" * html.LOT, None, "<h1>b</h1>", "<h1>c</h1>" + "x" * html.LOT, "<h1>d</h1>"]
    lots = list(html._pages(iter([(pd.Series(sources), pd.Series(["https://a.edu/"] * 5))])))
    assert [x["h1"].tolist() for x in lots] == [["a"], ["", "b", "c"], ["d"]]
    rows = spark.createDataFrame(list(enumerate(sources)), "i int, html string").coalesce(1).withColumn("url", F.lit("https://a.edu/"))
    assert [r["h1"] for r in html.parse_pages(rows).select("i", "page.h1").orderBy("i").collect()] == ["a", "", "b", "c", "d"]
    assert html.parse_pages(rows.where("i > 9")).count() == 0
