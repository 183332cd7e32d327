import pytest
from pyspark.sql import functions as F

from almanack.functions import titles, urls
from almanack.operators import inventory, keys

GOLDEN = [
    ("Department of Africana Studies", "crawl", "department_unit", "africana", 100),
    ("African Studies Center", "crawl", "center_institute", "african", 30),
    ("Africana Studies Becomes a Department", "crawl", "department_unit", "africana", 90),
    ("African, Black and Caribbean Studies", "crawl", "program", "black", 70),
    ("", "crawl", "junk", "other", 0),
    (None, "cv", "junk", "other", 0),
    ("Race and Ethnic Studies", "crawl", "program", "race", 100),
    ("North African Studies", "crawl", "program", "mena", 90),
    ("Black Belt Training", "crawl", "junk", "other", 0),
]


def test_golden_titles(spark):
    rows = spark.createDataFrame([(t, s) for t, s, *_ in GOLDEN], "raw_title string, source string")
    got = {r["raw_title"]: r for r in titles.classified(rows).collect()}
    for title, _, kind, bucket, conf in GOLDEN:
        row = got[title]
        assert (row["title_kind"], row["bucket"], row["conf"]) == (kind, bucket, conf), title


def test_split_cell_keeps_first_of_equal_titles(spark):
    row = spark.range(1).select(inventory.split_cell(F.lit("A | b||a|B |c")).alias("t")).first()
    assert row["t"] == ["A", "b", "c"]


def test_empty_evidence_has_columns(spark):
    rows = spark.createDataFrame([(1, None, "")], "unitid long, x string, y string")
    found = inventory.evidence(rows, {"crawl": "x", "cv": "y"}, ["unitid"])
    assert found.columns == ["unitid", "source", "pos", "raw_title"] and found.count() == 0


def test_missing_keys_match_each_other(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert [(r["a"], r["b"]) for r in keys.inner_with_missing(a, b, "k").collect()] == [(1, 3)]
    assert keys.only_left(a, b, "k", with_missing=False).count() == 1


@pytest.mark.parametrize("cell,expected", [("$1,234", True), ("12.8 %", True), ("n/a", False), (None, False), ("", False)])
def test_numericish(spark, cell, expected):
    assert spark.range(1).select(urls.numericish(F.lit(cell)).alias("x")).first()["x"] is expected


def test_resume_processes_each_key_once(spark, tmp_path):
    from almanack.streaming import resume

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for ids in ([1, 2], [2, 3]):
        spark.createDataFrame([(i,) for i in ids], "unitid long").write.mode("append").parquet(src)
        stream = spark.readStream.schema("unitid long").parquet(src)
        resume.resume(spark, stream, out, str(tmp_path / "cp"), "unitid", lambda rows: rows.withColumn("x", F.col("unitid") * 2)).awaitTermination()
    assert sorted(r["unitid"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
