import pytest
from pyspark.sql import functions as F

from almanack.functions import compare, pages, text, urls


def column(spark, make, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["x"] for r in rows.select("i", make(F.col("t")).alias("x")).orderBy("i").collect()]


def test_normal_forms(spark):
    odd = ["A &amp; B", "cafÃ© - x", "Ａﬁ\u00a0 b – c", None, "plain"]
    assert column(spark, text.title_text, *odd) == ["A and B", "café - x", "Afi b - c", "", "plain"]
    assert column(spark, text.plain_text, *odd) == ["A &amp; B", "cafÃ© - x", "Afi b – c", "", "plain"]
    assert column(spark, text.page_text, "“A”—it’s", "x\u00ady", "Ã© – b") == ['"A"-it\'s', "x-y", "é b"]
    assert column(spark, text.name_text, "‘A’  − Ã©") == ["'A' - Ã©"]


def test_first_object_after_a_marker(spark):
    values = ['x = {"a": {"b": "}"}} tail {}', "y = {1}", 'x = {"a": "\\"}"', None, "x but none"]
    assert column(spark, lambda t: text.balanced_object(t, "x"), *values) == ['{"a": {"b": "}"}}', "", "", "", ""]


def test_families_whatever_the_dash(spark):
    titles = ["Multi-Ethnic Studies Program", "Multi‐Ethnic Studies Program", "Multi–Ethnic Studies Program", "Multi−Ethnic Studies Program", "Multicultural and Gender Studies Program"]
    assert column(spark, compare.families, *titles) == [["ethnic"]] * 5


def test_overlap_guards_single_tokens(spark):
    sets = spark.createDataFrame([(["a"], ["a", "b", "c"]), (["a"], ["a", "b"]), ([], ["a"]), (["a", "b"], ["b", "c", "d"])], "a array<string>, b array<string>")
    got = [tuple(r) for r in sets.select(compare.overlap(F.col("a"), F.col("b")), compare.overlap(F.col("a"), F.col("b"), guarded=False)).collect()]
    assert got == [(1 / 3, 1.0), (1.0, 1.0), (0.0, 0.0), (0.5, 0.5)]


def test_sequence_ratio_is_that_of_matching_blocks(spark):
    pairs = spark.createDataFrame([("abcd", "bcde"), ("", "x"), (None, "x"), ("same", "same")], "a string, b string")
    assert [r[0] for r in pairs.select(compare.sequence_ratio(F.col("a"), F.col("b"))).collect()] == [0.75, 0.0, 0.0, 1.0]


def test_slugs(spark):
    assert column(spark, pages.slug, "St. John's College", "Texas A&M", "A  --  B") == ["st-johns-college", "texas-a-and-m", "a-b"]


@pytest.mark.parametrize("cell,expected", [("$1,234", True), ("12.8 %", True), ("n/a", False), (None, False), ("", False)])
def test_numericish(spark, cell, expected):
    assert spark.range(1).select(urls.numericish(F.lit(cell)).alias("x")).first()["x"] is expected
