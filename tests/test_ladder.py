import pytest
from pyspark.sql import functions as F

from almanack.operators import candidates, frames, keys, ladder, matching, schools
from almanack.operators import pages as P
from almanack.plans import golden


def listed(spark, cases):
    rows = [(k, ref, "", i, *c) for k, (ref, some) in enumerate(cases) for i, c in enumerate(some)] + [(k, ref, "", None, None, None, None) for k, (ref, some) in enumerate(cases) if not some]
    return spark.createDataFrame(rows, "id long, ref string, added string, pos int, title string, source string, kind string")


def test_golden_matches(spark):
    got = {r["id"]: r for r in ladder.matched(listed(spark, [m[:2] for m in golden.MATCHES]), ["id"]).collect()}
    for k, (_, _, want) in enumerate(golden.MATCHES):
        r = got[k]
        assert (r["best_title"], r["best_source"], r["best_kind"], r["match_level"], r["detail"]) == (*want[:4], want[5]), k
        assert r["match_score"] == pytest.approx(want[4], abs=1e-9)


def test_no_candidates_no_match(spark):
    got = {r["id"]: (r["best_title"], r["match_level"], r["match_score"]) for r in ladder.matched(listed(spark, [("Ethnic Studies", []), ("", [("Music", "crawl", "program")])]), ["id"]).collect()}
    assert got == {0: ("", "NO_MATCH", 0.0), 1: ("", "NO_MATCH", 0.0)}


def test_what_else_was_discovered(spark):
    rows = spark.createDataFrame([(1, "Ethnic Studies", "Ethnic Studies|Music & Art", "BA in Ethnic Studies", "center_institute:ethnic:crawl:Ethnic Studies Center")], "id int, ref string, a string, b string, s string")
    r = ladder.assembled(candidates.candidate_rows(rows, ["id"], "ref", "a", "b", "s"), ["id"]).collect()[0]
    assert (r["best_title"], r["best_source"], r["is_signal_ref"]) == ("Ethnic Studies", "crawl", 0)
    assert (r["discovered_crawl"], r["discovered_cv"], r["discovered_signals"]) == ("Ethnic Studies|Music and Art", "Ethnic Studies", "Ethnic Studies Center")
    assert r["discovered_all"] == "Ethnic Studies|Music & Art|BA in Ethnic Studies|Ethnic Studies Center"
    assert r["discovered_new_unmatched"] == "Music & Art" and r["discovered_new_when_best_signal"] == ""


def test_greedy_alignment_takes_the_best_pairs_first(spark):
    left, right = ["Black Studies Minor", "Black Studies", "Latin"], ["Africana Studies", "Black Studies Minor", "Greek"]
    pairs = spark.createDataFrame([(1, i, a, j, b) for i, a in enumerate(left) for j, b in enumerate(right)], "unitid int, i int, left string, j int, right string")
    got = matching.align(pairs, ["unitid"]).orderBy("i")
    assert [(r["left"], r["right"]) for r in got.collect()] == [("Black Studies Minor", "Africana Studies"), ("Black Studies", "Black Studies Minor")]
    text = matching.alignment_text(got, ["unitid"]).collect()[0]["alignment"]
    assert text == 'a="Black Studies Minor" ~ b="Africana Studies" score=1.00|a="Black Studies" ~ b="Black Studies Minor" score=1.00'
    titles = spark.createDataFrame([(1, i, a) for i, a in enumerate(left)], "unitid int, i int, left string")
    assert [r["left"] for r in matching.unpaired(titles, got, ["unitid"], "i").collect()] == ["Latin"]


def test_page_ranks_cut_before_they_promote(spark):
    rows = spark.createDataFrame([("s", k, 100 - k, int(k == 9)) for k in range(12)] + [("t", k, 100 - k, int(k in (2, 3))) for k in range(4)], "site string, page int, score int, canonical_hub int")
    got = {(r["site"], r["rank"]): r["page"] for r in P.best_pages(rows, ["site"], F.col("page")).collect()}
    assert got == {("s", k + 1): k for k in range(6)} | {("t", 1): 2, ("t", 2): 0, ("t", 3): 1, ("t", 4): 3}


def test_status_labels_by_priority(spark):
    rows = [("a", 429, "x"), ("a", 403, "x"), ("b", 503, "x"), ("b", -1, "x"), ("c", 404, None), ("d", 200, None), ("e", 200, "N/A"), ("f", 200, "x"), ("g", -1, "x")]
    got = dict(map(tuple, P.status_label(spark.createDataFrame(rows, "k string, code int, best string"), ["k"], "code", "best").collect()))
    assert got == {"a": "403_forbidden_seen", "b": "5xx_seen", "c": "4xx_seen", "d": "no_candidate", "e": "no_candidate", "f": "ok", "g": "exceptions_seen"}


def test_majors_by_code(spark):
    entries = spark.createDataFrame([(None, "1", "A", 0), ("2", "9", "B", 1), ("2", None, "C", 2), (None, None, "D", 3), ("4", None, "", 4)], "cipCode string, cip string, name string, ord int")
    assert {tuple(r) for r in schools.majors_table(entries).collect()} == {("1", "A"), ("2", "C")}


def test_review_sets(spark):
    rows = [(1, "strict_raw", "x", "y"), (2, "fuzzy_raw", "x", "y"), (3, "NO_MATCH", " ", "y"), (4, "NO_MATCH", "x", ""), (5, "NO_MATCH", "x", "y"), (6, "NO_MATCH", "", ""), (7, None, "x", "y"), (8, "strict_raw", "x", "y")]
    frame = spark.createDataFrame(rows, "id int, level string, ref string, now string")
    got = frames.review_splits(frame, F.col("id") < 8, "level", "ref", "now")
    assert [[s[:2] for s in r["splits"]] for r in got.orderBy("id").collect()] == [["02", "03"], ["02", "04"], ["02", "05"], ["02", "06"], ["02", "07"], ["02"], ["02"], ["01"]]
    assert tuple(frames.check_partition(got, ["id"]).collect()[0]) == (8, 7, 5, 0, 2)


def test_keys_are_cleaned(spark):
    rows = spark.createDataFrame([(" 1 ", "a"), ("nan", " "), ("None", "b"), ("", None)], "k string, x string")
    assert [r["k"] for r in rows.select(keys.clean_key(F.col("k")).alias("k")).collect()] == ["1", None, None, None]
    assert keys.drop_blank_rows(rows).count() == 2
