from pyspark.sql import functions as F

from almanack import stages

COHORT = [("1", "A College"), ("2", "B College"), (" ", "C College"), ("4", "D College")]
BASELINE = [("1", "A College, Ethnic Studies"), ("1", "A College"), ("9", "Z College, Black Studies"), ("", "Nameless, X"), (" ", " ")]


def frames(spark):
    return spark.createDataFrame(COHORT, "unitid string, name string"), spark.createDataFrame(BASELINE, "unitid string, name string")


def test_cohorts_are_merged(spark):
    got = stages.merge_cohorts(*frames(spark))
    assert {(r["unitid"], r["name"], r["name_2013comp"]) for r in got["inner"].collect()} == {("1", "A College", "A College, Ethnic Studies"), ("1", "A College", "A College"), (None, "C College", "Nameless, X")}
    assert [r["unitid"] for r in got["baseline_only"].collect()] == [None, "9"]
    assert {r["unitid"] for r in got["cohort_only"].collect()} == {"2", "4"}


def test_from_a_cohort_to_reviewed_matches(spark):
    def page(title, links):
        return f"<html><head><title>{title}</title></head><body><h1>{title}</h1><main><p>{'word ' * 400}</p>{''.join(f'<a href={u!r}>{t}</a>' for t, u in links)}</main></body></html>"

    cohort, baseline = frames(spark)
    snapshot = spark.createDataFrame([("https://www.a.edu", page("Home", [("Programs", "/programs")])), ("https://www.a.edu/programs", page("Majors", [("Ethnic Studies Program", "/programs/ethnic"), ("Black Studies Minor", "/programs/black")]))], "url string, html string")
    profiles = spark.createDataFrame([("1", "Website: www.a.edu"), ("2", "none")], "unitid string, body_text string")
    named = stages.attach_baseline(stages.attach_websites(cohort, profiles), baseline)
    assert named.columns[:4] == ["unitid", "name", "2013_program_name", "Web_address"]
    tables = stages.bucket_titles(stages.crawl_sites(named, snapshot))
    wide = {r["name"]: r for r in tables["wide"].collect()}
    assert wide["A College"]["program_bucket__ethnic"] == "crawl:Ethnic Studies" and wide["A College"]["program_buckets_hit"] == "black|ethnic" and wide["B College"]["program_buckets_hit"] == ""
    assert {(r["unitid"], r["bucket"], r["canonical_title"], r["program_conf_final"]) for r in tables["long_programs_agg"].collect()} == {("1", "ethnic", "Ethnic Studies", 90), ("1", "black", "Black Studies", 90)}
    assert tables["long_signals"].count() == 0 and tables["long_bucket_summary"].count() == 2
    got = {r["name"]: r for r in stages.review(stages.match_titles(tables["wide"])).collect()}
    assert len(got) == 4 and got["A College"]["match_2013__best_title"] == "Ethnic Studies Program" and got["A College"]["match_2013__best_source"] == "crawl"
    assert got["A College"]["splits"] == ["01_inadequate_controls"] and got["B College"]["match_2013__match_level"] == "NO_MATCH"


def test_third_party_titles(spark):
    cohort, _ = frames(spark)
    known = spark.createDataFrame([("s1", "a-college", "A College", ["05.01", "26"])], "id string, slug string, name string, codes array<string>")
    majors = spark.createDataFrame([("05.01", "Ethnic Studies", 0), ("26", "Biochemistry and History", 1)], "cipCode string, name string, ord int")
    got = {r["unitid"]: r for r in stages.third_party_titles(cohort, known, majors).collect()}
    assert got["1"]["college_vine_program_titles_found"] == "Ethnic Studies" and got["1"]["college_vine_ctrl_status"] == "failed_ctrl_thresh" and got["1"]["college_vine_url"].endswith("/a-college/majors")
    assert got["2"]["college_vine_ctrl_status"] == "cv_unresolved" and got["2"]["college_vine_site"] == "0"


def test_websites_from_raw_pages(spark):
    cohort, _ = frames(spark)
    responses = spark.createDataFrame([("1", 200, '<p>Website <a href="https://a.edu">x</a></p>'), ("2", 404, ""), ("4", 200, "<p>none")], "unitid string, http_status int, html string")
    got = {r["name"]: (r["Web_address"], r["web_status"]) for r in stages.websites_from_html(cohort, responses).collect()}
    assert got == {"A College": ("https://a.edu", "ok"), "B College": ("", "http_404"), "C College": ("", "missing_unitid"), "D College": ("", "no_web_found")}


def test_what_scripts_are_handed(spark):
    page = """<meta name="csrf-token" content="tok"><script>window.CV.pathInfo.endpoints = {"search": "/s", "x": "{"};</script>"""
    r = stages.bootstrap(spark.createDataFrame([(page,), ("<p>",)], "html string")).collect()
    assert (r[0]["csrf"], r[0]["endpoints"]) == ("tok", {"search": "/s", "x": "{"}) and (r[1]["csrf"], r[1]["endpoints"]) == ("", None)


def test_workbooks_in_a_log(spark):
    logs = ['{"message": {"method": "Network.requestWillBeSent", "params": {"request": {"url": "https://x/a.xlsx"}}}}', '{"message": {"method": "Network.responseReceived", "params": {"response": {"url": "https://x/b", "mimeType": "application/vnd.ms-excel"}}}}', '{"message": {"method": "Network.requestWillBeSent", "params": {"request": {"url": "https://x/c.css"}}}}', "broken"]
    assert {r["url"] for r in stages.workbook_links(spark.createDataFrame([(x,) for x in logs], "message string")).collect()} == {"https://x/a.xlsx", "https://x/b"}


def test_a_window_of_rows(spark):
    rows = stages.number_rows(spark.createDataFrame([("b",), ("a",), ("a",)], "x string"), F.col("x"))
    assert sorted((r["row_index"], r["x"]) for r in rows.collect()) == [(0, "a"), (1, "a"), (2, "b")]
