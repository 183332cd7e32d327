import datetime
import io
import zipfile
import zlib

from pyspark.sql import functions as F

from almanack.operators import cells, crawl, frames
from almanack.operators import pages as P
from almanack.sources import files, html, tables


def test_csv_as_text_with_missing_values_and_with_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("﻿unitid,name,n\r\n001,\"A \"\"B\"\", c\r\nd\",3\r\n,NA,\r\n".encode())
    assert [tuple(r) for r in tables.csv_text(spark, str(path)).collect()] == [("001", 'A "B", c\nd', "3"), ("", "NA", "")]
    assert [tuple(r) for r in tables.csv_missing(spark, str(path)).collect()] == [("001", 'A "B", c\nd', "3"), (None, None, None)]
    assert dict(tables.csv_typed(spark, str(path)).dtypes)["n"] == "int"
    out = str(tmp_path / "out")
    tables.write_csv(tables.csv_missing(spark, str(path)), out, 1)
    assert [tuple(r) for r in tables.csv_text(spark, out).collect()] == [("001", 'A "B", c\nd', "3"), ("", "", "")]


def test_files_of_a_glob_keep_their_names(spark, tmp_path):
    for k in (2, 1):
        (tmp_path / f"b{k}.csv").write_text(f"unitid\n{k}\n")
    got = tables.csv_files(spark, str(tmp_path / "b*.csv"), ["unitid"])
    assert {tuple(r) for r in got.collect()} == {("1", "b1.csv"), ("2", "b2.csv")}


def test_appended_rows_have_the_same_columns(spark, tmp_path):
    out = str(tmp_path / "progress")
    tables.append(spark.createDataFrame([(1, "x", 9)], "unitid int, a string, extra int"), out, ["unitid", "a", "b"])
    tables.append(spark.createDataFrame([("2",)], "unitid string"), out, ["unitid", "a", "b"])
    assert {tuple(r) for r in spark.read.parquet(out).select("unitid", "a", "b").collect()} == {("1", "x", ""), ("2", "", "")}


def test_snapshots_have_an_age(spark):
    now = datetime.datetime(2025, 5, 20)
    pages = spark.createDataFrame([("a", now - datetime.timedelta(days=3)), ("b", now - datetime.timedelta(days=30))], "url string, fetched_at timestamp")
    assert [r["url"] for r in tables.snapshot(pages, now).collect()] == ["a"]


def test_names_of_outputs():
    assert tables.output_name("x/y.csv", "__matches") == "x/y__matches.csv" and tables.output_name("y", "__m") == "y__m.csv"
    assert tables.inventory_outputs("in/z.csv", "out")["long_signals"] == "out/z__bucketed_programs__long_signals.csv"
    assert tables.batch_paths("o/z.csv", 7) == ("o/z__batch_007.csv", "o/z__batch_007__progress.csv")


def workbook(sheets):
    out = io.BytesIO()
    shared = []

    def cell(ref, v):
        if isinstance(v, str):
            shared.append(v)
            return f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'
        return f'<c r="{ref}"><v>{v}</v></c>'

    with zipfile.ZipFile(out, "w") as z:
        for k, rows in enumerate(sheets, 1):
            body = "".join(f"<row>{''.join(cell(ref, v) for ref, v in row)}</row>" for row in rows)
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="m"><sheetData>{body}</sheetData></worksheet>')
        names = "".join(f'<sheet name="S{k}" r:id="r{k}"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="m" xmlns:r="r"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="m">' + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
    return out.getvalue()


def test_fields_of_workbooks(spark):
    races = [(f"{chr(66 + k)}2", name) for k, name in enumerate(html.RACE_KEYS)]
    book = workbook([
        [[("A1", "7 - Example College")], [("B3", cells.SECTION_TUITION)], [("B4", "Level of student"), ("C4", "Tuition and required fees, 2024")], [("B5", "Undergraduate"), ("C5", "$12,345")], [("B6", "Graduate"), ("C6", "none")]],
        [[("A1", cells.SECTION_ENROLLMENT)], [("B2", "Total"), ("C2", "Men"), ("D2", "Women")], [("A3", "All students"), ("B3", 30), ("C3", 10.5), ("D3", "20 %")]],
        [[("A1", cells.SECTION_RACE)], races, [("A3", "Enrollment by race/ethnicity"), ("C3", "12 %")]],
    ])
    rows = spark.createDataFrame([("7", bytearray(book)), ("8", bytearray(b"no workbook")), ("9", bytearray(book))], "unitid string, content binary")
    got = {r["unitid"]: r for r in cells.workbook_fields(files.workbook_cells(rows, ["unitid"]), ["unitid"], "unitid").collect()}
    assert list(got) == ["7"]
    assert [got["7"][f] for f in html.FIELDS[:5]] == ["$12,345", "", "30", "10.5", "20 %"] and got["7"]["pct_Asian"] == "12 %" and got["7"]["pct_White"] == ""


def test_pages_stand_in_for_blank_workbooks(spark):
    blank = {f: "" for f in html.FIELDS}
    w = spark.createDataFrame([{"unitid": "1", **blank, "enrollment_total": "5"}, {"unitid": "2", **blank}])
    p = spark.createDataFrame([{"unitid": "1", **blank, "enrollment_total": "6"}, {"unitid": "2", **blank, "enrollment_men": "3"}, {"unitid": "3", **blank, "pct_White": "9 %"}])
    got = {r["unitid"]: (r["enrollment_total"], r["enrollment_men"], r["pct_White"], r["used"]) for r in cells.preferred(w, p, ["unitid"]).collect()}
    assert got == {"1": ("5", "", "", "workbook"), "2": ("", "3", "", "page"), "3": ("", "", "9 %", "page")}


def test_text_of_pdfs_and_bytes(spark):
    stream = zlib.compress(b"BT /F1 12 Tf [(Maj) 20 (ors)] TJ (and \\(minors\\)) Tj ET")
    rows = spark.createDataFrame([(bytearray(b"%PDF stream\n" + stream + b"\nendstream"),), (bytearray(b"caf\xc3\xa9 \xff"),), (None,)], "content binary")
    assert [r[0] for r in rows.select(files.pdf_text(F.col("content"))).collect()][0] == "Majors and (minors)"
    assert [r[0] for r in rows.select(files.decoded(F.col("content"))).collect()][1:] == ["café �", None]


def test_pages_sent_in_place_of_data(spark):
    rows = spark.createDataFrame([('{"majors": ["1"]}',), ("<!DOCTYPE html><p>",), ("not data",), ("[1]",)], "text string")
    got = [(r["status"], r["data"] and r["data"]["majors"]) for r in files.data_rows(rows, "majors array<string>").collect()]
    assert [g[0] for g in got] == [0, -3, -2, -2] and got[0][1] == ["1"]


HEAD = "<html><head><title>%s</title></head><body><h1>%s</h1><main><p>%s</p>%s</main></body></html>"


def page(title, links, words=400):
    return HEAD % (title, title, "word " * words, "".join(f'<a href="{u}">{t}</a>' for t, u in links))


def test_pages_are_read(spark):
    source = "<title>T &amp; U</title><script type='application/json'>{\"a\": 1}</script><script>var x;</script><nav><a href='/n#f' title='N'>Nav</a></nav><div id=root><h2> Head <b>line</b></h2><ul><li>One<li>Two</ul></div><noscript><a href='/no'>no</a></noscript>"
    r = html.parse_pages(spark.createDataFrame([(source, "https://a.edu/x/"), (None, None)], "html string, url string")).collect()
    p = r[0]["page"]
    assert (p["html_title"], p["h1"], p["json_blob"], p["js_hint"]) == ("T & U", "", '{"a": 1}', 0)
    assert [tuple(x) for x in p["links"]] == [("Nav", "https://a.edu/n")] and p["anchor_attrs"] == ["N"]
    assert p["title_like"] == ["Head line", "One Two", "Two"] and p["main_text"] == "T & U Head line One Two" and "var x" not in p["visible_text"]
    assert r[1]["page"]["visible_text"] == "" and r[1]["corpus_any"] == ""


def test_scores_are_made_of_their_parts(spark):
    links = [(f"Program {i} Studies", f"/programs/p{i}") for i in range(30)]
    rows = spark.createDataFrame([("https://www.a.edu/programs", page("Undergraduate Majors", links)), ("https://www.a.edu/news/x", page("News", [])), ("https://www.a.edu/nwo/programs", page("x", []))], "url string, html string")
    got = {r["url"]: r for r in P.scored(P.signals(html.parse_pages(rows).withColumn("base", F.lit("www.a.edu")))).collect()}
    hub = got["https://www.a.edu/programs"]
    # inventory, five signs of a hub, majors and programs, canonical, undergraduate
    assert hub["hub_sig"] == 5 and hub["score"] == 240 + 85 * 5 + 10 * len(hub["struct_hits"]) + 160 + 35
    assert got["https://www.a.edu/news/x"]["score"] == 40 - 260 and got["https://www.a.edu/nwo/programs"]["score"] == -10_000
    assert hub["reason"].startswith(f"score={hub['score']};tier=inventory;hubSig=5;listingLinks=30;slugDiv=30")


def test_a_site_is_found_in_the_snapshot(spark):
    snapshot = [
        ("https://www.a.edu", page("Home", [("Programs", "/programs"), ("Far", "/far"), ("Other", "https://b.org/programs")])),
        ("https://www.a.edu/programs", page("Majors", [(f"Program {i} Studies", f"/programs/p{i}") for i in range(30)] + [("African Studies Program", "/programs/african")])),
        ("https://www.a.edu/programs/african", page("African Studies Program", [("Minor in African Studies", "/x")])), ("https://www.a.edu/far", page("Far", [("Deep", "/deep")])),
        ("https://www.a.edu/deep", page("Deep", [("Deeper", "/deeper")])), ("https://www.a.edu/majors/listed", page("Listed", [])),
    ]
    sites = spark.createDataFrame([("1", "www.a.edu"), ("2", "c.edu"), ("3", " "), ("4", None)], "unitid string, web_address string")
    pages = spark.createDataFrame(snapshot, "url string, html string")
    maps = spark.createDataFrame([("https://www.a.edu/sitemap.xml", "<urlset><url><loc>https://www.a.edu/departments/listed</loc></url></urlset>")], "url string, xml string")
    got = {r["unitid"]: r for r in crawl.inventory(sites, pages, sitemaps=maps).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"1": "ok", "2": "no_candidates", "3": "error_missing_web_address", "4": "error_missing_web_address"}
    assert got["1"]["best_url"] == "https://www.a.edu/programs" and "https://www.a.edu/deep" in got["1"]["alt_urls"]
    assert got["1"]["program_titles_found"] == "African Studies Program|Minor in African Studies" and got["1"]["program_title_count"] == 2


def test_sitemaps_lead_to_others(spark):
    maps = [("https://a.edu/sitemap.xml", "<sitemapindex xmlns='x'><sitemap><loc>https://a.edu/s1.xml</loc></sitemap></sitemapindex>"),
            ("https://a.edu/s1.xml", "<urlset><url><loc>https://a.edu/programs/one#x</loc></url><url><loc>https://a.edu/programs/one</loc></url><url><loc>https://b.edu/programs/two</loc></url><url><loc>https://a.edu/news/programs/3</loc></url></urlset>")]
    sites = spark.createDataFrame([("1", "a.edu", "https://a.edu")], "unitid string, base string, start string")
    assert [tuple(r) for r in crawl.sitemap_urls(spark.createDataFrame(maps, "url string, xml string"), sites).collect()] == [("1", "https://a.edu/programs/one")]


def test_rows_are_numbered_in_order(spark):
    rows = spark.range(1000).withColumn("x", (F.col("id") * 7919) % 1000)
    got = frames.numbered(rows, F.col("x")).collect()
    assert all(r["row_index"] == r["x"] for r in got)


def test_website_beside_its_label(spark):
    values = ['<p><b>Website</b> <a href="https://own.edu/x">x</a></p><a href="http://first.org">f</a>', '<a href="https://p.own.gov/a">p</a><a href="http://first.org">f</a>', "<p>nothing", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, html string")
    assert [r["w"] for r in rows.select("i", html.website_column(F.col("html"), "own.gov").alias("w")).orderBy("i").collect()] == ["https://own.edu/x", "http://first.org", None, None]
