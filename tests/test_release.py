"""Release gate, sinks, collection checks, recognised text, state and streaming."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from leafmill.operators import browse, collect, ocr, release, state
from leafmill.plans import catalog
from leafmill.sources import derived, readers, writers
from leafmill.streaming import ingest

RECORD = {
    "item_id": "s:d:p0001:1", "source_id": "s", "doc": "d", "page_num": 1, "item_seq": 1, "number_label": "1", "kind": "multiple_choice", "stem": "What is two and two?", "choices": ["A) 3", "B) 4"], "flags": [],
    "status": "ok", "extraction_source": "text_layer", "ocr_mean_conf": None, "usage_tag": "PUBLIC_DOMAIN",
}
SCHEMA = "item_id string, source_id string, doc string, page_num int, item_seq int, number_label string, kind string, stem string, choices array<string>, flags array<string>, status string, extraction_source string, ocr_mean_conf double, usage_tag string"
ANSWER = "item_id string, correct_choice string, answer_text string, rationale string, answer_block string, answers_doc string, answer_flags array<string>, consistent boolean"


def records(spark, *over, answers=()):
    rows = [tuple({**RECORD, "item_id": f"s:d:p0001:{i}", "item_seq": i, **o}.values()) for i, o in enumerate(over, 1)]
    a = spark.createDataFrame([(f"s:d:p0001:{i}", c, None, "", "RW1", "a", [], True) for i, c in answers], ANSWER)
    return release.merge_records(spark.createDataFrame(rows, SCHEMA), a)


def checked(spark, answer=None, **over):
    r = release.gate(release.validate(records(spark, over, answers=[(1, answer)] if answer else ()))).first()
    return r.errors, r.warnings, r.decision


@pytest.mark.parametrize(
    ("over", "answer", "errors", "warnings", "decision"),
    [
        ({}, None, [], [], "include"),
        ({"stem": "  "}, None, [], ["empty stem"], "include"),
        ({"item_id": ""}, None, ["missing required field: item_id"], [], "fatal"),
        ({"page_num": 0}, None, ["page_num must be a positive integer"], [], "fatal"),
        ({"kind": "essay"}, None, ["unknown kind: 'essay'"], [], "fatal"),
        ({"status": None}, None, ["missing required field: status", "unknown status: None"], [], "fatal"),
        ({"usage_tag": "WHATEVER"}, None, ["unknown usage tag: 'WHATEVER'"], [], "fatal"),
        ({"usage_tag": None}, None, ["missing required field: usage_tag", "unknown usage tag: None"], [], "fatal"),
        ({"usage_tag": "RESTRICTED_X"}, None, [], [], "include"),
        ({"choices": ["A) 3"]}, None, ["multiple_choice with 1 choice(s)"], [], "quarantine"),
        ({"choices": ["A) 3", "A) 4"]}, None, ["duplicate choice letters"], [], "quarantine"),
        ({"kind": "unknown", "choices": []}, "E", [], [], "include"),
        ({}, "E", ["answer letter E not among choices"], [], "quarantine"),
        ({}, "B", [], [], "include"),
        ({"choices": ["A) 3"], "kind": "multiple_choice", "page_num": 0}, None, ["page_num must be a positive integer", "multiple_choice with 1 choice(s)"], [], "fatal"),
        ({"status": "needs_review", "flags": ["truncated_at_page_end"]}, None, [], ["needs_review", "truncated_at_page_end"], "include"),
    ],
)
def test_gate(spark, over, answer, errors, warnings, decision):
    if over.get("item_id") == "":
        got = release.gate(release.validate(release.merge_records(spark.createDataFrame([tuple({**RECORD, **over}.values())], SCHEMA)))).first()
        assert (got.errors, got.decision) == (errors, decision)
    else:
        assert checked(spark, answer, **over) == (errors, warnings, decision)


def test_release_is_written_whole_or_not_at_all(spark, tmp_path):
    good = records(spark, {}, {"usage_tag": "RESTRICTED_X"}, {"choices": ["A) 1"]}, {"status": "needs_review"}, answers=[(1, "A"), (2, "B")])
    done = writers.write_release(good, str(tmp_path / "r"), "1.0.0", "2024-01-01T00:00:00Z")
    assert (done["included"], done["quarantined"], done["warnings"]) == (3, 1, {"needs_review": 1})
    out = spark.read.json(str(tmp_path / "r/questions"))
    assert {r.partition: r["count"] for r in out.groupBy("partition").count().collect()} == {"public": 2, "restricted": 1}
    line = json.loads(next(x for x in spark.read.text(str(tmp_path / "r/questions/partition=public")).toPandas()["value"] if "p0001:4" in x))
    assert "answer" in line and line["answer"] is None and line["page_image"] == "data/pages/s/d/page_0001.png"
    assert spark.read.json(str(tmp_path / "r/excluded")).first()["_exclusion_reasons"] == ["multiple_choice with 1 choice(s)"]
    stats_md = (tmp_path / "r/STATS.md").read_text()
    assert "## by partition" in stats_md and "| public | 2 |" in stats_md and "| stem | string |" in (tmp_path / "r/SCHEMA.md").read_text()
    assert (tmp_path / "r/questions/partition=restricted/_RESTRICTED.txt").exists() and not (tmp_path / "r/questions/partition=public/_RESTRICTED.txt").exists()
    assert all(len(a["sha256"]) == 64 for a in done["artifacts"]) and done["artifacts"]
    with pytest.raises(writers.GateError):
        writers.write_release(records(spark, {}, {"kind": "x"}), str(tmp_path / "bad"), "1", "now")
    assert not os.path.exists(tmp_path / "bad")


def test_a_release_takes_the_place_of_the_one_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    writers.write_release(records(spark, {}, {}), path, "1.0.0", "now")
    done = writers.write_release(records(spark, {}, {"usage_tag": "RESTRICTED_X"}, {"choices": ["A) 1"]}), path, "1.1.0", "now")
    listed = {a["path"]: a for a in done["artifacts"]}
    here = {os.path.relpath(os.path.join(d, f), path) for d, _, files in os.walk(path) for f in files if not f.startswith((".", "_SUCCESS")) and f != "manifest.json"}
    assert set(listed) == here and {"STATS.md", "SCHEMA.md", "questions/partition=restricted/_RESTRICTED.txt"} <= here
    for name, a in listed.items():
        data = (tmp_path / "r" / name).read_bytes()
        assert (a["bytes"], a["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert json.loads((tmp_path / "r/manifest.json").read_text()) == done and done["counts"] == {"public": 1, "restricted": 1, "answered": 0}
    monkeypatch.setattr(writers, "manifest", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        writers.write_release(records(spark, {}), path, "1.2.0", "now")
    assert json.loads((tmp_path / "r/manifest.json").read_text())["version"] == "1.1.0" and [p.name for p in tmp_path.iterdir()] == ["r"]


def test_first_sight_follows_places_not_texts(spark):
    """Item 10 of a page comes after item 2, whatever their ids look like as text."""
    rows = records(spark, *({"kind": k, "item_seq": n, "item_id": f"s:d:p0001:{n}"} for k, n in (("unknown", 10), ("free_response", 2))))
    got = {r.value: r for r in release.stats(release.validate(rows)).where("stat = 'by_kind'").collect()}
    assert got["free_response"].first_seen < got["unknown"].first_seen
    assert [r.value for r in release.stats(release.validate(rows)).where("stat = 'by_kind'").orderBy(F.desc("n"), "first_seen").collect()] == ["free_response", "unknown"]
    again = rows.unionByName(rows.withColumns({"item_seq": F.lit(1), "page_num": F.lit(11), "item_id": F.lit("s:d:p0011:1")}))
    assert {r.first_item for r in release.stats(release.validate(again)).where("stat = 'total_items'").collect()} == {"s:d:p0001:2"}


def test_digests_scale_by_levels(spark, monkeypatch):
    rows = spark.createDataFrame([(f"i{i}", "p" if i % 3 else "q") for i in range(500)], "item_id string, p string")
    one = {r.p: r["items"] for r in release.digests(rows, "p", "item_id").collect()}
    monkeypatch.setattr(release, "BUCKET_IDS", 0.001)
    deep = sorted(map(tuple, release.digests(rows, "p", "item_id").collect()))
    assert {p: n for p, n, _ in deep} == one and deep == sorted(map(tuple, release.digests(rows.repartition(5), "p", "item_id").collect()))


def test_stored_tables_follow_their_source(spark, tmp_path):
    from leafmill.sources import derived

    source = str(tmp_path / "in")
    read = lambda: derived.stored(spark, source, "t", lambda: spark.read.parquet(f"{source}/t.parquet")).count()
    spark.range(9).write.parquet(f"{source}/t.parquet")
    assert read() == 9
    spark.range(3).write.mode("overwrite").parquet(f"{source}/t.parquet")
    assert read() == 3


def test_digests_do_not_depend_on_order(spark):
    rows = [(f"i{k}", "ab"[k % 2]) for k in range(500)]
    one, two = (sorted(map(tuple, release.digests(spark.createDataFrame(r, "item_id string, p string").repartition(3), "p", "item_id").collect())) for r in (rows, rows[::-1]))
    assert one == two and [r[1] for r in one] == [250, 250]
    assert one != sorted(map(tuple, release.digests(spark.createDataFrame(rows[:-1], "item_id string, p string"), "p", "item_id").collect()))


def test_stats(spark):
    rows = records(spark, {}, {"usage_tag": "RESTRICTED_X"}, {"kind": "unknown"}, answers=[(2, "A")])
    got = {(r.stat, r.value): (r.n, r.first_item) for r in release.stats(rows).collect()}
    assert got[("total_items", "all")][0] == 3 and got[("answered_items", "all")][0] == 1
    assert got[("by_kind", "multiple_choice")] == (2, "s:d:p0001:1") and got[("answered_by_doc", "_unanswered")][0] == 2
    assert ("answer_consistency_failures", "all") not in got


def test_csv_export_of_nothing_has_a_header(spark, tmp_path):
    df = spark.createDataFrame([("a", [1, 2])], "x string, y array<int>")
    writers.csv_export(df, str(tmp_path / "a"), ["x", "y"], ["x"])
    writers.csv_export(df.where("false"), str(tmp_path / "b"), ["x", "y"], ["x"])
    assert [r.value for r in spark.read.text(str(tmp_path / "a")).collect()][0] == "x,y"
    assert [r.value for r in spark.read.text(str(tmp_path / "b")).collect()] == ["x,y"]


@pytest.mark.parametrize("name", sorted(writers.EXPORTS))
def test_fixed_exports(spark, tmp_path, name):
    columns, order = writers.EXPORTS[name]
    some = [c for c in columns if c != columns[-1]]  # the last column is not known here
    df = spark.createDataFrame([tuple(f'{c} {k}, "x"' for c in some) for k in (2, 1)], ", ".join(f"{c} string" for c in some))
    writers.export(df, name, str(tmp_path / "a"))
    got = spark.read.csv(str(tmp_path / "a"), header=True, escape='"')
    assert got.columns == list(columns) and [r[0] for r in got.collect()] == [f'{columns[0]} {k}, "x"' for k in (1, 2)]
    writers.export(df.where("false"), name, str(tmp_path / "b"))
    assert [r.value for r in spark.read.text(str(tmp_path / "b")).collect()] == [",".join(columns)]


ROBOTS = "User-agent: collector\nAllow: /a/b\nDisallow: /a\n\nUser-agent: *\nDisallow: /\n"


BODIES = {
    "quoted": "User-agent: *\nDisallow: /über/\nDisallow: /a%3cd\nAllow: /b%20c\nDisallow: /b",
    "groups": "# head\nDisallow: /lost\nUser-agent: other\nUser-Agent: COLL # part of ours\n  # a comment between\nAllow: /x/y\nDisallow: /x\n\nUser-agent: *\nDisallow: /",
    "ended": "User-agent: collector\n\nDisallow: /\nUser-agent: *\nDisallow: /p?q=1\nDisallow:/e;\nDisallow: /f?\ncrawl-delay: 3",
    "first": "User-agent: *\nDisallow: /one\n\nUser-agent: *\nDisallow: /two\n\nUser-agent: a\nUser-agent: *\nDisallow: /three\nSitemap: http://h/s.xml\nDisallow: /four",
    "open": "User-agent: *\nDisallow:\nDisallow: /z",
    "delay": "User-agent: collector\nCrawl-delay: 5\n\nUser-agent: *\nDisallow: /",
    "star": "User-agent: *\nDisallow: *\nDisallow: /w*\nDisallow: /k+l\nDisallow: /~u",
    "nothing": "",
    "noise": "hello\nUser-agent collector\nDisallow: /",
}
PATHS = [
    "/über/x", "/%C3%BCber/x", "/a%3cd", "/a%3Cd/e", "/a<d", "/b c", "/b%20c", "/b/c", "/lost", "/x/y/z", "/x/z", "/p?q=1&r", "/p%3Fq=1", "/p", "/e", "/e;a", "/f", "/f?x", "/one", "/two", "/three", "/four", "/z", "", "/", "?q", "#f",
    "/w*x", "/wx", "/k+l", "/k%2Bl", "/k l", "/%7Eu", "/~u/v", "/*", "/100%", "/%zz", "/x/y#frag", "//x/y", "/x y z",
]


def test_robots_agrees_with_the_standard_library(spark):
    """Every body against every path, for several agents, in columns; the standard parser is the judge."""
    from urllib.robotparser import RobotFileParser

    files = spark.createDataFrame([(h, 200, b) for h, b in BODIES.items()], "host string, http_status int, body string")
    urls = spark.createDataFrame([(f"http://{h}{p}",) for h in BODIES for p in PATHS], "url string")
    for agent in ("collector/1.0", "Other", "a", "else/2"):
        gated = collect.robots_gate(urls, collect.robots_rules(files, agent))
        assert "Python" not in gated._jdf.queryExecution().executedPlan().toString()
        got = {r.url: r.allowed for r in gated.collect()}
        for host, body in BODIES.items():
            parser = RobotFileParser()
            parser.parse(body.splitlines())
            for path in PATHS:
                url = f"http://{host}{path}"
                assert got[url] == parser.can_fetch(agent, url), (agent, url)


def test_robots_closed_addresses(spark):
    files = spark.createDataFrame([("h", 404, None), ("", 404, None)], "host string, http_status int, body string")
    urls = spark.createDataFrame([("http://h/a b",), ("http://h x/a",), ("http://other/",), ("no address",), (None,), ("",)], "url string")
    got = {r.url: r.allowed for r in collect.robots_gate(urls, collect.robots_rules(files, "c")).collect()}
    assert got == {"http://h/a b": True, "http://h x/a": False, "http://other/": False, "no address": False, None: False, "": False}


def test_robots(spark):
    files = spark.createDataFrame([("x.org", 200, ROBOTS), ("y.org", 404, None), ("z.org", 503, None), ("e.org", 200, "")], "host string, http_status int, body string")
    urls = spark.createDataFrame([(u,) for u in ("https://x.org/a/b1", "https://x.org/a/c", "https://x.org/c", "https://y.org/a", "https://z.org/a", "https://n.org/", "https://e.org/a")], "url string")
    got = {r.url: r.allowed for r in collect.robots_gate(urls, collect.robots_rules(files, "collector/1.0")).collect()}
    assert [got[f"https://{u}"] for u in ("x.org/a/b1", "x.org/a/c", "x.org/c", "y.org/a", "z.org/a", "n.org/", "e.org/a")] == [True, False, True, True, False, False, True]
    other = {r.url: r.allowed for r in collect.robots_gate(urls, collect.robots_rules(files, "else/2")).collect()}
    assert not other["https://x.org/c"] and other["https://e.org/a"]


def test_orphans_are_adopted_after_validation(spark):
    good = b"%PDF-1.4" + b"x" * 10_000
    files = spark.createDataFrame([("a", "1.pdf", "data/raw/a/1.pdf", bytearray(good)), ("a", "2.pdf", "data/raw/a/2.pdf", bytearray(good)), ("a", "3.pdf", "data/raw/a/3.pdf", bytearray(b"<html>")), ("a", "n.txt", "data/raw/a/n.txt", bytearray(good)), ("b", "1.pdf", "data/raw/b/1.pdf", bytearray(good))], "source_id string, name string, local_path string, content binary")
    ledger = spark.createDataFrame([("data\\raw\\a\\1.pdf",), (None,)], "local_path string")
    sources = spark.createDataFrame([("a", "https://l", None)], "id string, landing_url string, usage_tag string")
    got = {r.filename: r for r in collect.reconcile(files, ledger, sources, "2024").collect()}
    assert set(got) == {"2.pdf", "3.pdf"} and got["2.pdf"].ok and not got["3.pdf"].ok
    assert (got["2.pdf"].url, got["2.pdf"].usage_tag, got["2.pdf"].sha256) == ("manual-download:https://l#2.pdf", "DO_NOT_COLLECT", hashlib.sha256(good).hexdigest())
    assert got["2.pdf"].detail.endswith("validated and hashed on 2024") and "HTML page" in got["3.pdf"].detail


def test_archive_items_without_a_pdf(spark):
    files = spark.createDataFrame([("i", 1, "a.txt", "Text PDF", "9"), ("j", 1, "b.pdf", "Image", "3"), ("j", 2, "c.PDF", "Image", "30"), ("k", 1, "d.pdf", "Image", "50"), ("k", 2, "e.pdf", "Text PDF", "1")], "item_id string, pos int, name string, format string, size string")
    got = {r.item_id: (r.filename, r.error) for r in collect.best_derivative(files).collect()}
    assert got == {"i": (None, "no PDF derivative found for archive item i"), "j": ("c.PDF", None), "k": ("e.pdf", None)}


def test_retries(spark):
    rows = spark.createDataFrame([(1, 500), (2, None), (3, 500), (1, 404), (1, 403)], "n int, s int").select(collect.retry_after(F.col("n"), F.col("s"))).collect()
    assert [r[0] for r in rows] == [5, 10, None, None, None]


PAYLOADS = [
    (b"%PDF-1.7 rest", "pdf"), (b"  <!DOCTYPE html><html>", "html"), (b"\n\t<HTML>", "html"), (b"text then <html> tag", "html"), (b'{"a": 1}', "json"), (b" [1]", "json"), (b"\x00\x01\x02", "unknown"), (b"", "unknown"),
]


def test_payloads(spark):
    rows = [(i, bytearray(b), k) for i, (b, k) in enumerate(PAYLOADS)]
    df = spark.createDataFrame(rows, "i int, b binary, k string")
    assert all(r.t == r.k for r in df.select("k", collect.detect_type(F.col("b")).alias("t")).collect())
    big = spark.createDataFrame([(i, bytearray(b + b"x" * 10_000), k) for i, b, k in rows], "i int, b binary, k string")
    got = {r.i: r.v for r in big.select("i", collect.validate_payload(F.col("b")).alias("v")).collect()}
    assert got[0].ok and not got[1].ok and "HTML page" in got[1].detail and "expected PDF" in got[4].detail
    small = df.where("i = 0").select(collect.validate_payload(F.col("b")).alias("v")).first().v
    assert not small.ok and small.detail == "rejected: payload too small (13 bytes < 10000)"


@pytest.mark.parametrize(("name", "want"), [("SAT%20test%20(1).pdf", "SAT_test__1_.pdf"), ("a/b\\c.pdf", "a_b_c.pdf"), ("a+b%2Bc.pdf", "a_b_c.pdf"), ("100%.pdf", "100_.pdf"), ("plain-name_1.pdf", "plain-name_1.pdf")])
def test_file_names(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(collect.safe_filename(F.col("n"))).first()[0] == want


def test_tsv(spark):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext"
    line = lambda level, conf, text: f"{level}\t1\t1\t1\t1\t1\t0\t0\t9\t9\t{conf}\t{text}"
    pages = [(1, "\n".join([head, line(5, 90, "two"), line(5, 70, "words")])), (2, "\n".join([head, line(4, -1, ""), line(5, -1, "x"), line(5, 80, " "), line(5, 66.5, "y")])), (3, head), (4, head + "\nbroken\trow\n" + line("x", 90, "w") + "\n" + line(5, "n/a", "w")), (5, "")]
    words = ocr.tsv_words(spark.createDataFrame(pages, "page int, tsv string"))
    got = {r.page: (r.word_count, r.mean_conf, r.quality_flag) for r in ocr.page_confidence(words, ["page"]).collect()}
    assert got == {1: (2, 80.0, "good"), 2: (1, 66.5, "fair")}
    grades = spark.createDataFrame([(5, 80.0), (5, 65.0), (5, 59.96), (0, 0.0)], "n int, c double").select(ocr.quality(F.col("n"), F.col("c"))).collect()
    assert [g[0] for g in grades] == ["good", "fair", "review", "empty"]


def test_means_on_the_edge_of_a_rounding(spark):
    words = [96.85, 16.74, 52.0, 5.01, 3.65]  # 34.85, and 34.849999999999994 if added up in this order
    rows = [(page, 5, c, "w") for page, some in ((1, words), (2, words[::-1]), (3, [1 / 3, 2 / 3]), (4, [80.1, 79.9, 80.0])) for c in some] + [(5, 5, -1.0, "w")]
    df = spark.createDataFrame(rows, "page int, level int, conf double, word string").coalesce(1)
    got = {r.page: (r.word_count, r.mean_conf, r.quality_flag) for r in ocr.page_confidence(df, ["page"]).collect()}
    assert got == {1: (5, 34.9, "review"), 2: (5, 34.9, "review"), 3: (2, 0.5, "review"), 4: (3, 80.0, "good"), 5: (0, 0.0, "empty")}


def test_state(spark):
    old = spark.createDataFrame([("a", 1, "x", 0), ("b", 1, "y", 0)], "k string, j int, v string, batch int")
    new = spark.createDataFrame([("b", 1, "z", 1), ("c", 2, "w", 1)], "k string, j int, v string, batch int")
    once = state.merge(old, new, ["k", "j"])
    assert {(r.k, r.v) for r in once.collect()} == {("a", "x"), ("b", "z"), ("c", "w")}
    assert sorted(map(tuple, state.merge(once, new, ["k", "j"]).collect())) == sorted(map(tuple, once.collect()))
    assert state.pending(new, old, ["k", "j"]).count() == 1 and state.pending(new, old, ["k", "j"], force=True).count() == 2


def test_neighbours_over_gaps(spark):
    pages = spark.createDataFrame([("s", "d", n) for n in (1, 2, 4, 7, 8)] + [("s", "e", 3)], "source_id string, doc string, page_num int")
    got = {(r.doc, r.page_num): (r.has_prev, r.has_next) for r in browse.neighbours(pages).collect()}
    assert got == {("d", 1): (False, True), ("d", 2): (True, False), ("d", 4): (False, False), ("d", 7): (False, True), ("d", 8): (True, False), ("e", 3): (False, False)}


def test_browse(spark):
    df = spark.range(100).select(F.col("id").alias("n"), F.lit("s").alias("source_id"))
    for number, first in ((0, 0), (1, 0), (2, 48), (3, 96), (9, 96)):
        assert browse.page_of(df, ["n"], number, 48).first().n == first
    assert browse.page_of(df.where("false"), ["n"], 3, 48).count() == 0
    assert df.where(browse.where_all(source_id=("s", None), n=("no such class", ("a",)))).count() == 100
    assert browse.totals(spark.createDataFrame([], "classification string, route string")).first().text_pct is None


def test_files(spark, tmp_path):
    (tmp_path / "inbox/s").mkdir(parents=True)
    (tmp_path / "inbox/s/a.PDF").write_bytes(b"%PDF-1")
    (tmp_path / "inbox/s/note.txt").write_bytes(b"caf\xe9 ok")
    assert [(r.folder, r.name) for r in readers.inbox(spark, str(tmp_path / "inbox")).collect()] == [("s", "a.PDF")]
    assert readers.text_files(spark, str(tmp_path / "inbox")).first().text == "caf� ok"
    seed = {"vetting_date": "2024-01-01", "sources": [{"id": "a", "name": "A", "status": "approved", "license": "l", "evidence": [{"url": "u"}], "decision_reason": "Good. Very"}]}
    (tmp_path / "seed.json").write_text(json.dumps(seed, indent=1))
    sources = readers.seed_sources(spark, str(tmp_path / "seed.json"))
    flat = collect.registry_flat(sources).first()
    assert (flat.usage_tag, flat.evidence_urls, flat.publisher) == ("DO_NOT_COLLECT", "u", "")
    pages = readers.pdf_pages(spark, str(tmp_path / "inbox"), lambda b: iter([(1, 612.0, 792.0, b.decode(), 0.5)])).collect()
    assert [(r.page_num, r.page_text) for r in pages] == [(1, "%PDF-1")]
    assert readers.ink_ratio(bytes([0] * 50 + [255] * 50), 10, 10, 10) == pytest.approx(0.5, abs=0.1)
    gray = spark.createDataFrame([(bytearray([0] * 50 + [255] * 50), 10), (None, 10)], "g binary, n int").select(readers.ink_density(F.col("g"), F.col("n"), F.col("n"), F.col("n"))).collect()
    assert gray[0][0] == pytest.approx(0.5, abs=0.1) and gray[1][0] is None
    images = spark.createDataFrame([("s", "d", 1, bytearray(b"ok")), ("s", "d", 2, bytearray(b"bad"))], "source_id string, doc string, page_num int, content binary")

    def engine(content):
        if content == b"bad":
            raise RuntimeError("engine failed")
        return "text", "tsv"

    read = {r.page_num: (r.text, r.tsv, r.error) for r in readers.recognise(images, engine).collect()}
    assert read == {1: ("text", "tsv", None), 2: (None, None, "engine failed")}
    files = {r.path: bytes(r.content) for r in readers.page_assets(images, lambda b, n: (b, b[:1]), "data").collect()}
    assert files == {"data/pages/s/d/page_0001.png": b"ok", "data/thumbs/s/d/page_0001.png": b"o", "data/pages/s/d/page_0002.png": b"bad", "data/thumbs/s/d/page_0002.png": b"b"}
    assert readers.table_or_empty(spark, "no_such_table", "a int").count() == 0


def test_incremental_ingest(spark, tmp_path):
    source, kept, mark = (str(tmp_path / n) for n in ("in", "state", "mark"))
    schema = "k string, v int"
    run = lambda: ingest.ingest(spark, source, schema, kept, mark, ["k"])
    spark.createDataFrame([("a", 1), ("b", 1)], schema).write.parquet(source)
    run()
    run()
    spark.createDataFrame([("b", 2), ("c", 1)], schema).write.mode("append").parquet(source)
    run()
    assert {(r.k, r.v) for r in ingest.current(spark, kept).collect()} == {("a", 1), ("b", 2), ("c", 1)}
    assert len(ingest.versions(spark, kept)) == 2
    for n in range(3, 6):
        spark.createDataFrame([("b", n)], schema).write.mode("append").parquet(source)
        run()
    assert {(r.k, r.v) for r in ingest.current(spark, kept).collect()} == {("a", 1), ("b", 5), ("c", 1)}
    assert len(ingest.versions(spark, kept)) == 2
    # only versions that one of the last two indexes names are left, and no emptied folders
    alive = {v for n in ingest.versions(spark, kept) for v in ingest._index(spark, kept, n + 1).values()}
    assert {int(p.name[2:]) for p in (tmp_path / "state").glob("v=*")} == alive
    # a batch that wrote its version but no index is not seen
    spark.createDataFrame([("a", 99, 9)], "k string, v int, batch long").write.partitionBy("k").parquet(f"{kept}/v=99")
    assert {(r.k, r.v) for r in ingest.current(spark, kept).collect()} == {("a", 1), ("b", 5), ("c", 1)}


def test_a_repeated_batch_starts_from_the_index_before_it(spark, tmp_path):
    import shutil

    source, kept, mark = (str(tmp_path / n) for n in ("in", "state", "mark"))
    run = lambda: ingest.ingest(spark, source, "k string, v int", kept, mark, ["k"], prepare=lambda b: b.groupBy("k").agg(F.sum("v").cast("int").alias("v")))
    for v in (1, 2):
        spark.createDataFrame([("a", v)], "k string, v int").write.mode("append").parquet(source)
        run()
    last = max((tmp_path / "mark/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()  # as if the process had died before the stream noted the batch
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    shutil.rmtree(tmp_path / "none", ignore_errors=True)
    run()
    assert [(r.k, r.v) for r in ingest.current(spark, kept).collect()] == [("a", 2)]


def test_published_releases(spark, tmp_path, monkeypatch):
    """The pointer names a whole release at any time; verification finds every change."""
    root = str(tmp_path / "pub")
    assert writers.current_release(spark, root) is None
    one = writers.publish_release(records(spark, {}, {"usage_tag": "RESTRICTED_X"}), root, "1", "now")
    assert writers.current_release(spark, root) == one
    monkeypatch.setattr(writers, "put_text", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        writers.publish_release(records(spark, {}), root, "2", "now")
    monkeypatch.undo()
    assert writers.current_release(spark, root) == one
    with pytest.raises(writers.GateError):
        writers.publish_release(records(spark, {"kind": "x"}), root, "2", "now")
    two = writers.publish_release(records(spark, {}, {"usage_tag": "RESTRICTED_X"}), root, "3", "now")
    assert writers.current_release(spark, root) == two and os.path.exists(one)
    writers.expire_releases(spark, root)
    assert not os.path.exists(one) and os.path.exists(two) and len([n for n in os.listdir(root) if n.startswith("release-")]) == 1
    status = lambda: {r.path: r.status for r in writers.verify_release(spark, two).collect()}
    assert set(status().values()) == {"ok"} and "questions/partition=restricted/_RESTRICTED.txt" in status()
    os.remove(f"{two}/questions/partition=restricted/_RESTRICTED.txt")
    with open(f"{two}/STATS.md", "a") as f:
        f.write("more")
    for crc in (f"{two}/.STATS.md.crc", f"{two}/.SCHEMA.md.crc"):
        os.path.exists(crc) and os.remove(crc)
    os.remove(f"{two}/SCHEMA.md")
    with open(f"{two}/added.txt", "w") as f:
        f.write("x")
    odd = {p: s for p, s in status().items() if s != "ok"}
    assert odd == {"questions/partition=restricted/_RESTRICTED.txt": "missing", "STATS.md": "changed", "SCHEMA.md": "missing", "added.txt": "unlisted"}


def test_log_batches_come_in_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "a string")
    assert writers.append_log(rows("x", None), path, "1")
    writers.stage_log(rows("y"), path, "2")  # died before the rename
    assert sorted((r.a or "", r.batch) for r in writers.read_log(spark, path, "a string").collect()) == [("", "1"), ("x", "1")]
    assert writers.append_log(rows("y"), path, "2") and not writers.append_log(rows("z"), path, "2")
    assert sorted(r.a or "" for r in writers.read_log(spark, path, "a string").collect()) == ["", "x", "y"]


def test_pages_without_their_files_are_due_again(spark):
    wanted = spark.createDataFrame([(i,) for i in range(5)], "k int")
    done = spark.createDataFrame([(0, "a0", "t0"), (1, "a1", "t1"), (2, "a2", None), (3, "gone", "gone"), (4, "a2", "")], "k int, image string, text string")
    files = spark.createDataFrame([(p,) for p in ("a0", "t0", "a1", "a2", "a0")], "path string")
    due = lambda **x: sorted(r.k for r in state.pending_files(wanted, done, ["k"], ["image", "text"], files, **x).collect())
    assert due() == [1, 2, 3] and due(force=True) == [0, 1, 2, 3, 4]


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/e/a.bin").write_bytes(b"12345")
    (tmp_path / "d/b.bin").write_bytes(b"")
    got = readers.listing(spark, str(tmp_path / "d"))
    assert sorted((r.path, r.bytes) for r in got.collect()) == [("e/a.bin", 5)]
    assert "content" not in got._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_ink_density_of_stacked_rasters(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(readers, "STACK_BYTES", 1000)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(60):
        w, h = int(rng.integers(1, 25)), int(rng.integers(1, 30))
        s = w + int(rng.integers(0, 4))
        rows.append((i, bytearray(rng.integers(0, 256, h * s, dtype=np.uint8).tobytes()), w, h, s))
    rows += [(90, None, 3, 3, 3), (91, bytearray(b"12"), 3, 3, 3), (92, bytearray(b""), 0, 0, 0)]
    df = spark.createDataFrame(rows, "i int, g binary, w int, h int, s int")
    got = {r.i: r.d for r in df.select("i", readers.ink_density(F.col("g"), F.col("w"), F.col("h"), F.col("s")).alias("d")).collect()}
    for i, g, w, h, s in rows[:60]:
        inner = [g[y * s + x] < 200 for y in range(int(h * 0.05), int(h * 0.95)) for x in range(int(w * 0.05), int(w * 0.95))]
        assert got[i] == pytest.approx(sum(inner) / len(inner) if inner else 0.0)
    assert got[90] is None and got[91] is None and got[92] == 0.0


def test_seek_paging_equals_offset_paging(spark, tmp_path):
    rows = [(s, d, n) for s in (None, "a", "b") for d in ("x", None, "y") for n in range(1, 9)]
    df = spark.createDataFrame(rows, "source_id string, doc string, page_num int").repartition(5)
    order = ["source_id", "doc", "page_num"]
    index = browse.page_index(df, order, 10, str(tmp_path / "index"))
    assert sorted(r.page for r in index.collect()) == list(range(1, 9))
    after = None
    for number in range(1, 9):
        want = [tuple(r) for r in browse.page_of(df, order, number, 10).collect()]
        assert [tuple(r) for r in browse.page_by_index(df, index, order, number, 10).collect()] == want
        assert [tuple(r) for r in browse.seek(df, order, after, 10).collect()] == want
        after = want[-1]
    for number in (-3, 0, 99):
        assert browse.page_by_index(df, index, order, number, 10).collect() == browse.page_of(df, order, number, 10).collect()
    none = df.where("false")
    assert browse.page_by_index(none, browse.page_index(none, order, 10, str(tmp_path / "none")), order, 1, 10).collect() == []


def test_stored_tables_prune_buckets_and_push_keys(spark, tmp_path):
    df = spark.createDataFrame([(f"s{i % 3}", f"d{i % 20}", i) for i in range(400)], "source_id string, doc string, page_num int")
    table = writers.keyed_table(df, "kept_pages_test", "doc", ["source_id", "doc", "page_num"], str(tmp_path / "t"), buckets=16)
    shown = {"spark.sql.maxMetadataStringLength": "2000", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}  # else files are pruned, but the plan does not say so
    for k, v in shown.items():
        spark.conf.set(k, v)
    try:
        found = table.where("source_id = 's1' and doc = 'd7' and page_num = 67")
        plan = found._jdf.queryExecution().toString()
        assert "SelectedBucketsCount: 1 out of 16" in plan
        assert all(f"EqualTo({c})" in plan for c in ("source_id,s1", "doc,d7", "page_num,67"))
        assert [tuple(r) for r in found.collect()] == [("s1", "d7", 67)]
        plan = browse.seek(table.where("doc = 'd7'"), ["source_id", "page_num"], ("s1", 100), 5)._jdf.queryExecution().toString()
        assert "TakeOrderedAndProject" in plan and "GreaterThan(source_id,s1)" in plan
    finally:
        for k in shown:
            spark.conf.unset(k)
        spark.sql("drop table kept_pages_test")


def test_rebuilt_partitions_and_optional_tables(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, part string")
    try:
        writers.rebuild_table(rows((1, "a", "x"), (2, "b", "y")), "rebuilt_test", "part", str(tmp_path / "t"))
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        writers.rebuild_table(rows((3, "c", "y"), (4, "d", "z")), "rebuilt_test", "part")
        assert sorted(map(tuple, spark.table("rebuilt_test").collect())) == [(1, "a", "x"), (3, "c", "y"), (4, "d", "z")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
        assert readers.table_or_empty(spark, "rebuilt_test", "k int").count() == 3 and readers.table_or_empty(spark, "not_there_test", "k int").count() == 0
    finally:
        spark.sql("drop table if exists rebuilt_test")


def test_large_and_old_inbox_files(spark, tmp_path):
    (tmp_path / "in/s").mkdir(parents=True)
    for name, data in (("a.pdf", b"%PDF-1"), ("B.PDF", b"%PDF-" + b"x" * 100), ("c.txt", b"no")):
        (tmp_path / "in/s" / name).write_bytes(data)
    os.utime(tmp_path / "in/s/a.pdf", (1_000_000_000, 1_000_000_000))
    got = {r.name: r for r in readers.inbox(spark, str(tmp_path / "in"), limit=50).collect()}
    assert set(got) == {"a.pdf", "B.PDF"} and bytes(got["a.pdf"].content) == b"%PDF-1" and (got["B.PDF"].content, got["B.PDF"].bytes) == (None, 105)
    assert [r.name for r in readers.inbox(spark, str(tmp_path / "in"), modified_after="2020-01-01T00:00:00").collect()] == ["B.PDF"]


def test_packed_files_beside_loose_ones(spark, tmp_path):
    root = str(tmp_path / "in")
    (tmp_path / "in/s").mkdir(parents=True)
    (tmp_path / "in/s/loose.pdf").write_bytes(b"%PDF-1")
    writers.pack(spark.createDataFrame([("s/packed.PDF", bytearray(b"%PDF-22")), ("s/note.txt", bytearray(b"caf\xe9")), ("t/empty.txt", bytearray(b""))], "path string, content binary"), root)
    assert {(r.folder, r.name, bytes(r.content), r.bytes) for r in readers.inbox(spark, root).collect()} == {("s", "loose.pdf", b"%PDF-1", 6), ("s", "packed.PDF", b"%PDF-22", 7)}
    assert {r.name: r.content is None for r in readers.inbox(spark, root, limit=6).collect()} == {"loose.pdf": False, "packed.PDF": True}
    assert readers.inbox(spark, root, modified_after="2999-01-01T00:00:00").count() == 0
    assert {(r.path.rsplit("/in/", 1)[1], r.text) for r in readers.text_files(spark, root).collect()} == {("s/note.txt", "caf\ufffd"), ("t/empty.txt", "")}
    assert sorted((r.path, r.bytes) for r in readers.listing(spark, root).collect()) == [("s/loose.pdf", 6), ("s/note.txt", 4), ("s/packed.PDF", 7), ("t/empty.txt", 0)]


@pytest.mark.parametrize("name", ["inbox_to_ledger", "page_text_lookup", "pending_files"])
def test_small_files_are_not_written_one_by_one(spark, tmp_path, monkeypatch, name):
    sf, made = "/root/testdata/sf0.001", str(tmp_path / "made")
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    monkeypatch.setattr(derived, "folder", lambda _: made)
    assert catalog.QUERIES[name](spark, sf).count() > 0
    assert sum(f.startswith("part-") for _, _, found in os.walk(made) for f in found) <= 2 * spark.sparkContext.defaultParallelism
