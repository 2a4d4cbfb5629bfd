"""Frontier, census, discovery, pilot, plans, files, fetching and streams."""

import email.message
import gzip
import inspect
import json
import random
import urllib.error

import pytest
from pyspark.sql import functions as F

from tablewright.operators import discovery as D
from tablewright.operators import frontier as C
from tablewright.operators import harvest as V
from tablewright.plans import catalog as K
from tablewright.plans import jobs as J
from tablewright.sources import fetch as N
from tablewright.sources import files as S
from tablewright.sources import html_tables as H
from tablewright.sources import robots as R
from tablewright.streaming import landing as L

ROOT = "https://www.statscrew.com"


def a(*hrefs):
    return "".join(f"<a href='{h}'>x</a>" for h in hrefs)


def site(spark):
    roster = lambda p: f"<table><tr><th>#</th><th>Player</th></tr><tr><td>1</td><td><a href='/football/stats/p-{p}'>P</a></td></tr></table>{a('/football/roster/t-ZZZ/y-1999')}"
    pages = {
        "/football/": a("/football/y1", "/football/y2", "/other/x", "https://elsewhere.org/football/z"),
        "/football/y1": a("/football/roster/t-A/y-1921", "/football/roster/t-B/y-1921", "/football/"),
        "/football/y2": a("/football/roster/t-C/y-1922", "/football/roster/t-D/y-1922", "/football/roster/t-A/y-1921"),
        "/football/roster/t-A/y-1921": roster("a1"),
        "/football/roster/t-B/y-1921": roster("b1"),
        "/football/roster/t-C/y-1922": roster("c1"),
        "/football/roster/t-D/y-1922": "<p>nothing here",
    }
    return spark.createDataFrame([(ROOT + k, v) for k, v in pages.items()], "url string, html string")


def seeds(spark, *urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def test_crawl_stays_in_its_namespace(spark):
    got = [tuple(r) for r in C.crawl_landed(ROOT + "/football/", site(spark), ["www.statscrew.com"], ["/football/"]).collect()]
    assert len(got) == len({u for u, _ in got}) == 11 and got == sorted(got)
    assert dict(got)[ROOT + "/football/roster/t-ZZZ/y-1999"] == "missing_fixture"


def test_bfs_depths_with_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("a", "d")], "src string, dst string")
    got = {r["url"]: r["depth"] for r in C.bounded_bfs(seeds(spark, "a"), edges, 9).collect()}
    assert got == {"a": 0, "b": 1, "d": 1, "c": 2}


def test_census_covers_every_leaf_once(spark):
    fetch = V.page_table_fetch(site(spark))
    c = C.run_census("statscrew", "team_season_roster", seeds(spark, ROOT + "/football/"), fetch, ["www.statscrew.com"], ["/football/"], shards=3)
    work = c.work.collect()
    assert sorted(w["key"] for w in work) == ["1921|A", "1921|B", "1922|C", "1922|D"]
    assert all(w["owner"] is not None for w in work)
    # Leaves are not followed, so the link on them was never asked for.
    asked = {r["url"]: r["status"] for r in c.ledger.collect()}
    assert ROOT + "/football/roster/t-ZZZ/y-1999" not in asked and len(asked) == 7
    s = {r["url"]: r["usability"] for r in c.surfaces.collect()}
    assert s == {ROOT + f"/football/roster/t-{t}": "canonical_candidate" for t in ("A/y-1921", "B/y-1921", "C/y-1922")}
    report = C.census_report(c).first()
    assert report["requests"] == 7 and report["request_status"] == {"ok": 7} and report["work_items"] == 4 and len(report["fingerprints"]) == 1


def test_census_asks_robots_and_keeps_the_seed_outside_the_list(spark):
    robots = R.robots_rules(spark.createDataFrame([("www.statscrew.com", 200, "User-agent: *\nDisallow: /football/y2")], "host string, status_code int, body string"))
    c = C.run_census("statscrew", "team_season_roster", seeds(spark, ROOT + "/football/"), V.page_table_fetch(site(spark)), ["www.statscrew.com"], ["/football/y", "/football/roster"], robots, shards=2)
    status = {r["url"].removeprefix(ROOT): r["status"] for r in c.ledger.collect()}
    assert status["/football/y2"] == "robots_denied" and status["/football/"] == "ok" and "/football/roster/t-C/y-1922" not in status


def test_census_has_no_bounds_of_its_own(spark):
    chain = [(f"{ROOT}/football/y{i}", a(f"/football/y{i + 1}")) for i in range(5)] + [(f"{ROOT}/football/y5", a("/football/roster/t-A/y-1921"))]
    pages = spark.createDataFrame([*chain, (f"{ROOT}/football/roster/t-A/y-1921", "<p>")], "url string, html string")
    census = lambda s: C.run_census("statscrew", "team_season_roster", s, V.page_table_fetch(pages), ["www.statscrew.com"], ["/football/"])
    c = census(seeds(spark, ROOT + "/football/y0"))
    assert c.ledger.count() == 7 and [w["key"] for w in c.work.collect()] == ["1921|A"]
    many = spark.range(10_001).select(F.concat(F.lit(ROOT + "/football/z"), "id").alias("url"))
    assert census(many).ledger.count() == 10_001


def test_crawl_has_no_depth_of_its_own(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(6)], "src string, dst string")
    assert C.bounded_bfs(seeds(spark, "n0"), edges).agg(F.max("depth")).first()[0] == 6
    assert inspect.signature(C.crawl_landed).parameters["max_depth"].default is None


def test_robots_rules(spark):
    d = spark.createDataFrame([("a", 200, "User-agent: *\nDisallow: /private"), ("b", 403, None), ("c", 500, None), ("d", None, None)], "host string, status_code int, body string")
    j = R.robots_rules(d).withColumn("url", F.explode(F.array(F.lit("https://h/private/x"), F.lit("https://h/open"))))
    got = {(r["host"], r["url"][10:]): r["ok"] for r in j.select("host", "url", R.can_fetch(F.col("rules"), F.col("url")).alias("ok")).collect()}
    assert got == {("a", "private/x"): False, ("a", "open"): True, ("b", "private/x"): False, ("b", "open"): False, **{(h, p): True for h in "cd" for p in ("private/x", "open")}}


# --- discovery --------------------------------------------------------------------------------------


def test_quota_is_the_sequential_reader(spark):
    rnd = random.Random(4)
    for _ in range(6):
        pages = [f"https://h/{rnd.choice('ab')}/{i}" for i in range(rnd.randint(1, 6))]
        pages = list(dict.fromkeys(pages))
        out = {u: [f"https://h/{rnd.choice('abc')}/{rnd.randint(0, 9)}" for _ in range(rnd.randint(0, 8))] for u in pages}
        ok = {u: rnd.random() < 0.8 for u in pages}
        k, family = 3, lambda u: u[9:11] + "/{n}"
        seen, taken, want = set(pages), {}, []
        for u in pages:
            if not ok[u]:
                continue
            taken[family(u)] = taken.get(family(u), 0) + 1
            for v in out[u]:
                if v in seen:
                    continue
                seen.add(v)
                if taken.get(family(v), 0) < k:
                    want.append(v)
                taken[family(v)] = taken.get(family(v), 0) + 1
        probes = spark.createDataFrame([(u, i, ok[u]) for i, u in enumerate(pages)], "url string, src_order long, ok boolean")
        rows = [(u, i, j, v, family(v)) for i, u in enumerate(pages) if ok[u] for j, v in enumerate(out[u])]
        links = spark.createDataFrame(rows, "src string, src_order long, link_pos int, dst string, url_pattern string")
        assert sorted(r["dst"] for r in D.quota_sample(probes, links, k).collect()) == sorted(want)


TWO = "<table><tr><th>Player</th><th>Yds</th></tr><tr><td><a href='/football/p-x1'>p</a></td><td>1</td></tr></table><table><tr><th>Pts</th><th>Team</th></tr><tr><td>1</td><td>t</td></tr><tr><td>1</td><td>t</td></tr></table>"
ONE = TWO[: TWO.index("</table>") + 8]


def test_every_table_is_described(spark):
    p = spark.createDataFrame([("u", TWO)], "url string, html string")
    got = D.described_tables(H.tables_of(p)).orderBy("position").collect()
    assert [(r["headers"], r["n_rows"], r["surface"]) for r in got] == [(["player", "yds"], 1, "corroborating_witness"), (["pts", "team"], 2, "corroborating_witness")]


def test_report_has_three_states(spark):
    p = spark.createDataFrame([(f"https://h/a/{i}", TWO, i, "/a/{n}") for i in range(4)] + [("https://h/b/1", ONE, 9, "/b/{n}"), ("https://h/c/1", ONE, 10, "/c/{n}")], "url string, html string, pos int, url_pattern string")
    inv = D.pattern_inventory(p.drop("html"), D.described_tables(H.tables_of(p)))
    first = inv.first()
    assert first["url_pattern"] == "/a/{n}" and first["pages_seen"] == 4 and len(first["example_urls"]) == 3 and first["n_distinct_table_shapes"] == 2
    claims = spark.createDataFrame([("/", "root", 0), ("/b", "b", 1), ("/b/", "bb", 2), ("/b/", "later", 3)], "prefix string, dataset string, position int")
    held = spark.createDataFrame([("/a/{n}", 120)], "url_pattern string, pages_held int")
    rep = D.three_state_report(inv, claims, held)
    got = {r["url_pattern"]: (r["state"], r["claimed_by_dataset"], r["worth_fetching"], r["max_rows"]) for r in rep.collect()}
    assert got == {"/a/{n}": ("HELD", None, False, 2), "/b/{n}": ("DECLARED_NOT_HELD", "bb", True, 1), "/c/{n}": ("UNCLAIMED", None, True, 1)}
    assert D.report_counters(rep).first().asDict() == {"patterns_unclaimed_with_tables": 1, "patterns_held": 1, "patterns_declared_not_held": 1, "patterns_worth_fetching": 2}
    assert [r["url_pattern"] for r in D.worth_fetching(rep).collect()] == ["/b/{n}", "/c/{n}"]


def test_pilot(spark):
    p = spark.createDataFrame([(f"u{i}", TWO if i == 3 else ONE, i, True) for i in range(4)], "url string, html string, pos int, ok boolean")
    t = H.tables_of(p)
    shapes = D.pilot_shapes(t, p.drop("html"))
    got = [(r["headers"], r["stability"], r["page_share"], r["has_source_native_id"], r["id_columns"]) for r in shapes.collect()]
    assert got == [(["player", "yds"], "structural", 1.0, True, ["player"]), (["pts", "team"], "variant", 0.25, False, ["team"])]
    prop = D.pilot_proposal("s", "/football/stats/p-{id}", shapes).first()
    assert prop["proposed_dataset"] == "football_stats" and prop["requires_table_tagging"] and prop["joinable"]
    assert D.sample_rows(t, 2).count() == 2
    with pytest.raises(ValueError, match="starts with"):
        D.pilot_proposal("s", "football", shapes)


def test_older_views(spark):
    html = "<h2>Logs</h2><table><tr><th>Fum</th><th>Lost</th></tr><tr><td>1</td><td>0</td></tr></table>"
    asked = spark.createDataFrame([("x", "logs", 1990, "u"), ("x", "career", None, "v")], "slug string, view string, season int, url string")
    p = spark.createDataFrame([("u", html), ("v", html)], "url string, html string")
    got = {r["view"]: r["cells"] for r in D.older_view_rows(p, asked).collect()}
    assert got["logs"]["fumbles_lost"] == "0" and "fumbles" not in got["career"]


# --- plans ------------------------------------------------------------------------------------------


def test_plan_filters(spark):
    t = spark.createDataFrame(J.TARGETS, "source string, dataset string, shards int")
    assert J.plan(t).count() == 15
    assert J.plan(t, "statscrew", "team_season_stats", "3").count() == 1
    assert J.plan(t, dataset="team_season_results").count() == 5 and J.plan(t, shards="2").count() == 6
    assert J.plan(t, source="other").count() == 0
    hosts = spark.createDataFrame([("statscrew", 1.0), ("other", 0.1)], "source string, delay_seconds double")
    assert J.max_parallel(J.plan(t), hosts).first()[0] == 4
    assert J.max_parallel(J.plan(t, source="other"), hosts).first()[0] == 1


def test_seed_expansion(spark):
    ranges = spark.createDataFrame([(1920, 1923, "https://x/{year}/")], "first_year int, last_year int, template string")
    got = [r["url"] for r in J.range_seeds(ranges, 1922, 0).orderBy("url").collect()]
    assert got == ["https://x/1922/", "https://x/1923/"] and J.range_seeds(ranges, 1990, None).count() == 0


def test_inventory_file(spark, tmp_path):
    (tmp_path / "i.csv").write_text("year,team\n1921,DAY\n1922,CHI\nx,BAD\n")
    inv = S.read_inventory(spark, str(tmp_path / "i.csv"))
    assert [r["url"] for r in J.inventory_seeds(inv, "https://x/t-{team}/y-{year}", 1921, 1921).collect()] == ["https://x/t-DAY/y-1921"]


def test_done_only_if_all_pages_answered(spark):
    u = spark.createDataFrame([("x", [1990, 1991]), ("y", [1990])], "slug string, years array<int>")
    ledger = spark.createDataFrame([("logs", "x", "ok"), ("logs", "x", "error"), ("logs", "y", "ok")], "view string, slug string, status string")
    got = sorted((r["slug"], r["view"], r["season"] or 0) for r in J.player_view_pages(u, J.done_views(ledger), ["career", "logs"]).collect())
    assert got == [("x", "career", 0), ("x", "logs", 1990), ("x", "logs", 1991), ("y", "career", 0)]


CATALOG = {"sources": {"s": {"domains": ["h"], "delay_seconds": 0.5, "datasets": {
    "d": {"first_year": 1920, "last_year": 2000, "allowed_prefixes": ["/a/"], "census_seeds": ["https://h/a/"]},
    "closed": {"first_year": 1920, "last_year": 2000, "harvest_disposition": "held_elsewhere", "disposition_reason": "kept"}}}}}


def test_catalog(spark):
    c = K.load_catalog(json.dumps(CATALOG))
    assert c.check_request("s", "d", 1921, 1922)["allowed_prefixes"] == ["/a/"] and c.problems() == []
    for bad in (("x", "d", 1921, 1922), ("s", "x", 1921, 1922), ("s", "d", 1923, 1922), ("s", "d", 1900, 1922)):
        with pytest.raises(K.CatalogError):
            c.check_request(*bad)
    with pytest.raises(K.CatalogError):
        K.load_catalog("[]")
    broken = json.loads(json.dumps(CATALOG))
    del broken["sources"]["s"]["datasets"]["closed"]["disposition_reason"], broken["sources"]["s"]["datasets"]["d"]["census_seeds"]
    assert len(K.Catalog(broken).problems()) == 2
    src, sets, prefixes, ranges = c.frames(spark)
    assert (src.count(), sets.count(), prefixes.count(), ranges.count()) == (1, 2, 1, 0)


# --- files ------------------------------------------------------------------------------------------


def test_manifest_round_trip(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "a.txt").write_text("one")
    (tmp_path / "sub dir" / "b+%.bin").write_bytes(b"\0\1")
    m = S.build_manifest(spark, str(tmp_path), source="s", dataset="d", shard_id=0, shard_count=1, artifact_run_id="r")
    assert [f["path"] for f in m["files"]] == ["a.txt", "sub dir/b+%.bin"] and m["files"][1]["bytes"] == 2
    (tmp_path / S.MANIFEST_NAME).write_text(json.dumps(m))
    assert S.verify_manifest(spark, str(tmp_path)) == []
    (tmp_path / "a.txt").write_text("two")
    (tmp_path / "sub dir" / "b+%.bin").unlink()
    m["files"].append({"path": "../x", "sha256": "0"})
    (tmp_path / S.MANIFEST_NAME).write_text(json.dumps(m))
    assert S.verify_manifest(spark, str(tmp_path)) == ["unsafe path: ../x", "checksum mismatch: a.txt", "missing file: sub dir/b+%.bin"]
    assert S.verify_manifest(spark, str(tmp_path), m | {"schema_version": 2})[0].startswith("unknown")


def test_lines_records_and_raw_pages(spark, tmp_path):
    d = spark.createDataFrame([("b", None, 2), ("a", "x", 1)], "z string, a string, m int")
    S.write_jsonl(d, str(tmp_path / "l"), ["m"])
    lines = [x for f in sorted((tmp_path / "l").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == ['{"a":"x","m":1,"z":"a"}', '{"a":null,"m":2,"z":"b"}']
    S.write_records(d, str(tmp_path / "r"), ["m"])
    assert spark.read.parquet(str(tmp_path / "r")).filter("a IS NULL").count() == 1
    p = spark.createDataFrame([("u", "same"), ("v", "same"), ("w", "other")], "url string, html string")
    S.write_raw(p, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2
    S.write_json_document(d.filter("m = 1"), tmp_path / "doc.json")
    assert json.loads((tmp_path / "doc.json").read_text()) == {"z": "a", "a": "x", "m": 1}
    assert S.read_json_document(spark, str(tmp_path / "doc.json")).first()["m"] == 1
    (tmp_path / "w.jsonl.gz").write_bytes(gzip.compress(b'{"key":"k","season":1963,"url":"u"}\n\n'))
    w = [r for r in S.read_work_items(spark, str(tmp_path / "w.jsonl.gz")).collect() if r["key"]]
    assert len(w) == 1 and w[0]["season"] == 1963 and w[0]["team"] is None


def test_holdings_and_samples(spark):
    doc = spark.createDataFrame([("s", {"d": ({"/a": 3, "/b": None},), "e": ({"/a": 4},)})], "source string, datasets map<string, struct<url_patterns: map<string, long>>>")
    assert {(r["url_pattern"], r["pages_held"]) for r in S.read_holdings(doc).collect()} == {("/a", 7), ("/b", 0)}
    p = spark.createDataFrame([("u1", "/a", 5), ("u2", "/a", 1), ("u1", "/a", 0), ("u3", "/b", 2)], "url string, url_pattern string, pos int")
    assert [r["url"] for r in S.sample_urls(p, "/a", 5).collect()] == ["u1", "u2"]
    u = S.union_first_seen(p.filter("pos = 5"), p.filter("pos < 5")).orderBy("first").collect()
    assert [r["url"] for r in u] == ["u1", "u2", "u3"]


# --- fetching ---------------------------------------------------------------------------------------


class Reply:
    status, headers = 200, {"Content-Type": "text/html"}

    def __enter__(self):
        return self

    def __exit__(self, *a):
        pass

    def read(self):
        return b"body"


def client(answers, **policy):
    slept, now = [], [0.0]

    def urlopen(request, timeout):
        x = answers.pop(0)
        if isinstance(x, tuple):
            h = email.message.Message()
            for k, v in x[1].items():
                h[k] = v
            raise urllib.error.HTTPError(request.full_url, x[0], "no", h, None)
        if isinstance(x, Exception):
            raise x
        return Reply()

    def sleep(s):
        slept.append(s)
        now[0] += s

    return N.HttpClient(N.Policy(**policy), sleep, lambda: now[0], urlopen), slept


def test_retries():
    c, slept = client([(429, {"Retry-After": "7"}), (503, {}), "ok"])
    assert c.fetch("https://h/")[0] == 200 and slept == [7, 6]
    c, slept = client([(404, {})])
    assert c.fetch("https://h/")[0] == 404 and slept == []
    c, slept = client([(429, {})] * 3)
    assert c.fetch("https://h/")[0] == 429 and slept == [30, 60]
    c, slept = client([urllib.error.URLError("x")] * 3)
    assert c.fetch("https://h/")[0] == 0 and slept == [3, 6]


def test_pace_and_budget():
    c, slept = client(["ok"] * 9, delay_seconds=2, budget_seconds=3)
    c.fetch("https://h/")
    c.fetch("https://h/")
    assert slept == [2]
    c.fetch("https://h/")
    with pytest.raises(N.BudgetExhausted):
        c.fetch("https://h/")


def test_spent_budget_keeps_the_ledger(spark):
    work = spark.createDataFrame([("k", "https://localhost.invalid/x")], "key string, url string")
    got = N.http_fetch(N.Policy(budget_seconds=-1))(work).first()
    assert got["status"] == "budget_exhausted" and got["key"] == "k" and got["status_code"] is None


# --- stream -----------------------------------------------------------------------------------------


def test_landing_stream(spark, tmp_path):
    rows = [(f"https://h/a/{i}", "<p>same" if i < 2 else f"<p>{i}", f"2024-01-01 00:0{i}:00") for i in range(4)]
    d = spark.createDataFrame(rows, "url string, html string, t string").select("url", "html", F.to_timestamp("t").alias("landed_at"))
    d.coalesce(1).write.parquet(str(tmp_path / "in"))
    pages = L.distinct_pages(L.landing_stream(spark, str(tmp_path / "in")))
    q = pages.writeStream.format("memory").queryName("landed").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("landed").count() == 3
    counts = L.pattern_counts(L.landing_stream(spark, str(tmp_path / "in")))
    q = counts.writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r["url_pattern"], r["pages"]) for r in spark.table("counted").collect()} == {("/a/{n}", 4)}


def test_discovery_is_one_hop(spark):
    from tablewright.operators.harvest import page_table_fetch

    p = site(spark)
    probes = spark.createDataFrame([(ROOT + "/football/", 0), (ROOT + "/football/y1", 1)], "url string, pos long")
    d = D.run_discovery(probes, page_table_fetch(p), ["www.statscrew.com"], ["/football"], per_pattern=2)
    ledger = {r["url"].removeprefix(ROOT): (r["status"], r["depth"]) for r in d.ledger.collect()}
    assert ledger["/football/"] == ("ok", 0) and ledger["/football/y2"] == ("ok", 1) and ledger["/football/roster/t-A/y-1921"] == ("ok", 1)
    assert "/football/roster/t-C/y-1922" not in ledger and "/other/x" not in ledger
    assert d.patterns.filter("n_distinct_table_shapes > 0").first()["url_pattern"] == "/football/roster/t-A/y-{year}"
    assert D.discovery_counters(d.ledger, d.patterns).first()["pages_ok"] == len(ledger)


def test_pilot_fails_when_nothing_was_fetched(spark):
    from tablewright.operators.gates import GateError
    from tablewright.operators.harvest import page_table_fetch

    urls = spark.createDataFrame([("u", 0), ("v", 1)], "url string, pos long")
    fetch = page_table_fetch(spark.createDataFrame([("u", TWO)], "url string, html string"))
    pilot = D.run_pilot("s", "/a/{n}", urls, fetch)
    assert pilot.counters.first().asDict() == {"urls_sampled": 2, "pages_fetched": 1, "pages_failed": 1} and pilot.shapes.count() == 2
    with pytest.raises(GateError, match="0 pages"):
        D.run_pilot("s", "/a/{n}", urls.filter("url = 'v'"), fetch)


def test_ci_lines(spark):
    t = spark.createDataFrame(J.TARGETS, "source string, dataset string, shards int")
    hosts = spark.createDataFrame([("statscrew", 1.0)], "source string, delay_seconds double")
    lines = J.ci_output(J.plan(t, shard="1"), hosts).splitlines()
    assert len(json.loads(lines[0].removeprefix("matrix="))["include"]) == 3 and lines[1] == "max_parallel=3"
    with pytest.raises(ValueError, match="no jobs"):
        J.ci_output(J.plan(t, source="x"), hosts)


def test_command_line(spark, tmp_path):
    from tablewright.__main__ import main

    c = {"sources": {"statscrew": {"domains": ["www.statscrew.com"], "delay_seconds": 1.0, "discovery_prefixes": ["/football"], "discovery_probes": [ROOT + "/football/"], "datasets": {
        "team_season_roster": {"first_year": 1920, "last_year": 2000, "allowed_prefixes": ["/football/"], "census_seeds": [ROOT + "/football/"]}}}}}
    (tmp_path / "c.json").write_text(json.dumps(c))
    site(spark).write.parquet(str(tmp_path / "pages"))
    common = ["--catalog", str(tmp_path / "c.json"), "--source", "statscrew", "--dataset", "team_season_roster", "--pages", str(tmp_path / "pages")]
    main(["census", *common, "--out", str(tmp_path / "census")])
    main(["harvest", *common, "--work", str(tmp_path / "census/work"), "--out", str(tmp_path / "harvest"), "--run-id", "r1"])
    assert spark.read.parquet(str(tmp_path / "harvest/records")).count() == 3
    main(["discover", *common, "--out", str(tmp_path / "found")])
    main(["report", *common, "--work", str(tmp_path / "found"), "--out", str(tmp_path / "report")])
    assert spark.read.parquet(str(tmp_path / "report/report")).count() == spark.read.parquet(str(tmp_path / "found/patterns")).count() > 0


def test_command_line_over_http(spark, tmp_path):
    """A census that fetches: robots rules for its own name, seeds of an inventory, bytes and their hashes, manifest."""
    import hashlib

    from tablewright.__main__ import main

    root, odd = "https://h.example", b"<a href=/football/roster/t-B/y-1930>\xff</a><table><tr><th>#</th><th>Player</th></tr><tr><td>1</td><td><a href=/football/stats/p-b1>B</a></td></tr></table>"

    def urlopen(request, timeout):
        import io
        import urllib.error
        from email.message import Message

        path = request.full_url.removeprefix("https://h.example")
        bodies = {"/robots.txt": b"User-agent: other\nDisallow: /\n\nUser-agent: reader\nDisallow: /football/roster/t-C", "/football/roster/t-A/y-1930": odd, "/football/roster/t-C/y-1930": odd}
        if path not in bodies:
            raise urllib.error.HTTPError(request.full_url, 404, "none", Message(), None)
        answer = io.BytesIO(bodies[path])
        answer.status, answer.headers = 200, {"Content-Type": "text/html"}
        return answer

    (tmp_path / "teams.csv").write_text("year,team\n1930,A\n1930,C\n1930,D\n1999,A\n")
    c = {"sources": {"statscrew": {"domains": ["h.example"], "delay_seconds": 0, "datasets": {"team_season_roster": {"first_year": 1920, "last_year": 1940, "allowed_prefixes": ["/football/"], "seed_inventory": "teams.csv", "census_seed_template": root + "/football/roster/t-{team}/y-{year}"}}}}}
    (tmp_path / "c.json").write_text(json.dumps(c))
    common = ["--catalog", str(tmp_path / "c.json"), "--source", "statscrew", "--dataset", "team_season_roster", "--agent", "reader", "--run-id", "r2"]
    main(["census", *common, "--out", str(tmp_path / "census")], urlopen)
    ledger = {r["url"][-10:-7]: (r["status"], r["status_code"]) for r in spark.read.parquet(str(tmp_path / "census/ledger")).collect()}
    assert ledger == {"t-A": ("ok", 200), "t-C": ("robots_denied", None), "t-D": ("absent", 404)}
    raw = spark.read.parquet(str(tmp_path / "census/raw")).collect()
    assert [(bytes(r["body"]), r["content_sha256"]) for r in raw] == [(odd, hashlib.sha256(odd).hexdigest())]
    assert [json.loads(x.value)["key"] for x in spark.read.text(str(tmp_path / "census/work_lines")).collect()] == ["1930|A"]
    assert S.verify_manifest(spark, str(tmp_path / "census")) == []
    main(["harvest", *common, "--work", str(tmp_path / "census/work"), "--out", str(tmp_path / "harvest")], urlopen)
    row = spark.read.parquet(str(tmp_path / "harvest/records")).first()
    assert row["player"] == "B" and row["content_sha256"] == hashlib.sha256(odd).hexdigest()
    manifest = json.loads((tmp_path / "harvest/ARTIFACT_MANIFEST.json").read_text())
    assert manifest["dataset"] == "team_season_roster" and {f["path"].split("/")[0] for f in manifest["files"]} >= {"ledger", "records", "raw"}
