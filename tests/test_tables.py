"""HTML tables, adapters, dictionaries and harvest on small pages."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMALL
from tablewright.operators import adapters as A
from tablewright.operators import gates as G
from tablewright.operators import harvest as V
from tablewright.queries import QUERIES
from tablewright.sources import html_tables as H

STATS = """<h2>Passing:</h2><table class=t><tr><th>Player</th><th><a title="Completions">Comp</a></th><th><a title="Completion Percentage">Comp</a></th><th>Yds</th></tr>
<tbody><td><a href=/football/stats/p-aa001>A&nbsp;Player</a></td><td>10</td><td>50</td><td>940</td><td><a href=/football/stats/p-bb001>B</a></td><td>1</td><td></td><td>2</td>
<tr class=tot><td>Totals</td><td>48</td><td>5</td><td>9</td></tr></table><h3>Receiving</h3><table><tr><th>Player</th><th>Yds</th></tr><tr><td>C</td><td>215</td></tr></table>"""
RESULTS = """<table><tr><th>Date</th><th></th><th>Game</th><th></th></tr><tr class=reg_season><td>October 3, 1971</td><td>W</td>
<td><a href="/football/results/t-ZZA/y-1963">W</a> @ <a href="/football/results/t-BBB/y-1963">C</a></td><td>1-0</td></tr></table>"""
LINEUP = """<table><tr><th colspan=3>LINEUPS</th></tr><tr><th colspan="3">Harbor Foxes</th></tr><tr><td>1</td><td>LE</td><td><a href="/players/q/quin00100.html">Ada Quinn</a></td></tr>
<tr><th colspan=3>Mill Rovers</th></tr><tr><td>2</td><td>RE</td><td><a href="/players/v/vela00300.html">Bo Vela</a></td></tr><tr><td>x</td></tr></table>"""
ROSTER = "<h1>R</h1><table><tr><th>#</th><th>Player</th><th>Pos.</th><th>GP</th></tr><tr><td>1</td><td><a href='/football/stats/p-marshlee001'>Lee Marsh</a></td><td>T</td><td>3</td></tr><tr><td>2</td><td>No link</td><td></td><td></td></tr></table>"


def pages(spark, html, url="u", season=1963, team="CLE", player=None):
    return spark.createDataFrame([(url, html, f"{season}|{team}", season, team, None, player)], "url string, html string, key string, season int, team string, game_id string, source_player_id string")


def test_orphans_titles_and_captions():
    a, b = H.read_tables(STATS)
    assert (a["caption"], a["headers"], a["css_class"], a["orphan_rows"], a["dropped_partial_cells"]) == ("Passing", ["player", "comp", "comp_2", "yds"], "t", 2, 0)
    assert dict(a["titles"]) == {"comp": "Completions", "comp_2": "Completion Percentage"} and len(a["rows"]) == 3
    assert b["caption"] == "Receiving" and b["table_index"] == 1


def test_partial_orphans_are_counted():
    t = H.read_tables("<table><tr><th>A</th><th>B</th></tr><td>1</td><td>2</td><td>3</td></table>")[0]
    assert (len(t["rows"]), t["orphan_rows"], t["dropped_partial_cells"]) == (1, 1, 1)


def test_group_headers():
    html = "<table><tr><th></th><th colspan=2>Goals</th><th>Sum</th><th colspan=2>Cards</th></tr><tr>" + "".join(f"<th>{h}</th>" for h in ["Who", "Home", "Away", "All", "Yellow", "Red"]) + "</tr><tr>" + "<td>1</td>" * 6 + "</tr></table>"
    t = H.read_tables(html)[0]
    assert t["header_rows"] == 2 and len(t["headers"]) == 6
    assert {k: dict(t["groups"])[k] for k in ("away", "all", "red")} == {"away": "Goals", "all": "Sum", "red": "Cards"}
    same = H.read_tables("<table><tr><th colspan=3>LINEUPS</th></tr><tr><th>Team</th></tr><tr><td>x</td></tr></table>")[0]
    assert (same["header_rows"], same["headers"]) == (1, ["lineups"])


def test_odd_markup():
    assert H.read_tables("") == [] and H.read_tables("<p>blocked") == []
    assert H.read_tables("<table><td>1</td></table>") == []
    outer = H.read_tables("<table><tr><th>A</th></tr><tr><td><table><tr><th>B</th></tr><tr><td>x</td></tr></table></td></tr></table>")
    assert [t["headers"] for t in outer] == [["b"]]
    t = H.read_tables("<TABLE><TR><TH>A<TH>B</TH></TR><tr><td>1</td></tr><tr><td colspan=x>1</td><td>2</td><td>3</td></tr></TABLE>")[0]
    assert t["headers"] == ["b"] and t["short_rows"] == 0 and len(t["rows"]) == 2


def test_roster(spark):
    p = pages(spark, ROSTER)
    r = A.get_adapter("statscrew").records("team_season_roster", p, H.tables_of(p), p).collect()
    assert [(x["player"], x["source_player_id"], x["position"], x["season"]) for x in r] == [("Lee Marsh", "marshlee001", "T", 1963)]


@pytest.mark.parametrize("name", ["roster_roundtrip", "stats_roundtrip_tagged", "results_roundtrip", "lineup_roundtrip"])
def test_parsed_tables_stay_off_the_driver(spark, name):
    """Parsed pages are guessed at 20 bytes a text, which at the default limit let Spark broadcast all of them."""
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "BroadcastExchange" not in plan


@pytest.mark.parametrize(("source", "href", "found"), [("profootballarchives", "/players/Q/QuinAd21.html", "QuinAd21"), ("nflcom", "/players/ada-quinn/", "ada-quinn"), ("nflcom", "/x", None)])
def test_player_ids(spark, source, href, found):
    assert spark.range(1).select(A.player_id(source, F.lit(href)).alias("r")).first()["r"] == found


def test_stats(spark):
    p = pages(spark, STATS)
    r = A.wide(A.stat_records("statscrew", "team_season_stats", H.tables_of(p), p), ["comp", "comp_2", "yds"]).orderBy("table_index", "row_pos").collect()
    assert [x["table_tag"] for x in r] == ["passing"] * 3 + ["receiving"]
    total = [x for x in r if x["is_total_row"]]
    assert len(total) == 1 and total[0]["comp"] == "48" and total[0]["row_class"] == "tot"
    assert {(x["player"], x["source_player_id"], x["comp_2"]) for x in r if x["row_class"] is None and x["table_tag"] == "passing"} == {("A Player", "aa001", "50"), ("B", "bb001", None)}


def test_career_rows_have_their_own_season(spark):
    html = "<h2>Career</h2><table><tr><th>Year</th><th>Team</th></tr><tr><td>1957</td><td>CLE</td></tr><tr><td>1958*</td><td></td></tr></table>"
    p = pages(spark, html, season=None, team=None, player="browji01")
    r = A.stat_records("statscrew", "player_season_stats", H.tables_of(p), p).orderBy("row_pos").collect()
    assert [(x["season"], x["team"], x["source_player_id"], x["cells"]["stat_team"]) for x in r] == [(1957, "CLE", "browji01", "CLE"), (None, None, "browji01", None)]


def test_results(spark):
    p = pages(spark, RESULTS)
    r = A.results_records("statscrew", "team_season_results", H.tables_of(p), p).collect()
    assert len(r) == 1 and r[0]["game_team_ids"] == "BBB ZZA" and r[0]["row_class"] == "reg_season"
    assert r[0]["cells"]["date"] == "October 3, 1971" and set(r[0]["cells"]) == {"date", "col_1", "game", "col_3"}


def test_lineups_and_fallback(spark):
    a = A.get_adapter("profootballarchives")
    p = pages(spark, LINEUP)
    got = {(x["team"], x["source_player_id"], x["position"]) for x in a.records("player_game_participation", p, H.tables_of(p), p).collect()}
    assert got == {("Harbor Foxes", "quin00100", "LE"), ("Mill Rovers", "vela00300", "RE")}
    q = pages(spark, "<table><tr><th>Player</th></tr><tr><td><a href='/players/Q/QuinAd21.html'>Ada Quinn</a></td></tr></table>")
    assert [x["source_player_id"] for x in a.records("team_season_roster", q, H.tables_of(q), q).collect()] == ["QuinAd21"]


def test_older_reader():
    html = "<h2>Old</h2><table><thead><tr><th>Fum</th><th></th><th>Lost</th></tr></thead><tbody><tr><td>1</td><td>2 &amp;</td></tr><tr><td> </td></tr><tr><th>x</th></tr></tbody></table><table><tr><th>one</th></tr></table>"
    t = H.read_older_tables(html)
    assert len(t) == 1 and t[0]["keys"] == ["fum", "lost"] and t[0]["rows"] == [[("fum", "1"), ("lost", "2 &")]]
    assert H.read_older_tables("") == [] and H.read_older_tables("<TABLE><TR><TD>1</TD></TR></TABLE>") == []


def test_older_reader_captions_and_links():
    head = "<tr><td>Name</td><td>Club</td><td>Club</td></tr>"
    row = "<tr data-x='/teams/mill-rovers/'><td><svg><td>no</td></svg><a href=/players/bo-vela/>Bo<b>Vela</b></a></td><td>M&nbsp;</td><td>2</td><td>3</td></tr>"
    html = "<h3>Far</h3>" + "." * 600 + f"<caption>Near <svg>x</svg>one</caption><table class=a>{head}{row}</table><h2>open <h4>Both</h4><table>{head}<tr><td></td><td> </td></tr></table><table>{head}{row}<tr><td>z"
    t = H.read_older_tables(html)
    assert [(x["table_index"], x["caption"], x["keys"]) for x in t] == [(0, "Near one", ["name", "club", "club_2"]), (1, "open Both", ["name", "club", "club_2"])]
    first, second = t[0]["rows"]
    assert first == [("name", "Name"), ("club", "Club"), ("club_2", "Club")]
    assert second == [("name", "Bo Vela"), ("club", "M"), ("club_2", "2"), ("_player_slug", "bo-vela"), ("_team_slug", "mill-rovers")]
    far = H.read_older_tables("<h3>Far</h3>" + "." * 600 + f"<table>{head}{row}</table>" + f"<h2>open <h4>Both</h4><table>{head}{row}</table>")
    assert [x["caption"] for x in far] == ["", "open Both"]


def test_positions_count_tables_with_rows():
    one = "<table><tr><th>A</th></tr>{}</table>"
    t = H.read_tables(one.format("<tr><td>1</td></tr>") + one.format("") + "<table><tr><td>1</td></tr></table>" + one.format("<tr><td>2</td></tr>"))
    assert [(x["table_index"], x["position"]) for x in t] == [(0, 0), (1, None), (3, 1)]


def test_lineup_rows():
    rows = H.read_lineup_rows(LINEUP)
    assert [r["team_label"] for r in rows] == [None, "Harbor Foxes", None, "Mill Rovers", None, None]
    assert [r["n_cells"] for r in rows] == [0, None, 3, None, 3, 1] or [r["n_cells"] for r in rows] == [None, None, 3, None, 3, 1]
    assert (rows[2]["href"], rows[2]["player"], rows[2]["position"]) == ("/players/q/quin00100.html", "Ada Quinn", "LE")
    assert H.read_lineup_rows("<table><tr><th>x</th></tr></table>") == []


def test_column_dictionary(spark):
    p = pages(spark, STATS).unionByName(pages(spark, STATS, url="v"))
    d = A.observed_dictionary(A.column_dictionary("statscrew", "team_season_stats", H.tables_of(p))).collect()
    by = {(x["table_tag"], x["column_key"]): x for x in d}
    assert by["passing", "comp_2"]["source_title"] == "Completion Percentage" and by["passing", "comp_2"]["pages_observed"] == 2 and by["passing", "comp"]["source_url"] == "u"
    r = pages(spark, RESULTS.replace("<th></th>", "<th>Player</th>", 1))
    t = H.tables_of(r)
    keys = {x["column_key"] for x in A.column_dictionary("statscrew", "x", t).collect()}
    assert keys == set(A.results_records("statscrew", "x", t, r).first()["cells"])  # one name in both


@pytest.mark.parametrize(
    ("source", "dataset", "url", "key"),
    [
        ("statscrew", "player_season_stats", "https://x/football/stats/p-abc01", "p|abc01"),
        ("statscrew", "team_season_stats", "https://x/football/STATS/t-CHI/y-1924?z", "1924|CHI"),
        ("statscrew", "team_season_roster", "https://x/football/stats/t-CHI/y-1924", None),
        ("profootballarchives", "player_game_participation", "https://x/nflboxscores2/1931aaaa012.html", "1931aaaa012"),
        ("nflcom", "team_season_roster", "https://x/sitemap/html/rosters/1963/harbor-foxes", "1963|harbor-foxes"),
        ("nflcom", "other", "https://x/sitemap/html/rosters/1963/d", None),
    ],
)
def test_work_items(spark, source, dataset, url, key):
    w = spark.range(1).select(A.work_item(source, F.lit(dataset), F.lit(url)).alias("w")).first()["w"]
    assert (w and w["key"]) == key


def test_harvest(spark):
    p = pages(spark, STATS, "a").unionByName(pages(spark, "<p>blocked", "b", 1964)).unionByName(pages(spark, None, "c", 1965))
    work = p.drop("html")
    h = V.run_harvest("statscrew", "team_season_stats", work, V.page_table_fetch(p), artifact_run_id="run")
    ledger = {r["url"]: (r["status"], r["record_count"], r["error"]) for r in h.ledger.collect()}
    assert ledger == {"a": ("ok", 4, None), "b": ("parse_error", 0, "no usable captioned stat rows"), "c": ("absent", 0, None)}
    r = h.records.first()
    assert r["artifact_run_id"] == "run" and len(r["content_sha256"]) == 64 and h.raw.count() == 2
    assert {x["source_url"] for x in h.dictionary.collect()} == {"a"}
    shards = [V.owned(work, i, 3).count() for i in range(3)]
    assert sum(shards) == 3 and V.owned(work, 1, 3, prepartitioned=True).count() == 3
    with pytest.raises(ValueError, match="unsupported"):
        A.get_adapter("nflcom").records("x", p, H.tables_of(p), work)


def test_gates(spark):
    row = spark.createDataFrame([(217, 217, 0)], "work int, requests int, records int")
    with pytest.raises(G.GateError, match="ZERO records"):
        G.check(row, G.harvest_reason(F.col("work"), F.col("records")))
    with pytest.raises(G.GateError, match="denied"):
        G.check(row, G.census_reason(F.lit(93), F.lit(93), F.lit(0)))
    with pytest.raises(G.GateError, match="0 pages"):
        G.check(row, G.pilot_reason(F.lit(0)))
    G.check(row, G.harvest_reason(F.lit(502), F.lit(17_132)))
