"""Registered queries: each applies operators of the engine to whole tables.

The driver's pages hold links but no tables, so table operators are shown by a round trip: pages are
built from relational rows, one per order, and read back by the engine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.functions import text as T
from tablewright.functions import urls as U
from tablewright.operators import adapters as A
from tablewright.operators import discovery as D
from tablewright.operators import frontier as C
from tablewright.operators import gates as G
from tablewright.operators import harvest as V
from tablewright.plans import jobs as J
from tablewright.sources import files as S
from tablewright.sources import html_tables as H
from tablewright.sources import robots as R

SITE = "https://www.statscrew.com/football/"
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# --- links and URLs ---------------------------------------------------------------------------------


def links(spark, d) -> DataFrame:
    return D.link_rows(read(spark, d, "pages"), order="page_id")


@query
def url_pattern_inventory(spark, d):
    found = links(spark, d)
    return found.groupBy("url_pattern").agg(F.count(F.lit(1)).alias("links"), F.count_distinct("src").alias("pages"))


@query
def page_pattern_counts(spark, d):
    return read(spark, d, "pages").groupBy(U.url_pattern(U.url_path(F.col("url"))).alias("url_pattern")).agg(F.count(F.lit(1)).alias("pages_seen"))


@query
def link_projection(spark, d):
    return links(spark, d).select("src", "link_pos", "href", "dst")


@query
def link_distinct_sorted(spark, d):
    p = read(spark, d, "pages")
    return p.select("page_id", F.array_join(F.array_sort(F.array_distinct(U.page_links(F.col("html")))), " ").alias("links"))


@query
def url_allowed_filter(spark, d):
    host = U.url_host(F.col("url"))
    p = read(spark, d, "pages")
    ok = U.url_allowed(F.col("url"), F.array(F.regexp_replace(host, r"^www\.", "")), ["/en", "/de/"])
    return p.filter(ok).select("page_id", "url")


@query
def shard_assignment(spark, d):
    u = F.col("url")
    return read(spark, d, "pages").select("page_id", T.shard_of(u, 60).alias("shard"), T.shard_of(u, 7, "sha1").alias("older_shard"))


@query
def one_hop_quota_sample(spark, d):
    p = read(spark, d, "pages")
    probes = p.select("url", F.col("page_id").alias("src_order"), (F.length("html") > 0).alias("ok"))
    return D.quota_sample(probes, links(spark, d).select("src", "src_order", "link_pos", "dst", "url_pattern"), 3)


@query
def work_items_from_urls(spark, d):
    o = read(spark, d, "orders")
    year = F.year("o_orderdate").cast("string")
    kind = F.col("o_orderkey") % 4
    url = F.concat(
        F.lit(SITE),
        F.when(kind == 0, F.concat(F.lit("roster/t-C"), F.col("o_custkey").cast("string"), F.lit("/y-"), year))
        .when(kind == 1, F.concat(F.lit("Stats/t-C"), F.col("o_custkey").cast("string"), F.lit("/y-"), year, F.lit("?x=1")))
        .when(kind == 2, F.concat(F.lit("stats/p-c"), F.col("o_custkey").cast("string")))
        .otherwise(F.concat(F.lit("l-"), year)),
    )
    each = o.select("o_orderkey", url.alias("url"), F.explode(F.array(*map(F.lit, ["team_season_roster", "team_season_stats", "player_season_stats"]))).alias("dataset"))
    w = A.work_item("statscrew", F.col("dataset"), F.col("url"))
    return each.withColumn("w", w).filter("w IS NOT NULL").select("o_orderkey", "dataset", "w.key", "w.season", "w.team", "w.source_player_id")


@query
def dataset_names(spark, d):
    return page_pattern_counts(spark, d).select("url_pattern", U.dataset_name(F.col("url_pattern")).alias("dataset"))


@query
def robots_filter(spark, d):
    p = read(spark, d, "pages").withColumn("host", U.url_host(F.col("url")))
    answers = p.select("host").distinct().select(
        "host",
        F.when(F.endswith("host", F.lit(".org")), 403).when(F.endswith("host", F.lit(".net")), 500).otherwise(200).alias("status_code"),
        F.lit("User-agent: *\nDisallow: /en\n").alias("body"),
    )
    j = p.join(R.robots_rules(answers), "host")
    return j.select("page_id", R.can_fetch(F.col("rules"), F.col("url")).alias("allowed"))


# --- hashing, verdicts, headers ---------------------------------------------------------------------


@query
def schema_fingerprints(spark, d):
    return read(spark, d, "pages").select("page_id", T.schema_fingerprint(U.page_links(F.col("html"))).alias("fingerprint"))


#: Columns that a user's events stand for.
EVENT_COLUMNS = {"view": "player", "click": "team", "purchase": "season", "signup": "story", "error": "yards"}


@query
def surface_verdicts(spark, d):
    names = F.create_map(*[F.lit(x) for kv in EVENT_COLUMNS.items() for x in kv])
    bucket = (F.col("event_id") % 997).alias("bucket")
    e = read(spark, d, "events").select(bucket, F.try_element_at(names, F.col("event_type")).alias("c"), "value")
    u = e.groupBy("bucket").agg(F.array_sort(F.collect_set(F.when(F.col("value") > 20, F.col("c")))).alias("cols"), F.count_if(F.col("value") > 20).alias("n_rows"))
    return u.select("bucket", F.array_join("cols", ",").alias("cols"), T.classify_surface(F.col("n_rows"), F.col("cols"), T.discovery_identifiers(F.col("cols"))).alias("usability"))


def event_ledger(spark, d) -> DataFrame:
    code = (F.element_at(F.array(*map(F.lit, [200, 204, 301, 401, 403, 404, 410, 429, 500, 503])), (F.col("event_id") % 10 + 1).cast("int"))).alias("status_code")
    return read(spark, d, "events").select("event_id", "event_type", code)


@query
def status_classes(spark, d):
    return event_ledger(spark, d).select("event_id", "status_code", T.status_class(F.col("status_code")).alias("status"))


@query
def ledger_status_counts(spark, d):
    return event_ledger(spark, d).groupBy("event_type", T.status_class(F.col("status_code")).alias("status")).agg(F.count(F.lit(1)).alias("requests"))


@query
def header_unique_keys(spark, d):
    p = read(spark, d, "part")
    labels = F.split(F.concat_ws(" ", "p_name", "p_type", F.lit("?"), "p_name", "p_brand", F.lit("--"), "p_type"), " ")
    rows = p.select("p_partkey", F.posexplode(labels).alias("pos", "label"))
    return T.unique_keys(rows, ["p_partkey"], "label", "pos").select("p_partkey", "pos", "label", "key", "blank", "duplicate")


@query
def older_header_keys(spark, d):
    p = read(spark, d, "part")
    labels = F.split(F.concat_ws(" ", "p_name", F.lit("?"), "p_type", F.lit("!"), "p_name"), " ")
    rows = p.select("p_partkey", F.posexplode(labels).alias("pos", "label"))
    return T.unique_keys(rows, ["p_partkey"], "label", "pos", "col", False).select("p_partkey", "pos", "key")


@query
def squeezed_text(spark, d):
    return read(spark, d, "documents").select("doc_id", F.sha2(T.squeeze(F.col("text")), 256).alias("squeezed"))


@query
def first_seen_content(spark, d):
    docs = read(spark, d, "documents")
    return docs.groupBy(T.content_sha256(F.col("text")).alias("content_sha256")).agg(F.min("doc_id").alias("doc_id"), F.min_by("source", "doc_id").alias("source"), F.count(F.lit(1)).alias("pages_observed"))


@query
def provenance_stamps(spark, d):
    p = read(spark, d, "pages")
    return p.select("page_id", T.content_sha256(F.col("html")).alias("content_sha256"), F.lit(V.PARSER_VERSION).alias("parser_version"), T.shard_of(F.col("url"), 8).alias("shard_id"))


@query
def json_lines(spark, d):
    n = read(spark, d, "nation").withColumn("n_comment", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")))
    return n.select(S.json_line(n).alias("line"))


@query
def manifest_problems(spark, d):
    n = read(spark, d, "supplier")
    name = F.col("s_name")
    path = F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("../"), name)).when(F.col("s_suppkey") % 5 == 1, F.concat(F.lit("/"), name)).otherwise(name)
    listed = n.select(path.alias("path"), F.sha2(name, 256).alias("sha256"))
    found = n.filter("s_suppkey % 7 <> 0").select(path.alias("path"), F.sha2(F.when(F.col("s_suppkey") % 3 == 0, F.concat(name, F.lit("!"))).otherwise(name), 256).alias("sha256"))
    return S.verify_files(listed, found)


# --- table round trips ------------------------------------------------------------------------------


def order_pages(spark, d, row: Column, head: str, before: str = "", tail: str = "", section: str = "stats") -> DataFrame:
    """One page per order that has line items: url, html, and its work item's columns. row is a line item's markup."""
    items = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", row.alias("row"))
    body = items.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "row"))), lambda x: x["row"]), "").alias("rows"))
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    # Spark guesses sizes from compressed files: sorting both sides never sends a table through the driver.
    p = body.hint("merge").join(o, body["l_orderkey"] == o["o_orderkey"])
    team = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    html = F.concat(F.lit("<html><body>" + before + "<table class=stat>" + head), "rows", F.lit("</table>" + tail + "</body></html>"))
    return p.select(
        F.concat(F.lit(f"{SITE}{section}/t-"), team, F.lit("/y-"), F.col("year").cast("string"), F.lit("?o="), F.col("o_orderkey").cast("string")).alias("url"),
        html.alias("html"), F.concat_ws("|", F.col("year").cast("string"), team, F.col("o_orderkey").cast("string")).alias("key"), F.col("year").alias("season"), team.alias("team"),
        F.lit(None).cast("string").alias("game_id"), F.lit(None).cast("string").alias("source_player_id"), F.col("o_orderkey"),
    )


def num(c: str) -> Column:
    return F.col(c).cast("long").cast("string")


def cells(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


ROSTER_HEAD = "<tr><th>Jersey #</th><th>Player</th><th>Pos.</th></tr>"
STAT_HEAD = "<tr><th>Player</th><th><a title='Quantity shipped'>Comp</a></th><th title=x>Comp</th><th>Team</th></tr>"
STAT_TAIL = "<h3>Receiving :</h3><table><tr><th>player</th><th>yds</th></tr><tr><td>Totals</td><td>7</td></tr></table>"


def roster_row() -> Column:
    return cells("<tr><td>", num("l_linenumber"), "</td><td><a href='/football/stats/p-x", num("l_partkey"), "'>Part ", num("l_partkey"), "</a></td><td> ", F.col("l_returnflag"), "&nbsp; </td></tr>")


def stat_row() -> Column:
    flag = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag"))
    return cells(
        "<tr class='", F.lower("l_linestatus"), "'><td><a href=/football/stats/p-x", num("l_partkey"), ">Part&nbsp;", num("l_partkey"), "</a></td><td>", num("l_quantity"),
        "</td><td>", num("l_extendedprice"), "</td><td>", flag, "</td></tr>",
    )


def order_of(c: str) -> Column:
    return F.regexp_extract(c, r"o=(\d+)$", 1).cast("long").alias("order_key")


@query
def roster_roundtrip(spark, d):
    p = order_pages(spark, d, roster_row(), ROSTER_HEAD, section="roster")
    r = A.roster_records("statscrew", "team_season_roster", H.tables_of(p), p)
    return r.select(order_of("source_url"), "season", "team", "player", "source_player_id", "position", "row_pos")


def stat_pages(spark, d) -> DataFrame:
    return order_pages(spark, d, stat_row(), STAT_HEAD, "<h2> Passing\n Stats: </h2>", STAT_TAIL)


@query
def stats_roundtrip_tagged(spark, d):
    p = stat_pages(spark, d)
    r = A.stat_records("statscrew", "team_season_stats", H.tables_of(p), p)
    r = A.wide(r, ["comp", "comp_2", "stat_team", "yds"])
    return r.select(order_of("source_url"), "table_tag", "row_pos", "season", "team", "player", "source_player_id", "row_class", "is_total_row", "comp", "comp_2", "stat_team", "yds")


@query
def results_roundtrip(spark, d):
    """A customer's orders as a calendar, a page per customer and year."""
    o = read(spark, d, "orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus")
    row = cells(
        "<tr class=", F.when(F.col("o_orderstatus") == "F", "post_season").otherwise("reg_season"), "><td>May 1</td><td>", num("o_orderkey"), "</td><td></td><td><a href='/football/roster/t-W", num("o_orderkey"),
        "/y-1963'>W</a> at <a href='/football/roster/t-C", num("o_custkey"), "/y-1963'>C</a></td></tr>",
    )
    p = o.select("o_custkey", "year", F.struct("o_orderkey", row.alias("row")).alias("x")).groupBy("o_custkey", "year").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["row"]), "").alias("rows"))
    p = p.select(
        F.concat(F.lit(f"{SITE}results/t-C"), num("o_custkey"), F.lit("/y-"), F.col("year").cast("string")).alias("url"),
        F.concat(F.lit("<table><tr><th>Date</th><th>Player</th><th></th><th>Game</th></tr>"), "rows", F.lit("</table>")).alias("html"),
        F.col("year").alias("season"), F.concat(F.lit("C"), num("o_custkey")).alias("team"), F.lit(None).cast("string").alias("game_id"), F.lit(None).cast("string").alias("source_player_id"),
    )
    r = A.wide(A.results_records("statscrew", "team_season_results", H.tables_of(p), p), ["date", "stat_player", "col_2", "game"])
    return r.select("team", "season", "row_pos", "row_class", "game_team_ids", "date", "stat_player", "col_2", "game")


@query
def orphan_rows_roundtrip(spark, d):
    """Cells without rows: whole rows come back, the cell that is left over is counted."""
    row = cells("<td>", num("l_linenumber"), "<td>lost</td><td>", num("l_partkey"), "</td>")
    p = order_pages(spark, d, row, "<tr><th>No</th><th>Part</th></tr>", tail="")
    p = p.withColumn("html", F.replace("html", F.lit("</table>"), F.lit("<td>extra</td></table>")))
    t = H.tables_of(p)
    rows = H.rows_of(t).select(order_of("url"), "orphan_rows", "dropped_partial_cells", "row_pos", H.cell_text("no").alias("no"), H.cell_text("part").alias("part"))
    return rows


@query
def group_header_roundtrip(spark, d):
    head = "<tr><th></th><th colspan=2>Price</th></tr><tr><th>Part</th><th>Base</th><th>Tax</th></tr>"
    row = cells("<tr><td>", num("l_partkey"), "</td><td>", num("l_extendedprice"), "</td><td>", num("l_linenumber"), "</td></tr>")
    rows = H.rows_of(H.tables_of(order_pages(spark, d, row, head)))
    group = F.try_element_at("groups", F.lit("tax"))
    return rows.select(order_of("url"), "row_pos", "header_rows", F.array_join("headers", ",").alias("headers"), group.alias("tax_group"), H.cell_text("part").alias("part"), H.cell_text("base").alias("base"), H.cell_text("tax").alias("tax"))


@query
def lineup_roundtrip(spark, d):
    row = cells(
        F.when(F.col("l_linenumber") % 3 == 1, cells("<tr><th colspan=3>Team &amp; ", F.col("l_linestatus"), num("l_linenumber"), "</th></tr>")).otherwise(""),
        "<tr><td>1</td><td> <b>", F.col("l_returnflag"), "</b> </td><td><a href='/players/x/p", num("l_partkey"), ".html'>Part <i>", num("l_partkey"), "</i></a></td></tr>",
    )
    p = order_pages(spark, d, row, "<tr><th colspan='3'> LINEUPS </th></tr>")
    r = A.lineup_records("profootballarchives", "player_game_participation", p, p)
    return r.select(order_of("source_url"), "season", "team", "player", "source_player_id", "position")


@query
def older_table_roundtrip(spark, d):
    row = cells(
        "<tr><td>", num("l_quantity"), "</td><td><svg><path></svg> ", F.col("l_returnflag"), " &amp; </td><td><a href='/players/part-", num("l_partkey"), "/stats/'>x</a></td><td>cut</td></tr><tr><td> </td></tr>"
    )
    p = order_pages(spark, d, row, "<thead><tr><th>Fum</th><th>Lost</th><th></th><th>Fum</th></tr></thead><tbody>", "<h5>Game <b>Logs</b></h5>", "")
    asked = p.select(F.col("o_orderkey").cast("string").alias("slug"), F.lit("logs").alias("view"), "season", "url")
    r = D.older_view_rows(p.select("url", "html"), asked)
    at = lambda k: F.try_element_at("cells", F.lit(k)).alias(k.lstrip("_"))
    return r.select(F.col("slug").cast("long").alias("order_key"), "season", F.col("table"), "row_pos", *map(at, ["fum", "lost", "fum_2", "fumbles", "fumbles_lost", "_player_slug"]))


@query
def column_dictionary(spark, d):
    e = A.column_dictionary("statscrew", "team_season_stats", H.tables_of(stat_pages(spark, d)))
    o = A.observed_dictionary(e)
    return o.select("table_tag", "table_caption", "column_key", "column_position", "source_label", "source_title", "header_rows", "blank_headers", "duplicate_headers", "pages_observed")


@query
def described_tables(spark, d):
    t = D.described_tables(H.tables_of(stat_pages(spark, d)))
    return t.select(order_of("url"), "position", F.array_join("headers", ",").alias("headers"), "n_headers", "n_rows", "schema_fingerprint", "surface")


@query
def pattern_tables(spark, d):
    p = stat_pages(spark, d)
    pages = p.select("url", U.url_pattern(U.url_path(F.col("url"))).alias("url_pattern"), F.col("o_orderkey").alias("pos"))
    inv = D.pattern_inventory(pages, D.described_tables(H.tables_of(p)))
    shape = F.col("table_shapes")[0]
    return inv.select("url_pattern", "pages_seen", F.array_join("example_urls", " ").alias("examples"), "n_distinct_table_shapes", shape["seen_on"].alias("first_seen_on"), shape["max_rows"].alias("first_max_rows"), F.array_join(shape["headers"], ",").alias("first_headers"))


@query
def pilot_stability(spark, d):
    p = stat_pages(spark, d)
    # Two pages of three name the second table's column otherwise.
    p = p.withColumn("html", F.when(F.col("o_orderkey") % 3 == 0, F.col("html")).otherwise(F.replace("html", F.lit("<th>yds</th>"), F.lit("<th>rec</th>"))))
    shapes = D.pilot_shapes(H.tables_of(p), p.select("url", F.col("o_orderkey").alias("pos"), F.lit(True).alias("ok")))
    return shapes.select(F.array_join("headers", ",").alias("headers"), "pages_carrying", "total_rows", "page_share", "stability", "rows_with_source_native_id_href", F.array_join("id_columns", ",").alias("id_columns"), F.array_join(F.transform("table_positions", lambda x: x.cast("string")), ",").alias("positions"))


@query
def harvest_ledger(spark, d):
    """Harvest of every order's page: a third is not landed, a third of the others has no player."""
    p = stat_pages(spark, d)
    landed = p.filter("o_orderkey % 3 <> 0").withColumn("html", F.when(F.col("o_orderkey") % 3 == 1, F.col("html")).otherwise(F.regexp_replace("html", "(?s)<h[23]>.*?</h[23]>", "")))
    work = p.select("key", "season", "team", "game_id", "source_player_id", "url")
    h = V.run_harvest("statscrew", "team_season_stats", work, V.page_table_fetch(landed))
    return h.ledger.select("key", "status_code", "status", "error", "record_count")


# --- joins, plans, aggregates -----------------------------------------------------------------------


@query
def landed_page_join(spark, d):
    p = read(spark, d, "pages")
    wanted = p.select(F.explode(F.array(F.col("url"), F.concat("url", F.lit("/missing")))).alias("url"))
    return V.page_table_fetch(p)(wanted).select("url", "status_code", "status")


CLAIMS = [("/", "all"), ("/en/", "english"), ("/en", "english_wide"), ("/de/{n}", "german_numbers"), ("/de/{n}/", "german_folders"), ("/fr/", "french"), ("/fr/", "french_again")]


def claims(spark) -> DataFrame:
    return values(spark, "prefix string, dataset string, position int", [(p, n, i) for i, (p, n) in enumerate(CLAIMS)])


@query
def longest_prefix_claim(spark, d):
    return D.longest_claims(page_pattern_counts(spark, d), claims(spark))


@query
def three_state_report(spark, d):
    """Shapes are stand-ins: as many as the pages seen modulo 3."""
    n = (F.col("pages_seen") % 3).cast("int")
    shape = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.struct((i * 10).alias("max_rows"), F.concat(F.lit("s"), i.cast("string")).alias("surface"))))
    p = page_pattern_counts(spark, d).select("url_pattern", "pages_seen", n.alias("n_distinct_table_shapes"), shape.alias("table_shapes"), F.array(F.col("url_pattern")).alias("example_urls"))
    held = read(spark, d, "pages").filter("page_id % 5 = 0").groupBy(U.url_pattern(U.url_path(F.col("url"))).alias("url_pattern")).agg(F.count(F.lit(1)).alias("pages_held"))
    held = held.filter("pages_held % 2 = 0")
    r = D.three_state_report(p, claims(spark), held)
    return r.select("url_pattern", "state", "pages_already_held", "pages_seen", "table_shapes", "max_rows", F.array_join("surfaces", ",").alias("surfaces"), "claimed_by_dataset", "worth_fetching")


@query
def views_left_to_do(spark, d):
    c = read(spark, d, "customer")
    universe = c.select(F.col("c_custkey").cast("string").alias("slug"), F.sequence(F.col("c_nationkey") + 1990, F.col("c_nationkey") + 1992).alias("years"))
    o = read(spark, d, "orders")
    done = J.done_views(o.select(F.lit("career").alias("view"), F.col("o_custkey").cast("string").alias("slug"), F.when(F.col("o_orderstatus") == "P", "error").otherwise("ok").alias("status")))
    return J.player_view_pages(universe, done, ["career", "logs"], 1, 3)


def targets(spark, d) -> DataFrame:
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("source"), F.col("n_name").alias("dataset"), (F.col("n_nationkey") % 5 + 1).alias("shards"))


@query
def job_matrix(spark, d):
    return J.plan(targets(spark, d), source="ASIA").unionByName(J.plan(targets(spark, d), shards="3", shard="2"))


@query
def parallel_cap(spark, d):
    sources = read(spark, d, "region").select(F.col("r_name").alias("source"), (F.col("r_regionkey") * 0.25 + 0.75).alias("delay_seconds"))
    return J.max_parallel(J.plan(targets(spark, d)), sources)


@query
def seed_expansion(spark, d):
    r, n, o = read(spark, d, "region"), read(spark, d, "nation"), read(spark, d, "orders")
    ranges = r.select((F.col("r_regionkey") + 1918).alias("first_year"), (F.col("r_regionkey") * 2 + 1920).alias("last_year"), F.concat(F.lit("https://x/"), "r_name", F.lit("/{year}/")).alias("template"))
    inventory = o.select(F.year("o_orderdate").cast("string").alias("year"), F.year("o_orderdate").alias("year_number"), F.concat(F.lit("C"), num("o_custkey")).alias("team"))
    static = n.select(F.concat(F.lit("https://x/"), "n_name").alias("url"))
    return J.all_seeds(static, J.range_seeds(ranges, 1920, 1925), J.inventory_seeds(inventory, "https://x/t-{team}/y-{year}", 1995, 1997))


@query
def holdings_sum(spark, d):
    e = read(spark, d, "events")
    one = e.groupBy("event_type", (F.col("user_id") % 50).alias("u"), (F.col("event_id") % 4).alias("part")).agg(F.count_if(F.col("value") > 30).alias("n"))
    n = F.when(F.col("n") > 0, F.col("n"))
    by = one.groupBy("event_type", "part").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("/u/"), F.col("u").cast("string")), n))).alias("url_patterns"))
    doc = by.groupBy(F.col("event_type").alias("source")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("part").cast("string"), F.struct("url_patterns")))).alias("datasets"))
    return S.read_holdings(doc)


@query
def discovery_counts(spark, d):
    ledger = event_ledger(spark, d).select(F.when(F.col("status_code") == 401, "robots_denied").otherwise(T.status_class(F.col("status_code"))).alias("status"))
    p = page_pattern_counts(spark, d).select((F.col("pages_seen") % 3).cast("int").alias("n_distinct_table_shapes"))
    return D.discovery_counters(ledger, p)


@query
def gate_reasons(spark, d):
    e = read(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("requests"), F.count_if(F.col("event_type") == "error").alias("denied"), F.count_if(F.col("event_type") == "purchase").alias("work"), F.count_if(F.col("event_type") == "view").alias("records"))
    return e.select("user_id", G.census_reason(F.col("requests"), F.col("denied"), F.col("work")).alias("census"), G.harvest_reason(F.col("work"), F.col("records")).alias("harvest"), G.pilot_reason(F.col("records")).alias("pilot"))


@query
def crawl_depths(spark, d):
    """Customers lead to their orders, orders to parts, parts to suppliers and back to customers."""
    o, i = read(spark, d, "orders"), read(spark, d, "lineitem")

    def node(kind, c):
        return F.concat(F.lit(kind), F.col(c).cast("string"))

    edges = [
        o.select(node("c", "o_custkey").alias("src"), node("o", "o_orderkey").alias("dst")),
        i.select(node("o", "l_orderkey"), node("p", "l_partkey")),
        i.select(node("p", "l_partkey"), node("s", "l_suppkey")),
        i.select(node("s", "l_suppkey"), node("c", "l_suppkey")),
    ]
    seeds = read(spark, d, "customer").select(node("c", "c_custkey").alias("url"))
    return C.bounded_bfs(seeds, reduce(DataFrame.union, edges).distinct())


def census_pages(spark, d) -> DataFrame:
    """A site: the start page links nations, a nation's page its suppliers' roster pages."""
    n, s = read(spark, d, "nation"), read(spark, d, "supplier")
    nation = F.concat(F.lit("/football/l-n"), num("n_nationkey"))
    team = F.concat(F.lit("/football/roster/t-S"), num("s_suppkey"), F.lit("/y-1963"))
    anchor = lambda c: F.concat(F.lit("<a href='"), c, F.lit("'>x</a> <a href='mailto:x'>m</a> "))
    join = lambda c: F.array_join(F.array_sort(F.collect_list(c)), "")
    root = "https://www.statscrew.com"
    start = n.agg(join(anchor(nation)).alias("html")).select(F.lit(f"{root}/football/").alias("url"), "html")
    middle = n.join(s, F.col("n_nationkey") == F.col("s_nationkey")).groupBy(F.concat(F.lit(root), nation).alias("url")).agg(join(anchor(team)).alias("html"))
    leaf = s.select(F.concat(F.lit(root), team).alias("url"), F.concat(F.lit("<a href='/football/roster/t-X/y-1999'>x</a><table><tr><th>#</th><th>Player</th></tr><tr><td>1</td><td><a href='/football/stats/p-s"), num("s_suppkey"), F.lit("'>"), "s_name", F.lit("</a></td></tr></table>")).alias("html"))
    return start.unionByName(middle).unionByName(leaf)


@query
def census_surfaces(spark, d):
    """The census of that site for three shards: every leaf once, with its owner and its tables' verdict."""
    seeds = spark.sql("SELECT 'https://www.statscrew.com/football/' AS url")
    c = C.run_census("statscrew", "team_season_roster", seeds, V.page_table_fetch(census_pages(spark, d)), ["www.statscrew.com"], ["/football/"], shards=3)
    j = c.work.select("url", "key", "season", "team", "owner").join(c.surfaces, "url", "left")
    return j.select("url", "key", "season", "team", "owner", "row_count", "columns_json", "fingerprint", "usability")


@query
def census_request_counts(spark, d):
    seeds = spark.sql("SELECT 'https://www.statscrew.com/football/' AS url")
    c = C.run_census("statscrew", "team_season_roster", seeds, V.page_table_fetch(census_pages(spark, d)), ["www.statscrew.com"], ["/football/"], shards=3)
    return c.ledger.groupBy("status", "depth").agg(F.count(F.lit(1)).alias("requests"))


@query
def census_links(spark, d):
    """Links of pages with unquoted values, references, capitals, fragments, repeats, comments, scripts and a sitemap."""
    k = num("s_suppkey")
    html = F.concat(
        F.lit("<!-- <a href='/no"), k, F.lit("'>x</a> --><a class=b href=/u"), k, F.lit(">u</a><A HREF='/q?a="), k, F.lit("&amp;b=2'>q</A><a href=#f>f</a><a name=x>n</a><a href=''>e</a>"),
        F.lit("<a href=/u"), k, F.lit(">again</a><script>x = \"<a href='/js"), k, F.lit("'>\"</script><a\nhref=\"next/"), k, F.lit("\">n</a>"),
    )
    page = read(spark, d, "supplier").select(F.concat(F.lit("https://h.example/a/s"), k).alias("url"), html.alias("html"))
    locs = F.concat(F.lit("\n <?xml version='1.0'?><urlset><loc> https://h.example/m"), num("n_nationkey"), F.lit(" </loc></urlset>"))
    maps = read(spark, d, "nation").select(F.concat(F.lit("https://h.example/map"), num("n_nationkey")).alias("url"), locs.alias("html"))
    return C.page_edges(page.unionByName(maps))


@query
def census_depths(spark, d):
    """A site six links deep: the start page leads to the page of the first region, each region's to the next one's and to the
    roster pages of its nations; the last one's next page is missing."""
    r, n = read(spark, d, "region"), read(spark, d, "nation")
    root = "https://www.statscrew.com"
    anchor = lambda c: F.concat(F.lit("<a href="), c, F.lit(">x</a>"))
    team = F.concat(F.lit("/football/roster/t-N"), num("n_nationkey"), F.lit("/y-1963"))
    own = n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(anchor(team))), "").alias("nations"))
    middle = r.join(own, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    after = F.concat(F.lit("/football/d"), (F.col("r_regionkey") + 1).cast("string"))
    middle = middle.select(F.concat(F.lit(f"{root}/football/d"), num("r_regionkey")).alias("url"), F.concat(anchor(after), F.coalesce("nations", F.lit(""))).alias("html"))
    start = r.agg(F.min("r_regionkey").alias("k")).select(F.lit(f"{root}/football/").alias("url"), anchor(F.concat(F.lit("/football/d"), num("k"))).alias("html"))
    leaf = n.select(F.concat(F.lit(root), team).alias("url"), F.lit("<a href=/football/d99>x</a>").alias("html"))
    c = C.run_census("statscrew", "team_season_roster", start.select("url"), V.page_table_fetch(start.unionByName(middle).unionByName(leaf)), ["www.statscrew.com"], ["/football/"])
    return c.ledger.select("url", "status", "status_code", "depth")


@query
def sampled_family(spark, d):
    p = read(spark, d, "pages").select("url", F.col("page_id").alias("pos"), U.url_pattern(U.url_path(F.col("url"))).alias("url_pattern"))
    return S.sample_urls(p, "/en/{n}", 12)


@query
def running_labels(spark, d):
    """The label that runs above each line item: the last return flag R or A of its order so far."""
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber").rowsBetween(W.unboundedPreceding, W.currentRow)
    first = read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("flag"))
    return first.select("l_orderkey", "l_linenumber", F.last(F.when(F.col("flag") != "N", F.col("flag")), ignorenulls=True).over(w).alias("running"))
