"""Crawl frontier and census over a link graph of landed or fetched pages."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import text as T
from tablewright.functions import urls as U
from tablewright.operators.adapters import WORK, get_adapter, work_item
from tablewright.operators.harvest import with_text
from tablewright.sources import html_tables as H
from tablewright.sources import links as L
from tablewright.sources.files import table_keep
from tablewright.sources.robots import can_fetch, fetch_robots


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst: sitemap locations as they are, anchors resolved; distinct. Anchors are read by the parser, as a browser
    does: unquoted values, decoded references, nothing in comments or scripts. Both in one Arrow pass."""
    p = pages.select(F.col(url).alias("src"), F.coalesce(F.col(html), F.lit("")).alias("body"))
    p = p.select("src", "body", U.is_sitemap(F.col("body")).alias("is_map"))
    maps = p.filter("is_map").select("src", F.explode(U.sitemap_links(F.col("body"))).alias("dst"))
    anchors = L.anchors_of(p.filter(~F.col("is_map")), "src", "body")
    return maps.unionByName(anchors.select("src", "dst").filter(F.col("dst") != "")).distinct()


def bounded_bfs(seeds: DataFrame, edges: DataFrame, max_depth: int | None = None, allowed: Callable[[Column], Column] | None = None, keep: Callable[[DataFrame], DataFrame] = table_keep) -> DataFrame:
    """seeds: url; edges: src, dst -> url, depth of the first visit. Seeds pass the allow-list, links must meet it.
    One join per round; what was seen is anti-joined, so cycles end. Without max_depth it runs until nothing new is met."""
    seen = keep(seeds.select("url").distinct().withColumn("depth", F.lit(0)))
    front = seen
    for depth in itertools.count(1):
        if max_depth is not None and depth > max_depth:
            break
        step = front.join(edges, front["url"] == edges["src"]).select(F.col("dst").alias("url")).distinct()
        if allowed is not None:
            step = step.filter(allowed(F.col("url")))
        front = keep(step.join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)))
        if not front.limit(1).count():
            break
        seen = keep(seen.unionByName(front))
    return seen


def crawl_landed(seed: str, pages: DataFrame, domains: list[str], prefixes: list[str], max_depth: int | None = None) -> DataFrame:
    """A crawl in a table of pages: url, status ok or missing_fixture, in the order of url."""
    spark = pages.sparkSession
    start = spark.sql("SELECT :s AS url", args={"s": seed})
    seen = bounded_bfs(start, page_edges(pages), max_depth, lambda u: U.url_allowed(u, domains, prefixes))
    landed = pages.select("url", F.lit("ok").alias("status"))
    return seen.join(landed, "url", "left").select("url", F.coalesce("status", F.lit("missing_fixture")).alias("status")).orderBy("url")


@dataclass
class Census:
    ledger: DataFrame
    work: DataFrame
    surfaces: DataFrame
    pages: DataFrame


def surfaces(tables: DataFrame, work: DataFrame, page_verdicts: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """One row per table with data rows: its columns, fingerprint and verdict. Season, team and game of the page's work
    item count as columns; a verdict of the page's adapter (url, verdict) stands for all its tables."""
    t = H.tables_with_rows(tables).join(work.select("url", "season", "team", "game_id"), "url", "left")
    own = F.array_distinct(F.flatten(F.transform("rows", lambda r: F.map_keys(r["cells"]))))
    context = [F.when(F.col(c).isNotNull(), F.array(F.lit(c))).otherwise(F.array().cast("array<string>")) for c in ("season", "team", "game_id")]
    t = t.withColumn("columns", F.array_sort(F.array_distinct(F.concat(own, *context))))
    verdict = T.classify_surface(F.size("rows"), T.census_columns(F.col("columns"), strict), T.census_identifiers(F.col("columns")))
    if page_verdicts is not None:
        t = t.join(page_verdicts.select("url", "verdict"), "url", "left")
        verdict = F.coalesce("verdict", verdict)
    return t.select(
        "url", "position", "caption", F.size("rows").alias("row_count"), "columns", F.to_json("columns").alias("columns_json"),
        T.schema_fingerprint(F.col("columns")).alias("fingerprint"), verdict.alias("usability"),
    )


def run_census(
    source: str,
    dataset: str,
    seeds: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    domains: list[str],
    prefixes: list[str],
    robots: DataFrame | None = None,
    shards: int = 1,
    max_depth: int | None = None,
    max_pages: int | None = None,
    keep: Callable[[DataFrame], DataFrame] = table_keep,
    obey_robots: bool = False,
    agent: str = "*",
) -> Census:
    """One frontier for all shards. owner is a column: one seed is shared and each of its links has the shard of
    its own hash; several seeds have the shard of theirs, and what they lead to inherits it. A URL is fetched once,
    whatever branches reach it. Seeds pass the allow-list but not robots. Pages that are work items are leaves.
    Only a caller's max_depth or max_pages ends it before the frontier is empty. robots: host, rules; without it,
    obey_robots asks the hosts of seeds and domains themselves. agent is the name that the rules are read for."""
    adapter = get_adapter(source)
    start = seeds.select("url").distinct()
    if robots is None and obey_robots:
        hosts = start.unionByName(start.sparkSession.createDataFrame([(f"https://{d}/",) for d in domains], "url string"))
        robots = keep(fetch_robots(hosts, fetch))
    single = start.limit(2).count() == 1
    owner = F.lit(None).cast("int") if single else T.shard_of(F.col("url"), shards)
    front = keep(start.withColumn("owner", owner))
    seen, ledgers, pages = front, [], []
    room = max_pages
    for depth in itertools.count():
        asked = front if room is None else front.orderBy("url").limit(room)
        if robots is not None:
            asked = asked.withColumn("host", U.url_host(F.col("url"))).join(robots, "host", "left")
            asked = asked.withColumn("may", can_fetch(F.coalesce("rules", F.lit("")), F.col("url"), agent)).drop("host", "rules")
        else:
            asked = asked.withColumn("may", F.lit(True))
        asked = keep(asked)
        got = keep(with_text(fetch(asked.filter("may").drop("may"))).withColumn("depth", F.lit(depth)))
        denied = asked.filter(~F.col("may")).select("url", "owner", F.lit("robots_denied").alias("status"), F.lit(None).cast("int").alias("status_code"), F.lit(None).cast("string").alias("error"), F.lit(depth).alias("depth"))
        ledgers.append(denied.unionByName(got.select("url", "owner", "status", "status_code", "error", "depth")))
        ok = got.filter(F.col("status") == "ok")
        pages.append(ok.select("url", "owner", "html", "depth", "content_sha256", F.col("body").cast("binary").alias("body")))
        if room is not None:
            room -= asked.count()
        if room is not None and room <= 0 or depth == max_depth:
            break
        inner = ok.filter(work_item(source, F.lit(dataset), F.col("url")).isNull())
        links = page_edges(inner, "url", "html").join(inner.select(F.col("url").alias("src"), "owner"), "src")
        links = links.filter(U.url_allowed(F.col("dst"), domains, prefixes))
        heir = F.coalesce("owner", T.shard_of(F.col("dst"), shards)) if single else F.col("owner")
        step = links.select(F.col("dst").alias("url"), heir.alias("owner")).groupBy("url").agg(F.min("owner").alias("owner"))
        front = keep(step.join(seen.select("url"), "url", "left_anti"))
        if not front.limit(1).count():
            break
        seen = keep(seen.unionByName(front))
    ledger, landed = _union(ledgers), keep(_union(pages))
    item = work_item(source, F.lit(dataset), F.col("url"))
    work = keep(landed.select(item.alias("w"), "owner").filter(F.col("w").isNotNull()).select("w.*", "owner"))
    tables = keep(H.tables_of(landed))
    spark = landed.sparkSession
    w = work.select(*[c.split()[0] for c in WORK.split(", ")])
    try:
        found = adapter.records(dataset, landed.select("url", "html"), tables, w)
    except ValueError:  # a dataset without a parser keeps its tables' own verdicts
        found = spark.createDataFrame([], "source_url string, player string, team string, season int, cells map<string,string>")
    known = F.array(*map(F.lit, T.CANONICAL))
    names = F.array(*[F.lit(c) for c in ("source", "dataset", "season", "team", "game_id", "player", "source_player_id", "source_url")])
    verdict = T.classify_surface(F.lit(1), names, known)
    verdicts = found.select(F.col("source_url").alias("url")).distinct().withColumn("verdict", verdict)
    return Census(ledger, work, surfaces(tables, w, verdicts), landed)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def census_report(census: Census) -> DataFrame:
    """One row: requests, request_status, work_items, surfaces by usability, distinct fingerprints in order."""
    status = census.ledger.groupBy("status").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "count")))).alias("request_status"), F.coalesce(F.sum("count"), F.lit(0)).alias("requests"))
    use = census.surfaces.groupBy("usability").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("usability", "count")))).alias("usability"))
    prints = census.surfaces.agg(F.array_sort(F.collect_set("fingerprint")).alias("fingerprints"))
    work = census.work.agg(F.count(F.lit(1)).alias("work_items"))
    # Four single rows side by side.
    one = [d.withColumn("k", F.lit(1)) for d in (status, use, prints, work)]
    return one[0].join(one[1], "k").join(one[2], "k").join(one[3], "k").drop("k")
