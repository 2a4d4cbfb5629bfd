"""python -m tablewright plan|discover|report|pilot|census|harvest: the stages, over a table of landed pages or over HTTP.

Without --pages they fetch, at the pace of the catalog and as robots.txt allows. Pages are Parquet with url and html; results are Parquet under --out. spark.checkpoint.dir is the shared folder of a cluster."""

from __future__ import annotations

import argparse
import urllib.request
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import urls as U
from tablewright.operators import discovery as D
from tablewright.operators import frontier as C
from tablewright.operators import gates as G
from tablewright.operators import harvest as V
from tablewright.plans import catalog as K
from tablewright.plans import jobs as J
from tablewright.sources import fetch as N
from tablewright.sources import files as S


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tablewright", description=__doc__)
    p.add_argument("stage", choices=["plan", "discover", "report", "pilot", "census", "harvest"])
    p.add_argument("--catalog", required=True)
    p.add_argument("--source", default="")
    p.add_argument("--dataset", default="")
    p.add_argument("--pages")
    p.add_argument("--work", help="work items of a census, for harvest; a discovery's folder, for report")
    p.add_argument("--holdings")
    p.add_argument("--family")
    p.add_argument("--sample", type=int, default=25)
    p.add_argument("--out")
    p.add_argument("--shard", default="")
    p.add_argument("--shards", default="")
    p.add_argument("--first-year", type=int)
    p.add_argument("--last-year", type=int)
    p.add_argument("--max-depth", type=int, help="links from a seed that a census follows; all without it")
    p.add_argument("--max-pages", type=int, help="pages that a census asks for; all without it")
    p.add_argument("--run-id", default="")
    p.add_argument("--agent", default=N.Policy.agent, help="the name that requests and robots rules go by")
    p.add_argument("--budget-minutes", type=float, default=90, help="after which no more pages are fetched")
    p.add_argument("--ignore-robots", action="store_true")
    p.add_argument("--inventory", help="CSV of year and team, for datasets whose seeds come from one; else the catalog's file, beside the catalog")
    return p.parse_args(given)


def inventory_of(spark: SparkSession, spec: dict, path: str, first: int, last: int) -> DataFrame:
    """Seeds of a dataset's inventory: url."""
    if not spec.get("seed_inventory"):
        return spark.createDataFrame([], "url string")
    return J.inventory_seeds(S.read_inventory(spark, path), spec["census_seed_template"], first, last)


def main(given: list[str] | None = None, urlopen: Callable = urllib.request.urlopen) -> None:
    a = arguments(given)
    spark = SparkSession.builder.appName("tablewright").getOrCreate()
    catalog = K.load_catalog(Path(a.catalog).read_text())
    sources, _, prefixes, ranges = catalog.frames(spark)
    if a.stage == "plan":
        jobs = J.plan(spark.createDataFrame(J.TARGETS, "source string, dataset string, shards int"), a.source, a.dataset, a.shard, a.shards)
        print(J.ci_output(jobs, sources), end="")
        return
    spec = catalog.source(a.source)
    if a.stage == "report":
        claims = prefixes.filter(F.col("source") == a.source).select("prefix", "dataset", "position")
        held = S.read_holdings(S.read_json_document(spark, a.holdings, "source string, datasets map<string, struct<url_patterns: map<string, long>>>")) if a.holdings else spark.createDataFrame([], "source string, url_pattern string, pages_held long")
        D.three_state_report(spark.read.parquet(f"{a.work}/patterns"), claims, held.filter(F.col("source") == a.source)).write.parquet(f"{a.out}/report")
        return
    if a.pages:
        pages = spark.read.parquet(a.pages)
        fetch = V.page_table_fetch(pages)
    else:
        pages = None
        fetch = N.http_fetch(N.Policy(a.agent, float(spec.get("delay_seconds", 1.0)), budget_seconds=60 * a.budget_minutes), urlopen)
    robots = not a.pages and not a.ignore_robots
    if a.stage == "discover":
        probes = spark.createDataFrame([(u, i) for i, u in enumerate(spec["discovery_probes"])], "url string, pos long")
        d = D.run_discovery(probes, fetch, spec["domains"], spec["discovery_prefixes"])
        for name in ("ledger", "described", "patterns"):
            getattr(d, name).write.parquet(f"{a.out}/{name}")
    elif a.stage == "pilot":
        if pages is None:
            raise SystemExit("a pilot samples the table of --pages")
        placed = pages.select("url", U.url_pattern(U.url_path(F.col("url"))).alias("url_pattern"), F.monotonically_increasing_id().alias("pos"))
        pilot = D.run_pilot(a.source, a.family, S.sample_urls(placed, a.family, a.sample), fetch)
        for name in ("shapes", "proposal", "counters", "samples"):
            getattr(pilot, name).write.parquet(f"{a.out}/{name}")
    elif a.stage == "census":
        x = catalog.check_request(a.source, a.dataset, a.first_year or catalog.dataset(a.source, a.dataset)["first_year"], a.last_year or catalog.dataset(a.source, a.dataset)["last_year"])
        first, last = a.first_year or x["first_year"], a.last_year or x["last_year"]
        own = ranges.filter((F.col("source") == a.source) & (F.col("dataset") == a.dataset))
        static = spark.createDataFrame([(u,) for u in x.get("census_seeds") or []], "url string")
        c = C.run_census(a.source, a.dataset, J.all_seeds(static, J.range_seeds(own, a.first_year, a.last_year), inventory_of(spark, x, a.inventory or str(Path(a.catalog).parent / str(x.get("seed_inventory"))), first, last)), fetch, spec["domains"], x["allowed_prefixes"], shards=int(a.shards or 1), max_depth=a.max_depth, max_pages=a.max_pages, obey_robots=robots, agent=a.agent)
        for name in ("ledger", "work", "surfaces"):
            getattr(c, name).write.parquet(f"{a.out}/{name}")
        S.write_jsonl(c.ledger, f"{a.out}/ledger_lines", ["url"])
        S.write_jsonl(c.work, f"{a.out}/work_lines", ["key"])
        S.write_raw(c.pages, f"{a.out}/raw")
        S.write_manifest(spark, a.out, source=a.source, dataset=a.dataset, shard_id=0, shard_count=int(a.shards or 1), artifact_run_id=a.run_id)
        r = C.census_report(c)
        denied = F.coalesce(F.try_element_at("request_status", F.lit("robots_denied")), F.lit(0))
        G.check(r, G.census_reason(F.col("requests"), denied, F.col("work_items")))
    else:
        h = V.run_harvest(a.source, a.dataset, spark.read.parquet(a.work), fetch, int(a.shard or 0), int(a.shards or 1), artifact_run_id=a.run_id)
        S.write_records(h.records, f"{a.out}/records")
        h.ledger.write.parquet(f"{a.out}/ledger")
        S.write_raw(h.raw, f"{a.out}/raw")
        if h.dictionary is not None:
            S.write_jsonl(h.dictionary, f"{a.out}/column_dictionary", ["table_tag", "column_position"])
        S.write_manifest(spark, a.out, source=a.source, dataset=a.dataset, shard_id=int(a.shard or 0), shard_count=int(a.shards or 1), artifact_run_id=a.run_id)
        G.check(h.counts(), G.harvest_reason(F.col("work_item_count"), F.coalesce("record_count", F.lit(0))))


if __name__ == "__main__":
    main()
