"""Seeds of a census, job matrices and the older crawl's page list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import shard_of
from tablewright.functions.urls import seed_url

# Default targets and the pace that one host bears.
TARGETS = (
    ("statscrew", "team_season_roster", 5),
    ("statscrew", "team_season_stats", 5),
    ("statscrew", "team_season_results", 5),
)
MAX_REQUESTS_PER_SECOND_PER_HOST = 4.0


def year_window(first: Column, last: Column, asked_first: int | None, asked_last: int | None) -> tuple[Column, Column]:
    """The narrower of a spec's and a request's years; 0 and None ask for nothing."""
    lo = F.greatest(first, F.lit(asked_first)) if asked_first else first
    hi = F.least(last, F.lit(asked_last)) if asked_last else last
    return lo, hi


def range_seeds(ranges: DataFrame, asked_first: int | None = None, asked_last: int | None = None) -> DataFrame:
    """ranges: first_year, last_year, template -> url; empty windows give nothing."""
    lo, hi = year_window(F.col("first_year"), F.col("last_year"), asked_first, asked_last)
    r = ranges.withColumn("lo", lo).withColumn("hi", hi).filter(F.col("lo") <= F.col("hi"))
    return r.select("template", F.explode(F.sequence("lo", "hi")).alias("year")).select(seed_url(F.col("template"), F.col("year")).alias("url"))


def inventory_seeds(inventory: DataFrame, template: str, first: int, last: int) -> DataFrame:
    """inventory: year (text), year_number, team."""
    return inventory.filter(F.col("year_number").between(first, last)).select(seed_url(F.lit(template), F.col("year"), F.col("team")).alias("url"))


def all_seeds(*parts: DataFrame) -> DataFrame:
    """Static, range and inventory seeds without repeats."""
    return reduce(DataFrame.unionByName, parts).distinct()


def plan(targets: DataFrame, source: str = "", dataset: str = "", shard: str = "", shards: str = "") -> DataFrame:
    """targets: source, dataset, shards -> a row per job; filters come before the jobs are made."""
    if shards:
        targets = targets.withColumn("shards", F.lit(int(shards)))
    for name, want in (("source", source), ("dataset", dataset)):
        if want:
            targets = targets.filter(F.col(name) == want)
    jobs = targets.select("source", "dataset", "shards", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    return jobs.filter(F.col("shard") == int(shard)) if shard != "" else jobs


def max_parallel(jobs: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: how many jobs may run at once, if all met the most patient host: max_parallel."""
    met = jobs.join(sources.select("source", "delay_seconds"), "source", "left")
    cap = F.least(F.floor(F.min("delay_seconds") * MAX_REQUESTS_PER_SECOND_PER_HOST), F.count(F.lit(1)))
    return met.agg(F.greatest(F.lit(1).cast("long"), F.coalesce(cap, F.lit(1))).alias("max_parallel"))


def ci_output(jobs: DataFrame, sources: DataFrame) -> str:
    """The two lines that a job runner reads: the matrix and how many jobs may run at once. An empty plan is an error."""
    import json

    include = [r.asDict() for r in jobs.orderBy("source", "dataset", "shard").collect()]  # one row per job to start
    if not include:
        raise ValueError("the selection has no jobs")
    return f"matrix={json.dumps({'include': include})}\nmax_parallel={max_parallel(jobs, sources).first()[0]}\n"


OLDER_ROOT = "https://www.nfl.com/players/"


def player_view_pages(universe: DataFrame, done: DataFrame, views: list[str], shard_id: int = 0, shards: int = 1) -> DataFrame:
    """universe: slug, years array<int>; done: view, slug -> slug, view, season, url of the pages left to do.
    The career view has one page; the others one for each year."""
    mine = universe.filter(shard_of(F.col("slug"), shards, "sha1") == shard_id)
    each = mine.select("slug", "years", F.explode(F.array(*map(F.lit, views))).alias("view")).join(done, ["view", "slug"], "left_anti")
    years = F.when(F.col("view") == "career", F.array(F.lit(None).cast("int"))).otherwise(F.col("years"))
    each = each.select("slug", "view", F.explode(years).alias("season"))
    tail = F.when(F.col("view") == "career", F.lit("/stats/")).otherwise(F.concat(F.lit("/stats/"), "view", F.lit("/"), F.col("season").cast("string"), F.lit("/")))
    return each.withColumn("url", F.concat(F.lit(OLDER_ROOT), "slug", tail))


def done_views(ledger: DataFrame) -> DataFrame:
    """A slug is done for a view when every page of it was answered."""
    return ledger.groupBy("view", "slug").agg(F.bool_and(F.col("status") == "ok").alias("all_ok")).filter("all_ok").select("view", "slug")
