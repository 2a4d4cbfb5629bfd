"""Harvest: work items to fetched pages, records, ledger and column dictionary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import text as T
from tablewright.operators.adapters import get_adapter, observed_dictionary
from tablewright.sources import html_tables as H
from tablewright.sources.files import table_keep

PARSER_VERSION = "1"
Fetch = Callable[[DataFrame], DataFrame]


def page_table_fetch(pages: DataFrame, url: str = "url", html: str = "html") -> Fetch:
    """Fetch from a table of landed pages; a missing page is absent, code 404. Adds status_code, status,
    body, error to the rows asked for."""
    landed = pages.select(F.col(url).alias("url"), F.col(html).alias("body")).dropDuplicates(["url"])

    def fetch(wanted: DataFrame) -> DataFrame:
        j = wanted.join(landed, "url", "left")
        code = F.when(F.col("body").isNull(), 404).otherwise(200)
        return j.withColumns({"status_code": code, "status": T.status_class(code), "error": F.lit(None).cast("string")})

    return fetch


def with_text(fetched: DataFrame) -> DataFrame:
    """Adds html, the body as text, and content_sha256 of the body's bytes as they were received."""
    received = dict(fetched.dtypes)["body"] == "binary"
    text = T.page_text(F.col("body")) if received else F.col("body")
    return fetched.withColumns({"html": text, "content_sha256": T.content_sha256(F.col("body").cast("binary"))})


def owned(work: DataFrame, shard_id: int, shards: int, prepartitioned: bool = False) -> DataFrame:
    return work if prepartitioned else work.filter(T.shard_of(F.col("key"), shards) == shard_id)


@dataclass
class Harvest:
    records: DataFrame
    ledger: DataFrame
    dictionary: DataFrame | None
    raw: DataFrame

    def counts(self) -> DataFrame:
        n = F.count(F.lit(1))
        requests = self.ledger.agg(n.alias("request_count"), F.count_if(F.col("status") == "ok").alias("ok_count"), F.sum("record_count").alias("record_count"))
        return requests.withColumn("work_item_count", F.col("request_count"))


def run_harvest(
    source: str,
    dataset: str,
    work: DataFrame,
    fetch: Fetch,
    shard_id: int = 0,
    shards: int = 1,
    prepartitioned: bool = False,
    artifact_run_id: str = "",
    keep: Callable[[DataFrame], DataFrame] = table_keep,
) -> Harvest:
    """keep is applied once to the fetched pages and once to the parsed tables, which several results
    read: by default both are written to the shared folder, so nothing is fetched or parsed twice."""
    adapter = get_adapter(source)
    mine = owned(work, shard_id, shards, prepartitioned)
    fetched = keep(fetch(mine))
    pages = with_text(fetched.filter(F.col("status") == "ok")).select("url", "html", "content_sha256", F.col("body").cast("binary").alias("body"))
    distinct = pages.dropDuplicates(["url"])
    tables = keep(H.tables_of(distinct))
    stamp = distinct.select(F.col("url").alias("source_url"), "content_sha256")
    records = adapter.records(dataset, distinct, tables, mine).join(stamp, "source_url")
    records = records.withColumns(
        {
            "retrieved_at_utc": F.current_timestamp(),
            "parser_version": F.lit(PARSER_VERSION),
            "artifact_run_id": F.lit(artifact_run_id),
            "shard_id": F.lit(shard_id),
        }
    )
    found = records.groupBy(F.col("source_url").alias("url")).agg(F.count(F.lit(1)).alias("record_count"))
    ledger = fetched.select("key", "url", "status_code", "status", "error").join(found, "url", "left").join(distinct.select("url", "content_sha256"), "url", "left")
    failed = (F.col("status") == "ok") & F.col("record_count").isNull()
    ledger = ledger.select(
        "key",
        "url",
        "status_code",
        F.when(failed, "parse_error").otherwise(F.col("status")).alias("status"),
        F.when(failed, adapter.empty_message(dataset)).otherwise(F.col("error")).alias("error"),
        "content_sha256",
        F.when(F.col("content_sha256").isNotNull(), F.concat(F.lit("raw/"), "content_sha256", F.lit(".html.gz"))).alias("raw_path"),
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
    )
    entries = adapter.dictionary(dataset, tables)
    # Columns of pages that gave records only, as a page that fails is not observed.
    if entries is not None:
        entries = observed_dictionary(entries.join(found.select(F.col("url").alias("source_url")), "source_url", "left_semi"))
    return Harvest(records, ledger, entries, pages.select("content_sha256", "body").dropDuplicates(["content_sha256"]))
