"""A landing folder of pages as a stream: new files are parsed once, copies within the watermark dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.urls import url_path, url_pattern
from tablewright.sources.html_tables import tables_of

LANDED = "url string, html string, landed_at timestamp"


def landing_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def distinct_pages(pages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Pages whose content was not seen within the delay; state older than that is dropped."""
    hashed = pages.withColumn("content_sha256", F.sha2(F.col("html").cast("binary"), 256))
    return hashed.withWatermark("landed_at", delay).dropDuplicatesWithinWatermark(["content_sha256"])


def pattern_counts(pages: DataFrame, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Pages per family and window of landing."""
    p = pages.withWatermark("landed_at", delay).withColumn("url_pattern", url_pattern(url_path(F.col("url"))))
    return p.groupBy(F.window("landed_at", window).alias("w"), "url_pattern").agg(F.count(F.lit(1)).alias("pages"))


def stream_tables(pages: DataFrame) -> DataFrame:
    return tables_of(pages)
