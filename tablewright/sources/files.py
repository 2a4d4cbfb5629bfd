"""File sources and sinks."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_NAME, MANIFEST_VERSION = "ARTIFACT_MANIFEST.json", 1


def table_keep(df: DataFrame, name: str = "kept") -> DataFrame:
    """Write to the shared checkpoint folder and read back: each round's state survives lost executors.
    Without such a folder (one machine) a reliable checkpoint is not possible and the frame is cached."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.cache()
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Seed inventory year, team as text; year as a number beside it."""
    d = spark.read.schema("year string, team string").csv(path, header=True)
    return d.withColumn("year_number", F.expr("try_cast(year AS INT)"))


def read_work_items(spark: SparkSession, path: str) -> DataFrame:
    from tablewright.operators.adapters import WORK

    return spark.read.schema(WORK).json(path)


def read_json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_holdings(document: DataFrame) -> DataFrame:
    """document: source, datasets map<string, struct<url_patterns: map<string, long>>> -> source, url_pattern, pages_held."""
    d = document.select("source", F.explode("datasets").alias("dataset", "d")).select("source", F.explode("d.url_patterns").alias("url_pattern", "n"))
    return d.groupBy("source", "url_pattern").agg(F.sum(F.coalesce("n", F.lit(0))).alias("pages_held"))


def sample_urls(pages: DataFrame, family: str, limit: int) -> DataFrame:
    """The first distinct URLs of a family in the order of `pos`."""
    first = pages.filter(F.col("url_pattern") == family).groupBy("url").agg(F.min("pos").alias("pos"))
    return first.orderBy("pos").limit(limit)


def union_first_seen(*parts: DataFrame) -> DataFrame:
    """URLs of several lists, each (url, pos), in order, without repeats."""
    tagged = [p.select("url", F.lit(i).alias("part"), "pos") for i, p in enumerate(parts)]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t)
    return every.groupBy("url").agg(F.min(F.struct("part", "pos")).alias("first"))


def json_line(df: DataFrame) -> Column:
    """A row as JSON with sorted keys and with nulls."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    rows = df.orderBy(*order) if order else df
    rows.select(json_line(df).alias("value")).write.mode("overwrite").text(path)


def write_records(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet with the frame's declared types; nothing is turned into text."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_raw(pages: DataFrame, path: str) -> None:
    """Pages by content: one row for each distinct body (bytes), or html (text), compressed by the writer."""
    body = F.col("body" if "body" in pages.columns else "html").cast("binary")
    raw = pages.select(F.sha2(body, 256).alias("content_sha256"), body.alias("body"))
    raw.dropDuplicates(["content_sha256"]).write.mode("overwrite").option("compression", "gzip").parquet(path)


def write_json_document(df: DataFrame, path: str | Path) -> None:
    """A one-row frame as an indented document on the driver."""
    Path(path).write_text(json.dumps(df.first().asDict(recursive=True), indent=2, default=str))


def file_digests(spark: SparkSession, directory: str) -> DataFrame:
    """path (relative), bytes, sha256 of all files below but the manifest, in order."""
    root = directory.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
    rel = F.regexp_extract("path", "^(?:[a-z]+:/*)?(/.*)$", 1)
    base = "/" + root.split(":", 1)[-1].lstrip("/") if ":" in root else root
    rel = F.substr(rel, F.lit(len(base) + 1))
    return files.select(rel.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).filter(F.col("path") != MANIFEST_NAME)


def build_manifest(spark: SparkSession, directory: str, *, source: str, dataset: str, shard_id: int, shard_count: int, artifact_run_id: str) -> dict:
    from datetime import UTC, datetime

    rows = file_digests(spark, directory).orderBy("path").collect()
    return {
        "schema_version": MANIFEST_VERSION,
        "source": source,
        "dataset": dataset,
        "shard_id": shard_id,
        "shard_count": shard_count,
        "artifact_run_id": artifact_run_id,
        "created_at_utc": datetime.now(UTC).isoformat(),
        "files": [r.asDict() for r in rows],
    }


def write_manifest(spark: SparkSession, directory: str, **names) -> dict:
    """The manifest of a finished folder, written into it on whatever store it is."""
    manifest = build_manifest(spark, directory, **names)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{MANIFEST_NAME}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(json.dumps(manifest, indent=2).encode()))
    out.close()
    return manifest


def verify_files(listed: DataFrame, found: DataFrame) -> DataFrame:
    """listed and found: path, sha256. The first failing rule of each listed file: path, problem."""
    f = found.select(F.col("path").alias("p"), F.col("sha256").alias("actual"))
    j = listed.join(f, F.col("path") == F.col("p"), "left")
    problem = (
        F.when(F.startswith("path", F.lit("/")) | F.array_contains(F.split("path", "/"), ".."), "unsafe path")
        .when(F.col("actual").isNull(), "missing file")
        .when(F.col("actual") != F.col("sha256"), "checksum mismatch")
    )
    return j.select("path", problem.alias("problem")).filter(F.col("problem").isNotNull())


def verify_manifest(spark: SparkSession, directory: str, manifest: dict | None = None) -> list[str]:
    if manifest is None:
        manifest = json.loads(Path(directory.removeprefix("file://"), MANIFEST_NAME).read_text())
    if manifest.get("schema_version") != MANIFEST_VERSION:
        return [f"unknown schema_version: {manifest.get('schema_version')}"]
    if not manifest["files"]:
        return []
    listed = spark.createDataFrame([(f["path"], f["sha256"]) for f in manifest["files"]], "path string, sha256 string")
    return [f"{r['problem']}: {r['path']}" for r in verify_files(listed, file_digests(spark, directory)).orderBy("path").collect()]
