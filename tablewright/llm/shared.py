"""What the operators share: the folder for intermediate tables, and text constants."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words, as a set for trim() and as a regular expression.
SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
#: A key is hot if it holds more than one in so many of all rows; so there are fewer hot keys than this.
HOT = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A cluster names it in spark.checkpoint.dir. Only in local mode,
    where the driver is the only executor, a temporary folder is made and set if it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tablewright-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Asks the path's own file system, whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def written(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back. This cuts the lineage:
    a lost executor costs a re-read of files, not a recomputation, and rows that carry generated
    ids keep them. few: for tables that are small beside the input, two files for each core at most."""
    spark = df.sparkSession
    path = table_path(spark, name)
    if few:
        df = df.coalesce(2 * spark.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_keys(sizes: DataFrame, key: str, size: str, rows: int, hot: int = HOT) -> DataFrame:
    """sizes: one row per key with the number of its rows, of `rows` in all -> the hot keys, fewer than `hot`."""
    return written(sizes.filter(F.col(size) > rows / hot).select(key), "hot", few=True)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """rows joined to groups, which has one row per key. Rows of hot keys (see hot_keys) stay where they are and
    get their groups by a broadcast, whose size the number of hot keys bounds; the others are shuffled by key."""
    of_hot = groups.join(F.broadcast(hot), key, "left_semi")
    others = rows.join(F.broadcast(hot), key, "left_anti")
    return rows.join(F.broadcast(of_hot), key).unionByName(others.join(groups, key))


def text_or_empty(column: str | Column) -> Column:
    """Null texts count as empty ones."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
