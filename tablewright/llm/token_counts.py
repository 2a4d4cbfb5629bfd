"""Token counts through a digest cache.

The cache is a table (tokenizer, digest, n_tokens): tokenizer is the digest of the vocabulary file
and library version, digest the SHA-256 of the normalised content. It is partitioned by tokenizer, so a run reads
its own tokenizer's counts only. Documents are joined to it by both; of the digests that it lacks one document each is encoded, and their counts are appended.
Normalising here means that null becomes the empty text; nothing else may change, as any rewriting
could change the count.

Only digests, lengths and ids are grouped, so thousands of copies cost a row per task, and the rows of a digest
that holds more than a thousandth of them take their count from a broadcast; texts move
once, by their own id, and only if they are the one that is encoded.

Defined results: null text counts as empty; null doc_ids and repeated rows keep their rows; an empty
table gives no rows; a repeated cache row is harmless; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import exists, hot_keys, join_groups, text_or_empty, written
from tablewright.llm.tokenize import version_digest

CACHE = "digest binary, n_tokens long"
LIMIT = 2048
NO_ID = -9_223_372_036_854_775_808


def encode_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    """texts: digest, text -> digest, n_tokens."""

    def work(batches):
        import pyarrow as pa

        from tablewright.llm.tokenize import encoder

        enc = encoder(tokenizer)
        for batch in batches:
            counts = enc.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.mapInArrow(work, "digest binary, n_tokens long")


def count_tokens(
    docs: DataFrame, tokenizer: str, cache_path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. Appends to the table at cache_path."""
    spark, own = docs.sparkSession, f"{cache_path}/tokenizer={version_digest(tokenizer)}"
    cache = spark.read.schema(CACHE).parquet(own) if exists(spark, own) else spark.createDataFrame([], CACHE)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    d = d.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keyed = written(d.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")

    key = F.coalesce("doc_id", F.lit(NO_ID))
    groups = written(keyed.groupBy("digest").agg(F.min(key).alias("key"), F.count(F.lit(1)).alias("size")), "digest-groups")
    chosen = groups.join(cache.select("digest"), "digest", "left_anti").select("digest", "key")
    # A hash join, as sorting texts to pick some is the costlier way; its built side holds no text.
    texts = d.withColumn("key", key).join(chosen.hint("shuffle_hash"), ["key", "digest"], "left_semi").select("digest", "text")
    encode_counts(texts, tokenizer).write.mode("append").parquet(own)

    counts = spark.read.schema(CACHE).parquet(own).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    hot = hot_keys(groups, "digest", "size", keyed.count())
    return join_groups(keyed, counts, "digest", hot).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
