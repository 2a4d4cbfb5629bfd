"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result as
Parquet in the shared folder and reads it again as the next one's docs. All but the last return the
columns of documents.

Defined results: each stage decides row by row. Null and empty texts fail the quality rules. Rows with null or repeated doc_ids are
told apart by their texts; rows alike in both share every decision, so they stay or go together. Other columns pass
through unchanged; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import exact, mixing, near, packing, quality
from tablewright.llm.queries import MIX_WEIGHTS, domain_of, table, vocabulary
from tablewright.llm.shared import written

#: Tokens that mixing keeps, in per cent of those that reach it; no document is taken twice after dedup.
MIX_PER_CENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    total = F.expr(f"all_tokens * {MIX_PER_CENT} div 100")
    return mixing.keep_selected(docs, domain_of(), total, MIX_WEIGHTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_rules),
    ("exact", exact_dedup),
    ("near", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Order MinHash and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
