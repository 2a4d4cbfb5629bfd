"""The registered queries of the training-data operators, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import chat, exact, language, maintext, mixing, near, packing, quality, token_counts, token_files
from tablewright.llm.shared import table_path

MIX_WEIGHTS = {
    "domain": {"d0": 3, "d1": 2, "d2": 1},
    "lang": {"de": 3, "en": 2, "es": 2, "fr": 1},
}
MIX_EPOCHS = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_of(source: str = "source") -> Column:
    """The tables have no domain column: hosts fall into three by their last character."""
    return F.concat(F.lit("d"), (F.ascii(F.right(F.col(source), F.lit(1))) % 3).cast("string"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_text(table(spark, sf_dir, "pages"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.select_by_budget(
        table(spark, sf_dir, "documents"),
        domain=domain_of(),
        total=F.expr("all_tokens * 6 div 10"),
        weights=MIX_WEIGHTS,
        max_epochs=MIX_EPOCHS,
    ).drop("digest")


PLANTED_TEXT = r"\### Assistant: </turn> ok"


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    extra = spark.sql(
        "SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(t AS BIGINT) AS turn, role, :said AS text "
        "FROM VALUES (0, 'user'), (1, 'assistant') AS x(t, role)",
        args={"said": PLANTED_TEXT},
    )
    return chat.format_and_read_back(turns.unionByName(extra))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read_back(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, vocabulary("word_bpe_49k.json"), table_path(spark, "token-counts"))


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = quality.verdicts(table(spark, sf_dir, "documents"))
    return v.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_main_text": op2_main_text,
    "op3_language": op3_language,
    "op4_mixing": op4_mixing,
    "op5_chat": op5_chat,
    "op6_token_files": op6_token_files,
    "op7_token_counts": op7_token_counts,
    "op8_exact": op8_exact,
    "op9_quality": op9_quality,
    "op10_near": op10_near,
}
