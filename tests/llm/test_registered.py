"""All ten operators and the pipeline are registered; the pipeline's stages hold on small and empty input."""

import re

import __spark_entry__ as e
import pytest
from pyspark.sql import functions as F

import corpus_pipeline


def test_names():
    found = sorted(int(m[1]) for n in e.queries() if (m := re.match(r"op(\d+)_", n)))
    assert found == list(range(1, 11)) and "pipeline" in e.queries()


def make(spark, tmp_path, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_pipeline_against_its_operators(spark, tmp_path):
    import random

    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(3, 8))) for _ in range(900)]
    text = lambda n=60: " ".join(rnd.choices(words, k=n))
    base = text(120).split()
    rows = [(i, text(), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100, " ".join(base), "en", "s0", 1), (101, " ".join(base) + " ", "en", "s0", 1), (102, " ".join([*base[:60], "other", *base[61:]]), "en", "s0", 1)]
    rows += [(200, "too short", "en", "s0", 1), (201, None, None, None, None), (202, "spam spam " * 80, "en", "s1", 1)]
    d = make(spark, tmp_path, rows)
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d).cache()
        assert docs.columns == columns
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    quality, exact, near, mixed = kept
    assert quality == {*range(40), 100, 101, 102} and quality - exact == {100} and exact - near == {102} and mixed < near
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, d).select("doc_id").collect()}
    assert packed == mixed


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "x", None, None, None)] * 3])
def test_pipeline_edges(spark, tmp_path, rows):
    assert corpus_pipeline.run(spark, make(spark, tmp_path, rows)).agg(F.count(F.lit(1))).first()[0] == 0
