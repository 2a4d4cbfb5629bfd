r"""Exact dedup by content-defined chunk recipes (native).

A text, after deleting the characters of [\x20\x09-\x0D], is cut into chunks whose ends follow
from the content: a cut comes after five letters of fixed classes in a row, which chance makes
about once in 800 letters, or after a full stop of scripts without such letters, if min_chunk
characters have passed, and else after max_chunk characters. So texts that differ in one place
soon have the same cuts again, and share the chunks between.
A chunk's identifier is its SHA-256; length and a second, independent hash verify it: the
dictionary of identifiers is checked for two contents under one identifier before recipes are
compared, and the query stops if there are any. Two texts are equal when their ordered lists of
identifiers (recipes) are equal. A list travels as its own SHA-256 and a second hash of the whole list with
lengths and checks; a digest with two such hashes stops the query. Texts are read once and never shuffled.

Of equal texts the row with the most code points in its original text, then the smallest doc_id,
stays.

Defined results: null counts as empty, and all empty texts are equal; a null doc_id comes after
all others; repeated rows of one doc_id and text share one verdict; an empty table gives no rows;
other columns are ignored. Groups are counted before they are shuffled, so a group of any size
costs one row per task; the join back to the rows is by the recipe's digest and moves some 100 bytes a row,
but the rows of a group that holds more than a thousandth of them stay in place and get its row by a broadcast. drop_copies decides row by row: rows of one doc_id (or none) with
different texts are separate, and rows alike in doc_id and text stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import SPACE, hot_keys, join_groups, text_or_empty, written

MIN_CHUNK, MAX_CHUNK = 64, 4096
#: Letters by their code point modulo 4: 1, 2, 3, 0 and 1 again.
CUT = "[aeimquyAEIMQUY][bfjnrvzBFJNRVZ][cgkoswCGKOSW][dhlptxDHLPTX][aeimquyAEIMQUY]|[\\u3002\\uff01\\uff1f\\u061f\\u0964]"
#: More than any 64-bit id, so that (length, id) fits one decimal that keeps their order.
ID_SPAN = "10000000000000000000"
NO_ID = 9_223_372_036_854_775_807


def recipes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chunk: int = MIN_CHUNK,
    max_chunk: int = MAX_CHUNK,
) -> DataFrame:
    """doc_id, raw (a hash of the original), n_points (its code points), text_sha256 (normalised), recipe: the ordered
    array of (id, n, check) of the chunks, list_id and list_check: digest and second hash of the recipe."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    d = d.select(
        "doc_id",
        F.xxhash64("text").alias("raw"),
        F.length("text").cast("long").alias("n_points"),
        F.regexp_replace("text", SPACE + "+", "").alias("norm"),
    )
    cut = rf"(?s).{{{min_chunk},{max_chunk - 5}}}?(?:{CUT})|.{{1,{max_chunk}}}"
    d = d.withColumn("chunks", F.regexp_extract_all("norm", F.lit(cut), F.lit(0)))
    d = d.select(
        "doc_id",
        "raw",
        "n_points",
        F.sha2("norm", 256).alias("text_sha256"),
        F.transform(
            "chunks",
            lambda c: F.struct(F.sha2(c, 256).alias("hex"), F.length(c).alias("n"), F.xxhash64(c).alias("check")),
        ).alias("chunks"),
    )
    listed = F.array_join(F.transform("chunks", lambda c: c["hex"]), "")
    return d.select(
        "doc_id",
        "raw",
        "n_points",
        "text_sha256",
        F.transform("chunks", lambda c: F.struct(F.unhex(c["hex"]).alias("id"), c["n"].alias("n"), c["check"].alias("check"))).alias("recipe"),
        F.unhex(F.sha2(listed, 256)).alias("list_id"),
        F.xxhash64("chunks").alias("list_check"),
    )


def chunk_dictionary(recipe_rows: DataFrame) -> DataFrame:
    """One row per identifier: id, n, uses, documents' first doc_id, and verified: whether every chunk
    under it agrees in length and in the second hash."""
    return (
        recipe_rows.select("doc_id", F.explode("recipe").alias("c"))
        .groupBy("c.id")
        .agg(
            F.min("c.n").alias("n"),
            F.count(F.lit(1)).alias("uses"),
            F.min("doc_id").alias("first_doc"),
            ((F.min("c.n") == F.max("c.n")) & (F.min("c.check") == F.max("c.check"))).alias("verified"),
        )
    )


def exact_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, raw, keep_id, group_size, kept, text_sha256."""
    r = written(recipes(docs, doc_id, text), "recipes")
    if chunk_dictionary(r).filter(~F.col("verified")).limit(1).count():
        raise ValueError("two chunks share a SHA-256 identifier; recipes can't be compared")
    by_id = F.coalesce("doc_id", F.lit(NO_ID)).cast("decimal(38,0)")
    rank = F.col("n_points").cast("decimal(38,0)") * F.lit(ID_SPAN).cast("decimal(20,0)") - by_id
    groups = r.groupBy("list_id").agg(
        F.max(rank.cast("decimal(38,0)")).alias("best"),
        F.max("n_points").alias("most"),
        F.count(F.lit(1)).alias("group_size"),
        (F.min("list_check") == F.max("list_check")).alias("one"),
    )
    keep = F.col("most").cast("decimal(38,0)") * F.lit(ID_SPAN).cast("decimal(20,0)") - F.col("best")
    keep = F.nullif(keep.cast("decimal(38,0)").cast("long"), F.lit(NO_ID))
    groups = groups.select(
        "list_id",
        "most",
        "group_size",
        F.when(F.col("one"), keep).otherwise(F.raise_error(F.lit("two recipes share a digest"))).alias("keep_id"),
    )
    groups = written(groups, "groups")
    hot = hot_keys(groups, "list_id", "group_size", r.count())
    j = join_groups(r.select("doc_id", "raw", "n_points", "text_sha256", "list_id"), groups, "list_id", hot)
    return j.select(
        "doc_id",
        "raw",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("most"))).alias("kept"),
        "text_sha256",
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_rows(docs, doc_id, text).drop("raw")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns. Whole texts move once, past a table of the dropped rows' keys."""
    gone = exact_rows(docs, doc_id, text).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("raw").alias("gone_raw"))
    same = docs[doc_id].cast("long").eqNullSafe(gone["gone_id"]) & (F.xxhash64(text_or_empty(docs[text])) == gone["gone_raw"])
    return docs.join(gone.distinct().hint("shuffle_hash"), same, "left_anti")
