r"""Quality rules with cross-document line frequency (native).

Two kinds of rules. The base rules look at one text: too few words, or too many words inside
five-word windows that the text repeats. The method's rule looks across documents: lines are
normalised (white space squeezed, lower case) and hashed together with their host; for each line the
distinct documents that hold it are counted; a line above the limit is removed; a document that removal
leaves depleted is rejected.

Distinct documents differ in their words (white space squeezed, lower case), so a much-copied text counts once
for each of its lines and copying alone removes nothing. Near copies are different documents: a line
that more than min_docs of them share goes, as it would in any other pages.

Limits. A line goes if more than min_docs distinct documents of its host hold it, however large the host is. A document
is depleted if removal leaves fewer than min_words words, or less than left_pct per cent of its words.

Plan. A first pass reads the lines of each text and keeps one row (unit) for each host and sequence of lines, so copies
are merged before anything is shuffled by line. Lines are counted by a partial aggregation, frequent ones join
the lines of the units (adaptive execution splits a frequent line's rows), and what goes from a unit comes back as one row. A second
pass takes the base measures of each text and joins them with the units' rows. No table of whole texts is written.

Line hashes have 64 bits: a line is taken for a frequent one by chance once in 2**64 / (number of frequent lines).

Defined results: null text has no words and fails the base rules; a null host is a host; repeated
rows are judged one by one, with one verdict, as rows are never merged; doc_id is not used, so null and repeated ones change
nothing; an empty table gives no rows; other columns pass through `carry` only, so clashing names can't meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import SPACE, SPACES, text_or_empty, written

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MIN_DOCS = 20
LEFT_PCT = 25


def squeezed(text: Column) -> Column:
    """White space runs become one space, none at the ends, lower case."""
    return F.lower(F.regexp_replace(F.btrim(text, F.lit(SPACES)), SPACE + "+", " "))


def has_words(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES)) != ""


def lines_of(text: Column) -> Column:
    """The text's lines that have words, squeezed, in order."""
    return F.transform(F.filter(F.split(text, "\n", -1), has_words), squeezed)


def unit_of(lines: Column, host: Column) -> Column:
    """Digest of a host and a sequence of lines; a null host is not an empty one."""
    return F.unhex(F.md5(F.concat(F.when(host.isNull(), "0").otherwise(F.concat(F.lit("1"), host)), F.lit("\n"), F.array_join(lines, "\n"))))


def measures(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One pass over each text. Columns: doc_id, the base counts, unit and the columns of carry in a struct."""
    d = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        text_or_empty(text).alias("text"),
        F.struct(*[F.col(c) for c in carry] or [F.lit(0).alias("none")]).alias("carried"),
    )
    d = d.withColumn("trimmed", F.btrim("text", F.lit(SPACES)))
    d = d.withColumn(
        "words",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", SPACE + "+")),
    )
    d = d.withColumn("hashed", F.transform("words", lambda w: F.xxhash64(w)))
    grams = F.transform(
        F.sequence(F.lit(0), F.size("hashed") - WINDOW),
        lambda i: F.xxhash64(*[F.col("hashed")[i + k] for k in range(WINDOW)]),
    )
    d = d.withColumn(
        "grams", F.when(F.size("hashed") >= WINDOW, grams).otherwise(F.array().cast("array<bigint>"))
    )
    # Only texts that repeat a window pay for the sort that finds where.
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    d = d.withColumn(
        "sorted",
        F.when(
            repeats, F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        ),
    )
    last = F.size("sorted") - 1
    twice = F.filter(
        "sorted",
        lambda x, i: ((i > 0) & (F.col("sorted")[F.greatest(i - 1, F.lit(0))]["g"] == x["g"]))
        | ((i < last) & (F.col("sorted")[F.least(i + 1, last)]["g"] == x["g"])),
    )
    d = d.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    end = F.size("at") - 1
    covered = F.aggregate(
        F.transform(
            "at",
            lambda p, j: F.when(
                j < end, F.least(F.lit(WINDOW), F.col("at")[F.least(j + 1, end)] - p)
            ).otherwise(WINDOW),
        ),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    d = d.withColumn(
        "full", F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    )
    d = d.withColumn("joined", F.array_join("words", ""))
    return d.select(
        "doc_id",
        "carried",
        F.size("words").cast("long").alias("n_words"),
        F.length("joined").cast("long").alias("word_chars"),
        F.regexp_count("joined", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        # Adds 0. Filters don't move below a column that isn't deterministic, else they would repeat all of the above.
        (F.coalesce(covered, F.lit(0)) + F.shiftright(F.monotonically_increasing_id(), 63)).cast("long").alias("n_repeat_words"),
        unit_of(lines_of(F.col("text")), F.col("host")).alias("unit"),
    )


def units(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """One row for each host and sequence of lines: unit, content (hash of the words), lines (array of hash of host and line, and
    number of words, in order)."""
    d = docs.select(F.col(host).cast("string").alias("host"), lines_of(text_or_empty(text)).alias("squeezed"))
    d = d.filter(F.size("squeezed") > 0)
    spaces = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
    lines = F.transform("squeezed", lambda x: F.struct(F.xxhash64(F.col("host"), x).alias("h"), (spaces(x) + 1).alias("n")))
    d = d.select(unit_of(F.col("squeezed"), F.col("host")).alias("unit"), F.xxhash64(F.array_join("squeezed", " ")).alias("content"), lines.alias("lines"))
    return d.dropDuplicates(["unit"])


def frequent_lines(unit_rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """h, held: the lines of a host that more than min_docs distinct documents hold."""
    rows = unit_rows.select("content", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    return rows.groupBy("h").agg(F.count_distinct("content").alias("held")).filter(F.col("held") > min_docs)


def removals(docs: DataFrame, text: str = "text", host: str = "source", min_docs: int = MIN_DOCS) -> DataFrame:
    """unit, removed_words, removed: how many words go, and the places (from 0, among lines with words) of the lines that go."""
    rows = written(units(docs, text, host), "quality-units")
    gone = frequent_lines(rows, min_docs).select("h")
    lines = rows.select("unit", F.posexplode("lines").alias("at", "line")).select("unit", "at", "line.h", "line.n")
    return lines.join(gone, "h").groupBy("unit").agg(F.sum("n").cast("long").alias("removed_words"), F.collect_list("at").alias("removed"))


def verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    carry: tuple[str, ...] = (),
    min_words: int = MIN_WORDS,
    max_repeat_pct: int = MAX_REPEAT_PCT,
    min_docs: int = MIN_DOCS,
    left_pct: int = LEFT_PCT,
) -> DataFrame:
    """measures() with base_failed, removed_words, removed (places of lines, null if none) and kept."""
    gone = removals(docs, text, host, min_docs).withColumnRenamed("unit", "of_unit").hint("shuffle_hash")
    m = measures(docs, doc_id, text, host, carry)
    j = m.join(gone, F.col("unit") == F.col("of_unit"), "left").drop("of_unit")
    j = j.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    j = j.withColumn(
        "base_failed",
        (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct),
    )
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < min_words) | (left * 100 < F.col("n_words") * left_pct))
    return j.withColumn("kept", ~F.col("base_failed") & ~depleted)


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The documents that stay, with their own columns; frequent lines are gone from their texts."""
    names = docs.columns
    v = verdicts(docs, doc_id, text, host, carry=tuple(names)).filter("kept")
    every = F.split(f"carried.{text}", "\n", -1)
    # Places among all lines of those with words, then of those that go; sets of numbers are compared by hash.
    v = v.withColumn("every", F.when(F.col("removed_words") > 0, every))
    numbered = F.transform("every", lambda x, i: F.when(has_words(x), i))
    v = v.withColumn("worded", F.filter(numbered, lambda i: i.isNotNull()))
    # Named twice, so that it stays a column and is not made anew for each place.
    gone = F.when(F.size("worded") > 0, F.transform("removed", lambda at: F.col("worded")[at]))
    stay = F.array_except(F.sequence(F.lit(0), F.size("every") - 1), gone)
    kept_lines = F.transform(stay, lambda i: F.col("every")[i])
    new_text = F.when(F.col("removed_words") > 0, F.array_join(kept_lines, "\n")).otherwise(F.col(f"carried.{text}"))
    v = v.withColumn("new_text", new_text)
    out = {c: F.col("carried")[c] for c in names} | {text: F.col("new_text")}
    if "n_chars" in names and dict(docs.dtypes)["n_chars"] == "bigint":
        out["n_chars"] = F.when(F.col("removed_words") > 0, F.length("new_text").cast("long")).otherwise(
            F.col("carried.n_chars")
        )
    return v.select(*[out[c].alias(c) for c in names])
