r"""Mixing sources to target weights by hierarchical budgeting (native).

Sources are the leaves of a tree, domain - language - source. A budget of tokens goes down the
tree by weight. A node can't take more than its leaves hold (times max_epochs); what it can't take
goes to its siblings in proportion to their weights, and only what all siblings together can't
take would go to their parent's siblings: as a node's capacity is the sum of its leaves', its
parent has never been given more than that. Each step is a water level in closed form, in exact
integers: siblings in the order of capacity/weight are full up to a point, the rest share by
weight.

Selection: a leaf's documents are put in a seeded order for each epoch, and the leaf takes the
prefix of (epoch, order) whose tokens before the document are below its budget. So full epochs
come whole, and the last document may overshoot by less than its length. Prefix sums go through
`slots` ranges of the order hash per leaf, so a leaf with a third of all rows is summed by many
tasks; only the one range in which the budget ends is sorted.

A token is a word [^\x20\x09-\x0D]+ here, counted over whole texts.

Defined results: null text has 0 tokens; documents of 0 tokens are taken as their place in the
order says; null domain, language or source is a node of its own named ''; weights must be positive
integers, names not given weigh default_weight; the order is by doc_id ('null' if it has none) and text, so rows of
one doc_id, or of none, with different texts have places of their own; rows alike in both have one place and are taken
together; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.shared import text_or_empty, written

LEVELS = ("domain", "lang", "source")
SLOTS = 1024
SEED = 17


def weight_of(level: str, weights: dict[str, int], default: int) -> Column:
    return reduce(lambda c, kv: F.when(F.col(level) == kv[0], kv[1]).otherwise(c), sorted(weights.items()), F.lit(default)).cast("long")


def order_hash(doc_id: Column, digest: Column, epoch: Column, seed: int) -> Column:
    """48 bits of a hash that SQL engines share. digest: the MD5 of the text."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")), digest)
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def _wide(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def water_fill(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """nodes: parents, name, cap, weight and the parent's budget -> the same rows with their own budget.
    Integer parts are given; each parent may leave fewer tokens than it has children."""
    by = W.partitionBy(*parents).orderBy((F.col("cap") / F.col("weight")).asc(), F.col(name).asc())
    before, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(W.currentRow, W.unboundedFollowing)
    n = nodes.withColumn("rest", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    n = n.withColumn("heft", F.sum("weight").over(after))
    full = _wide(F.col("cap")) * F.col("heft") <= _wide(F.col("weight")) * F.greatest(F.col("rest"), F.lit(0))
    n = n.withColumn("full", full)
    first = F.when(~F.col("full"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col(name).alias("k"), "rest", "heft"))
    n = n.withColumn("level", F.min(first).over(W.partitionBy(*parents)))
    share = F.expr("cast(weight as decimal(18,0)) * cast(greatest(level.rest, 0L) as decimal(20,0)) div cast(level.heft as decimal(20,0))")
    own = F.when(F.col("full"), F.col("cap")).otherwise(share)
    return n.withColumn("budget", own).drop("rest", "heft", "full", "level")


def leaf_budgets(leaves: DataFrame, total: Column, weights: dict[str, dict[str, int]], max_epochs: int, default_weight: int = 1) -> DataFrame:
    """leaves: domain, lang, source, tokens -> with budget. total: the whole budget, given all tokens as
    the column all_tokens."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    above = leaves.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    above = above.withColumn("all_tokens", F.sum("tokens").over(W.partitionBy(F.lit(0)))).withColumn("budget", total.cast("long"))
    above = above.withColumn("weight", weight_of("domain", weights.get("domain", {}), default_weight))
    above = above.withColumn("root", F.lit(0))
    filled = water_fill(above, ["root"], "domain").select("domain", "budget")
    for depth in (2, 3):
        keys = list(LEVELS[:depth])
        below = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap"))
        below = below.join(filled, keys[:-1]).withColumn("weight", weight_of(keys[-1], weights.get(keys[-1], {}), default_weight))
        filled = water_fill(below, keys[:-1], keys[-1]).select(*keys, "budget")
    return leaves.join(filled, list(LEVELS))


def select_by_budget(
    docs: DataFrame,
    domain: Column,
    total: Column,
    weights: dict[str, dict[str, int]],
    max_epochs: int = 2,
    seed: int = SEED,
    slots: int = SLOTS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """One row per document and epoch taken: doc_id, domain, lang, source, n_tokens, epoch (from 0), digest (MD5 of the text)."""
    d = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(domain, F.lit("")).alias("domain"),
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_tokens"),
        F.md5(text_or_empty(text)).alias("digest"),
    )
    d = written(d, "mixing-tokens")
    leaves = d.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
    budgets = leaf_budgets(leaves, total, weights, max_epochs)
    # Epochs that a leaf needs: whole ones and the one in which its budget ends.
    budgets = budgets.select(*LEVELS, F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"), "tokens", "budget")
    budgets = budgets.withColumn("need", F.least(F.col("budget") - F.col("epoch") * F.col("tokens"), F.col("tokens")))
    # A row per leaf and epoch; written, as two parts of the plan need it.
    budgets = written(budgets.filter(F.col("need") > 0).select(*LEVELS, "epoch", "need"), "budgets", few=True)
    j = d.join(budgets, list(LEVELS)).withColumn("h", order_hash(F.col("doc_id"), F.col("digest"), F.col("epoch"), seed))
    j = j.withColumn("slot", F.shiftright("h", 48 - (slots - 1).bit_length()))
    key = [*LEVELS, "epoch"]
    sums = j.groupBy(*key, "slot", "need").agg(F.sum("n_tokens").alias("slot_tokens"))
    w = W.partitionBy(*key).orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("slot_tokens").over(w), F.lit(0)))
    taken = sums.filter(F.col("before") < F.col("need")).select(*key, "slot", "before", "slot_tokens")
    j = j.join(taken, [*key, "slot"])
    ends = F.col("before") + F.col("slot_tokens") > F.col("need")
    out = ["doc_id", *LEVELS, "n_tokens", F.col("epoch").cast("long").alias("epoch"), "digest"]
    whole = j.filter(~ends).select(*out)
    inside = W.partitionBy(*key, "slot").orderBy("h").rangeBetween(W.unboundedPreceding, -1)
    part = j.filter(ends).withColumn("at", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return whole.unionByName(part.filter(F.col("at") < F.col("need")).select(*out))


def keep_selected(docs: DataFrame, domain: Column, total: Column, weights: dict[str, dict[str, int]], seed: int = SEED, doc_id: str = "doc_id", **names) -> DataFrame:
    """The documents within their leaf's budget, once each, with their own columns."""
    picked = select_by_budget(docs, domain, total, weights, max_epochs=1, seed=seed, doc_id=doc_id, **names)
    picked = picked.select(F.col("doc_id").alias("picked_id"), F.col("digest").alias("picked_digest")).distinct()
    same = docs[doc_id].eqNullSafe(picked["picked_id"]) & (F.md5(text_or_empty(docs[names.get("text", "text")])) == picked["picked_digest"])
    return docs.join(picked.hint("shuffle_hash"), same, "left_semi")
