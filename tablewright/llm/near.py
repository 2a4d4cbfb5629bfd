r"""Near-duplicate documents by order MinHash.

Words are [^\x20\x09-\x0D]+; k-mers are windows of five words (a shorter text is one k-mer), labelled with
their occurrence number, so that a text's k-mers are a set. A sketch is the tuple of the `picks`
k-mers with the least hashes under one hash function, in the order of the text: two texts share it
if they share those k-mers in that order, so it answers to edit similarity, not only to content. With
three picks, two texts of similarity 0.8 share one sketch in about two, and all of 20 miss with a
chance of one in a million.

Texts of equal words are one node from the start. Nodes that share a sketch meet in a bucket.

Stars: of each bucket the node that meets the most others, in all its buckets, leads; it and each other
node are a candidate. So there are no more candidates than nodes times sketches. Their links give provisional
classes, as the centre of a group (the text nearest to what the others were copied from) shares the most sketches.

The rest: a bucket whose other nodes are of more than one provisional class has pairs that no star decided.
Its nodes are open, and all pairs of open nodes of different classes are decided by a prefix filter: the k-mers
of open nodes are put in one order, those that nodes of one class alone hold first, then by the number of
their holders; two texts of n k-mers that reach the threshold share one of their first n - 0.8 n + 1.
So nodes meet at their rare k-mers only, and a passage that very many texts hold brings none together. At
each of these k-mers the nodes of different classes are compared, in blocks of a bounded number of rows, by
their sizes and profiles, and go on only where they share none of the k-mers just before: a profile counts the k-mers in BINS bins of their hash, and the sum of the lesser
counts of two profiles is at least their common k-mers. What the bounds leave open is verified. So of any two
nodes that share a sketch, either the pair was decided or they are in one class: the classes are those that all
pairs with a common sketch would give.

Candidates are verified by banded alignment: with labelled k-mers the best alignment is the
longest increasing run of common positions, and only positions that lie within the band which the
threshold leaves open may match. Similarity is common / (all - common), the Jaccard index of
k-mers that agree in order; from 0.8 on it is a link. Classes are the connected components of
links, found by contracting every node to its neighbour of least hash, round by round.

Defined results: class_id is the least doc_id of the class (null if it has none), and the row with that
doc_id is kept; of several with it, those of one text. Null text is empty; texts without words are one class.
A null doc_id is compared like any other and comes last. Rows of one doc_id with different texts are separate;
repeated rows share their verdict. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.shared import text_or_empty, written

K = 5
SIMILARITY = 0.8
SKETCHES = 20
PICKS = 3
WORD_LIMIT = 100_000
#: Bins of a profile, and rows of one side of a block that are compared at a time.
BINS = 128
BLOCK = 1024
#: Earlier k-mers that a row of the prefix filter knows of.
BEFORE = 16
#: k-mers times sketches that are held at a time.
CELLS = 2_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Words(dict):
    """Word -> 32-bit hash, kept for up to WORD_LIMIT words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh32_intdigest(word)
        return h

    def of(self, text: str) -> tuple[np.ndarray, bytes]:
        """The words' hashes and a digest of the words. bytes.split() cuts at just the six blanks."""
        words = text.encode().split()
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words)), hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def labelled_kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-mers with their occurrence numbers, in text order; no two are equal."""
    if not len(words):
        return np.zeros(0, np.uint64)
    w = words.astype(np.uint64)
    span = min(k, len(w))
    g = np.full(len(w) - span + 1, span, np.uint64)
    for i in range(span):
        g = (g ^ w[i : len(w) - span + 1 + i]) * _ODD
        g ^= g >> np.uint64(29)
    order = np.argsort(g, kind="stable")
    s = g[order]
    new = np.r_[True, s[1:] != s[:-1]]
    if not new.all():
        first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
        seen = np.empty(len(s), np.uint64)
        seen[order] = np.arange(len(s)) - first
        g = g + seen * np.uint64(0xD6E8FEB86659FD93)
    return _mix(g)


def sketch_keys(x: np.ndarray, sketches: int = SKETCHES, picks: int = PICKS) -> np.ndarray:
    """One hash for each ordered tuple of minima."""
    salt = _mix(np.arange(1, sketches + 1, dtype=np.uint64) * _ODD)
    step = max(1, CELLS // len(x))
    picked = []
    for at in range(0, sketches, step):
        s = salt[at : at + step, None]
        if len(x) > picks:
            v = (x[None, :] ^ s) * (_mix(s) | np.uint64(1))
            p = np.argpartition(v, picks - 1, axis=1)[:, :picks]
            p.sort(axis=1)
        else:
            p = np.tile(np.arange(len(x)), (len(s), 1))
        picked.append(p)
    t = x[np.vstack(picked)]
    key = salt
    for c in range(t.shape[1]):
        key = _mix((key ^ t[:, c]) * _ODD)
    return key.view(np.int64)


def profile(x: np.ndarray) -> bytes:
    """How many k-mers fall into each bin, a byte each; empty if a count doesn't fit, which bounds nothing."""
    n = np.bincount((x >> np.uint64(40)).astype(np.int64) % BINS, minlength=BINS)
    return n.astype(np.uint8).tobytes() if n.max() < 256 else b""


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Similarity of two texts' labelled k-mers, or 0 if it is below the threshold."""
    both = len(a) + len(b)
    if not both:
        return 1.0
    _, pa, pb = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(pa) < similarity * (both - len(pa)) - 1e-9:
        return 0.0
    # k-mers left over by an alignment that reaches the threshold; no matched pair lies farther off.
    band = both * (1 - similarity) / (1 + similarity) + 1
    near = np.abs(pa - pb) <= band
    run: list[int] = []
    for j in pb[near][np.argsort(pa[near], kind="stable")].tolist():
        at = bisect_left(run, j)
        if at == len(run):
            run.append(j)
        else:
            run[at] = j
    s = len(run) / (both - len(run))
    return s if s >= similarity - 1e-9 else 0.0


def prefix_length(n: int, similarity: float = SIMILARITY) -> int:
    """So many k-mers, in any order of all k-mers, that texts which reach the threshold share one of them."""
    return n - math.ceil(similarity * n - 1e-9) + 1


def sketches_of(docs: DataFrame, sketches: int = SKETCHES, picks: int = PICKS) -> DataFrame:
    """docs: doc_id, raw, text -> doc_id, raw, digest (of the words), keys (none for a text without words)."""

    def work(batches):
        import pyarrow as pa

        words = Words()
        for batch in batches:
            digests, keys = [], []
            for text in batch.column(2):
                w, digest = words.of(text.as_py())
                digests.append(digest)
                keys.append(sketch_keys(labelled_kmers(w), sketches, picks) if len(w) else np.zeros(0, np.int64))
            ends = np.r_[0, np.cumsum([len(k) for k in keys])].astype(np.int32)
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), flat)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "raw", "digest", "keys"])

    return docs.select("doc_id", "raw", "text").mapInArrow(work, "doc_id long, raw long, digest binary, keys array<long>")


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """nodes: id, keys -> key, id, n: the rows of the sketches that more than one node has."""
    rows = nodes.select("id", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(sizes, "key")


def with_leaders(buckets: DataFrame) -> DataFrame:
    """buckets with the column lead: the node of the bucket that meets the most rows in all its buckets."""
    weight = buckets.groupBy("id").agg(F.sum("n").alias("met"))
    leads = buckets.join(weight, "id").groupBy("key").agg(F.max_by("id", F.struct("met", "id")).alias("lead"))
    return buckets.join(leads, "key")


def star_pairs(led: DataFrame) -> DataFrame:
    """a, b with a < b: each leader with each other node of its bucket, each pair once."""
    pairs = led.filter("id <> lead").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
    return pairs.distinct()


def open_nodes(led: DataFrame, roots: DataFrame) -> DataFrame:
    """id, root: the nodes of buckets whose nodes besides the leader are of more than one class."""
    others = led.filter("id <> lead").join(roots, "id", "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    several = others.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("greatest")).filter("least <> greatest")
    return others.join(several.select("key"), "key", "left_semi").select("id", "root").distinct()


def words_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """docs: doc_id, raw, text; nodes: id, doc_id, raw -> id, words: 32-bit hashes of the text's words, each node once."""

    def work(batches):
        import pyarrow as pa

        words = Words()
        for batch in batches:
            out = [words.of(t.as_py())[0].astype("<u4").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "words"])

    of = nodes.select("id", F.col("doc_id").alias("of_id"), F.col("raw").alias("of_raw")).hint("shuffle_hash")
    texts = docs.join(of, docs["doc_id"].eqNullSafe(of["of_id"]) & (docs["raw"] == of["of_raw"]))
    return texts.select("id", "text").mapInArrow(work, "id long, words binary").dropDuplicates(["id"])


def kmers_of(words: DataFrame) -> DataFrame:
    """id, root, words -> id, root, n_kmers, profile, kmers."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            found = [labelled_kmers(np.frombuffer(raw.as_py(), "<u4")) for raw in batch.column(2)]
            sizes = [len(x) for x in found]
            ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
            flat = pa.array((np.concatenate(found) if found else np.zeros(0, np.uint64)).view(np.int64))
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(map(profile, found), pa.binary()), pa.ListArray.from_arrays(pa.array(ends), flat)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "root", "n_kmers", "profile", "kmers"])

    return words.select("id", "root", "words").mapInArrow(work, "id long, root long, n_kmers long, profile binary, kmers array<long>")


def prefix_rows(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """nodes: id, root, n_kmers, kmers -> kmer, id, before: of each node, those of its first k-mers that nodes of several
    classes hold, and up to BEFORE of them that come before in the order. Where they stand in the order: after all k-mers of one class, which need no rows to be counted."""
    rows = nodes.select("id", "root", "n_kmers", F.explode("kmers").alias("kmer"))
    held = rows.groupBy("kmer").agg(F.count(F.lit(1)).alias("holders"), F.min("root").alias("least"), F.max("root").alias("greatest"))
    rows = rows.join(held.filter("least <> greatest").select("kmer", "holders"), "kmer")
    by = W.partitionBy("id")
    before = F.col("n_kmers") - F.count(F.lit(1)).over(by)
    place = before + F.row_number().over(by.orderBy("holders", "kmer"))
    # prefix_length(n_kmers)
    length = F.col("n_kmers") - F.ceil(F.lit(similarity) * F.col("n_kmers") - 1e-9) + 1
    before_it = F.collect_list("kmer").over(by.orderBy("holders", "kmer").rowsBetween(-BEFORE, -1))
    return rows.withColumns({"place": place, "before": before_it}).filter(F.col("place") <= length).select("kmer", "id", "before")


def rest_pairs(nodes: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """nodes: id, root, n_kmers, profile, kmers -> a, b: the pairs of nodes of different roots that share a k-mer of
    their prefixes and whose sizes and profiles leave a link possible, each once."""

    def links_of(i, root, side, n, raw, before):
        # The rows of one block, by size, so that the nodes whose size may fit stand in a row.
        known = np.array([len(x) > 0 for x in raw])
        counts = np.frombuffer(b"".join(x or bytes(BINS) for x in raw), np.uint8).reshape(len(raw), BINS)
        ends = np.searchsorted(n, n / similarity + 1e-6, side="right")
        crossed = side.min() != side.max()
        for at in range(len(i)):
            others = root[at + 1 : ends[at]] != root[at]
            if crossed:
                others &= side[at + 1 : ends[at]] != side[at]
            to = np.flatnonzero(others) + at + 1
            if known[at] and len(to):
                most = np.minimum(counts[to], counts[at]).sum(axis=1, dtype=np.int64)
                to = to[(most >= similarity * (n[at] + n[to] - most) - 1e-9) | ~known[to]]
            if len(to) and before[at]:
                # Two nodes that share an earlier k-mer of both have met there.
                to = to[[before[at].isdisjoint(before[k]) for k in to.tolist()]]
            if len(to):
                yield np.minimum(i[at], i[to]), np.maximum(i[at], i[to])

    def compare(batches):
        import pyarrow as pa

        # Blocks come in a row; the last one of a batch may go on in the next.
        kept = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                kept = table if kept is None else pa.concat_tables([kept, table])
            if kept is None or not kept.num_rows:
                continue
            names = ("kmer", "i", "j", "id", "root", "side", "n_kmers")
            kmer, i, j, node, root, side, n = (kept.column(c).to_numpy() for c in names)
            starts = np.flatnonzero(np.r_[True, (kmer[1:] != kmer[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            ends = np.r_[starts[1:], len(kmer)]
            done = len(starts) if batch is None else len(starts) - 1
            if not done:
                continue
            raw = kept.column("profile").to_pylist()
            before = [set(x) for x in kept.column("before").to_pylist()]
            found = []
            for u, v in zip(starts[:done].tolist(), ends[:done].tolist(), strict=True):
                if v - u > 1:
                    found.extend(links_of(node[u:v], root[u:v], side[u:v], n[u:v], raw[u:v], before[u:v]))
            if found:
                a, b = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            kept = kept.slice(ends[done - 1])

    rows = prefix_rows(nodes, similarity).join(nodes.select("id", "root", "n_kmers", "profile"), "id")
    held = rows.groupBy("kmer").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("greatest"))
    held = held.filter("least <> greatest").select("kmer", F.ceil(F.col("n") / block).alias("blocks"))
    many = rows.join(held, "kmer").withColumn("side", F.pmod(F.xxhash64("id"), "blocks"))
    many = many.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    many = many.select("kmer", F.least("side", "to").alias("i"), F.greatest("side", "to").alias("j"), "id", "root", "side", "n_kmers", "profile", "before")
    many = many.repartition("kmer", "i", "j").sortWithinPartitions("kmer", "i", "j", "n_kmers")
    return many.mapInArrow(compare, "a long, b long").distinct()


def verified_links(pairs: DataFrame, words: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """pairs: a, b; words: id, words -> a, b, similarity of the pairs that pass."""

    def verify(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            known: dict[int, np.ndarray] = {}

            def kmers(i: int, raw, known=known) -> np.ndarray:
                x = known.get(i)
                if x is None:
                    if len(known) >= 64:
                        known.clear()
                    x = known[i] = labelled_kmers(np.frombuffer(raw.as_py(), "<u4"))
                return x

            out = ([], [], [])
            for i, (u, v) in enumerate(zip(a, b, strict=True)):
                s = aligned(kmers(u, batch.column(2)[i]), kmers(v, batch.column(3)[i]), similarity)
                if s:
                    for c, x in zip(out, (u, v, s), strict=True):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["a", "b", "similarity"])

    j = pairs.join(words.select(F.col("id").alias("b"), F.col("words").alias("words_b")), "b")
    j = j.join(words.select(F.col("id").alias("a"), F.col("words").alias("words_a")), "a")
    return j.select("a", "b", "words_a", "words_b").mapInArrow(verify, "a long, b long, similarity double")


def components(links: DataFrame) -> DataFrame:
    """links: a, b -> id, root: equal roots for connected ids. Each round sends every node to the one of
    least hash among itself and its neighbours; chains shorten geometrically, as each round hashes anew."""
    edges = written(links.select("a", "b").filter(F.col("a") != F.col("b")), "edges", few=True)
    labels = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("root"))
    turn = 0
    # Each round's state is written, so lineage stays short.
    while edges.limit(1).count():
        turn += 1
        ends = edges.select("a", "b").union(edges.select("b", "a")).union(edges.select("a", "a")).union(edges.select("b", "b"))
        parent = ends.groupBy("a").agg(F.min_by("b", F.xxhash64(F.lit(turn), "b")).alias("parent"))
        parent = written(parent.select(F.col("a").alias("node"), "parent"), "parents", few=True)
        labels = labels.join(parent, labels["root"] == parent["node"], "left").select("id", F.coalesce("parent", "root").alias("root"))
        labels = written(labels, "labels", few=True)
        moved = edges.join(parent.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
        moved = moved.join(parent.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
        moved = moved.filter(F.col("pa") != F.col("pb")).select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = written(moved.distinct(), "edges", few=True)
    return labels


def near_rows(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, raw (a hash of its text), class_id, class_size (rows), kept."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).withColumn("raw", F.xxhash64("text"))
    # Each row gets a number of its own, which the written table keeps; the least of a text's rows is the node.
    sketched = written(sketches_of(d).withColumn("row", F.monotonically_increasing_id()), "sketches")
    nodes = sketched.groupBy("digest").agg(F.min("row").alias("id"))
    own = sketched.join(nodes.select("id"), F.col("row") == F.col("id"), "left_semi").withColumnRenamed("row", "id")
    led = written(with_leaders(bucket_rows(own)), "buckets")
    met = led.select("id").distinct()
    words = written(words_of(d, own.join(met, "id", "left_semi").select("id", "doc_id", "raw")), "words")
    pairs = written(star_pairs(led), "pairs")
    roots = components(verified_links(pairs, words, similarity))
    opened = open_nodes(led, roots).join(words, "id")
    opened = written(kmers_of(opened), "open")
    rest = written(rest_pairs(opened, similarity).join(pairs, ["a", "b"], "left_anti"), "rest-pairs")
    more = verified_links(rest, words, similarity).select("a", "b")
    of = opened.select("id", "root")
    more = more.join(of.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a").join(of.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b")
    last = components(more.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    # Classes of one node are no root of a link, but may be of the rest.
    roots = roots.join(last.select(F.col("id").alias("root"), F.col("root").alias("whole")), "root", "full")
    roots = roots.select(F.coalesce("id", "root").alias("id"), F.coalesce("whole", "root").alias("root"))
    nodes = nodes.join(roots, "id", "left").select(F.col("digest"), F.coalesce("root", "id").alias("root"))
    rows = written(sketched.select("doc_id", "raw", "digest").join(nodes, "digest").select("doc_id", "raw", "root"), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "raw"))
    classes = rows.groupBy("root").agg(first.alias("first"), F.count(F.lit(1)).alias("class_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("raw") == F.col("first.raw"))
    return rows.join(classes, "root").select("doc_id", "raw", F.col("first.doc_id").alias("class_id"), "class_size", kept.alias("kept"))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, class_size (rows), kept."""
    return near_rows(docs, similarity, doc_id, text).drop("raw")


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one of each class, with their own columns."""
    gone = near_rows(docs, similarity, doc_id, text).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("raw").alias("gone_raw"))
    same = docs[doc_id].cast("long").eqNullSafe(gone["gone_id"]) & (F.xxhash64(text_or_empty(docs[text])) == gone["gone_raw"])
    return docs.join(gone.distinct().hint("shuffle_hash"), same, "left_anti")
