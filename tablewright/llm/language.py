r"""Language identification by prediction by partial matching.

Per language a context tree of orders 0 to 3 over bytes is counted from a bounded sample of labelled
rows and then frozen. A byte's probability in a context is n / (T + D), an escape's is D / (T + D),
with T symbols and D distinct ones seen there; after an escape the next shorter context is asked,
contexts that were never seen cost nothing, and below order 0 all 256 bytes are alike. A text's
code length in a language is the exact sum over all its bytes; the shortest wins, and the score
is its posterior probability under equal priors.

With frozen counts the cost of a byte depends on it and the three bytes before only. Costs are laid out once, for all
languages side by side: dense tables for orders 0 and 1, and for orders 2 and 3 a row for each string of three or four
bytes that any language has seen, found by hashing, so texts are scored by numpy gathers. All 256 bytes and every
context of the sample count. Texts are preceded by three line feeds, in training and in scoring.

The sample is bounded: max_docs rows of a language, each of max_doc_bytes at most, in the order of a hash of doc_id. The
model is broadcast and has at most max_model_bytes; training stops with an error beyond (some 30 MB for each language
in practice), and the sample must then be made smaller.

Defined results: `und` with score 0 for null text or a text without a letter, and for all texts if no
labelled row was there to learn from; equal lengths go to the first language in order; a null doc_id
counts as ''; null lang is never learned; repeated rows are separate; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 3
PAD = b"\n" * ORDER
MAX_DOCS, MAX_DOC_BYTES = 400, 65_536
MAX_MODEL_BYTES = 1 << 29
#: Bytes that are scored at a time.
BLOCK = 1 << 18
UNKNOWN = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, bits double"


class Rows:
    """Numbers of known keys, by open addressing: all keys of an array are looked up at a time."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.key = np.zeros(1 << self.bits, np.uint32)
        self.row = np.full(1 << self.bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = np.flatnonzero(self.row[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.key[at[won]], self.row[at[won]] = keys[left[won]], left[won]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, at = left[rest], (at[rest] + 1) & (len(self.key) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for unknown ones."""
        at = self._place(keys)
        out = self.row[at]
        left = np.flatnonzero((out >= 0) & (self.key[at] != keys))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.key) - 1)
            out[left] = self.row[at]
            wrong = (out[left] >= 0) & (self.key[at] != keys[left])
            left, at = left[wrong], at[wrong]
        return out


@dataclass
class Model:
    """Bits: a column for each language. Keys are bytes in text order, the coded byte last."""

    languages: list[str]
    one: np.ndarray  # (two bytes) -> cost in order 1
    escape_two: np.ndarray  # (two bytes) -> escape of that context
    threes: Rows
    two: np.ndarray  # row of three bytes -> cost in order 2
    escape_three: np.ndarray  # row of three bytes -> escape of that context
    fours: Rows
    three: np.ndarray  # row of four bytes -> cost in order 3

    @property
    def size(self) -> int:
        parts = (self.one, self.escape_two, self.two, self.escape_three, self.three, self.threes.key, self.threes.row, self.fours.key, self.fours.row)
        return sum(p.nbytes for p in parts)

    def order_two(self, keys: np.ndarray) -> np.ndarray:
        """Costs of strings of three bytes in order 2."""
        row = self.threes.find(keys)
        out = self.two[row]
        new = np.flatnonzero(row < 0)
        out[new] = self.escape_two[keys[new] >> 8] + self.one[keys[new] & 0xFFFF]
        return out

    def costs(self, keys: np.ndarray) -> np.ndarray:
        """Costs of strings of four bytes."""
        row = self.fours.find(keys)
        out = self.three[row]
        new = np.flatnonzero(row < 0)
        out[new] = self.order_two(keys[new] & 0xFFFFFF)
        context = self.threes.find(keys[new] >> 8)
        seen = context >= 0
        out[new[seen]] += self.escape_three[context[seen]]
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths in bits: a row for each text, a column for each language."""
        out = np.zeros((len(texts), len(self.languages)))
        group, held = [], 0
        for i, t in enumerate(texts):
            for at in range(0, len(t), BLOCK):
                part = (PAD if not at else t[at - ORDER : at]) + t[at : at + BLOCK]
                if held + len(part) > BLOCK + ORDER and group:
                    self._add(out, group)
                    group, held = [], 0
                group.append((i, part))
                held += len(part)
        if group:
            self._add(out, group)
        return out

    def _add(self, out: np.ndarray, group: list[tuple[int, bytes]]) -> None:
        s = np.frombuffer(b"".join(p for _, p in group), np.uint8)
        bits = np.cumsum(self.costs(strings(s, 4)), axis=0, dtype=np.float64)
        bits = np.vstack([np.zeros((1, bits.shape[1])), bits])
        ends = np.cumsum([len(p) for _, p in group])
        starts = ends - [len(p) for _, p in group]
        np.add.at(out, [i for i, _ in group], bits[ends - ORDER] - bits[starts])


def strings(s: np.ndarray, length: int) -> np.ndarray:
    """All strings of so many bytes, as numbers."""
    out = np.zeros(max(0, len(s) - length + 1), np.uint32)
    for i in range(length):
        out = (out << np.uint32(8)) | s[i : len(s) - length + 1 + i]
    return out


def _seen(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct strings with their costs, their contexts with the escapes' costs."""
    u, n = np.unique(grams, return_counts=True)
    contexts, at = np.unique(u >> 8, return_inverse=True)
    total, kinds = np.bincount(at, n), np.bincount(at)
    return u, -np.log2(n / (total + kinds)[at]) if len(u) else np.zeros(0), contexts, -np.log2(kinds / (total + kinds))


def train(samples: dict[str, list[bytes]], max_model_bytes: int = MAX_MODEL_BYTES) -> Model:
    languages = sorted(samples)
    grams = {}
    for g in languages:
        # Four bytes that end inside a text; each text has its own bytes in front.
        joined = np.frombuffer(b"".join(PAD + t for t in samples[g]), np.uint8)
        inside = np.concatenate([np.r_[np.zeros(ORDER, bool), np.ones(len(t), bool)] for t in samples[g]] or [np.zeros(0, bool)])
        grams[g] = strings(joined, 4)[inside[ORDER:]]
    every = np.unique(np.concatenate([np.zeros(0, np.uint32), *grams.values()]))
    threes = np.unique(np.concatenate([every & 0xFFFFFF, every >> 8]))
    shape = len(languages)
    table = lambda n: np.zeros((max(1, n), shape), np.float32)
    m = Model(languages, table(1 << 16), table(1 << 16), Rows(threes), table(len(threes)), table(len(threes)), Rows(every), table(len(every)))
    if m.size > max_model_bytes:
        raise ValueError(f"the language model has {m.size} bytes, more than {max_model_bytes}: take fewer or shorter samples")
    for k, g in enumerate(languages):
        x = grams[g]
        zero = np.full(256, 8.0)
        u, cost, contexts, escape = _seen(x & 0xFF)
        zero += escape[0] if len(escape) else 0.0
        zero[u] = cost
        u, cost, contexts, escape = _seen(x & 0xFFFF)
        one = np.tile(zero, 256).reshape(256, 256)
        one[contexts] += escape[:, None]
        one = one.ravel()
        one[u] = cost
        m.one[:, k] = one
        u, cost, contexts, escape = _seen(x & 0xFFFFFF)
        m.escape_two[contexts, k] = escape
        m.two[: len(threes), k] = m.escape_two[threes >> 8, k] + m.one[threes & 0xFFFF, k]
        m.two[m.threes.find(u), k] = cost
        u, cost, contexts, escape = _seen(x)
        m.escape_three[m.threes.find(contexts), k] = escape
        m.three[: len(every), k] = m.escape_three[m.threes.find(every >> 8), k] + m.two[m.threes.find(every & 0xFFFFFF), k]
        m.three[m.fours.find(u), k] = cost
    return m


def fold(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def training_rows(docs: DataFrame, max_docs: int = MAX_DOCS, max_doc_bytes: int = MAX_DOC_BYTES, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, list[bytes]]:
    """The sample: max_docs rows of each language by hash. Languages are first counted, so that a
    threshold on the hash leaves about twice as many rows as are wanted, whatever the table's size."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (fold(doc_id) != 1) & (F.octet_length(text) <= max_doc_bytes))
    place = F.shiftrightunsigned(F.xxhash64(F.lit("ppm"), F.col(doc_id)), 32)
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # a row for each language
    limit = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, min(2**32, 2**32 * 2 * max_docs // n + 2**32 * 40 // n))]) if counts else None
    if limit is None:
        return {}
    near = rows.filter(place < limit[F.col(lang)]).select(F.col(lang).alias("g"), place.alias("p"), F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    near = near.groupBy("g").agg(F.slice(F.sort_array(F.collect_list(F.struct("p", "d", "t"))), 1, max_docs).alias("rows"))
    return {r["g"]: [x["t"].encode() for x in r["rows"]] for r in near.collect()}


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_docs: int = MAX_DOCS, max_doc_bytes: int = MAX_DOC_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, bits (the code length)."""
    samples = training_rows(docs, max_docs, max_doc_bytes, doc_id, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(train(samples) if samples else None)

    def work(batches):
        import pyarrow as pa
        import regex

        model, letter = shared.value, regex.compile(r"\p{L}")
        for batch in batches:
            texts = batch.column(2).to_pylist()
            told = [i for i, t in enumerate(texts) if model and t and letter.search(t)]
            bits = model.lengths([texts[i].encode() for i in told]) if told else np.zeros((0, 1))
            best = bits.argmin(1)
            least = bits.min(1) if told else np.zeros(0)
            sure = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
            names, score, length = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            for i, b, s, n in zip(told, best, sure, least, strict=True):
                names[i], score[i], length[i] = model.languages[b], float(s), float(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names), pa.array(score), pa.array(length)], ["doc_id", "held_out", "lang_pred", "score", "bits"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (fold(doc_id) == 1).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(work, SCHEMA)
