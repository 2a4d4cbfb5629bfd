"""Packing, token files and counts against the tokenizer libraries; edge cases."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import packing, token_counts, token_files
from tablewright.llm.shared import table_path
from tablewright.llm.tokenize import Encoder, version_digest

WORD, BYTE, PIECE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", "  a", "a  b\n\n c", "foo's it'S 'LL", "Ünïcode é́ é.", "ΣΑΣ. x", "a\x1cb c", "a b", "<|endoftext|> x <|startoftext|>.", "İstanbul.",
    "x.\n y,\tz", "...a.,", "1,234. 5", "ß. ẞ,", " x 　y", "a\r\nb", "'s.", "re.'re, 're.", ". .", "\n", "a\n\n\n   b", "é.É,", "x" * 5000, "straße àéîõü ÇÑß", "ªº µm Ÿ",
    "the same text", "the same text", "word " * 9000,
]


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def docs(spark, texts, ids=None):
    rows = list(zip(ids or range(len(texts)), texts, strict=True))
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"length": F.lit("clash"), "key": F.lit(1), "digest": F.lit(2), "shard": F.lit(3)})


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_cached_encoding_is_exact(path):
    rnd = random.Random(3)
    letters = list("ab'sST.,<|>\n  \t1é́ßΣ\x1c endoftextÀÿ")
    texts = [t for t in ODD if t is not None] + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    e, want = Encoder(path, limit=500), library(path, texts)
    assert e.ids(texts) == [np.array(w, "<u4").tobytes() for w in want]
    assert e.counts(texts) == [len(w) for w in want]


@given(st.integers(1, 2047))
def test_pieces_cover_the_rest(rest):
    p = packing.pieces_of(rest)
    assert sum(p) == rest and min(p) > 0 and len(p) <= 8
    assert all(n * (2048 // n) >= 0.93 * 2048 for n in p)


def test_packing_against_library(spark):
    texts = ODD * 6
    ids = {i: w + [1] for i, w in enumerate(library(WORD, texts))}
    rows = packing.pack(docs(spark, texts).repartition(3), WORD, with_ids=True).collect()
    cover, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and crc(part) == r["ids_crc32"] and np.frombuffer(r["ids"], "<u4").tolist() == part
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        cover[r["doc_id"]].append((r["start"], r["length"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"], r["class"]))
    for k, v in ids.items():
        assert sum(n for _, n in cover[k]) == len(v) and sorted(cover[k])[0][0] == 0 and len({s for s, _ in cover[k]}) == len(cover[k])
    for b in bins.values():
        at = 0
        for offset, n, _ in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048 and len({k for *_, k in b}) == 1 and (b[0][2] in (0, len(b)))
    assert packing.pack(docs(spark, ["x"]).filter("false"), WORD).count() == 0
    assert [r["doc_id"] for r in packing.pack(docs(spark, ["x"], [None]), WORD).collect()] == [None]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.data())
def test_bits_round_trip(bits, data):
    ids = data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=70))
    raw = token_files.pack_bits(np.array(ids, "<u4"), bits)
    assert len(raw) == (len(ids) * bits + 7) // 8
    start = data.draw(st.integers(0, len(ids)))
    count = data.draw(st.integers(0, len(ids) - start))
    assert token_files.unpack_bits(raw, bits, start, count).tolist() == ids[start : start + count]


def test_width():
    assert [token_files.width(n) for n in (1, 2, 3, 256, 257, 50_257, 65_537)] == [1, 1, 2, 8, 9, 16, 17]


def test_token_files_against_library(spark):
    rnd = random.Random(1)
    names = rnd.sample(range(-1000, 1000), len(ODD) - 1) + [None]
    d = docs(spark, ODD, names).repartition(4)
    path = table_path(spark, "t")
    token_files.write_tokens(d, path, BYTE, block_ids=300)
    assert token_files.read_blocks(spark, path).count() >= 2
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_documents(spark, path).collect()}
    at = 0
    for name, ids in sorted(zip(names, library(BYTE, ODD), strict=True), key=lambda x: (x[0] is not None, x[0] or 0)):
        assert got[name] == (at, len(ids) + 1, crc(ids + [2]))
        at += len(ids) + 1
    # Random access inside a block.
    b = token_files.read_blocks(spark, path).orderBy(F.desc("n_ids")).first()
    whole = token_files.unpack_bits(b["payload"], b["bits"], 0, b["n_ids"])
    assert token_files.unpack_bits(b["payload"], b["bits"], 5, 9).tolist() == whole[5:14].tolist()
    assert token_files.write_and_read_back(d.filter("false"), BYTE).count() == 0


def test_repeated_rows_in_files(spark):
    d = docs(spark, ["b", "a", "a"], [1, 1, 1])
    rows = sorted((r["start"], r["n_tokens"]) for r in token_files.write_and_read_back(d, BYTE).collect())
    assert rows == [(0, 2), (2, 2), (4, 2)]


@pytest.mark.parametrize("path", [WORD, PIECE])
def test_counts_and_cache(spark, path):
    cache = table_path(spark, "cache")
    d = docs(spark, ODD)
    if path == PIECE:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(sp.encode(t or "")) for t in ODD]
    else:
        want = [len(w) for w in library(path, ODD)]
    got = {r["doc_id"]: r for r in token_counts.count_tokens(d, path, cache).collect()}
    for i, (t, n) in enumerate(zip(ODD, want, strict=True)):
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 2048)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for t in ODD}) and {r["tokenizer"] for r in stored.select("tokenizer").distinct().collect()} == {version_digest(path)}
    # A second run encodes only what is new.
    more = docs(spark, [*ODD, "something new"])
    token_counts.count_tokens(more, path, cache).collect()
    assert spark.read.parquet(cache).count() == stored.count() + 1


def test_counts_edges(spark):
    assert token_counts.count_tokens(docs(spark, ["x"]).filter("false"), WORD, table_path(spark, "c")).count() == 0
    got = token_counts.count_tokens(docs(spark, ["x", "x", None], [None, None, 3]), WORD, table_path(spark, "c")).collect()
    assert sorted((r["doc_id"] is None, r["n_tokens"]) for r in got) == [(False, 0), (True, 1), (True, 1)]
