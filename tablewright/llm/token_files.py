"""Token-id output: fixed-width bit packing with block offsets.

Each id takes the least bits that the vocabulary needs. The files form a table of blocks in
ascending doc_id order: shard (file of the range), block, first (ids before it in the shard), bits,
n_ids, doc_ids, offsets (ids before each document in the block, and the end), payload (the ids, bit
after bit, low bits first, padded to whole bytes). Id i of a block lies at bit i * bits, so any
range is read without the rest and unpacked by numpy. The container is Parquet: Spark's
writer commits whole files to any store, and a lost executor leaves nothing half-written. A
document is never split over blocks; a block is closed at BLOCK_IDS ids.

Defined results: null text is empty and has the end id alone; null doc_ids come first; rows of one
doc_id are ordered by text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.shared import table_path, text_or_empty

BLOCK_IDS = 65_536
#: Chunks that the encoder keeps, about 120 MB for each generation: encoding is nearly all of the work here.
CHUNK_LIMIT = 600_000
END_ID = 2
BLOCKS = "shard int, block int, first long, bits int, n_ids long, doc_ids array<long>, offsets array<long>, payload binary"
ROWS = "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """ids as `bits` bits each, low bits first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype="<u4")) & 1
    return np.packbits(spread.astype(np.uint8), bitorder="little").tobytes()


def unpack_bits(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """count ids from id `start` on, reading only the bytes that hold them."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, start * bits // 8).astype("<u4")
    low = start * bits
    raw = np.frombuffer(payload, np.uint8, (low + count * bits + 7) // 8 - low // 8, low // 8)
    flat = np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + count * bits]
    return flat.reshape(count, bits).astype("<u4") @ (np.uint32(1) << np.arange(bits, dtype="<u4"))


def token_blocks(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The blocks of all documents; partitions are ranges of doc_id in ascending order."""

    def work(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tablewright.llm.tokenize import encoder

        enc, end = encoder(tokenizer, CHUNK_LIMIT), end_id.to_bytes(4, "little")
        bits, shard = width(max(enc.vocabulary, end_id + 1)), TaskContext.get().partitionId()
        longs = pa.list_(pa.int64())
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), longs, longs, pa.binary()]
        names, parts, held, number, first = [], [], 0, 0, 0

        def block() -> pa.RecordBatch:
            sizes = [len(p) // 4 for p in parts]
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = [shard, number, first, bits, held, names, [0, *np.cumsum(sizes).tolist()], pack_bits(ids, bits)]
            names_of = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names_of)

        for batch in batches:
            all_names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                for name, ids in zip(all_names[at : at + 256], enc.ids(texts[at : at + 256]), strict=True):
                    names.append(name)
                    parts.append(ids + end)
                    held += len(ids) // 4 + 1
                    if held >= block_ids:
                        yield block()
                        names, parts, number, first, held = [], [], number + 1, first + held, 0
        if names:
            yield block()

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    ordered = d.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return ordered.mapInArrow(work, BLOCKS)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    token_blocks(docs, tokenizer, **options).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            out = [[], [], [], [], []]
            for r in batch.to_pylist():
                ids, at = unpack_bits(r["payload"], r["bits"], 0, r["n_ids"]), r["offsets"]
                raw = memoryview(ids.tobytes())
                for doc_id, a, b in zip(r["doc_ids"], at, at[1:], strict=False):
                    for c, v in zip(out, (r["shard"], doc_id, r["first"] + a, b - a, zlib.crc32(raw[4 * a : 4 * b])), strict=True):
                        c.append(v)
            kinds = [pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    blocks = read_blocks(spark, path)
    # One row per file: the ids of all files before it.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(W.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    base = sizes.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    rows = blocks.select("shard", "first", "bits", "n_ids", "doc_ids", "offsets", "payload").mapInArrow(work, ROWS)
    return rows.join(base, "shard").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read_back(docs: DataFrame, tokenizer: str) -> DataFrame:
    path = table_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_documents(docs.sparkSession, path)
