"""Harmonic packing into sequences of a fixed capacity.

Lengths fall into classes by reciprocal capacity: class k holds pieces of up to capacity/k ids, and
each of its bins takes k pieces, whatever they are. A document is cut so that its pieces nearly
fill their class's share: first whole bins, then, of the rest r, the whole rest if k = capacity//r of
them fill at least `fill` of a bin, else a piece of exactly capacity//(k+1) ids for the next class,
and so on with what is left. The rest shrinks about quadratically, so there are few cuts.

Every worker fills its own bins and never looks at another's: there is no shuffle. Pieces wait
until their bin is full, at most k for each of about a hundred classes. What waits when the rows
end is laid end to end, largest first, and cut at the capacity, so a worker pads the equal of one
bin besides what the fixed counts leave.

Defined results: null text is empty and has one id, the end id; a null doc_id stays null; repeated
rows are separate documents; an empty table gives no rows; other columns are ignored. Rerun tasks
read the same rows and give the same sequences.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import text_or_empty

CAPACITY = 2048
FILL = 0.98
END_ID = 1
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, class long"
)
#: Sequence numbers of one worker.
WORKER_BITS = 40


@functools.lru_cache(maxsize=1 << 16)
def pieces_of(rest: int, capacity: int = CAPACITY, fill: float = FILL) -> tuple[int, ...]:
    """Lengths, in order, into which the last `rest` < capacity ids of a document are cut."""
    if not rest:
        return ()
    k = capacity // rest
    if rest * k >= fill * capacity:
        return (rest,)
    share = capacity // (k + 1)
    return (share, *pieces_of(rest - share, capacity, fill))


class Bins:
    """One worker's bins. add() and rest() give placed pieces: (piece, sequence, offset, class)."""

    def __init__(self, first: int, capacity: int = CAPACITY):
        self.next, self.capacity, self.waiting = first, capacity, {}

    def _close(self, k: int, pieces: list) -> Iterator[tuple]:
        offset = 0
        for p in pieces:
            yield p, self.next, offset, k
            offset += len(p[2]) // 4
        self.next += 1

    def add(self, doc_id: int | None, start: int, ids: bytes, total: int) -> Iterator[tuple]:
        k = self.capacity // (len(ids) // 4)
        bin_ = self.waiting.setdefault(k, [])
        bin_.append((doc_id, start, ids, total))
        if len(bin_) == k:
            del self.waiting[k]
            yield from self._close(k, bin_)

    def rest(self) -> Iterator[tuple]:
        left, room = [], self.capacity
        for k in sorted(self.waiting):
            for doc_id, start, ids, total in self.waiting[k]:
                while ids:
                    take = min(room, len(ids) // 4)
                    left.append((doc_id, start, ids[: 4 * take], total))
                    ids, start, room = ids[4 * take :], start + take, room - take
                    if not room:
                        yield from self._close(0, left)
                        left, room = [], self.capacity
        if left:
            yield from self._close(0, left)
        self.waiting = {}


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    fill: float = FILL,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, class (0: laid
    end to end at a worker's end) and, with_ids, the ids as little-endian unsigned 32-bit bytes."""

    def work(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tablewright.llm.tokenize import encoder

        enc, end = encoder(tokenizer), end_id.to_bytes(4, "little")
        bins = Bins(TaskContext.get().partitionId() << WORKER_BITS, capacity)

        def table(placed: list) -> pa.RecordBatch:
            cols = zip(*[(d, s, len(i) // 4, zlib.crc32(i), t, q, o, k, *([i] * with_ids)) for (d, s, i, t), q, o, k in placed], strict=True)
            kinds = [pa.int64()] * 8 + [pa.binary()] * with_ids
            names = [*SCHEMA.replace(" long", "").split(", "), *["ids"] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        placed = []
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                for name, ids in zip(names[at : at + 256], enc.ids(texts[at : at + 256]), strict=True):
                    ids += end
                    total, start = len(ids) // 4, 0
                    whole = total // capacity
                    for n in (*[capacity] * whole, *pieces_of(total - whole * capacity, capacity, fill)):
                        placed += bins.add(name, start, ids[4 * start : 4 * (start + n)], total)
                        start += n
                if len(placed) >= 4096:
                    yield table(placed)
                    placed = []
        placed += bins.rest()
        if placed:
            yield table(placed)

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return d.mapInArrow(work, SCHEMA + ", ids binary" * with_ids)
