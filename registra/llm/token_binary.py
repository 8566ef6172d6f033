"""Token-id matrices: best-fit-decreasing packing with a segment tree over the free capacity.

Every task packs its own rows in blocks of at most ``block_ids`` ids, so nothing is shuffled and a
block's memory is bounded; a document is never dropped: one longer than a row is cut into full rows
and a rest. Within a block pieces are taken longest first. A segment tree over capacities 0..row
length marks which capacities some open row has; the search for the least capacity that fits walks
down from the root in log(row length) steps.

Each result row is one packed row: its padded ids, the cumulative segment lengths and the positions
that restart at 0 with every segment (and run on over the padding, which forms a last segment of its own).
``write_matrix`` stores them as Parquet, a matrix row in a cell of little-endian unsigned 32-bit numbers, and
gives what is stored.

Which documents share a block, and so a row, hangs on how the input is split into tasks: a ``sequence_id``
names a row of one result, and reruns over another split give other rows of the same pieces.

Defined results: a null or empty text is the single id 0; an empty table gives an empty result;
repeated rows are packed once per row; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, bounded_batches
from .tokens import default_paths, encode

ROW_LEN = 2048
BLOCK_IDS = 4_000_000

_OUT = pa.schema([
    ("sequence_id", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())),
    ("n_tokens", pa.int64()), ("ids", pa.binary()), ("positions", pa.binary()),
])
DDL = "sequence_id string, doc_ids array<bigint>, starts array<bigint>, cu_seqlens array<int>, n_tokens bigint, ids binary, positions binary"


class CapacityTree:
    """Which capacities 1..size some open row has, and the least one that is large enough."""

    def __init__(self, size: int):
        self.n = 1 << size.bit_length()
        self.count = [0] * (2 * self.n)

    def add(self, capacity: int, by: int) -> None:
        i = capacity + self.n
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, need: int) -> int:
        """The least capacity >= need that is present, or 0."""
        i = need + self.n
        if self.count[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.n:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.n
            i >>= 1
        return 0


def best_fit_decreasing(lengths: list[int], row_len: int) -> list[list[int]]:
    """Indexes of the pieces of each row."""
    tree = CapacityTree(row_len)
    at: dict[int, list[int]] = {}
    rows: list[list[int]] = []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need = lengths[k]
        room = tree.least(need)
        if room:
            r = at[room].pop()
            tree.add(room, -1)
        else:
            r, room = len(rows), row_len
            rows.append([])
        rows[r].append(k)
        if room > need:
            at.setdefault(room - need, []).append(r)
            tree.add(room - need, 1)
    return rows


def pack_rows(spark: SparkSession, docs: DataFrame, row_len: int = ROW_LEN, block_ids: int = BLOCK_IDS, paths=None, text: str = "text", doc_id: str = "doc_id", pad: int = 0) -> DataFrame:
    bounded_batches(spark)
    paths = paths or default_paths()

    def flush(part: int, block: int, pieces: list[tuple[int, int, np.ndarray]]):
        rows = best_fit_decreasing([len(p[2]) for p in pieces], row_len)
        step = 1000
        for lo in range(0, len(rows), step):
            out: dict[str, list] = {f.name: [] for f in _OUT}
            for n, row in enumerate(rows[lo : lo + step], lo):
                segs = [pieces[k] for k in row]
                cu = np.cumsum([0, *(len(s[2]) for s in segs)])
                ids = np.full(row_len, pad, "<u4")
                pos = np.arange(row_len, dtype="<u4")
                for (_, _, t), a, b in zip(segs, cu[:-1], cu[1:], strict=True):
                    ids[a:b] = t
                    pos[a:b] = np.arange(b - a)
                pos[cu[-1] :] -= pos.dtype.type(cu[-1])
                for k, v in zip(_OUT.names, (f"{part:06d}-{block:06d}-{n:06d}", [s[0] for s in segs], [s[1] for s in segs], cu.tolist(), int(cu[-1]), ids.tobytes(), pos.tobytes()), strict=True):
                    out[k].append(v)
            yield batch(_OUT, **out)

    def run(batches):
        from pyspark import TaskContext

        part, block, held, pieces = TaskContext.get().partitionId(), 0, 0, []
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tok = np.append(encode(t or "", paths), np.uint32(0)).astype("<u4")
                for s in range(0, len(tok), row_len):
                    piece = tok[s : s + row_len]
                    pieces.append((d, s, piece))
                    held += len(piece)
                    if held >= block_ids:
                        yield from flush(part, block, pieces)
                        block, held, pieces = block + 1, 0, []
        yield from flush(part, block, pieces)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, DDL)


def write_matrix(rows: DataFrame, path: str) -> DataFrame:
    """Packed rows written as Parquet, the id and position matrices as binary rows, and what is then read
    from the files. A task that is lost writes its file anew; the folder appears whole or not at all."""
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
