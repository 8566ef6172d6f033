"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram.

A document is its token ids and a closing 0. It is cut into pieces of ``max_len`` ids and one rest;
each piece is a row with its ids. Only the histogram of piece lengths (at most ``max_len`` bins,
whatever the corpus size) reaches the driver. There lengths are placed longest first: each goes to
the shortest open packing pattern that has room, and the patterns' counts are updated, so the number
of patterns stays under about two per length. Pieces meet their slot in a pattern by their rank
among the pieces of their length.

Ranks come without any group in one task: pieces are numbered within (length, salt), the salts'
counts give offsets, and the number of salts follows the corpus size.

Defined results: a null or empty text is the single id 0. A document of any length is cut without
loss. Repeated rows are packed once per row. An empty table gives an empty result. Other columns of
the input are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, batch, bounded_batches
from .tokens import default_paths, encode

MAX_LEN = 1024
#: About so many pieces share a (length, salt) group when all have the same length.
PIECES_PER_SALT = 20_000

_PIECES = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
PIECES_DDL = "row_id long, doc_id long, start long, length long, doc_tokens long, ids binary"


class Pattern(NamedTuple):
    """``count`` sequences that hold pieces of these lengths, in this order."""

    count: int
    lengths: tuple[int, ...]


def shortest_pack_first(histogram: dict[int, int], max_len: int) -> list[Pattern]:
    """Patterns that hold every piece of the histogram {length: number}."""
    open_by_room: dict[int, list[list]] = defaultdict(list)  # room left -> [count, lengths]
    done: list[Pattern] = []

    def put(count: int, lengths: tuple[int, ...], room: int) -> None:
        if room:
            open_by_room[room].append([count, lengths])
        else:
            done.append(Pattern(count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        # shortest pack: most room first; a pack that just got this length may get it again
        while left:
            room = max((r for r, packs in open_by_room.items() if packs and r >= length), default=None)
            if room is None:
                times = max_len // length
                whole, over = divmod(left, times)
                if whole:
                    put(whole, (length,) * times, max_len - times * length)
                if over:
                    put(1, (length,) * over, max_len - over * length)
                break
            pack = open_by_room[room][-1]
            n = min(left, pack[0])
            if n == pack[0]:
                open_by_room[room].pop()
            else:
                pack[0] -= n
            put(n, (*pack[1], length), room - length)
            left -= n
    done.extend(Pattern(c, ls) for packs in open_by_room.values() for c, ls in packs)
    return sorted(done)


class Slots(NamedTuple):
    """For each length the runs of ranks and the slot that each run fills."""

    key: np.ndarray  # length << 40 | first rank of the run, sorted
    sequence: np.ndarray  # sequence of the run's first rank
    offset: np.ndarray


def slots(patterns: list[Pattern]) -> tuple[Slots, int]:
    key, seq, off = [], [], []
    used: dict[int, int] = defaultdict(int)
    base = 0
    for p in patterns:
        at = 0
        for length in p.lengths:
            key.append(length << 40 | used[length])
            seq.append(base)
            off.append(at)
            used[length] += p.count
            at += length
        base += p.count
    order = np.argsort(np.array(key, np.int64), kind="stable")
    return Slots(*(np.array(x, np.int64)[order] for x in (key, seq, off))), base


def tokenize(docs: DataFrame, max_len: int, paths, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pieces with their ids as little-endian unsigned 32-bit numbers."""

    def run(batches):
        for b in batches:
            rows, ids, texts = (b.column(i).to_pylist() for i in range(3))
            out: dict[str, list] = {f.name: [] for f in _PIECES}
            size = 0
            for r, d, t in zip(rows, ids, texts, strict=True):
                tok = np.append(encode(t or "", paths), np.uint32(0)).astype("<u4")
                for s in range(0, len(tok), max_len):
                    part = tok[s : s + max_len]
                    for k, v in zip(_PIECES.names, (r, d, s, len(part), len(tok), part.tobytes()), strict=True):
                        out[k].append(v)
                size += len(tok)
                if size > 4_000_000:
                    yield batch(_PIECES, **out)
                    out, size = {f.name: [] for f in _PIECES}, 0
            yield batch(_PIECES, **out)

    src = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return src.mapInArrow(run, PIECES_DDL)


def place(keys: DataFrame, histogram: dict[int, int], max_len: int, carry: list[str]) -> DataFrame:
    """Adds sequence_id and offset to rows that have row_id, start and length."""
    total = sum(histogram.values())
    salts = max(16, total // PIECES_PER_SALT)
    table, _ = slots(shortest_pack_first(histogram, max_len))
    cols = [c for c in carry if c not in ("row_id", "start", "length")]
    keys = keys.withColumn("salt", F.pmod(F.xxhash64("row_id", "start"), F.lit(salts)))
    counts = keys.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = keys.withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy("row_id", "start")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("r"))
    names = ["row_id", "start", "length", *cols]
    src = ranked.select(*names, "rank")
    schema = src.select(*names).schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = b.column(b.schema.get_field_index("rank")).to_numpy(zero_copy_only=False)
            key = (length.astype(np.int64) << 40) | rank
            at = np.searchsorted(table.key, key, "right") - 1
            seq = table.sequence[at] + key - table.key[at]
            keep = [b.column(b.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(seq), pa.array(table.offset[at])], names=[*names, "sequence_id", "offset"])

    return src.mapInArrow(run, schema)


class Packed(NamedTuple):
    pieces: DataFrame  # row_id, doc_id, start, length, doc_tokens, ids
    placed: DataFrame  # row_id, start, length, the extra columns, sequence_id, offset

    def sequences(self) -> DataFrame:
        """Pieces with ids and place, for writing."""
        return self.pieces.join(self.placed.select("row_id", "start", "sequence_id", "offset"), ["row_id", "start"])


def pack(spark: SparkSession, docs: DataFrame, max_len: int = MAX_LEN, paths=None, text: str = "text", doc_id: str = "doc_id", digest: dict | None = None) -> Packed:
    """Tokenise, cut and place ``docs``. ``digest`` adds columns computed from each stored piece."""
    bounded_batches(spark)
    scratch = Scratch(spark, "packing")
    pieces = scratch.write(tokenize(docs, max_len, paths or default_paths(), text, doc_id), "pieces", "zstd")
    digest = digest or {}
    extra = {"doc_id": F.col("doc_id"), "doc_tokens": F.col("doc_tokens")} | digest
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most max_len rows
    keys = pieces.select("row_id", "start", "length", *[c.alias(n) for n, c in extra.items()])
    return Packed(pieces, place(keys, histogram, max_len, list(extra)))
