"""Byte-level BPE encoding and decoding over padded matrices.

A text is split by a pattern; the distinct matches of a batch are merged together. Those of about one
length share a padded matrix with one row each. In every round each row merges its leftmost pair of
least rank: the ranks of neighbours stand in a second matrix, the column behind each merge is squeezed
out, and only the two pairs beside a merge are looked up again, in an open-addressing hash table of all
pairs that the vocabulary can merge. Rows without a pair leave the matrix. A match that is a token
itself is taken whole, as the rank library does. Matches of more than ``MAX_ROW`` bytes, on which a
matrix would take quadratic time, are merged in the same order by a heap.

``encode`` and ``decode`` run in place in each partition, without a shuffle. Ids are stored as
little-endian unsigned 32-bit numbers.

Defined results: a null or empty text has no ids; texts of any length are encoded whole; repeated rows
give repeated results; an empty table gives an empty one. Other columns ride along, and one that is
named like a result gives way to it. Null ids decode to no bytes; an id outside the vocabulary, or ids
whose bytes are no multiple of four, raise ValueError.
"""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import bounded_batches

#: Longest match that goes through the matrices, in bytes.
MAX_ROW = 1024
#: Cells of one matrix, and characters of the texts that are encoded together.
CELLS = 1 << 21
CHARS = 2_000_000
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128, 256, 512, MAX_ROW)
NONE = np.int32(2**31 - 1)
# Letters and numbers that later versions of Unicode have than version 16, by which the rank
# library splits. The pattern's classes leave them out, whatever version the installed ``regex`` knows.
LATER_LETTERS = (
    "\\u0558\\u058b\\u058c\\u088f\\u0c5c\\u0cdc\\u208f\\u209d-\\u209f\\ua7ce\\ua7cf\\ua7d2\\ua7d4\\ua7dd\\ua7e2\\ua7f1\\uab6c\\uab6d\\U000107bb-\\U000107bf"
    "\\U00010940-\\U00010959\\U00010ec5-\\U00010ec7\\U00010ed9-\\U00010eee\\U00011b0a\\U00011db0-\\U00011ddb\\U00011df1\\U00016ea0-\\U00016eb8\\U00016ebb-\\U00016ed3"
    "\\U00016ff2\\U00016ff3\\U000187f8-\\U000187ff\\U00018cd6-\\U00018cda\\U00018d09-\\U00018d20\\U00018d80-\\U00018df2\\U00018e00-\\U00019191\\U000191a0-\\U000191d2"
    "\\U0001b123-\\U0001b128\\U0001b168\\U0001d6a6\\U0001df1f-\\U0001df24\\U0001df2b-\\U0001df81\\U0001df90-\\U0001df96\\U0001dfcd-\\U0001dfff\\U0001e6c0-\\U0001e6de"
    "\\U0001e6e0-\\U0001e6e2\\U0001e6e4\\U0001e6e5\\U0001e6e7-\\U0001e6ed\\U0001e6f0-\\U0001e6f4\\U0001e6fe\\U0001e6ff\\U0002b73a-\\U0002b73f\\U0002b81e\\U0002cea2-\\U0002cead"
    "\\U000323b0-\\U00033479\\U0003d000-\\U0003fc3f"
)
LATER_NUMBERS = "\\U00011de0-\\U00011de9\\U0001246f\\U00012475-\\U0001247f\\U00012550-\\U00012686\\U00016ff4-\\U00016ff6"
_MULT = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of every pair (left id, right id) whose joined bytes are a token, by hash."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(4 * len(left)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        key = self.key(left, right)
        at, todo = self.slot(key), np.arange(len(key))
        while len(todo):  # of the keys that want a free slot the last takes it, the others move on
            free = todo[self.keys[at[todo]] == -1]
            self.keys[at[free]] = key[free]
            todo = todo[self.keys[at[todo]] != key[todo]]
            at[todo] = (at[todo] + 1) & self.mask
        self.ranks[at] = rank

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _MULT) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = self.key(left, right)
        at = self.slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.ranks[at], NONE)
        more = np.nonzero((found != key) & (found != -1))
        while len(more[0]):
            at[more] = (at[more] + 1) & self.mask
            found = self.keys[at[more]]
            hit = found == key[more]
            out[more] = np.where(hit, self.ranks[at[more]], NONE)
            on = ~hit & (found != -1)
            more = tuple(m[on] for m in more)
        return out


class Vocabulary:
    """Tokens by rank, which is also the id, and the pairs that merge into them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, splitter(pattern)
        self.tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            self.tokens[r] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pad = np.int32(len(self.tokens))
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pairs = PairTable(*np.array(pairs, np.int32).reshape(-1, 3).T)

    def merge_matrix(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a padded matrix one after the other, and the number of ids of each row."""
        n, rows = len(m), np.arange(len(m))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self.pairs(m[:, :-1], m[:, 1:])
        while len(m):
            here = np.arange(len(m))
            at = rank.argmin(1) if rank.shape[1] else np.zeros(len(m), np.int64)
            best = rank[here, at] if rank.shape[1] else np.full(len(m), NONE)
            on = best != NONE
            if not on.all():
                done.append((rows[~on], m[~on]))
                rows, m, rank, at, best = rows[on], m[on], rank[on], at[on], best[on]
                if not len(m):
                    break
                here = np.arange(len(m))
            m[here, at] = best
            keep = np.ones(m.shape, bool)
            keep[here, at + 1] = False
            m = m[keep].reshape(len(m), -1)
            keep = np.ones(rank.shape, bool)
            keep[here, at] = False
            rank = rank[keep].reshape(len(m), -1)
            left, right = here[at > 0], here[at < m.shape[1] - 1]
            rank[left, at[left] - 1] = self.pairs(m[left, at[left] - 1], m[left, at[left]])
            rank[right, at[right]] = self.pairs(m[right, at[right]], m[right, at[right] + 1])
        count = np.zeros(n, np.int64)
        for r, x in done:
            count[r] = (x != self.pad).sum(1)
        start = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for r, x in done:
            real = x != self.pad
            out[(start[r][:, None] + np.arange(x.shape[1]))[real]] = x[real]
        return out, count

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges in the same order, for one long piece, by a heap of (rank, place)."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        joined = lambda a, b: self.ranks.get(self.tokens[a] + self.tokens[b])
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := joined(ids[i], ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j == len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids) and (q := joined(ids[x], ids[y])) is not None:
                    heapq.heappush(heap, (q, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and the number of ids of each."""
        raw = [p.encode() for p in pieces]
        whole = np.array([self.ranks.get(p, -1) for p in raw], np.int32)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        buf, first = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size
        parts = [(np.flatnonzero(whole >= 0), whole[whole >= 0], np.ones(int((whole >= 0).sum()), np.int64))]
        open_ = whole < 0
        narrow = 1
        for width in WIDTHS:
            chosen = np.flatnonzero(open_ & (size > narrow) & (size <= width))
            narrow = width
            for k in range(0, len(chosen), CELLS // width):
                rows = chosen[k : k + CELLS // width]
                col = np.arange(width)
                inside = col < size[rows][:, None]
                at = np.minimum(first[rows][:, None] + col, len(buf) - 1)
                parts.append((rows, *self.merge_matrix(np.where(inside, self.single[buf[at]], self.pad))))
        for i in np.flatnonzero(open_ & (size > MAX_ROW)):
            ids = self.merge_long(raw[i])
            parts.append((np.array([i]), ids, np.array([len(ids)])))
        count = np.zeros(len(raw), np.int64)
        for rows, _, c in parts:
            count[rows] = c
        start = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for rows, ids, c in parts:
            out[spread(start[rows], c)] = ids
        return out, count

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        found = [self.split(t) for t in texts]
        size = [len(x) for x in found]
        flat = [p for x in found for p in x]
        pieces = dict.fromkeys(flat)
        ids, count = self.merge(list(pieces))
        pieces.update(zip(pieces, range(len(pieces)), strict=True))
        code = np.fromiter(map(pieces.__getitem__, flat), np.int64, len(flat))
        start = np.cumsum(count) - count
        out = ids[spread(start[code], count[code])].astype(np.uint32)
        ends = np.concatenate([[0], np.cumsum(count[code])])[np.cumsum(size)] if len(size) else []
        return np.split(out, ends[:-1]) if len(size) else []

    def decode(self, ids: np.ndarray) -> bytes:
        try:
            return b"".join([self.tokens[i] for i in ids.tolist()])
        except (IndexError, TypeError):
            raise ValueError("an id is not in the vocabulary") from None


def splitter(pattern: str):
    """Function that gives the matches of the pattern in a text, with the letters and numbers of Unicode 16."""
    import regex

    old = pattern.replace(r"\p{L}", rf"[\p{{L}}--[{LATER_LETTERS}]]").replace(r"\p{N}", rf"[\p{{N}}--[{LATER_NUMBERS}]]")
    plain, exact = regex.compile(pattern).findall, regex.compile(old, regex.V1).findall
    later = frozenset(regex.findall(rf"[{LATER_LETTERS}{LATER_NUMBERS}]", "".join(map(chr, range(0x500, 0xD800))) + "".join(map(chr, range(0xE000, 0x40000)))))
    return lambda text: plain(text) if text.isascii() or later.isdisjoint(text) else exact(text)


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for count[0] places, then the same of the next."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - ends + count, count)


@functools.cache
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One a Python worker and file of ranks."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers as p

    return p.path("byte_bpe_multi_50k.tiktoken"), p.PATTERN


def _added(df: DataFrame, *fields: StructField) -> tuple[list[str], StructType]:
    """Columns of ``df`` that stay beside the new ones, and the schema of both."""
    gone = {f.name.lower() for f in fields}
    stay = [f for f in df.schema if f.name.lower() not in gone]
    return [f.name for f in stay], StructType([*stay, *fields])


def groups_of(texts: list[str], most: int):
    """Runs of texts of about ``most`` characters."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(spark: SparkSession, docs: DataFrame, vocab: tuple[str, str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and ids of the texts."""
    bounded_batches(spark)
    names, schema = _added(docs, StructField("n_tokens", LongType()), StructField("ids", BinaryType()))
    vocab = vocab or default_vocabulary()

    def run(batches):
        v = vocabulary(*vocab)
        for b in batches:
            n = len(names)
            texts = [t or "" for t in b.column(n).to_pylist()]
            ids = [x for part in groups_of(texts, CHARS) for x in v.encode(part)]
            new = [pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *new], names=[*names, "n_tokens", "ids"])

    return docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)


def decode(spark: SparkSession, rows: DataFrame, vocab: tuple[str, str] | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with the decoded bytes of their ids."""
    names, schema = _added(rows, StructField("decoded", BinaryType()))
    vocab = vocab or default_vocabulary()

    def run(batches):
        v = vocabulary(*vocab)
        for b in batches:
            n = len(names)
            got = [v.decode(np.frombuffer(x or b"", "<u4")) for x in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(got, pa.binary())], names=[*names, "decoded"])

    return rows.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{ids}`").alias("_ids")).mapInArrow(run, schema)


def digests(spark: SparkSession, docs: DataFrame, vocab: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_tokens and the hashes of the ids and of the bytes that they decode to."""
    x = decode(spark, encode(spark, docs.select("doc_id", "text"), vocab).drop("text"), vocab)
    return x.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
