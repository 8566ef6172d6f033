"""Cross-tokenizer alignment: tokens of two vocabularies grouped where their byte offsets end together.

The left side encodes a space and the text with a byte-level BPE, the right side the text with a piece
model that puts the space itself, so both token sequences spell the same bytes. Each side's cumulative
ends become a dictionary from end to index; the sorted common keys of the two cut both id lists into
groups. Inside a group every stretch of bytes between two cuts belongs to one token of each side: these
stretches are the *links*, all pairs of tokens whose byte ranges overlap.

Texts are cut into *runs*, spaces with the characters up to the next space, and the distinct runs of a
batch are encoded and aligned once. Both sides begin a token at every run: no piece holds a space behind
another character (checked when the model is opened), so no merge of the right side crosses that place; and
the left side's pattern begins a match at a space behind another character, unless that is white space and
the space is followed by white space or nothing. A text with such a place is one run.

``scores`` counts every id pair over the corpus: counts are added up in each task before the shuffle. The
most frequent pairs, ``HEAD`` at most, whatever the corpus holds, go to all tasks and are applied where the
links lie; only links of rarer pairs, told once for each text, are joined with their counts. The best count of each right id has
one row an id of the vocabulary.

Defined results: a null or empty text, or one whose tokens do not spell a space and the text (it holds
U+2581, say), has no tokens: zeros, no group, an empty hash. Special tokens inside a text are plain text.
Texts of any length are aligned whole; repeated rows are counted and told once each; an empty table gives
an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import groups_of, spread
from .common import Scratch, batch, bounded_batches
from .tokens import LONG_RUN

#: Most id pairs whose counts are sent to all tasks.
HEAD = 1 << 18
CHARS = 2_000_000
#: Distinct pairs that a task adds up before it hands them on.
PAIRS = 1 << 20
_RUN = re.compile(" +[^ ]*")
_ODD = re.compile(r"[^\S ] (?:\s|\Z)")


class Paths(NamedTuple):
    left: str  # tokenizers file of the byte-level BPE
    ranks: str  # its ranks
    right: str  # piece model


def default_paths() -> Paths:
    import public_tokenizers as p

    return Paths(p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.path("piece_bpe_32k.model"))


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters for
    themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


class Sides:
    """The two encoders of a Python worker, and the bytes of their tokens."""

    def __init__(self, paths: Paths):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(paths.left)
        self.slow.encode_special_tokens = True
        with open(paths.ranks, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("left", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        known = byte_of_char()
        names = {i: t for t, i in self.slow.get_vocab().items()}
        self.left = [bytes(known[c] for c in names[i]) if all(c in known for c in names[i]) else names[i].encode() for i in range(len(names))]
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=paths.right)
        n = self.pieces.get_piece_size()
        name = [self.pieces.id_to_piece(i) for i in range(n)]
        if any("▁" in t.lstrip("▁") for t in name):
            raise ValueError("a piece holds a space behind another character")
        self.right = [bytes([int(t[3:5], 16)]) if self.pieces.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(name)]
        self.space = self.pieces.piece_to_id("▁")
        self.size = [np.array([len(t) for t in side], np.int64) for side in (self.left, self.right)]
        # every id with the sign that may follow it
        self.signs = [b"%d%s" % (i, s) for side, signs in ((self.left, b",|"), (self.right, b",;")) for s in (signs[:1], signs[1:]) for i in range(len(side))]

    def encode_left(self, text: str) -> list[int]:
        if len(text) > LONG_RUN and max(map(len, text.split()), default=0) > LONG_RUN:
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, runs: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of runs that begin with a space; none where the two do not spell the run."""
        a = [self.encode_left(r) for r in runs]
        b = [x or [self.space] for x in self.pieces.encode([r[1:] for r in runs], num_threads=1)]
        for k, r in enumerate(runs):
            if not b"".join([self.left[i] for i in a[k]]) == r.encode() == b"".join([self.right[i] for i in b[k]]):
                a[k], b[k] = [], []
        return a, b


@functools.cache
def sides(paths: Paths) -> Sides:
    """One a Python worker."""
    return Sides(paths)


class Aligned(NamedTuple):
    """Two id lists, the number of ids up to the end of each group, and the links."""

    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    links: np.ndarray  # (n, 2) places in a and b

    def signs(self, s: Sides) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3;`` in its parts, one an id."""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.cut_a - 1] = last_b[self.cut_b - 1] = 1
        na, nb = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        left, right = len(s.left), len(s.right)
        at = np.empty(len(self.a) + len(self.b), np.int64)
        at[np.arange(len(self.a)) + np.repeat(self.cut_b - nb, na)] = self.a + left * last_a
        at[np.arange(len(self.b)) + np.repeat(self.cut_a, nb)] = 2 * left + self.b + right * last_b
        return [s.signs[i] for i in at.tolist()]


def align(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """Groups and links of two id lists that spell the same bytes."""
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    at_a = dict(zip(ends_a.tolist(), range(1, len(a) + 1), strict=True))
    at_b = dict(zip(ends_b.tolist(), range(1, len(b) + 1), strict=True))
    common = sorted(at_a.keys() & at_b.keys())
    cut_a = np.fromiter(map(at_a.__getitem__, common), np.int64, len(common))
    cut_b = np.fromiter(map(at_b.__getitem__, common), np.int64, len(common))
    # the stretches of each slice end with its left ids, and with those right ids that end no slice
    inner = np.ones(len(b), bool)
    inner[cut_b - 1] = False
    stretch = np.sort(np.concatenate([ends_a, ends_b[inner]]), kind="stable")
    links = np.stack([np.searchsorted(ends_a, stretch), np.searchsorted(ends_b, stretch)], 1)
    return Aligned(a, b, cut_a, cut_b, links)


class Part(NamedTuple):
    """Values of all texts of a batch one after the other, and how many each text has."""

    values: np.ndarray
    size: np.ndarray

    def of_texts(self) -> list[np.ndarray]:
        return np.split(self.values, np.cumsum(self.size)[:-1])


def aligned(s: Sides, texts: list[str]) -> tuple[dict[str, Part], list[bytes]]:
    """Ids, cuts and links (id pairs) of the texts, and their listings; texts must be some."""
    runs = [[" " + t] if _ODD.search(" " + t) else _RUN.findall(" " + t) if t else [] for t in texts]
    flat = [r for x in runs for r in x]
    index = dict.fromkeys(flat)
    ids = s.encode(list(index))
    index.update(zip(index, range(len(index)), strict=True))
    code = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
    count = [np.fromiter(map(len, x), np.int64, len(x)) for x in ids]
    x = align(*(np.fromiter((i for r in side for i in r), np.int64, int(n.sum())) for side, n in zip(ids, count, strict=True)), *s.size)
    # a text with a run that is not spelt has no tokens
    text = np.repeat(np.arange(len(texts)), [len(r) for r in runs])
    good = np.bincount(text, count[0][code] == 0, minlength=len(texts)) == 0
    code, text = code[good[text]], text[good[text]]
    end_a, end_b = np.cumsum(count[0]), np.cumsum(count[1])
    groups_end, links_end = np.searchsorted(x.cut_a, end_a, "right"), np.searchsorted(x.links[:, 0], end_a)

    def told(values: np.ndarray, ends: np.ndarray) -> Part:
        n = np.diff(ends, prepend=0)
        return Part(values[spread((ends - n)[code], n[code])], np.bincount(text, n[code], minlength=len(texts)).astype(np.int64))

    def cuts(cut: np.ndarray, ends: np.ndarray) -> Part:
        """Cuts counted from the start of the text."""
        n = np.diff(ends, prepend=0)
        before = np.cumsum(n[code]) - n[code]  # ids of the batch before each run
        first = np.concatenate([[0], np.cumsum(np.bincount(text, n[code], minlength=len(texts)))[:-1]]).astype(np.int64)
        part = told(cut, groups_end)
        groups = np.diff(groups_end, prepend=0)[code]
        return part._replace(values=part.values + np.repeat(before - first[text] - (ends - n)[code], groups))

    pairs = x.a[x.links[:, 0]] << 32 | x.b[x.links[:, 1]]
    parts = {"ids_a": told(x.a, end_a), "ids_b": told(x.b, end_b), "cut_a": cuts(x.cut_a, end_a), "cut_b": cuts(x.cut_b, end_b), "links": told(pairs, links_end)}
    signs, ends = x.signs(s), (end_a + end_b).tolist()
    shown = [b"".join(signs[i:j]) for i, j in zip([0, *ends], ends, strict=False)]
    order, at = [shown[c] for c in code.tolist()], np.cumsum(np.bincount(text, minlength=len(texts))).tolist()
    return parts, [b"".join(order[i:j])[:-1] for i, j in zip([0, *at], at, strict=False)]


#: What ``groups`` can give for a text, and its type.
COLUMNS = {"ids_a": "binary", "ids_b": "binary", "cut_a": "binary", "cut_b": "binary", "links": "binary", "groups_sha256": "string"}


def groups(spark: SparkSession, docs: DataFrame, paths: Paths | None = None, columns: tuple[str, ...] = tuple(COLUMNS)) -> DataFrame:
    """row_id, doc_id, n_a, n_b, n_groups, n_links and the chosen columns of every row.

    Ids and cuts are little-endian unsigned 32-bit numbers, as many as the counts tell; a link is the
    64-bit number (left id << 32 | right id), in order."""
    bounded_batches(spark)
    paths = paths or default_paths()
    counts = ["row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links"]
    schema = pa.schema([*[(c, pa.int64()) for c in counts], *[(c, pa.string() if COLUMNS[c] == "string" else pa.binary()) for c in columns]])

    def run(batches):
        s = sides(paths)
        for b in batches:
            keys = [c.to_pylist() for c in b.columns[:2]]
            done = 0
            for texts in groups_of([t or "" for t in b.column(2).to_pylist()], CHARS):
                parts, shown = aligned(s, texts)
                part = slice(done, done + len(texts))
                done += len(texts)
                out = dict(zip(counts, (keys[0][part], keys[1][part], *[parts[p].size for p in ("ids_a", "ids_b", "cut_a", "links")]), strict=True))
                for c in columns:
                    if c == "groups_sha256":
                        out[c] = [hashlib.sha256(x).hexdigest() if x else "" for x in shown]
                    else:
                        out[c] = [x.astype("<i8" if c == "links" else "<u4").tobytes() for x in parts[c].of_texts()]
                yield batch(schema, **out)

    ddl = ", ".join([*[f"{c} long" for c in counts], *[f"{c} {COLUMNS[c]}" for c in columns]])
    src = docs.select(F.monotonically_increasing_id(), F.col("doc_id").cast("long"), F.col("text"))
    return src.toDF("row_id", "doc_id", "text").mapInArrow(run, ddl)


def pair_counts(links: DataFrame) -> DataFrame:
    """(code, n): how many links of the corpus hold each id pair."""
    schema = pa.schema([("code", pa.int64()), ("n", pa.int64())])

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            code, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return code, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        for b in batches:
            held.append(np.unique(np.frombuffer(b"".join(b.column(0).to_pylist()), "<i8"), return_counts=True))
            if sum(len(c) for c, _ in held) > PAIRS:
                held = [merged()]
                if len(held[0][0]) > PAIRS // 2:
                    yield batch(schema, code=held[0][0], n=held[0][1])
                    held = []
        if held:
            code, n = merged()
            yield batch(schema, code=code, n=n)

    return links.select("links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _head_cut(counts: DataFrame, most: int) -> int:
    """Least count such that at most ``most`` pairs have it or more."""
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.lit(1024) + F.floor(16 * F.log2(F.col("n") / 1024.0)).cast("long"))
    steps = sorted(counts.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("low")).collect(), reverse=True)  # under 2000 rows
    cut, total = 1 << 62, 0
    for r in steps:
        total += r.k
        if total > most:
            break
        cut = r.low
    return cut


def scores(spark: SparkSession, docs: DataFrame, paths: Paths | None = None, head: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    scratch = Scratch(spark, "align", broadcast=False)
    found = scratch.write(groups(spark, docs, paths, ("links", "groups_sha256")), "groups", "zstd")
    counts = scratch.write(pair_counts(found), "counts")
    most = counts.groupBy(F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")).agg(F.max("n").alias("top"))
    best = counts.join(F.broadcast(most), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)) == F.col("b"))  # one row an id of the right vocabulary
    best = scratch.write(best.select("code", "n", (F.col("n") == F.col("top")).cast("long").alias("best")), "best")
    cut = _head_cut(counts, head)
    top = best.where(F.col("n") >= cut).toArrow().sort_by("code")
    shared = spark.sparkContext.broadcast([top.column(c).to_numpy() for c in ("code", "n", "best")])
    told = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = pa.schema([("row_id", pa.int64()), *[(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in told], *[(c, pa.int64()) for c in ("n_best", "count_sum", "code", "times")]])

    def run(batches):
        code, n, is_best = shared.value
        for b in batches:
            rows = b.select(["row_id", *told]).to_pydict() | {"n_best": [], "count_sum": [], "code": [None] * len(b), "times": [None] * len(b)}
            size = np.array(b.column("n_links").to_numpy())
            links = np.frombuffer(b"".join(b.column("links").to_pylist()), "<i8")
            row = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(code, links), max(len(code) - 1, 0))
            hit = code[at] == links if len(code) else np.zeros(len(links), bool)
            for name, x in (("n_best", is_best), ("count_sum", n)):
                total = np.zeros(len(size), np.int64)
                np.add.at(total, row[hit], x[at[hit]])
                rows[name] = total
            yield batch(schema, **rows)
            key = np.stack([row[~hit], links[~hit]], 1)
            if len(key):
                key, times = np.unique(key, axis=0, return_counts=True)
                for k in range(0, len(key), 1 << 17):
                    m = len(times[k : k + (1 << 17)])
                    none = {c: [None] * m for c in (*told, "n_best", "count_sum")}
                    yield batch(schema, row_id=np.array(rows["row_id"])[key[k : k + m, 0]], code=key[k : k + m, 1], times=times[k : k + m], **none)

    ddl = ", ".join(f"{f.name} {'string' if f.name == 'groups_sha256' else 'long'}" for f in schema)
    parts = scratch.write(found.select("row_id", *told, "links").mapInArrow(run, ddl), "parts")
    rare = parts.where("code is not null").select("row_id", "code", "times").join(best.where(F.col("n") < cut), "code")
    rare = rare.select("row_id", *[F.lit(None).cast(parts.schema[c].dataType).alias(c) for c in told], (F.col("times") * F.col("best")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    whole = parts.where("code is null").select("row_id", *told, "n_best", "count_sum").unionByName(rare)
    whole = whole.groupBy("row_id").agg(*[F.max(c).alias(c) for c in told], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
