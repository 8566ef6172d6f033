"""Two texts side by side: words around places they have in common, exact extension of matches.

A *seed* is a pair of places at which two texts have the same or nearly the same paragraph. Around seeds
the words themselves are compared: a match runs on over equal words and bridges up to ``BRIDGE`` words on
either side where ``RESUME`` equal words follow. A stretch counts from ``least`` words on whose 5-word
shingles have a Jaccard of 0.75; one that fails is divided at its widest bridge.

Words travel as 32-bit hashes in blocks, and only those blocks that seeds ask for: never whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batch, hash_words, mix64, rows_by_text, shingle_hashes, signed, word_bounds

BLOCK = 128  # words that are sent together
MARGIN = 64  # words around the seeds that are looked at
BRIDGE = 8
RESUME = 5
TEXT = ("t1", "t2")
SIDES = ("t1", "t2", "h1", "h2")


def text_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words, first byte and byte after the last of each."""
    low = (text or "").encode().lower()
    s, e = word_bounds(np.frombuffer(low, np.uint8))
    return hash_words(low, s, e), s, e


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal words at the start."""
    n = min(len(a), len(b))
    for lo in range(0, n, 256):
        d = a[lo : min(n, lo + 256)] != b[lo : min(n, lo + 256)]
        if d.any():
            return lo + int(d.argmax())
    return n


_STEPS = sorted(((x, y) for x in range(BRIDGE + 1) for y in range(BRIDGE + 1) if x or y), key=lambda v: (v[0] + v[1], abs(v[0] - v[1])))


def _ahead(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Equal runs (place in a, place in b, words) from the start of both on."""
    out, i, j = [], 0, 0
    while True:
        n = _run(a[i:], b[j:])
        if n:
            out.append((i, j, n))
        i, j = i + n, j + n
        p, q = a[i : i + BRIDGE + RESUME].tolist(), b[j : j + BRIDGE + RESUME].tolist()
        for x, y in _STEPS:
            if len(p) >= x + RESUME and p[x : x + RESUME] == q[y : y + RESUME]:
                i, j = i + x, j + y
                break
        else:
            return out


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Do two word sequences have a shingle Jaccard of 0.75."""
    x, y = (np.unique(shingle_hashes(v.astype(np.uint64))) for v in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 75 * (len(x) + len(y) - both)


def shared(a: np.ndarray, b: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int, int]]:
    """(start and end in a, start and end in b) of the passages around the seeds."""
    out, done = [], []
    for p, q in seeds:
        if any(x <= p < x + n and p - x == q - y for x, y, n in done):
            continue
        back = [(p - x - n, q - y - n, n) for x, y, n in _ahead(a[:p][::-1], b[:q][::-1])][::-1]
        runs = back + [(p + x, q + y, n) for x, y, n in _ahead(a[p:], b[q:])]
        done += runs
        todo = [runs] if runs else []
        while todo:
            r = todo.pop()
            x0, y0, x1, y1 = r[0][0], r[0][1], r[-1][0] + r[-1][2], r[-1][1] + r[-1][2]
            if min(x1 - x0, y1 - y0) < least:
                continue
            if len(r) == 1 or near(a[x0:x1], b[y0:y1]):
                out.append((x0, x1, y0, y1))
                continue
            k = max(range(1, len(r)), key=lambda k: r[k][0] - r[k - 1][0] - r[k - 1][2] + r[k][1] - r[k - 1][1] - r[k - 1][2])
            todo += [r[:k], r[k:]]
    return out


_REGION = pa.schema([(x, pa.int64()) for x in SIDES] + [("seeds", pa.binary()), ("mine", pa.list_(pa.int32())), ("other", pa.list_(pa.int32()))])
_REGION_DDL = "t1 long, t2 long, h1 long, h2 long, seeds binary, mine array<int>, other array<int>"


def _regions(width: int):
    """Seeds of two texts, divided where they are far apart, and the blocks of words around them."""

    def run(batches):
        for b in batches:
            out: dict[str, list] = {f.name: [] for f in _REGION}
            for *ids, seeds in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = np.array(sorted({(x["pos"], x["h_pos"]) for x in seeds}), np.int64).reshape(-1, 2)
                far = (np.diff(s[:, 0]) > 2 * MARGIN) | (np.abs(np.diff(s[:, 0] - s[:, 1])) > 2 * MARGIN)
                for part in np.split(s, np.flatnonzero(far) + 1):
                    spans = [list(range(max(0, int(c.min()) - MARGIN) // BLOCK, (int(c.max()) + width + MARGIN) // BLOCK + 1)) for c in part.T]
                    for name, v in zip(_REGION.names, (*ids, part.astype("<i4").tobytes(), *spans), strict=True):
                        out[name].append(v)
            yield batch(_REGION, **out)

    return run


_BLOCKS = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("block", pa.int32()), ("words", pa.binary())])


def _blocks(batches):
    """Wanted blocks of each text."""
    for b in batches:
        out: dict[str, list] = {f.name: [] for f in _BLOCKS}
        for t1, t2, text, want in zip(*(c.to_pylist() for c in b.columns), strict=True):
            h = text_words(text)[0].astype("<u4")
            for k in want:
                if k * BLOCK < len(h):
                    for name, v in zip(_BLOCKS.names, (t1, t2, k, h[k * BLOCK : (k + 1) * BLOCK].tobytes()), strict=True):
                        out[name].append(v)
        yield batch(_BLOCKS, **out)


def _read(blocks: list[dict]) -> tuple[np.ndarray, int]:
    """(word hashes, place of the first)."""
    blocks = sorted(blocks, key=lambda x: x["block"])  # each once: the rows were collected as a set
    return np.frombuffer(b"".join(x["words"] for x in blocks), "<u4"), blocks[0]["block"] * BLOCK


def windows(h: np.ndarray, at: list[int], width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of every run of ``least`` words that holds one of the windows at ``at``."""
    near_by = np.unique(np.array(at, np.int64)[:, None] - np.arange(least - width + 1))
    s = near_by[(near_by >= 0) & (near_by <= len(h) - least)]
    k = mix64(h[s[:, None] + np.arange(least)].astype(np.uint64) + np.arange(least, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return s, signed(mix64(np.bitwise_xor.reduce(k, axis=1)))


_SPAN = pa.schema([("kind", pa.int32())] + [(x, pa.int64()) for x in (*SIDES, "x0", "x1", "y0", "y1")])
_SPAN_DDL = ", ".join(f"{f.name} {'int' if f.name == 'kind' else 'long'}" for f in _SPAN)


def _anchor(a: np.ndarray, p: int, b: np.ndarray, q: int) -> tuple[int, int] | None:
    """The seed itself where its words are equal, else the first equal ``RESUME`` words after it."""
    if p + RESUME <= len(a) and np.array_equal(a[p : p + RESUME], b[q : q + RESUME]):
        return p, q
    x, y = (np.lib.stride_tricks.sliding_window_view(v, RESUME) for v in (a[p : p + BLOCK], b[q : q + BLOCK]) if len(v) >= RESUME) if min(len(a) - p, len(b) - q) >= RESUME else ((), ())
    at: dict[bytes, int] = {}
    for j, v in enumerate(y):
        at.setdefault(v.tobytes(), j)
    return next(((p + i, q + at[v.tobytes()]) for i, v in enumerate(x) if v.tobytes() in at), None)


def _aligner(width: int, least: int, ask: bool):
    def run(batches):
        for b in batches:
            out = [np.empty((0, len(_SPAN)), np.int64)]
            for *ids, seeds, blocks in zip(*(c.to_pylist() for c in b.columns), strict=True):
                a, a0 = _read([x for x in blocks if x["side"] == 0])
                c, c0 = _read([x for x in blocks if x["side"] == 1])
                at = (np.frombuffer(seeds, "<i4").reshape(-1, 2) - np.array([a0, c0])).tolist()
                at = [x for x in (_anchor(a, p, c, q) for p, q in at) if x]
                found = shared(a, c, at, least)
                if found:
                    out.append(np.array([(0, *ids, x0 + a0, x1 + a0, y0 + c0, y1 + c0) for x0, x1, y0, y1 in found], np.int64))
                open_ = sorted({p for p, _ in at if not any(x0 <= p and p + width <= x1 for x0, x1, _, _ in found)}) if ask else []
                if open_ and len(a) >= least:
                    s, key = windows(a, open_, width, least)
                    rows = np.zeros((len(s), len(_SPAN)), np.int64)
                    rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 5] = 1, ids[0], ids[1], key, s + a0
                    out.append(rows)
            rows = np.concatenate(out)
            yield batch(_SPAN, **{f.name: rows[:, i].astype(np.int32) if i == 0 else np.ascontiguousarray(rows[:, i]) for i, f in enumerate(_SPAN)})

    return run


def align(scratch: Scratch, docs: DataFrame, texts: DataFrame, seeds: DataFrame, width: int, least: int, label: str, ask: bool = False) -> DataFrame:
    """Spans (kind 0: t1, t2, h1, h2, x0, x1, y0, y1) that the texts t and h share around ``seeds``
    (t1, t2, h1, h2, pos, h_pos). With ``ask`` also rows of kind 1 for seeds that gave none: every window
    of ``least`` words around them (t1, t2, key in h1, start in x0).

    ``docs`` has doc_id, t1, t2 and text; ``texts`` the doc_id of one row of each text."""
    x = seeds.groupBy(*SIDES).agg(F.collect_list(F.struct("pos", "h_pos")).alias("seeds"))  # at most the paragraphs of one text
    regions = scratch.write(x.mapInArrow(_regions(width), _REGION_DDL), f"{label}-regions")
    regions = regions.withColumn("rid", F.monotonically_increasing_id())
    ask_for = regions.select("rid", F.lit(0).alias("side"), "t1", "t2", F.explode("mine").alias("block"))
    ask_for = ask_for.union(regions.select("rid", F.lit(1).alias("side"), F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.explode("other").alias("block")))
    want = ask_for.groupBy(*TEXT).agg(F.collect_set("block").alias("want")).join(texts.select("t1", "t2", "doc_id"), [*TEXT])
    want = scratch.write(want, f"{label}-wanted")
    scratch.tidy()
    got = rows_by_text(scratch.spark, docs, want).select("t1", "t2", "text", "want")
    blocks = scratch.write(got.mapInArrow(_blocks, "t1 long, t2 long, block int, words binary"), f"{label}-blocks", bloom=True)
    scratch.tidy()
    sent = ask_for.join(blocks, [*TEXT, "block"]).groupBy("rid").agg(F.collect_set(F.struct("side", "block", "words")).alias("blocks"))
    sent = regions.drop("mine", "other").join(sent, "rid").select(*SIDES, "seeds", "blocks")
    out = scratch.write(sent.mapInArrow(_aligner(width, least, ask), _SPAN_DDL), f"{label}-spans")
    scratch.drop(*[f"{label}-{k}" for k in ("regions", "wanted", "blocks")])
    scratch.tidy()
    return out
