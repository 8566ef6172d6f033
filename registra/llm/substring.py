"""Repeated passages: paragraph MinHash banding, exact verification, clusters of removals.

A *paragraph* is what stands between two cuts of the text's words, line ends left aside; a cut is made
where the hash of two neighbouring words is the least of ``REACH`` on either side, so the words
themselves say where, and paragraphs have over 40 words on average. They are compared by MinHash of
their 5-word shingles, banded by ``tune`` for high recall. Paragraphs that collide in a band are joined:
all pairs in a band of at most ``LEAF``, in a larger one each with its first, and then, by the complete
prefix filter of ``near_dup.rare_pairs``, those that are not of one component by that.

A passage may hold no whole paragraph. So inside them the finest level is compared too: windows of
``WINDOW`` words that begin at the least pair hash of ``SPREAD`` neighbouring places. Two texts that
share ``WINDOW + SPREAD - 1`` words (47) in a row have such a window in common; equal windows are joined
with the first text that has theirs.

Every colliding pair is extended word by word to both ends (``passages``) and verified by exact Jaccard
of 0.75; a passage is what then has ``LEAST`` words or more. Where two texts have equal windows but no
passage with their first holder, each run of ``LEAST`` words around them is looked up, so that a passage
of two later texts is found too. Passages that overlap in a text are one stretch; components of matched
stretches are the clusters. Of each match the text that comes first, by smallest document id, keeps its
words; ``remove`` cuts the others.

Texts, not rows, are compared: equal texts are one, and of their rows all but the first are repeats
from end to end. Texts are told apart by 96 bits of hash.

Defined results: null and empty texts have no passages, nor has a text of fewer than ``LEAST`` words; a
document without a repeated passage has no row; a null doc_id is an id of its own, sorted first; of
repeated rows all but one are repeats; an empty table gives an empty result; other columns, whatever
their names, are ignored (``remove`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KeyFilter, Scratch, batch, bounded_batches, components, fresh, minhash_multipliers, mix64, rows_by_text, selective, shingle_hashes, signed, word_bounds
from .near_dup import _hashed, confirm, rare_pairs
from .passages import SIDES, align, text_words

REACH = 20
WINDOW = 20
SPREAD = 28
LEAST = 50
LEAF = 16


def tune(threshold: float = 0.75, recall: float = 0.98, most: int = 5) -> tuple[int, int]:
    """(bands, rows): the most selective banding of at most ``most`` bands that finds a pair of paragraphs
    at the threshold with the wanted probability."""
    for rows in range(8, 0, -1):
        for bands in range(1, most + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                return bands, rows
    return most, 1


BANDS, ROWS = tune()
_Q = np.uint64(0x9FB21C651E98DF25)


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` neighbours, by doubling."""
    k, out = 1, x
    while 2 * k <= width:
        out = op(out[:-k], out[k:])
        k *= 2
    return op(out[: len(x) - width + 1], out[width - k : width - k + len(x) - width + 1]) if k < width else out


def _pairs(h: np.ndarray) -> np.ndarray:
    """Hash of every two neighbouring words."""
    return mix64(h[:-1] * _Q + h[1:])


def cuts(h: np.ndarray) -> np.ndarray:
    """Places at which a paragraph begins: the text's head, and least pair hashes (the first of equal ones)."""
    g = _pairs(h)
    if len(g) <= 2 * REACH:
        return np.zeros(min(len(h), 1), np.int64)
    most = np.full(REACH, np.uint64(0xFFFFFFFFFFFFFFFF))
    wide = np.concatenate([most, g, most])
    low = _slide(wide, REACH, np.minimum)
    before, after = low[: len(g)], low[REACH + 1 : REACH + 1 + len(g)]
    at = np.flatnonzero((g < before) & (g <= after))
    return np.concatenate([[0], at[at > 0]])


def starts(h: np.ndarray) -> np.ndarray:
    """Places at which the windows of a word sequence begin."""
    n = len(h) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.int64)
    g = _pairs(h)[:n]
    w = min(SPREAD, n)
    least = np.concatenate([np.zeros(w - 1, np.uint64), _slide(g, w, np.minimum), np.zeros(w - 1, np.uint64)])
    return np.flatnonzero(_slide(least, w, np.maximum) == g)


def windows(h: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints) of the windows of a word sequence with shingle hashes ``s``. Of equal windows
    that overlap (a text that goes round in circles) the first is told."""
    at = starts(h)
    if not len(at):
        return at, np.empty(0, np.uint64)
    fp = mix64(mix64(mix64(s[at] * _Q + s[at + 5]) * _Q + s[at + 10]) * _Q + s[at + 15])
    if len(at) > 1 and np.diff(at).min() < WINDOW:
        order = np.lexsort((at, fp))
        again = np.zeros(len(at), bool)
        again[order[1:]] = (fp[order[1:]] == fp[order[:-1]]) & (at[order[1:]] - at[order[:-1]] < WINDOW)
        at, fp = at[~again], fp[~again]
    return at, fp


def paragraphs(seqs: list[np.ndarray], sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, words, fingerprint, band keys) of the paragraphs of ``WINDOW`` words or more of some
    texts, given as word hashes and their shingle hashes."""
    at = [cuts(h) for h in seqs]
    n = np.concatenate([np.diff(c, append=len(h)) for c, h in zip(at, seqs, strict=True)])
    text = np.repeat(np.arange(len(seqs)), [len(c) for c in at])
    at = np.concatenate(at)
    ok = n >= WINDOW
    text, at, n = text[ok], at[ok], n[ok]
    keys = np.zeros((len(at), BANDS), np.uint64)
    fp = np.zeros(len(at), np.uint64)
    if len(at):
        # the shingles of all paragraphs, in one run
        m = n - 4
        head = np.cumsum(m) - m
        base = np.cumsum([0, *map(len, sets[:-1])])[text] + at
        inner = np.arange(int(m.sum())) - np.repeat(head, m)
        x = np.concatenate(sets)[inner + np.repeat(base, m)]
        fp = mix64(np.add.reduceat(mix64(x + inner.astype(np.uint64) * _Q), head))
        a, b = minhash_multipliers(BANDS * ROWS, seed=11)
        for j in range(BANDS):
            k = np.full(len(at), j + 1, np.uint64)
            for r in range(j * ROWS, (j + 1) * ROWS):
                k = mix64(k * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat((x ^ b[r]) * a[r], head))
            keys[:, j] = k
    return text, at, n, fp, keys


_UNIT = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("pos", pa.int32()), ("n_words", pa.int32()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64()))])
_UNIT_DDL = "row_id long, doc_id long, t1 long, t2 long, pos int, n_words int, fp long, bands array<bigint>"


def _units(batches):
    """Per text one row (pos -1) with its number of words, its windows (n_words null) and its paragraphs."""
    for b in batches:
        for lo in range(0, b.num_rows, 200):
            part = b.slice(lo, 200)
            seqs = [text_words(t)[0] for t in part.column(4).to_pylist()]
            sets = [shingle_hashes(h) for h in seqs]
            win = [windows(h, s) for h, s in zip(seqs, sets, strict=True)]
            text, at, n, fp, keys = paragraphs(seqs, sets)

            def rows(i, pos, n_words=None, fp=None, bands=None, part=part):
                size = len(i)
                lists = pa.array(np.arange(size + 1) * BANDS, pa.int32())
                return batch(_UNIT, **{k: part.column(c).take(pa.array(i)) for c, k in enumerate(_UNIT.names[:4])}, pos=pos.astype(np.int32), n_words=pa.nulls(size, pa.int32()) if n_words is None else n_words.astype(np.int32),
                             fp=pa.nulls(size, pa.int64()) if fp is None else signed(fp), bands=pa.nulls(size, pa.list_(pa.int64())) if bands is None else pa.ListArray.from_arrays(lists, pa.array(signed(bands).ravel())))

            yield rows(np.arange(len(seqs)), np.full(len(seqs), -1), np.array([len(h) for h in seqs], int))
            yield rows(np.repeat(np.arange(len(seqs)), [len(w[0]) for w in win]), np.concatenate([w[0] for w in win]), fp=np.concatenate([w[1] for w in win]))
            yield rows(text, at, n, fp, keys)


def _sets(batches):
    """Shingle sets of the wanted paragraphs of each text."""
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary())])
    for b in batches:
        for text, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            h = text_words(text)[0]
            yield batch(schema, node=[x["fp"] for x in want], set=[np.unique(shingle_hashes(h[x["pos"] : x["pos"] + x["n"]])).tobytes() for x in want])


def _first():
    """The occurrence that comes first: by document id and row, then by place."""
    return F.min(F.struct("o", "t1", "t2", "pos"))


def _seeds(occ: DataFrame, hub: DataFrame, key: str) -> DataFrame:
    """Occurrences (key, t1, t2, pos, o) with the first of their key (key, hub), where that is in another text."""
    x = occ.join(hub, key).where("t1 <> hub.t1 or t2 <> hub.t2")
    return x.select("t1", "t2", F.col("hub.t1").alias("h1"), F.col("hub.t2").alias("h2"), "pos", F.col("hub.pos").alias("h_pos"))


def _alike(a: str, b: str):
    """Can paragraphs of so many words reach the threshold (sets of n - 4 shingles at most)."""
    return F.expr(f"4 * (least({a}, {b}) - 4) >= 3 * (greatest({a}, {b}) - 4)")


def _pair(rows: DataFrame) -> DataFrame:
    """Seeds of pairs x, y (first occurrences), the later text against the earlier; n and pos of the later."""
    z = rows.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x.t1 <> y.t1 or x.t2 <> y.t2")
    return z.select("x.t1", "x.t2", F.col("y.t1").alias("h1"), F.col("y.t2").alias("h2"), F.col("x.pos").alias("pos"), F.col("y.pos").alias("h_pos"), F.col("x.n").alias("n"))


def near_seeds(scratch: Scratch, docs: DataFrame, texts: DataFrame, par: DataFrame, cover: DataFrame) -> DataFrame:
    """Seeds of different paragraphs that collide in a band, between the first texts that have them.
    ``cover`` (t1, t2, cover) are words that go already: a paragraph inside them needs no partner."""
    rows = par.select(F.explode("bands").alias("key"), "fp")
    keys = rows.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("key")
    keys = scratch.write(keys, "band-keys")
    scratch.tidy()
    here = F.struct(F.struct("doc_id", "row_id").alias("o"), "t1", "t2", "pos", F.col("n_words").alias("n"))
    met = par.select(F.explode("bands").alias("key"), "fp", here.alias("r")).join(selective(keys, "key"), "key")
    met = scratch.write(met.groupBy("key", "fp").agg(F.min("r").alias("r")), "band-met", bloom=True)
    scratch.tidy()
    sizes = scratch.write(met.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("r", "fp")).alias("f")), "band-sizes")
    small = met.join(sizes.where(F.col("size") <= LEAF).select("key"), "key")
    small = small.select("key", F.col("r").alias("x"), F.col("fp").alias("fx")).join(small.select("key", F.col("r").alias("y"), F.col("fp").alias("fy")), "key").where("fx < fy")
    out = _pair(small.where(_alike("x.n", "y.n")))
    large = scratch.write(met.join(sizes.where(F.col("size") > LEAF).select("key", "f"), "key"), "band-large")
    covered = F.coalesce(F.exists("cover", lambda c: (c["x0"] <= F.col("pos")) & (F.col("pos") + F.col("n") <= c["x1"])), F.lit(False))
    if not large.isEmpty():
        reps = large.groupBy("fp").agg(F.min("r").alias("r")).select("fp", "r", "r.t1", "r.t2", "r.pos", "r.n").join(cover, ["t1", "t2"], "left")
        reps = scratch.write(reps.select("fp", "r", (~covered).alias("open")), "band-reps")
        want = reps.groupBy("r.t1", "r.t2").agg(F.collect_list(F.struct("fp", F.col("r.pos").alias("pos"), F.col("r.n").alias("n"))).alias("want")).join(texts.select("t1", "t2", "doc_id"), ["t1", "t2"])
        want = scratch.write(want, "band-wanted")
        sets = rows_by_text(scratch.spark, docs, want).select("text", "want").mapInArrow(_sets, "node long, set binary")
        sets = scratch.write(sets.dropDuplicates(["node"]), "band-sets", bloom=True)
        star = large.where("fp <> f.fp").select(F.col("fp").alias("a"), F.col("f.fp").alias("b"), F.col("r").alias("x"), F.col("f.r").alias("y")).where(_alike("x.n", "y.n"))
        out = out.unionByName(_pair(star))
        links = scratch.write(confirm(star.select("a", "b").distinct(), sets), "band-links")
        # members of one confirmed star are of one component, and need not meet again
        comp = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))
        rare = scratch.write(confirm(rare_pairs(scratch, sets, comp, reps.where("open").select(F.col("fp").alias("node"))), sets), "band-rare")
        rare = rare.join(reps.select(F.col("fp").alias("a"), F.col("r").alias("x")), "a").join(reps.select(F.col("fp").alias("b"), F.col("r").alias("y")), "b")
        out = out.unionByName(_pair(rare))
    out = out.distinct().join(cover, ["t1", "t2"], "left").where(~covered)
    out = scratch.write(out.select(*SIDES, "pos", "h_pos").distinct(), "near-seeds")
    scratch.drop("band-keys", "band-met", "band-sizes", "band-large", "band-reps", "band-wanted", "band-sets", "band-links", "band-rare", "rare")
    return out


_PART = pa.schema([("kind", pa.int32()), ("t1", pa.int64()), ("t2", pa.int64()), ("stretch", pa.int64()), ("first", pa.int64()), ("n_words", pa.int64())])
_PART_DDL = "kind int, t1 long, t2 long, stretch long, first long, n_words long"


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for x, y in sorted(spans):
        if out and x < out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return out


def _parts(batches):
    """Per text: its stretches (kind 0 kept, kind 1 removed words) and the stretch of each span (kind 2)."""
    for b in batches:
        out: dict[str, list] = {f.name: [] for f in _PART}
        for t1, t2, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
            whole = _merge([(s["x0"], s["x1"]) for s in spans])
            heads = [w[0] for w in whole]
            of = lambda x: heads[int(np.searchsorted(heads, x, "right")) - 1]  # noqa: B023, E731
            gone = _merge([(s["x0"], s["x1"]) for s in spans if s["later"]])
            rows = [(1, of(x), x, y - x) for x, y in gone]
            rows += [(0, x, x, y - x) for x, y in whole if not any(x <= g[0] < y for g in gone)]
            rows += [(2, of(x), x, 0) for x in sorted({s["x0"] for s in spans})]
            for kind, head, first, n in rows:
                for name, v in zip(_PART.names, (kind, t1, t2, head, first, n), strict=True):
                    out[name].append(v)
        yield batch(_PART, **out)


def repeated_passages(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per passage and row of ``docs`` that has it: doc_id, t1 and t2 (the text's hashes), first
    (word, from 0), n_words, class_id, copies (members of the class), removed, and whole, which is true of
    rows whose entire text is a repeat of, or is repeated by, another row's."""
    bounded_batches(spark)
    scratch = Scratch(spark, "substring", broadcast=False)
    src = _hashed(docs, text, doc_id)
    units = src.select(F.monotonically_increasing_id(), "doc_id", "t1", "t2", "text").mapInArrow(_units, _UNIT_DDL)
    units = scratch.write(units, "units")
    rows = units.where("pos < 0").select("row_id", "doc_id", "t1", "t2", F.col("n_words").cast("long").alias("n_words"))
    texts = rows.groupBy("t1", "t2").agg(F.count("*").alias("n"), F.max("n_words").alias("n_words"), F.min(F.struct("doc_id", "row_id")).alias("o"))
    texts = scratch.write(texts.withColumn("doc_id", F.col("o.doc_id")), "texts")

    # equal windows of different texts
    win = units.where("fp is not null and bands is null")
    equal = win.groupBy("fp").agg(F.min("t1").alias("lo"), F.max("t1").alias("hi")).where("lo <> hi").select("fp")
    equal = scratch.write(equal, "equal")
    scratch.tidy()
    occ = win.join(selective(equal, "fp"), "fp").groupBy("fp", "t1", "t2", "pos").agg(F.min(F.struct("doc_id", "row_id")).alias("o"))
    occ = scratch.write(occ, "occurrences", bloom=True)
    scratch.tidy()
    hub = scratch.write(occ.groupBy("fp").agg(_first().alias("hub")), "hubs")
    seeds = scratch.write(_seeds(occ, hub, "fp"), "seeds")
    whole = rows.join(texts.where((F.col("n") > 1) & (F.col("n_words") >= LEAST)).select("t1", "t2", "n", F.col("o.row_id").alias("r")), ["t1", "t2"])
    whole = whole.select("doc_id", "t1", "t2", F.lit(0).cast("long").alias("first"), "n_words", F.xxhash64("t1", "t2").alias("class_id"), F.col("n").alias("copies"), (F.col("row_id") != F.col("r")).alias("removed"), F.lit(True).alias("whole"))
    whole = scratch.write(whole, "whole")
    scratch.drop("equal", "occurrences", "hubs")
    scratch.tidy()
    told = align(scratch, src, texts, seeds, WINDOW, LEAST, "first", ask=True)
    spans = told.where("kind = 0").drop("kind")

    # near paragraphs, and passages of later texts whose windows all stand in other, earlier ones
    cover = spans.groupBy("t1", "t2", "x0").agg(F.max("x1").alias("x1")).groupBy("t1", "t2").agg(F.collect_list(F.struct("x0", "x1")).alias("cover"))
    near = near_seeds(scratch, src, texts, units.where("bands is not null"), scratch.write(cover, "cover"))
    ask = told.where("kind = 1").select("t1", "t2", F.col("h1").alias("key"), F.col("x0").alias("pos")).distinct()
    keys = ask.groupBy("key").agg(F.min("t1").alias("lo"), F.max("t1").alias("hi")).where("lo <> hi").select("key")
    ask = scratch.write(ask.join(selective(keys, "key"), "key").join(texts.select("t1", "t2", "o"), ["t1", "t2"]), "asked", bloom=True)
    hub = ask.groupBy("key").agg(_first().alias("hub"))
    more = scratch.write(near.unionByName(_seeds(ask, hub, "key")).distinct(), "more-seeds")
    spans = spans.unionByName(align(scratch, src, texts, more, WINDOW, LEAST, "second").drop("kind"))
    spans = scratch.write(spans.distinct(), "spans")
    scratch.drop("units", "seeds", "first-spans", "second-spans", "cover", "near-seeds", "asked", "more-seeds")

    # stretches of each text; a place with many spans counts by its longest, so a group is no larger than its text
    sides = spans.select("t1", "t2", "x0", "x1", F.lit(True).alias("later")).union(spans.select("h1", "h2", "y0", "y1", F.lit(False)))
    sides = sides.groupBy("t1", "t2", "x0", "later").agg(F.max("x1").alias("x1"))
    parts = scratch.write(sides.groupBy("t1", "t2").agg(F.collect_list(F.struct("x0", "x1", "later")).alias("spans")).mapInArrow(_parts, _PART_DDL), "parts")
    place = parts.where("kind = 2").select("t1", "t2", F.col("first").alias("x0"), F.xxhash64("t1", "t2", "stretch").alias("node"))
    edges = spans.select(*SIDES, "x0", "y0").distinct().join(place, ["t1", "t2", "x0"]).withColumnRenamed("node", "a").select("a", "h1", "h2", "y0")
    edges = edges.join(place.select(F.col("t1").alias("h1"), F.col("t2").alias("h2"), F.col("x0").alias("y0"), F.col("node").alias("b")), ["h1", "h2", "y0"]).select("a", "b").distinct()
    comp = scratch.write(components(scratch, edges), "components")
    copies = comp.groupBy("comp").agg(F.count("*").alias("copies"))
    found = parts.where("kind < 2").withColumn("node", F.xxhash64("t1", "t2", "stretch")).join(comp, "node").join(copies, "comp").join(texts.select("t1", "t2", "doc_id"), ["t1", "t2"])
    found = found.select("doc_id", "t1", "t2", "first", "n_words", F.col("comp").alias("class_id"), "copies", (F.col("kind") == 1).alias("removed"), F.lit(False).alias("whole"))
    out = scratch.write(found.unionByName(whole), "passages")
    scratch.drop("texts", "whole", "spans", "parts", "components")
    scratch.tidy()
    return out


def _cut(text: str, spans: list[dict]) -> str:
    """The text without the given runs of words; what stands between other words stays."""
    data = text.encode()
    s, e = word_bounds(np.frombuffer(data, np.uint8))
    out, at = [], 0
    for x, n in sorted((v["first"], v["n_words"]) for v in spans):
        out.append(data[at : s[x]])
        at = int(e[x + n - 1])
    out.append(data[at:])
    return b"".join(out).decode()


def remove(spark: SparkSession, docs: DataFrame, passages: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without the passages that are to go; those left without a word are dropped.

    Columns stay as they are; a column n_chars is counted anew where a text changed. Texts of which
    nothing goes pass through without a shuffle (``KeyFilter``); of repeated rows one stays."""
    bounded_batches(spark)
    scratch = Scratch(spark, "substring-remove")
    cols = docs.columns
    gone = passages.where("removed and not whole").groupBy("t1", "t2").agg(F.collect_set(F.struct("first", "n_words")).alias("spans"))
    twice = passages.where("whole").groupBy("t1", "t2").agg(F.min(F.struct("doc_id")).alias("lead"))
    plan = scratch.write(gone.join(twice, ["t1", "t2"], "full").select("t1", "t2", F.coalesce("spans", F.array().cast("array<struct<first: bigint, n_words: bigint>>")).alias("spans"), "lead"), "plan")
    h1, h2, spans, lead, number = fresh(docs, "t1", "t2", "spans", "lead", "number")
    plan = plan.toDF(h1, h2, spans, lead)
    own = [F.col(f"`{c}`") for c in cols]
    src = docs.withColumns({h1: F.xxhash64(F.col(f"`{text}`")), h2: F.hash(F.col(f"`{text}`")).cast("long")})
    known = KeyFilter(spark, plan, h1)
    untouched = src.where(~known.maybe(h1)).select(*own)
    # of equal texts only rows of the smallest id are candidates to stay
    touched = src.where(known.maybe(h1)).join(plan, [h1, h2], "left")
    touched = touched.where(F.col(lead).isNull() | F.col(lead)["doc_id"].eqNullSafe(F.col(f"`{doc_id}`").cast("long")))
    if not twice.isEmpty():
        touched = scratch.write(touched.withColumn(number, F.monotonically_increasing_id()), "touched", "zstd")
        first = scratch.write(touched.where(F.col(lead).isNotNull()).groupBy(h1, h2).agg(F.min(number).alias(number)).select(number), "leads")
        touched = touched.where(F.col(lead).isNull()).unionByName(touched.where(F.col(lead).isNotNull()).join(first, number, "left_semi").select(*touched.columns))
    at = cols.index(text)

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            cuts = b.column(b.num_columns - 1).to_pylist()
            new = [_cut(t, s) if s else t for t, s in zip(texts, cuts, strict=True)]
            keep = pa.array([not s or bool(t.encode().split()) for t, s in zip(new, cuts, strict=True)], pa.bool_())
            columns = list(b.columns[:-1])
            columns[at] = pa.array(new, b.schema.field(at).type)
            if "n_chars" in cols:
                i = cols.index("n_chars")
                old = columns[i].to_pylist()
                columns[i] = pa.array([len(t) if s else o for t, s, o in zip(new, cuts, old, strict=True)], b.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(columns, names=cols).filter(keep)

    return untouched.union(touched.select(*own, F.col(spans)).mapInArrow(run, docs.schema))
