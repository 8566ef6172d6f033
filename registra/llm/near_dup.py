"""MinHash near-duplicates with an LSH forest: sorted signature orders and adaptive prefix depth.

A document's set is its distinct 5-word shingles (as 64-bit hashes). Documents with the same set
are one class; the rest works on one representative of each class.

The forest: every tree reads the signature of ``N_HASH`` minima in its own order (it starts at
another place and goes round). Two documents meet in a tree down to the depth of their longest
common prefix. Depth adapts to the region: where at most ``LEAF`` documents share a prefix of
``DEPTH`` minima, all their pairs are candidates (a bounded number per document). A larger region is
sorted by whole signatures, and each document is paired with its ``NEIGHBOURS`` neighbours
before it, those with the longest common prefix, however deep that is. Each member of a larger region
is also paired with the region's most central documents, those that share the most prefixes over all
trees: the originals that scattered copies were made from. So a region of any size yields a number of
pairs that is linear in it. The sort is a range shuffle, so no region has to fit in one task.

Candidates are confirmed on full sets, first each document's most promising pair, then only pairs
that still join two components. Members of larger regions that are then still apart are compared by an
exact way (``rare_pairs``): two sets at the threshold have one of their rarest shingles in common, so
documents of different components meet at those. Components are computed in a distributed way; nothing
about single documents reaches the driver, only a table of ``CELLS`` shingle counts.

Defined results: null and empty texts have the empty set, stand alone and are kept; a text of fewer
than five words is one shingle. A null doc_id takes part like any other and sorts last within its
component. Rows of one doc_id with different texts are documents of their own, each with its own
component; repeated rows are copies like any other. An empty table gives an empty result. Other columns,
whatever their names, are ignored (``keep_one`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KeyFilter, Scratch, batch, bounded_batches, doc_words, fingerprint, hash_words, minhash, mix64, fresh, rows_by_text, selective, shingle_hashes, signed, stars

N_HASH = 96
DEPTH = 4  # minima of the shallowest prefix
TREES = 24
NEIGHBOURS = 5
LEADERS = 2  # central members that every member of a larger region is paired with
LEAF = 24  # a region of at most so many is compared in full
LEAST_ESTIMATE = 0.56  # candidates whose signatures agree in less than this part are dropped; at a true 0.75 that is over four standard errors below
PERCENT = 75
CELLS = 1 << 17  # of the table that orders shingles by how rare they are
SPAN = 1 << 10  # cells whose counts are one row

_SIG = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("sig", pa.binary())])
_SIG_DDL = "row_id long, doc_id long, t1 long, t2 long, n_shingles long, fp1 long, fp2 long, sig binary"


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    data, s, e = doc_words(text)
    return np.unique(shingle_hashes(hash_words(data, s, e)))


def _signatures(batches):
    for b in batches:
        rows, ids, t1, t2, texts = (b.column(i).to_pylist() for i in range(5))
        sets = [shingle_set(t) for t in texts]
        n = np.array([len(x) for x in sets], np.int64)
        has = np.flatnonzero(n)
        sigs: list[bytes | None] = [None] * len(sets)
        lo = 0
        while lo < len(has):  # blocks of about a million shingles
            hi = lo + max(1, int(np.searchsorted(np.cumsum(n[has[lo:]]), 1_000_000)))
            part = has[lo:hi]
            starts = np.concatenate([[0], np.cumsum(n[part])[:-1]]).astype(np.int64)
            for k, m in zip(part, minhash(np.concatenate([sets[k] for k in part]), starts, N_HASH), strict=True):
                sigs[k] = m.astype("<u4").tobytes()
            lo = hi
        fps = [fingerprint(x) for x in sets]
        yield batch(_SIG, row_id=rows, doc_id=ids, t1=t1, t2=t2, n_shingles=n, fp1=[f[0] for f in fps], fp2=[f[1] for f in fps], sig=sigs)


def _first_key(sig: np.ndarray, tree: int) -> np.ndarray:
    """Hash of the first DEPTH minima in the tree's order."""
    h = mix64(np.full(len(sig), tree + 1, np.uint64))
    for j in range(DEPTH):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, (tree * DEPTH + j) % N_HASH].astype(np.uint64))
    return h


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, N_HASH)


def _first_keys(batches):
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("tree", pa.int32())])
    for b in batches:
        if b.num_rows:
            node, sig = b.column(0).to_numpy(), _matrix(b.column(1))
            for t in range(TREES):
                yield batch(schema, key=signed(_first_key(sig, t)), node=node, tree=np.full(len(node), t, np.int32))


_SORTED = pa.schema([("node", pa.int64()), ("tree", pa.int32()), ("order", pa.binary()), ("n_shingles", pa.int64())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("est", pa.int32())])


def _orders(batches):
    """The signature of each (node, tree, sig, n_shingles) row in its tree's order, as sortable bytes."""
    for b in batches:
        if b.num_rows:
            tree, sig = b.column(1).to_numpy(), _matrix(b.column(2))
            at = (tree[:, None].astype(np.int64) * DEPTH + np.arange(N_HASH)) % N_HASH
            rows = np.take_along_axis(sig, at, 1).astype(">u4")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in rows], pa.binary()), b.column(3)], schema=_SORTED)


def _neighbours(batches):
    """Pairs of rows that follow each other within NEIGHBOURS places, share DEPTH minima at least and
    pass the estimate, which the rows' whole signatures give at once."""
    tree, node, size, sig = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, N_HASH), ">u4")
    for b in batches:
        if not b.num_rows:
            continue
        new = len(node)
        node, tree, size = (np.concatenate([old, b.column(k).to_numpy()]) for old, k in ((node, 0), (tree, 1), (size, 3)))
        sig = np.concatenate([sig, np.frombuffer(b"".join(b.column(2).to_pylist()), ">u4").reshape(-1, N_HASH)])
        for k in range(1, NEIGHBOURS + 1):
            i = np.arange(max(new, k), len(node))
            i = i[(tree[i] == tree[i - k]) & (sig[i, :DEPTH] == sig[i - k, :DEPTH]).all(1) & (node[i] != node[i - k])]
            est = (sig[i] == sig[i - k]).sum(1).astype(np.int32)
            ok = likely(est, size[i], size[i - k])
            i, est = i[ok], est[ok]
            yield batch(_PAIRS, a=np.minimum(node[i], node[i - k]), b=np.maximum(node[i], node[i - k]), est=est)
        node, tree, size, sig = (x[-NEIGHBOURS:] for x in (node, tree, size, sig))


def likely(est: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Can two sets of these sizes, whose signatures agree in ``est`` minima, be linked."""
    return (est >= LEAST_ESTIMATE * N_HASH) & (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb))


def _leaf_pairs(batches):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for b in batches:
        out = [np.array([[x, y] for k, x in enumerate(m) for y in m[k + 1 :]], np.int64).reshape(-1, 2) for m in (sorted(set(v)) for v in b.column(0).to_pylist())]
        if out:
            p = np.concatenate(out)
            yield batch(schema, a=p[:, 0], b=p[:, 1])


def candidates(scratch: Scratch, nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidate pairs (a < b) of ``nodes`` (node, sig): those of small regions and with central members,
    those of neighbours in larger regions, and the nodes of larger regions."""
    first = scratch.write(nodes.select("node", "sig").mapInArrow(_first_keys, "key long, node long, tree int"), "first")
    # counts are written before they are joined back, so that a key with many rows is a skewed join
    # that adaptive execution splits
    n0 = scratch.write(first.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "n0")
    met = scratch.write(first.join(n0, "key"), "met")
    scratch.drop("first")
    big = met.where(F.col("n") > LEAF)
    pairs = met.where(F.col("n") <= LEAF).groupBy("key").agg(F.collect_list("node").alias("nodes")).select("nodes").mapInArrow(_leaf_pairs, "a long, b long")
    # larger regions: neighbours in the sorted order of each tree
    order = big.select("node", "tree").join(nodes.select("node", "sig", "n_shingles"), "node").select("node", "tree", "sig", "n_shingles").mapInArrow(_orders, "node long, tree int, order binary, n_shingles long")
    order = scratch.write(order, "orders")
    near = scratch.write(order.repartitionByRange("tree", "order").sortWithinPartitions("tree", "order").mapInArrow(_neighbours, "a long, b long, est int").distinct(), "neighbours")
    # and the most central members, those that share the most prefixes
    central = scratch.write(big.groupBy("node").agg(F.sum("n").alias("c")), "central")
    ranked = scratch.write(big.select("key", "node").join(central, "node"), "ranked")
    leader = scratch.write(ranked.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(LEADERS)).alias("part")).agg(F.max(F.struct("c", (-F.col("node")).alias("m"))).alias("x")).select("key", (-F.col("x.m")).alias("leader")), "leader")
    star = ranked.join(leader, "key").where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
    out = scratch.write(pairs.union(star).distinct(), "pairs")
    scratch.drop("met", "n0", "orders", "ranked", "leader")
    return out, near, central.select("node")


def _estimate(batches):
    for b in batches:
        if b.num_rows:
            est = (_matrix(b.column(2)) == _matrix(b.column(3))).sum(1).astype(np.int32)
            ok = likely(est, b.column(4).to_numpy(), b.column(5).to_numpy())
            yield batch(_PAIRS, a=b.column(0).to_numpy()[ok], b=b.column(1).to_numpy()[ok], est=est[ok])


def _sets(batches):
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary())])
    for b in batches:
        yield batch(schema, node=b.column(0), set=[shingle_set(t).tobytes() for t in b.column(1).to_pylist()])


def _cells(h: np.ndarray) -> np.ndarray:
    return (mix64(h) >> np.uint64(47)).astype(np.int64)


_TALLY = pa.schema([("block", pa.int32()), ("n", pa.binary())])
_TALLY_DDL = "block int, n binary"


def _blocks(n: np.ndarray) -> pa.RecordBatch:
    """A row for each ``SPAN`` cells of a table of counts that are not all zero."""
    rows = n.reshape(-1, SPAN)
    at = np.flatnonzero(rows.any(1))
    return batch(_TALLY, block=at.astype(np.int32), n=[rows[k].tobytes() for k in at])


def _tally(batches):
    """How many sets have a shingle of each cell, in blocks."""
    n = np.zeros(CELLS, np.int64)
    for b in batches:
        if b.num_rows:
            n += np.bincount(_cells(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64)), minlength=CELLS)
    yield _blocks(n)


def _total(batches):
    """The sum of the blocks' counts."""
    n = np.zeros(CELLS, np.int64)
    for b in batches:
        for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            n[k * SPAN : (k + 1) * SPAN] += np.frombuffer(x, np.int64)
    yield _blocks(n)


def tally(sets: DataFrame) -> np.ndarray:
    """How many of the sets have a shingle of each of the ``CELLS`` cells. Counts travel in blocks, so a task
    gives at most CELLS / SPAN rows, however many shingles it has."""
    rows = sets.select("set").mapInArrow(_tally, _TALLY_DDL).repartition("block").mapInArrow(_total, _TALLY_DDL)
    counts = np.zeros(CELLS, np.int64)
    for r in rows.toArrow().to_pylist():  # CELLS counts at most
        counts[r["block"] * SPAN : (r["block"] + 1) * SPAN] += np.frombuffer(r["n"], np.int64)
    return counts


def prefix(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The rarest shingles of a set that have to be looked at, and how many of them when the other set
    is as large or larger."""
    n = len(h)
    order = np.lexsort((h, counts[_cells(h)]))
    probe = n - -(-PERCENT * n // 100) + 1
    index = n - -(-2 * PERCENT * n // (100 + PERCENT)) + 1
    return h[order[:probe]], index


def rare_pairs(scratch: Scratch, sets: DataFrame, comp: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of the nodes of ``sets`` that belong to different components and may be linked, those
    with one of the nodes of ``wanted`` at least where it is given: a complete prefix filter. Shingles are ordered by their counts in a table of bounded size; any order
    gives all pairs, and a good one few others. At the first shingle that two linked sets share, what either
    has from there on is no less than what they share, so places too far on are not paired."""
    counts = tally(sets)
    shared = scratch.spark.sparkContext.broadcast(counts)

    def run(batches):
        schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("index", pa.bool_()), ("left", pa.int32())])
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                sets = [np.frombuffer(x, np.uint64) for x in part.column(1).to_pylist()]
                rare = [prefix(h, shared.value) for h in sets]
                m = [len(k) for k, _ in rare]
                at = np.concatenate([np.arange(k, dtype=np.int32) for k in m])
                n = np.repeat(np.array([len(h) for h in sets], np.int32), m)
                yield batch(schema, key=signed(np.concatenate([k for k, _ in rare])), node=np.repeat(part.column(0).to_numpy(), m), n=n,
                            index=at < np.repeat([i for _, i in rare], m), left=n - at)

    met = sets.select("node", "set").mapInArrow(run, "key long, node long, n int, index boolean, left int").join(comp.select("node", F.col("comp").alias("c")), "node", "left")
    met = met.withColumn("on", F.lit(True)) if wanted is None else met.join(wanted.select("node", F.lit(True).alias("on")), "node", "left")
    met = scratch.write(met.select("key", "node", "n", "index", "left", F.coalesce("c", "node").alias("c"), F.coalesce("on", F.lit(False)).alias("on")), "prefixes")
    keys = met.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.bool_or("index").alias("any"), F.bool_or("on").alias("some")).where("lo <> hi and any and some").select("key")
    keys = scratch.write(keys, "prefix-keys")
    met = scratch.write(met.join(selective(keys, "key"), "key"), "prefix-met", bloom=True)
    small = met.where("index").select("key", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("left").alias("lx"), F.col("c").alias("cx"), F.col("on").alias("ox"))
    large = met.select("key", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("left").alias("ly"), F.col("c").alias("cy"), F.col("on").alias("oy"))
    pairs = small.join(large, "key").where(f"cx <> cy and (ox or oy) and (nx < ny or nx = ny and x < y) and 100L * nx >= {PERCENT}L * ny and {100 + PERCENT}L * least(lx, ly) >= {PERCENT}L * (nx + ny)")
    out = scratch.write(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "rare")
    scratch.drop("prefixes", "prefix-keys", "prefix-met")
    return out


def _confirm(batches):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for b in batches:
        keep = np.zeros(b.num_rows, bool)
        for k, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[k] = 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield batch(schema, a=b.column(0).to_numpy()[keep], b=b.column(1).to_numpy()[keep])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets pass."""
    with_a = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    with_b = with_a.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    return with_b.select("a", "b", "sa", "sb").mapInArrow(_confirm, "a long, b long")


def pairs_of(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b")


def estimate(scratch: Scratch, pairs: DataFrame, nodes: DataFrame, label: str) -> DataFrame:
    """(a, b, est): the pairs whose signatures and set sizes allow a link, and how many minima agree."""
    s = nodes.select("node", "sig", "n_shingles")
    x = pairs.join(s.select(F.col("node").alias("a"), F.col("sig").alias("sa"), F.col("n_shingles").alias("na")), "a")
    x = x.join(s.select(F.col("node").alias("b"), F.col("sig").alias("sb"), F.col("n_shingles").alias("nb")), "b")
    return scratch.write(x.select("a", "b", "sa", "sb", "na", "nb").mapInArrow(_estimate, "a long, b long, est int"), label)


def crossing(scratch: Scratch, pairs: DataFrame, comp: DataFrame, label: str) -> DataFrame:
    """The pairs that join two components as they are known so far."""
    half = pairs.join(comp.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left").select("b", "a", F.coalesce("ca", "a").alias("ca"))
    whole = half.join(comp.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
    return scratch.write(whole.where(F.col("ca") != F.coalesce("cb", "b")).select("a", "b"), f"crossing-{label}")


def _hashed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    c = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(c).alias("t1"), F.hash(c).cast("long").alias("t2"), c.alias("text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept; and row_id, the text's hashes t1 and
    t2, and c, the component's own number, which no two components share whatever their ids."""
    bounded_batches(spark)
    scratch = Scratch(spark, "near-dup", broadcast=False)
    src = _hashed(docs, text, doc_id)
    sig = scratch.write(src.select(F.monotonically_increasing_id(), "doc_id", "t1", "t2", "text").mapInArrow(_signatures, _SIG_DDL), "signatures")
    full = sig.where("n_shingles > 0")
    classes = scratch.write(full.groupBy("fp1", "fp2").agg(F.min("row_id").alias("node")), "classes")
    nodes = full.join(classes.select(F.col("node").alias("row_id")), "row_id", "left_semi").withColumnRenamed("row_id", "node")
    nodes = scratch.write(nodes, "nodes")
    pairs, near, dense = candidates(scratch, nodes)
    est = estimate(scratch, pairs, nodes, "estimates1")
    scratch.drop("pairs")
    scratch.tidy()

    # full sets of all nodes in question, from the texts
    ends = est.select(F.col("a").alias("node")).union(est.select(F.col("b").alias("node"))).union(dense).distinct()
    wanted = scratch.write(nodes.select("node", "doc_id", "t1", "t2").join(ends, "node", "left_semi"), "wanted")
    sets = rows_by_text(spark, src, wanted, once=True).select("node", "text").mapInArrow(_sets, "node long, set binary")
    sets = scratch.write(sets, "sets", bloom=True)
    scratch.tidy()

    # first each document's most promising pair, then what still joins two components
    ways = est.select(F.col("a").alias("x"), F.col("b").alias("y"), "est").union(est.select(F.col("b").alias("x"), F.col("a").alias("y"), "est"))
    best = ways.groupBy("x").agg(F.max(F.struct("est", (-F.col("y")).alias("m"))).alias("w")).select("x", (-F.col("w.m")).alias("y"))
    best = scratch.write(best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "best")
    links = scratch.write(confirm(best, sets), "links1")
    comp = stars(scratch, links, "cc1")
    left = crossing(scratch, pairs_of(near).union(pairs_of(est)).distinct().join(best, ["a", "b"], "left_anti"), comp, "rest")
    more = scratch.write(confirm(left, sets), "links2")
    scratch.drop("estimates1", "best", "neighbours", "crossing-rest")
    comp = stars(scratch, comp.union(more).toDF("a", "b"), "cc2")
    if not dense.isEmpty():  # members of larger regions that may still be apart
        rare = estimate(scratch, rare_pairs(scratch, sets.join(dense, "node", "left_semi"), comp), nodes, "estimates3")
        more = scratch.write(confirm(rare, sets), "links3")
        if not more.isEmpty():
            comp = stars(scratch, comp.union(more).toDF("a", "b"), "cc3")

    # rows -> class -> component -> smallest doc_id
    mine = ["row_id", "doc_id", "t1", "t2", "n_shingles"]
    of = full.select(*mine, "fp1", "fp2").join(classes, ["fp1", "fp2"]).select(*mine, "node")
    of = of.join(comp.withColumnRenamed("comp", "c"), "node", "left").select(*mine, F.coalesce("c", "node").alias("c"))
    of = scratch.write(of, "rows")
    least = scratch.write(of.groupBy("c").agg(F.min("doc_id").alias("component_id")), "least")
    out = of.join(least, "c").select(*mine, "component_id", "c")
    out = out.union(sig.where("n_shingles = 0").select(*mine, F.col("doc_id").alias("component_id"), F.col("row_id").alias("c")))
    out = scratch.write(out, "result")
    scratch.drop("signatures", "classes", "nodes", "wanted", "sets", "central", "links1", "links2", "rare", "estimates3", "links3", "rows", "least", *[f"cc{i}-{k}" for i in (1, 2, 3) for k in range(100)])
    scratch.tidy()
    return out.withColumn("kept", F.expr("doc_id <=> component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents, one row of each group, whatever ids they have: that of the smallest doc_id, and of
    rows that share that id the first by text hash. Rows without words all stay, since they are linked
    with nothing. Rows that surely stay pass through without a shuffle (``KeyFilter``)."""
    found = near_duplicates(spark, docs, text, doc_id)
    scratch = Scratch(spark, "near-dup-keep")
    own = [F.col(f"`{c}`") for c in docs.columns]
    key, h1, h2, i, number = fresh(docs, "key", "t1", "t2", "i", "number")
    groups = found.where("n_shingles > 0").groupBy("c", "doc_id", "t1", "t2", "kept").agg(F.count("*").alias("n"))
    lead = scratch.write(groups.where("kept").groupBy("c").agg(F.min(F.struct("t1", "t2", "n", "doc_id")).alias("x")).select("c", "x.*"), "leads")
    single = lead.where("n = 1").select(F.col("c").alias("lc"), F.col("doc_id").alias("li"), F.col("t1").alias("l1"), F.col("t2").alias("l2"))
    # keys of rows that go, and of rows of which one stays
    drop = groups.join(single, F.expr("c = lc and doc_id <=> li and t1 = l1 and t2 = l2"), "left_anti")
    drop = scratch.write(drop.select(F.xxhash64("doc_id", "t1", "t2").alias(key), F.col("doc_id").alias(i), F.col("t1").alias(h1), F.col("t2").alias(h2)), "drop")
    src = docs.withColumns({h1: F.xxhash64(F.col(f"`{text}`")), h2: F.hash(F.col(f"`{text}`")).cast("long")})
    src = src.withColumn(key, F.xxhash64(F.col(f"`{doc_id}`").cast("long"), h1, h2))
    known = KeyFilter(spark, drop, key)
    kept = src.where(~known.maybe(key)).select(*own)
    maybe = src.where(known.maybe(key))
    same = [maybe[h1] == drop[h1], maybe[h2] == drop[h2], F.col(f"`{doc_id}`").cast("long").eqNullSafe(drop[i])]
    kept = kept.union(maybe.join(drop, same, "left_anti").select(*own))
    again = scratch.write(lead.where("n > 1").select(F.xxhash64("doc_id", "t1", "t2").alias(key)), "again")
    if again.isEmpty():
        return kept
    # rows of one id and one text: the first by all columns, without texts in the shuffle of the choice
    rows = scratch.write(maybe.join(again, key, "left_semi").withColumn(number, F.monotonically_increasing_id()), "shared", "zstd")
    order = rows.select(key, number, F.xxhash64(*own).alias(h1)).groupBy(key).agg(F.min(F.struct(h1, number)).alias("x")).select(F.col(f"x.{number}").alias(number))
    return kept.union(rows.join(order, number, "left_semi").select(*own))
