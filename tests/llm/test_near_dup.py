import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from registra.llm import near_dup
from registra.llm.common import Scratch, components, rows_by_text
from registra.llm.near_dup import keep_one, near_duplicates

from .docs import DDL, awkward, prose

NONE = 1 << 62


def words(t):
    return (t or "").encode().lower().split()


def shingles(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    par[find(i)] = find(j)
    least = defaultdict(lambda: NONE)
    for i, r in enumerate(rows):
        least[find(i)] = min(least[find(i)], NONE if r[0] is None else r[0])
    key = lambda v: None if v == NONE else v
    return sorted(((r[0], len(sets[i]), key(least[find(i)]) if sets[i] else r[0]) for i, r in enumerate(rows)), key=str)


def edited(rng, text, k):
    w = text.split(" ")
    for _ in range(k):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def got(spark, rows):
    out = near_duplicates(spark, spark.createDataFrame(rows, DDL)).collect()
    for r in out:
        assert r.kept == (r.doc_id == r.component_id)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)


def test_awkward_rows_match_brute_force(spark):
    rows = awkward()
    assert got(spark, rows) == brute(rows)
    assert near_duplicates(spark, spark.createDataFrame([], DDL)).count() == 0


def test_large_groups_match_brute_force(spark):
    """More near copies than a region holds, hung on an original that has no small id, and borderline pairs."""
    rng = random.Random(5)
    base = prose(rng, 200, 5000)
    texts = [edited(rng, base, rng.randint(1, 7)) for _ in range(90)] + [base]
    chain = [prose(rng, 150, 5000)]
    for _ in range(12):
        chain.append(edited(rng, chain[-1], 3))
    texts += chain + [prose(rng, 120, 5000) for _ in range(40)] + [base] * 40
    rng.shuffle(texts)
    rows = [(i, t, "en", "a", 0, "", "") for i, t in enumerate(texts)]
    assert got(spark, rows) == brute(rows)


def test_keep_one(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, DDL)
    kept = keep_one(spark, df)
    assert kept.columns == df.columns
    out = [tuple(r) for r in kept.collect()]
    want = brute(rows)
    firsts = {w[0] for w in want if w[0] == w[2]}
    assert {r[0] for r in out} == firsts
    assert sum(r[0] == 5 for r in out) == 1 and {100, 101, 102} <= {r[0] for r in out}


def test_template_family_in_a_large_region(spark):
    """Hundreds of documents alike at 0.69 of which a few pairs reach 0.75: every such link is found."""
    rng = random.Random(21)
    template = [f"t{k}" for k in range(160)]
    texts = []
    for k in range(400):
        own = [f"u{k}x{j}" for j in range(36)]
        texts.append((template, own))
        if k % 20 == 0:
            texts.append((template, [*own[:22], *[f"z{k}x{j}" for j in range(14)]]))
    rows = [(i, " ".join(a + b), "en", "a", 0, "", "") for i, (a, b) in enumerate(texts)]
    rng.shuffle(rows)
    want = brute(rows)
    assert 15 <= sum(w[0] != w[2] for w in want) <= 25
    assert got(spark, rows) == want


def test_ids_at_both_ends_and_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    rng = random.Random(23)
    t = prose(rng, 200, 5000)
    ids = (-(1 << 63), -(1 << 62), -(1 << 62) - 5, 0, (1 << 63) - 1, None)
    rows = [(i, edited(rng, t, 1), "en", "a", 0, "", "") for i in ids] + [(4, prose(rng, 90), "en", "a", 0, "", ""), (4, prose(rng, 90), "en", "a", 0, "", "")]
    assert got(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, DDL)
    for c in ("__id", "__hash", "t1", "t2", "key", "i", "number", "node", "c"):
        df = df.withColumn(c, F.lit(7))
    out = keep_one(spark, df)
    assert out.columns == df.columns
    got_ = out.collect()
    assert sorted(r.doc_id for r in got_) == [-(1 << 63), 4, 4] and {r["__id"] for r in got_} == {7}


def test_unlinked_rows_of_one_id_stay(spark):
    rng = random.Random(8)
    texts = [prose(rng, 80, 5000) for _ in range(5)]
    rows = [(i, t, "en", "a", 0, "", "") for i, t in zip((None, None, 7, 7, 9), texts, strict=True)]
    rows += [rows[0], rows[2], (8, texts[3], "en", "a", 0, "", ""), (None, None, "en", "a", 0, "", ""), (None, "", "en", "a", 0, "", "")]
    out = keep_one(spark, spark.createDataFrame(rows, DDL)).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([*zip((None, None, 7, 7, 9), texts, strict=True), (None, None), (None, "")], key=str)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 400)] + [(1, 2), (2, 3), (3, 1), (9, 9)]
    df = spark.createDataFrame(edges, "a long, b long")
    c = {r.node: r.comp for r in components(Scratch(spark, "t"), df).collect()}
    assert all(c[i] == 100 for i in range(100, 161)) and all(c[k] == 7 for k in range(200, 400)) and c[3] == c[2] == c[1] == 1 and 9 not in c
    assert components(Scratch(spark, "t"), df.limit(0)).count() == 0


def test_components_in_few_rounds(spark):
    """Long chains, a hub of the largest id and a random graph, in shuffled order: right, with few tables written."""

    class Counting(Scratch):
        n = 0

        def write(self, *args, **kw):
            Counting.n += 1
            return super().write(*args, **kw)

    rng = random.Random(31)
    ids = rng.sample(range(1 << 40), 6000)
    edges = [(ids[i], ids[i + 1]) for i in range(1500)] + [(1 << 41, x) for x in ids[2000:3000]]
    edges += [(rng.choice(ids[3000:]), rng.choice(ids[3000:])) for _ in range(2500)]
    rng.shuffle(edges)
    par = {x: x for e in edges for x in e}

    def find(x):
        while par[x] != x:
            par[x] = x = par[par[x]]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    rows = components(Counting(spark, "t"), spark.createDataFrame(edges, "a long, b long").repartition(8)).collect()
    assert len(rows) == len(want) and {r.node: r.comp for r in rows} == want
    assert Counting.n <= 7


def test_forest_keeps_components_and_blocks_are_bounded(monkeypatch):
    from registra.llm import common

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 4000, (2, 3000))
    node, root = common.forest(a, b)
    assert len(np.unique(node)) == len(node) and not np.isin(root, node).any() and (root < node).all()
    monkeypatch.setattr(common, "EDGES", 500)
    parts = [pa.RecordBatch.from_arrays([pa.array(a[k : k + 100]), pa.array(b[k : k + 100])], ["a", "b"]) for k in range(0, 3000, 100)]
    out = list(common._forests(iter(parts)))
    assert len(out) > 1 and max(x.num_rows for x in out) < 700
    again = common.forest(*(np.concatenate([x.column(k).to_numpy() for x in out]) for k in (0, 1)))
    assert np.array_equal(again[0], node) and np.array_equal(again[1], root)
    assert list(common._forests(iter([]))) == []


def test_word_hashes_do_not_depend_on_place():
    from registra.llm.common import doc_words, hash_words

    big = "a" * (3 << 20)
    t = f"x {big} y x {big}b {big}"
    d, s, e = doc_words(t)
    h = hash_words(d, s, e)
    assert h[0] == h[3] and h[1] == h[5] != h[4] and len(set(h.tolist())) == 4
    assert near_dup.shingle_set(None).size == 0


def test_repeated_rows_do_not_multiply(spark, tmp_path):
    """Copies of two near texts, without ids and of one id: every node has one set, and all are linked."""
    rng = random.Random(12)
    a = prose(rng, 200)
    b = a.replace("the", "a", 1)
    rows = [(None, a), (None, b)] * 1000 + [(7, a + " end"), (8, b + " end")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    src = near_dup._hashed(docs, "text", "doc_id")
    want = src.select("doc_id", "t1", "t2", F.col("t1").alias("node")).distinct()
    assert rows_by_text(spark, src, want).count() == 2600
    once = rows_by_text(spark, src, want, once=True)
    assert sorted(r.text for r in once.collect()) == sorted([a, b, a + " end", b + " end"])
    got = near_dup.near_duplicates(spark, docs)
    assert got.count() == 2600 and got.select("c").distinct().count() == 1


def test_tally_counts_every_cell_in_few_rows(spark):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 3000, np.uint64)) for _ in range(40)] + [np.empty(0, np.uint64)]
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "node long, set binary").repartition(8)
    want = np.bincount(near_dup._cells(np.concatenate(sets)), minlength=near_dup.CELLS)
    assert np.array_equal(near_dup.tally(df), want)
    part = pa.RecordBatch.from_pydict({"set": pa.array([x.tobytes() for x in sets], pa.binary())})
    assert sum(b.num_rows for b in near_dup._tally([part])) <= near_dup.CELLS // near_dup.SPAN < 3000
    assert not near_dup.tally(df.limit(0)).any()
