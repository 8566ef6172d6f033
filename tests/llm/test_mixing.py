import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from registra.llm.mixing import GROWTH, MAX_COPIES, NEAR, apply_mix, mix, uniform

from .docs import DDL, awkward


def targets(sizes):
    """Water filling, step by step."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    t, left, active = {}, float(sum(sizes.values())), set(order)
    while active:
        level = left / sum(w[s] for s in active)
        over = {s for s in active if w[s] * level >= MAX_COPIES * sizes[s]}
        if not over:
            t |= {s: w[s] * level for s in active}
            break
        for s in over:
            t[s] = float(MAX_COPIES * sizes[s])
            left -= t[s]
        active -= over
    return t


def test_targets_and_copies(spark):
    rows = awkward() + [(1000 + i, "a b c d e f g h i j", "en", "tiny" if i < 2 else "z", 0, "", "") for i in range(60)]
    df = spark.createDataFrame(rows, DDL)
    got = mix(spark, df).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    want = targets(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] and r.taken <= MAX_COPIES * r["size"]
        taken[r.source] += r.taken
    for s, t in want.items():
        smallest = min((r["size"] for r in got if r.source == s and r["size"]), default=0)
        assert abs(t - taken[s]) <= max(0.1 * t, smallest)
    again = {(r.doc_id, r["size"], r.taken) for r in mix(spark, df.repartition(3)).collect()}
    assert again == {(r.doc_id, r["size"], r.taken) for r in got}


def test_mixed_documents(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, DDL)
    out = apply_mix(spark, df)
    assert out.columns == df.columns
    want = sum(r.copies for r in mix(spark, df).collect())
    assert out.count() == want
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in df.collect()}
    assert mix(spark, df.limit(0)).count() == 0 and apply_mix(spark, df.limit(0)).count() == 0


def plain_mix(rows, seed_u):
    """Copies of (id, source, size) by a plain Pareto sampler; sources in one dict."""
    want, size_of = {}, defaultdict(int)
    for _, s, n in rows:
        size_of[s] += n
    for s, t in targets(dict(size_of)).items():
        mine = [(i, n) for i, s2, n in rows if s2 == s]
        w = {i: 2.0 ** (GROWTH * int(math.log2(max(n, 1)))) for i, n in mine}
        low, high = 0.0, 1e6
        for _ in range(200):  # the level at which the expected words meet the target
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(MAX_COPIES, mid * w[i]) * n for i, n in mine) < t else (low, mid)
        e = {i: min(MAX_COPIES, low * w[i]) for i, _ in mine}
        e = {i: round(x) if abs(x - round(x)) < 1e-9 else x for i, x in e.items()}
        got = {i: math.floor(x) for i, x in e.items()}
        room = t - sum(got[i] * n for i, n in mine)
        odds = lambda x: x / (1 - x)
        order = sorted((odds(seed_u[i]) / odds(e[i] % 1), i, n) for i, n in mine if e[i] % 1 and n)
        for sample in range(1, MAX_COPIES + 1):
            rest, most = [x for x in order if math.floor(e[x[1]]) + sample <= MAX_COPIES], room
            for _, i, n in rest:
                if n > most:
                    continue
                if n > room:  # a front ends here
                    if room <= NEAR * t:
                        break
                    most = room
                elif most > NEAR * t:
                    got[i] += 1
                    room -= n
        left = [(abs(n - room), q, i) for q, i, n in order if n < 2 * room and got[i] < MAX_COPIES]
        if left:
            got[min(left)[2]] += 1
        want |= {i: (got[i], e[i]) for i in got}
    return want


def test_sample_is_the_plain_pareto_sample(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice("aaab"), int(rng.paretovariate(0.9) * 7) % 900) for i in range(1500)] + [(9000 + i, "c", 50 + 3000 * (i == 0)) for i in range(12)]
    df = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, s, n in rows], "doc_id long, text string, source string").cache()
    hits, trials = defaultdict(int), 2
    for seed in range(trials):  # each is a whole mix
        u = {r.doc_id: r.u for r in df.select("doc_id", uniform(F.col("doc_id"), F.col("text"), seed).alias("u")).collect()}
        got = {r.doc_id: r for r in mix(spark, df, seed=seed).collect()}
        want = plain_mix(rows, u)
        if seed < 2:
            assert sum(got[i].copies != want[i][0] for i, s, _ in rows) <= 2  # sums of doubles may part at a front's end
        for i, s, n in rows:
            if s == "a" and n:
                hits[int(math.log2(n))] += got[i].copies - want[i][1]
    for k, miss in hits.items():  # by class, the copies taken are near those expected
        n = trials * sum(1 for _, s, m in rows if s == "a" and m and int(math.log2(m)) == k)
        assert abs(miss) <= 4 * math.sqrt(n * 0.25) + 2
    df.unpersist()


def test_one_hot_source(spark):
    rows = [(i, " ".join("w" for _ in range(1 + i % 40)), "en", "hot" if i % 3 else f"s{i % 7}", 0, "", "") for i in range(3000)]
    got = mix(spark, spark.createDataFrame(rows, DDL)).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 0.01 * t + 1 for s, t in target.items())


def test_columns_named_like_the_plan(spark):
    df = spark.createDataFrame(awkward(), DDL)
    clash = df.withColumn("extra", F.lit(1)).withColumnsRenamed({"extra": "copies", "q": "rank"}).withColumn("size", F.lit("s")).withColumn("fronts", F.lit(0)).withColumn("a.b", F.lit(2))
    out = apply_mix(spark, clash)
    assert out.columns == clash.columns and {(r["copies"], r["size"], r["fronts"], r["a.b"]) for r in out.collect()} == {(1, "s", 0, 2)}
