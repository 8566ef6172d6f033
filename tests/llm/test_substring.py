import random
from collections import defaultdict

from pyspark.sql import functions as F

from registra.llm import substring as S
from registra.llm.common import Scratch
from registra.llm.passages import text_words

from .docs import DDL, awkward, prose


def line(rng, n):
    return " ".join(f"v{rng.randrange(3000)}" for _ in range(n))


def words(t):
    return (t or "").encode().lower().split()


def windows(rows, n=S.LEAST):
    by = defaultdict(set)
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            by[tuple(w[k : k + n])].add(i)
    return by


def brute(rows):
    """Documents with a run of 50 words that another document has too."""
    return {i for v in windows(rows).values() if len(v) > 1 for i in v}


def row(i, t):
    return (i, t, "en", "a", len(t), "", "")


def corpus(n=600, seed=9):
    """Documents of which some share passages of 51 to 200 words, inside lines, across lines and edited."""
    rng = random.Random(seed)
    docs = [[line(rng, rng.randint(5, 120)) for _ in range(rng.randint(1, 6))] for _ in range(n)]
    planted, used = set(), set()
    for _ in range(n // 20):
        p = line(rng, rng.choice((51, 55, 60, 80, 120, 200)))
        for d in rng.sample(range(n), rng.choice((2, 2, 3, 12))):
            k = rng.randrange(len(docs[d]))
            if (d, k) in used:
                continue  # none inside another
            used.add((d, k))
            at = rng.randrange(1 + len(docs[d][k].split()))
            w = docs[d][k].split()
            q = p if rng.random() < 0.7 else "\n".join(" ".join(p.split()[i : i + 11]) for i in range(0, len(p.split()), 11))
            docs[d][k] = " ".join([*w[:at], q, *w[at:]])
            planted.add(d)
    return [row(i, "\n".join(d)) for i, d in enumerate(docs)], planted


def test_shared_passages_match_brute_force(spark):
    rows, planted = corpus()
    df = spark.createDataFrame(rows, DDL)
    p = S.repeated_passages(spark, df)
    found = {r.doc_id for r in p.collect()}
    want = brute(rows)
    assert planted >= want and len(want) > 60
    assert found >= want  # recall 1 for exact passages
    assert len(found - want) <= 0.01 * (len(rows) - len(want))
    left = [tuple(r) for r in S.remove(spark, df, p).collect()]
    assert not brute(left)
    text = {r[0]: r[1] for r in left}
    assert all(text[i] == t for i, t, *_ in rows if i not in planted)
    first = {min(v) for v in windows(rows).values() if len(v) > 1}
    assert all(any(set(w) <= set(words(text[d])) for w in windows([(d, rows[d][1])])) for d in first)


def test_edited_passages_are_one_class(spark):
    rng = random.Random(3)
    p = line(rng, 120).split()
    rows, texts = [], {}
    for i in range(12):
        w = list(p)
        for _ in range(i % 3):
            w[rng.randrange(30, 90)] = f"edit{i}"
        texts[i] = f"{line(rng, 40)} {' '.join(w)} {line(rng, 70)}"
        rows.append(row(i, texts[i]))
    rows += [row(100 + i, line(rng, 200)) for i in range(10)]
    out = S.repeated_passages(spark, spark.createDataFrame(rows, DDL)).collect()
    assert {r.doc_id for r in out} == set(range(12)) and len({r.class_id for r in out}) == 1
    assert [r.doc_id for r in out if not r.removed] == [0]
    for r in out:
        got = words(texts[r.doc_id])[r["first"] : r["first"] + r.n_words]
        assert 110 <= len(got) <= 130 and got[:20] == [x.encode() for x in p[:20]]


def test_passages_of_later_texts_whose_paragraphs_have_other_first_holders(spark):
    """Two texts share 80 words; earlier texts hold every short part of them, never 50 words together."""
    rng = random.Random(5)
    p = line(rng, 80).split()
    rows = [row(i, f"{line(rng, 60)} {' '.join(p[k : k + 40])} {line(rng, 60)}") for i, k in enumerate(range(0, 45, 5))]
    rows += [row(100 + i, f"{line(rng, 60)} {' '.join(p)} {line(rng, 60)}") for i in range(3)]
    out = S.repeated_passages(spark, spark.createDataFrame(rows, DDL)).collect()
    assert brute(rows) == {100, 101, 102} == {r.doc_id for r in out}
    assert sorted(r.doc_id for r in out if r.removed) == [101, 102] and all(r.n_words >= 80 for r in out)


def test_near_paragraphs_in_a_large_band(spark):
    """Paragraphs of one template, more than a band is compared in full for: every near pair gives a seed."""
    rng = random.Random(6)
    base = line(rng, 41).split()
    texts = {tuple([*base[:-8], *(f"x{rng.randrange(3)}y{j}" for j in range(8))]) for _ in range(40)}
    texts = [" ".join(t) for t in texts]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(37)} for t in texts]
    want = {(b, a) for b in range(len(sets)) for a in range(b) if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])}
    units = spark.createDataFrame([(i, i, i, i, t) for i, t in enumerate(texts)], "row_id long, doc_id long, t1 long, t2 long, text string")
    par = units.mapInArrow(S._units, S._UNIT_DDL).where("bands is not null").groupBy("t1").agg(*[F.min_by(c, "pos").alias(c) for c in ("row_id", "doc_id", "t2", "pos", "n_words", "fp", "bands")])
    seeds = S.near_seeds(Scratch(spark, "t"), units.drop("row_id"), units.select("t1", "t2", "doc_id"), par.where("n_words = 41"), spark.createDataFrame([], "t1 long, t2 long, cover array<struct<x0: long, x1: long>>"))
    got = {(r.t1, r.h1) for r in seeds.collect()}
    n = {r.t1 for r in par.where("n_words = 41").collect()}
    want = {p for p in want if set(p) <= n}
    reach = {i: i for i in n}

    def find(x):
        while reach[x] != x:
            x = reach[x]
        return x

    for a, b in got & {(x, y) for x in n for y in n if 4 * len(sets[x] & sets[y]) >= 3 * len(sets[x] | sets[y])}:
        reach[find(a)] = find(b)
    assert len(n) > S.LEAF and want and all(find(a) == find(b) for a, b in want)


def test_one_of_equal_rows_keeps_its_text(spark):
    rng = random.Random(4)
    texts = [line(rng, 60), line(rng, 45) + "\n" + line(rng, 60)]
    rows = [(k, t, "en", "a", 0, "", "") for k, t in zip((1, None), texts, strict=True) for _ in range(3)]
    rows += [(9, texts[0], "en", "a", 0, "", ""), (-(1 << 63), texts[0], "en", "a", 0, "", ""), ((1 << 63) - 1, texts[1], "en", "a", 0, "", "")]
    df = spark.createDataFrame(rows, DDL)
    for c in ("t1", "t2", "spans", "lead", "number", "key", "__spans"):
        df = df.withColumn(c, F.lit(7))
    out = S.remove(spark, df, S.repeated_passages(spark, df))
    assert out.columns == df.columns
    out = out.collect()
    assert {(r.t1, r.spans, r.number) for r in out} == {(7, 7, 7)}
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(zip((-(1 << 63), None), texts, strict=True), key=str)


def test_awkward_rows(spark):
    df = spark.createDataFrame(awkward(), DDL)
    p = S.repeated_passages(spark, df)
    rows = p.collect()
    assert {0, 106, 107} <= {r.doc_id for r in rows} and not {100, 101, 102, 103, 109} & {r.doc_id for r in rows}
    text = {r.doc_id: r.text for r in S.remove(spark, df, p).collect()}
    assert {100, 101, 102, 103, 109} <= text.keys() and 106 not in text and text[100] is None
    assert S.repeated_passages(spark, df.limit(0)).count() == 0


def test_banding_is_tuned():
    b, r = S.tune()
    assert (b, r) == (S.BANDS, S.ROWS) and 1 - (1 - 0.75**r) ** b >= 0.98 and b <= 5


def test_windows_and_paragraphs_follow_the_content():
    rng = random.Random(1)

    def of(t):
        h = text_words(t)[0]
        return h, S.shingle_hashes(h)

    for _ in range(50):
        inner = line(rng, S.WINDOW + S.SPREAD - 1)
        found = [set(S.windows(*of(f"{line(rng, rng.randrange(90))} {inner} {line(rng, rng.randrange(90))}"))[1].tolist()) for _ in range(2)]
        assert found[0] & found[1]
    inner = line(rng, 400)
    par = [S.paragraphs(*([x] for x in of(f"{line(rng, n)} {inner} {line(rng, n)}"))) for n in (0, 77)]
    assert len(set(par[0][3].tolist()) & set(par[1][3].tolist())) >= 4
    for t in (prose(rng, 500), "x" * 100_000, "é " * 4000, "a b c " * 3000, "one two", ""):
        h, s = of(t)
        at, fp = S.windows(h, s)
        plain = []
        n = len(h) - S.WINDOW + 1
        if n > 0:
            g = [int(x) for x in S._pairs(h)[:n]]
            w = min(S.SPREAD, n)
            plain = sorted({i for k in range(n - w + 1) for i in range(k, k + w) if g[i] == min(g[k : k + w])})
        assert S.starts(h).tolist() == plain and set(at.tolist()) <= set(plain) and len(at) == len(fp)
        g = [int(x) for x in S._pairs(h)] if len(h) > 1 else []
        r = S.REACH
        want = [i for i in range(1, len(g)) if len(g) > 2 * r and all(g[i] < x for x in g[max(0, i - r) : i]) and all(g[i] <= x for x in g[i + 1 : i + r + 1])]
        assert S.cuts(h).tolist() == ([0] if len(h) else []) + want
