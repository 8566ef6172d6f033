"""Language identification, toxicity and the language model."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from registra.llm import hmm, langid, media, toxicity

from .docs import DDL, awkward

EN = "the of and to in is that it for was on are with as be by this from at or an have which you".split()
DE = "der die und das in den von zu mit ist des auf für im dem nicht ein eine als auch an es so wie".split()


def talk(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(("", "s", "en", "ly")) for _ in range(n))


def test_language_held_out(spark):
    rng = random.Random(2)
    rows = [(i, talk(rng, EN if i % 2 else DE, rng.randint(5, 40)), "en" if i % 2 else "de", "a", 0, "", "") for i in range(200)]
    df = spark.createDataFrame(rows, DDL)
    model = langid.train(spark, df.where("doc_id < 150"))
    out = {r.doc_id: r for r in langid.predict(spark, df.where("doc_id >= 150"), model).collect()}
    assert np.mean([out[r[0]].lang_pred == r[2] for r in rows[150:]]) > 0.95
    assert all(0 <= r.score <= 1 for r in out.values())


def test_language_of_awkward_rows(spark):
    df = spark.createDataFrame(awkward() + [(300, "12 34 !?", "en", "a", 0, "", "")], DDL)
    model = langid.train(spark, df)
    out = langid.predict(spark, df, model).collect()
    assert len(out) == df.count()
    by = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert by[100] == by[101] == by[102] == by[300] == ("und", 0.0) and by[109][0] in ("en", "de")
    none = langid.train(spark, df.limit(0))
    assert {r.lang_pred for r in langid.predict(spark, df, none).collect()} == {"und"}
    assert langid.predict(spark, df.limit(0), model).count() == 0


def test_cells_of_blocks_agree():
    rng = random.Random(3)
    t = talk(rng, EN, 2000)
    whole = langid.cell_counts(t)
    old, langid.BLOCK_CHARS = langid.BLOCK_CHARS, 700
    try:
        for u in (". a", " ab  c.", "A\u03a3 b", "..", "\u0130" * 5, t[:701], t[:1400] + " ", "." * 900 + t[:900]):
            langid.BLOCK_CHARS = 3 if len(u) < 20 else 700
            a = langid.cell_counts(u)
            langid.BLOCK_CHARS = old
            b = langid.cell_counts(u)
            assert (a is None) == (b is None) and (a is None or all(np.array_equal(x, y) for x, y in zip(a, b, strict=True)))
        langid.BLOCK_CHARS = 700
        parts = langid.cell_counts(t)
    finally:
        langid.BLOCK_CHARS = old
    assert all(np.array_equal(x, y) for x, y in zip(parts, whole, strict=True))


# toxicity


def brute_maximal(scores):
    """Maximal segments by their definition: no wider segment scores as much, and every proper part
    and proper extension inside scores less."""
    found = []

    def go(lo, hi):
        best = max(((sum(scores[a:b]), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
        if best[0] > 1e-9:
            a = -best[2]
            b = a - best[1]
            found.append((a, b - 1, best[0]))
            go(lo, a)
            go(b, hi)

    go(0, len(scores))
    return sorted(found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(1, 8).map(lambda k: k * 0.1371)), max_size=24))
def test_maximal_segments(hits):
    got = toxicity.maximal_segments([(i, s) for i, s in enumerate(hits) if s])
    want = brute_maximal([-toxicity.DRIFT if s is None else s for s in hits])
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_toxic_texts(spark):
    rng = random.Random(4)
    bad = [f"slur{c}" for c in "abcdef"]
    rows, labels = [], []
    for i in range(400):
        t = talk(rng, EN, rng.randint(40, 200)).split()
        if i % 5 == 0:
            for _ in range(4):
                t.insert(rng.randrange(len(t)), rng.choice(bad).upper() + ",")
        rows.append((i, " ".join(t), "en", "a", 0, "", ""))
        labels.append((i, 1, int(i % 5 == 0)))
    df = spark.createDataFrame(rows + awkward()[30:], DDL)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(spark, df, lab.where("doc_id < 300"))
    out = {r.doc_id: r for r in toxicity.score_texts(spark, df, model).collect()}
    for i, *_ in rows[300:]:
        assert (out[i].score >= toxicity.THRESHOLD) == (i % 5 == 0)
        assert i % 5 == 0 or not out[i].passages
    assert any(out[i].passages for i in range(300, 400))
    assert all(0 <= r.score <= 1 for r in out.values()) and out[100].score < 0.7 and out[101].n_tokens == 0
    for r in out.values():
        for p in r.passages:
            assert 0 <= p["first"] <= p["last"] < r.n_tokens
    empty = toxicity.train(spark, df, lab.limit(0))
    assert {r.score for r in toxicity.score_texts(spark, df, empty).collect()} == {0.0}
    assert toxicity.score_texts(spark, df.limit(0), model).count() == 0


def test_only_near_copies_are_left_out_of_learning():
    base = [f"w{k}" for k in range(60)]
    lead = " ".join(base)
    texts = [" ".join([*base[:30], "new", *base[31:]]), " ".join([*base[:20], *(f"v{k}" for k in range(40))]), lead.upper(), "one two", "", None]
    b = pa.RecordBatch.from_pydict({"text": texts, "y": pa.array([1] * 6, pa.int32()), "lead": [lead] * 6})
    (out,) = toxicity._apart([b])
    assert out.column(0).to_pylist() == [texts[1], "one two", "", None]


def test_kept_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, "some words here", "x")], "doc_id long, text string, __text string")
    model = toxicity.Model({"=words": 3.0}, 1.0, 0.1)
    (r,) = toxicity.score_texts(spark, df, model, keep=("doc_id", "__text")).collect()
    assert (r["__text"], r.n_tokens) == ("x", 3)
    got = langid.predict(spark, df, langid.train(spark, df.limit(0).withColumn("lang", df.text)), keep=("doc_id", "__text")).collect()
    assert [(g["__text"], g.lang_pred) for g in got] == [("x", "und")]
    (r,) = media.parse_pages(spark, df.withColumnsRenamed({"text": "html", "__text": "__html"}), keep=("doc_id", "__html")).collect()
    assert r["__html"] == "x" and [i.text for i in r["items"]] == ["some words here"]


def test_many_weak_passages_are_evidence():
    model = toxicity.Model({"x": 1.0}, 1.0, 0.1)
    scores = [math.log(400)] * 500  # 100 expected by chance in 40,000 tokens
    assert model.chance(40_000, scores) < 1e-6 and model.chance(40_000, scores[:100]) == 1.0
    assert math.isclose(toxicity.poisson_tail(100.0, 100), 0.5133, abs_tol=1e-3)


def test_poisson_tail():
    for mean in (0.001, 0.5, 3.0):
        for r in (1, 2, 5):
            want = 1 - sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(r))
            assert math.isclose(toxicity.poisson_tail(mean, r), want, rel_tol=1e-6, abs_tol=1e-12)


# language model


def random_chain(seed=1):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(hmm.STATES), rng.random((hmm.STATES, hmm.STATES)), rng.random((hmm.SYMBOLS, hmm.STATES))
    return hmm.Chain(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def plain_forward(c, s):
    a = c.start * c.emit[s[0]]
    log = 0.0
    for x in s[1:]:
        log += math.log(a.sum())
        a = (a / a.sum()) @ c.move * c.emit[x]
    return log + math.log(a.sum())


def test_forward_in_blocks_and_spans():
    c, rng = random_chain(), np.random.default_rng(2)
    seqs = [rng.integers(0, hmm.SYMBOLS, n).astype(np.int32) for n in (1, 2, 3, 50, 400, 1, 77)]
    want = [plain_forward(c, s) for s in seqs]
    assert np.allclose(hmm.forward(c, seqs), want)
    assert np.allclose([hmm._forward_long(c, s) for s in seqs if len(s) > 1], [w for s, w in zip(seqs, want) if len(s) > 1])


def test_expected_counts_match_enumeration():
    c, rng = random_chain(3), np.random.default_rng(4)
    seqs = [rng.integers(0, hmm.SYMBOLS, n).astype(np.int32) for n in (1, 3, 4)]
    s, m, e, ll = hmm.expected(c, seqs)
    ws, wm, wll = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), 0.0
    import itertools

    for x in seqs:
        total, paths = 0.0, []
        for path in itertools.product(range(hmm.STATES), repeat=len(x)):
            p = c.start[path[0]] * c.emit[x[0], path[0]]
            for k in range(1, len(x)):
                p *= c.move[path[k - 1], path[k]] * c.emit[x[k], path[k]]
            total += p
            paths.append((path, p))
        wll += math.log(total)
        for path, p in paths:
            ws[path[0]] += p / total
            for k in range(1, len(x)):
                wm[path[k - 1], path[k]] += p / total
    assert np.allclose(s, ws, atol=1e-4) and np.allclose(m, wm, atol=1e-4) and math.isclose(ll, wll, rel_tol=1e-4)
    assert math.isclose(e.sum(), sum(map(len, seqs)), rel_tol=1e-5)


def test_expected_counts_of_long_texts_match_plain_recursions():
    c, rng = random_chain(6), np.random.default_rng(7)
    c.move = 0.7 * np.eye(hmm.STATES) + 0.3 * c.move  # states that last, so that a row's borders matter
    seqs = [rng.integers(0, hmm.SYMBOLS, n).astype(np.int32) for n in (1, 200, hmm.SEGMENT, hmm.SEGMENT + 1, 1, 3 * hmm.SEGMENT, 5, 1000)]
    s, m, e, ll = hmm.expected(c, seqs)
    ws, wm, we = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros((hmm.SYMBOLS, hmm.STATES))
    for x in seqs:
        n = len(x)
        a, b = np.zeros((n, hmm.STATES)), np.ones((n, hmm.STATES))
        for k in range(n):
            a[k] = (a[k - 1] @ c.move if k else c.start) * c.emit[x[k]]
            a[k] /= a[k].sum()
        for k in range(n - 2, -1, -1):
            b[k] = c.move @ (c.emit[x[k + 1]] * b[k + 1])
            b[k] /= b[k].sum()
        g = a * b
        g /= g.sum(1, keepdims=True)
        ws += g[0]
        np.add.at(we, x, g)
        for k in range(1, n):
            xi = a[k - 1][:, None] * c.move * (c.emit[x[k]] * b[k])
            wm += xi / xi.sum()
    assert np.allclose(s, ws, atol=1e-3) and np.allclose(m, wm, rtol=1e-3, atol=1e-2) and np.allclose(e, we, atol=1e-3)
    assert math.isclose(ll, sum(plain_forward(c, x) for x in seqs), rel_tol=1e-5)


def test_scores_match_brute_force(spark):
    import zlib

    rows = awkward() + [(400, "neverseen word", "en", "a", 0, "", "")]
    old = hmm.HEAD
    hmm.HEAD = 50  # so that most tokens are looked up by the join
    try:
        got = hmm.language_model_scores(spark, spark.createDataFrame(rows, DDL)).collect()
    finally:
        hmm.HEAD = old
    held = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 7 == 2
    c: Counter = Counter()
    for i, t, *_ in rows:
        if held(i) is False:
            c.update(hmm.words(t))
    n, v = sum(c.values()), len(c)
    want = defaultdict(list)
    for i, t, *_ in rows:
        w = hmm.words(t)
        want[i].append((bool(held(i)), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)))
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
        assert r.score < 0 and math.isfinite(r.score)
    assert {k: sorted(x) for k, x in have.items()} == {k: sorted(x) for k, x in want.items()}
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_model_is_normalised(spark):
    """Probabilities of all one-token texts, the unseen ones as one, sum to one."""
    counts = Counter({b"": 5, b"a": 3, b"bb": 2, b"cc": 1})
    df = spark.createDataFrame([(bytearray(k), n) for k, n in counts.items()], "token binary, c long")
    lex = hmm.lexicon(spark, df)
    assert lex.total == 11 and lex.types == 4
    big = hmm.Lexicon([b"x"], np.array([9]), {b"x"}, 12, 4)
    big.class_n[hmm.token_class(b"bb")], big.class_v[hmm.token_class(b"bb")] = 3, 2
    den = big.class_n[hmm.token_class(b"bb")] + big.class_v[hmm.token_class(b"bb")] + 1
    assert math.isclose(sum((k + 1) / den for k in (2, 1)) + 1 / den, 1.0)


def test_language_model_of_nothing(spark):
    df = spark.createDataFrame([], DDL)
    assert hmm.language_model_scores(spark, df).count() == 0
    import zlib

    i = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (r,) = hmm.language_model_scores(spark, spark.createDataFrame([(i, "a b", "en", "a", 0, "", "")], DDL)).collect()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score)
