"""Alignment of two tokenizers against their definitions, text by text."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from registra.llm import align as L

from .docs import DDL, awkward


@pytest.fixture(scope="module")
def s():
    return L.sides(L.default_paths())


def plain(s, text):
    """(A ids, B ids, groups, links) of one text, straight from the definitions."""
    if not text:
        return [], [], [], []
    data = (" " + text).encode()
    a, b = s.slow.encode(" " + text, add_special_tokens=False).ids, s.pieces.encode(text)
    if b"".join(s.left[i] for i in a) != data or b"".join(s.right[i] for i in b) != data:
        return [], [], [], []
    ends = [np.cumsum([len(side[i]) for i in ids]).tolist() for side, ids in ((s.left, a), (s.right, b))]
    groups, i, j = [], 0, 0
    place = [{e: k + 1 for k, e in enumerate(side)} for side in ends]
    for e in sorted(set(ends[0]) & set(ends[1])):
        x, y = place[0][e], place[1][e]
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    owner = [[k for k, i in enumerate(ids) for _ in side[i]] for side, ids in ((s.left, a), (s.right, b))]
    links = [(a[i], b[j]) for i, j in set(zip(*owner, strict=True))]
    return a, b, groups, links


def listing(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups).encode()


def check(s, texts):
    parts, shown = L.aligned(s, texts)
    cut = {k: p.of_texts() for k, p in parts.items()}
    for k, t in enumerate(texts):
        a, b, groups, links = plain(s, t)
        assert cut["ids_a"][k].tolist() == a and cut["ids_b"][k].tolist() == b, t[:50]
        assert shown[k] == listing(groups)
        assert cut["cut_a"][k].tolist() == np.cumsum([len(x) for x, _ in groups]).tolist() and cut["cut_b"][k].tolist() == np.cumsum([len(y) for _, y in groups]).tolist()
        assert sorted(cut["links"][k].tolist()) == sorted(x << 32 | y for x, y in links)


def test_random_texts(s):
    rng = random.Random(3)
    parts = ["a", "the", "ing", " ", "  ", "\n", "\t", " \n", "'", "'s", "!", "é", "日本", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "<|endoftext|>", "\0", "\x85", " ", "word", "Straße", "12", "\r\n", "\U0001f600"]
    check(s, ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)])


def test_spaces_at_every_place(s):
    check(s, [x + y + z for x in ("", " ", "a", "a\n", "\n", "  ") for y in (" ", "  ", "\n ", "\n  ", " \n ", "   \n", "\t ") for z in ("", "b", " b", "\n", ".")])


def test_long_texts(s):
    check(s, ["x" * 2500 + " y", "ab " * 900, "é" * 2100, " " * 2200])


def test_left_encoders_agree(s):
    points = [chr(c) for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c) != "▁"]
    for k in range(0, len(points), 1000):
        t = "".join(f" a{c} {c}1{c}{c}" for c in points[k : k + 1000])
        if s.fast.encode_ordinary(t) != s.slow.encode(t, add_special_tokens=False).ids:
            odd = [c for c in points[k : k + 1000] if s.encode_left(t := f" a{c} {c}1{c}{c}a") != s.slow.encode(t, add_special_tokens=False).ids]
            assert not odd, [hex(ord(c)) for c in odd]


@pytest.mark.parametrize("head", [0, 40, L.HEAD])
def test_scores(spark, s, head):
    docs = spark.createDataFrame([(*r, 1, "c") for r in awkward()], DDL + ", n_a int, code string")
    told = [(r.doc_id, plain(s, r.text)) for r in docs.collect()]
    counts = Counter(p for _, x in told for p in x[3])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    want = [
        (i, len(a), len(b), len(g), len(ln), sum(counts[p] == top[p[1]] for p in ln), sum(counts[p] for p in ln), hashlib.sha256(listing(g)).hexdigest() if g else "")
        for i, (a, b, g, ln) in told
    ]
    got = [tuple(r) for r in L.scores(spark, docs, head=head).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_columns(spark, s):
    docs = spark.createDataFrame([(1, "ab cde"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.groups(spark, docs).collect()}
    a, b, groups, _ = plain(s, "ab cde")
    assert np.frombuffer(got[1].ids_a, "<u4").tolist() == a and np.frombuffer(got[1].ids_b, "<u4").tolist() == b and got[1].n_groups == len(groups)
    assert (got[2].n_a, bytes(got[2].links), got[2].groups_sha256) == (0, b"", "")


def test_empty_table(spark):
    assert L.scores(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0
