"""Matrix BPE against the rank library, and the round trip of ids."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from registra.llm import bpe

from .docs import DDL, awkward

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(*bpe.default_vocabulary())


@pytest.fixture(scope="module")
def library(vocab):
    return tiktoken.Encoding("plain", pat_str=bpe.default_vocabulary()[1], mergeable_ranks=vocab.ranks, special_tokens={})


def same(vocab, library, texts):
    got = vocab.encode(texts)
    assert [x.tolist() for x in got] == [library.encode_ordinary(t) for t in texts]
    assert [vocab.decode(x) for x in got] == [t.encode() for t in texts]


def test_random_texts(vocab, library):
    rng = random.Random(4)
    parts = ["a", "b", "e", "th", "the", " ", "  ", "\n", "\0", "'", "'s", "'re", "'ll", "S", "!", "1", "23", "é", "日", "本", "xxxxx", " ", "\x1c", "\x85", "　", "<|endoftext|>"]
    same(vocab, library, ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["", ""])


def test_every_code_point(vocab, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    same(vocab, library, ["".join(f"a{c} {c}1{c}{c}" for c in points[k : k + 1000]) for k in range(0, len(points), 1000)])


def test_long_matches(vocab, library):
    rng = random.Random(9)
    word = "".join(rng.choice("abcdefghij") for _ in range(20_000))
    same(vocab, library, ["a" * 3000, "ab" * 600, "!" * 1024, "!" * 1025, "é" * 900, word, " " * 5000 + "x", word[:1023], word[:1025]])


def test_heap_and_matrix_agree(vocab):
    rng = random.Random(2)
    for _ in range(200):
        piece = "".join(rng.choice("aehnrst ") for _ in range(rng.randint(2, 90))).encode()
        m = vocab.single[np.frombuffer(piece, np.uint8)][None, :]
        assert vocab.merge_matrix(m)[0].tolist() == vocab.merge_long(piece).tolist()


def test_vocabulary_whose_longer_token_comes_first():
    """Ranks that no training gives: the merged pair makes a pair of lesser rank beside it."""
    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"abc": 0, b"bc": 1, b"ab": 2, b"cd": 3}
    v = bpe.Vocabulary(ranks, r"[a-z]+|[^a-z]+")
    lib = tiktoken.Encoding("odd", pat_str=r"[a-z]+|[^a-z]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    same(v, lib, ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 40))) for _ in range(500)])


def test_pair_table_holds_every_pair():
    rng = np.random.default_rng(0)
    pairs = np.unique(rng.integers(0, 300, (5000, 2), np.int32), axis=0)
    t = bpe.PairTable(pairs[:, 0], pairs[:, 1], np.arange(len(pairs), dtype=np.int32))
    assert (t(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    have = set(map(tuple, pairs.tolist()))
    other = np.array([p for p in rng.integers(0, 400, (5000, 2)).tolist() if tuple(p) not in have], np.int32)
    assert (t(other[:, 0], other[:, 1]) == bpe.NONE).all()


def test_awkward_rows(spark, library):
    docs = spark.createDataFrame([(*r, 7, "k") for r in awkward()], DDL + ", ids int, N_Tokens string")
    got = bpe.decode(spark, bpe.encode(spark, docs)).collect()
    assert len(got) == docs.count()
    for r in got:
        ids = library.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids) and bytes(r.ids) == np.array(ids, "<u4").tobytes() and bytes(r.decoded) == (r.text or "").encode() and r.q == "q"
    assert bpe.digests(spark, docs.where("false")).count() == 0
    for r in bpe.digests(spark, docs).collect():
        assert len(r.ids_sha256) == len(r.decoded_sha256) == 64
    empty = [r for r in bpe.digests(spark, docs).collect() if r.doc_id in (100, 101)]
    assert {(r.n_tokens, r.decoded_sha256) for r in empty} == {(0, hashlib.sha256(b"").hexdigest())}


def test_bad_ids(vocab):
    with pytest.raises(ValueError):
        vocab.decode(np.array([10**6], np.uint32))
    assert zlib.crc32(vocab.decode(np.array([], np.uint32))) == 0
