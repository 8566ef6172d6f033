import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from registra.llm import tokens
from registra.llm.packing import pack, shortest_pack_first, slots
from registra.llm.token_binary import CapacityTree, best_fit_decreasing, pack_rows, write_matrix
from registra.llm.tokens import default_paths, encode

from .docs import DDL, awkward


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_paths()[0])
    return [*t.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_patterns_hold_every_piece(hist):
    pats = shortest_pack_first(hist, 64)
    got = defaultdict(int)
    for p in pats:
        assert sum(p.lengths) <= 64
        for n in p.lengths:
            got[n] += p.count
    assert got == hist
    table, total = slots(pats)
    seen = set()
    for n, c in hist.items():
        for r in range(c):
            at = np.searchsorted(table.key, n << 40 | r, "right") - 1
            seen.add((int(table.sequence[at] + (n << 40 | r) - table.key[at]), int(table.offset[at])))
    assert len(seen) == sum(hist.values()) and all(0 <= s < total for s, _ in seen)


def test_padding_is_small():
    rng = random.Random(1)
    hist = defaultdict(int)
    for _ in range(20_000):
        hist[rng.randint(1, 1024)] += 1
    n = sum(p.count for p in shortest_pack_first(hist, 1024))
    assert sum(k * v for k, v in hist.items()) / (1024 * n) > 0.99


def test_pieces_round_trip(spark):
    rows = awkward()
    p = pack(spark, spark.createDataFrame(rows, DDL), max_len=128)
    got = p.sequences().collect()
    docs = defaultdict(dict)
    for g in got:
        docs[g.row_id, g.doc_id][g.start] = np.frombuffer(g.ids, "<u4").tolist()
        assert len(g.ids) == 4 * g.length
    texts = sorted(sum((x[1] for x in sorted(parts.items())), []) for parts in docs.values())
    assert texts == sorted(reference_ids(r[1]) for r in rows)
    rows_of = defaultdict(list)
    for g in got:
        rows_of[g.sequence_id].append((g.offset, g.length))
    for parts in rows_of.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 128
    assert sorted(rows_of) == list(range(len(rows_of)))
    assert pack(spark, spark.createDataFrame([], DDL)).placed.count() == 0


def test_encoder_agrees_with_tokenizers():
    paths = default_paths()
    for t in ["", "a", " lead", "tabs\t\tand  spaces \n\n end ", "ñandú ß 漢字 🙂", "x" * 3000, "1234 56.7", "<|endoftext|> hi", "it's we'll"]:
        assert encode(t, paths).tolist() == reference_ids(t)[:-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_matches_a_plain_search(lengths):
    rows = best_fit_decreasing(lengths, 50)
    assert sorted(k for r in rows for k in r) == list(range(len(lengths)))
    free: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = [f for f in free if f >= n]
        if fit:
            free.remove(min(fit))
            free.append(min(fit) - n)
        else:
            free.append(50 - n)
    assert len(rows) == len(free)


def test_capacity_tree():
    t = CapacityTree(100)
    for c in (3, 17, 64, 100):
        t.add(c, 1)
    assert [t.least(n) for n in (1, 3, 4, 18, 65)] == [3, 3, 17, 64, 100]
    t.add(100, -1)
    assert t.least(65) == 0


def test_matrix_rows(spark):
    rows = awkward()
    got = pack_rows(spark, spark.createDataFrame(rows, DDL), row_len=128).collect()
    docs = []
    pieces = defaultdict(list)
    for g in got:
        ids, pos = np.frombuffer(g.ids, "<u4"), np.frombuffer(g.positions, "<u4")
        assert len(ids) == 128 and g.cu_seqlens[0] == 0 and g.cu_seqlens[-1] == g.n_tokens
        for d, s, a, b in zip(g.doc_ids, g.starts, g.cu_seqlens, g.cu_seqlens[1:]):
            pieces[d].append((s, ids[a:b].tolist()))
            assert pos[a:b].tolist() == list(range(b - a))
        assert not ids[g.n_tokens :].any()
    for d, parts in pieces.items():
        if d not in (5, None):
            docs.append(sum((x[1] for x in sorted(parts)), []))
    assert sorted(docs) == sorted(reference_ids(r[1]) for r in rows if r[0] not in (5, None))


def test_stored_matrix_gives_the_documents_back(spark, tmp_path):
    """Only the files are read, by another reader than the one that wrote them."""
    import pyarrow.parquet as pq

    rows = [(i, r[1], *r[2:]) for i, r in enumerate(awkward())]
    write_matrix(pack_rows(spark, spark.createDataFrame(rows, DDL), row_len=96), f"{tmp_path}/m")
    table = pq.read_table(f"{tmp_path}/m").to_pydict()
    ids = np.stack([np.frombuffer(v, "<u4") for v in table["ids"]])
    positions = np.stack([np.frombuffer(v, "<u4") for v in table["positions"]])
    assert ids.shape == positions.shape and ids.shape[1] == 96
    pieces = defaultdict(dict)
    for k, (docs, starts, cu) in enumerate(zip(table["doc_ids"], table["starts"], table["cu_seqlens"], strict=True)):
        resets = [*cu[:-1], *([cu[-1]] if cu[-1] < 96 else [])]
        assert np.flatnonzero(positions[k] == 0).tolist() == resets
        for d, s, a, b in zip(docs, starts, cu, cu[1:]):
            assert s not in pieces[d]
            pieces[d][s] = ids[k, a:b].tolist()
    assert {d: sum((p[s] for s in sorted(p)), []) for d, p in pieces.items()} == {r[0]: list(reference_ids(r[1])) for r in rows}


def test_stored_matrix_of_an_empty_table(spark, tmp_path):
    got = write_matrix(pack_rows(spark, spark.createDataFrame([], DDL)), f"{tmp_path}/m")
    assert got.count() == 0 and got.columns[:2] == ["sequence_id", "doc_ids"]


def test_plain_texts_load_one_encoder_only():
    tokens._slow.cache_clear()
    assert encode("plain words", default_paths()).tolist() == reference_ids("plain words")[:-1]
    assert tokens._slow.cache_info().currsize == 0
    assert encode("a <|b", default_paths()).tolist() == reference_ids("a <|b")[:-1]
    assert tokens._slow.cache_info().currsize == 1
