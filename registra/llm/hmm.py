"""Hidden Markov language model: Baum-Welch over partitions, exact scaled forward likelihood.

Tokens are words, A-Z lower-cased, and one end token per text. The model is exact and normalised over
an open vocabulary: a token's *symbol* is its own for the ``OWN`` most frequent training tokens, else
one of ``CLASSES`` classes by its first and last letters; hidden states emit symbols, and a class
emits its tokens by smoothed counts, (c + 1) / (class tokens + class types + 1), of which one part is
for tokens never seen. So log P(text) = forward likelihood of the symbols + sum of log P(token | class).

Counts of all training tokens are summed in Spark and stay a table. The most frequent tokens, as many as
have a count that no more than ``HEAD`` tokens reach (of at most ``HEAD_BYTES`` bytes) are broadcast, a fixed bound; occurrences of any other token are
looked up by a join with the table. As no frequent token takes part, that join has no hot key among
the training tokens; an unseen token that is frequent in held-out texts finds no partner.

Baum-Welch runs over all training texts, whole. The E-step lays a text out in rows of ``SEGMENT`` symbols
that step together; what the rest of the text says about a row's borders is first worked out exactly from
the rows' transfer matrices, so every move is counted and starts are counted at heads of texts only. Each task adds up its expected counts; Spark sums them by index, and the driver gets states x symbols
numbers per round, whatever the corpus size. Texts are scored whole: texts of a block step together,
and a text of more than ``LONG`` tokens is cut into spans whose transfer matrices are multiplied.

Defined results: null and empty texts are the end token alone; without training rows every token
is unknown (base_score 0); rows with a null id neither train nor are held out; repeated rows each
train and score; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, bounded_batches, crc_mod

STATES = 8
OWN = 1024
CLASSES = 1024
SYMBOLS = OWN + CLASSES
HEAD = 200_000
HEAD_BYTES = 40
ROUNDS = 6
SEGMENT = 64
LONG = 1 << 14
FLUSH = 400_000
END = b""


def words(text: str | None) -> list[bytes]:
    w = (text or "").encode().lower().split()
    w.append(END)
    return w


def token_class(w: bytes) -> int:
    """Class symbol of a token that has no symbol of its own."""
    return OWN + zlib.crc32(w[:2] + b"|" + w[-2:]) % CLASSES


def _count(batches):
    schema = pa.schema([("token", pa.binary()), ("c", pa.int64())])
    seen: Counter = Counter()
    for b in batches:
        for t in b.column(0).to_pylist():
            seen.update(words(t))
            if len(seen) > FLUSH:
                yield batch(schema, token=list(seen), c=list(seen.values()))
                seen.clear()
    yield batch(schema, token=list(seen), c=list(seen.values()))


class Lexicon:
    """The broadcast part: head tokens, their counts and symbols, and the classes' totals."""

    def __init__(self, tokens: list[bytes], counts: np.ndarray, own: set[bytes], total: int, types: int):
        self.tokens, self.counts, self.total, self.types = tokens, counts, total, types
        self.own = {w: i for i, w in enumerate(sorted(own))}
        self.class_n = np.zeros(SYMBOLS)
        self.class_v = np.zeros(SYMBOLS)

    def symbol(self, w: bytes) -> int:
        s = self.own.get(w)
        return token_class(w) if s is None else s


def lexicon(spark: SparkSession, counts: DataFrame) -> Lexicon:
    row = counts.agg(F.sum("c"), F.count("*")).first()
    short = counts.where(F.octet_length("token") <= HEAD_BYTES).withColumn("level", F.floor(F.log2("c") * 64))
    levels = sorted(short.groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True)  # 64 * 63 rows at most
    cut = held = 0
    for level, n in levels:
        held += n
        if held > HEAD:
            cut = level + 1
            break
    top = short.where(F.col("level") >= cut).select("token", "c").toArrow()  # HEAD rows at most
    ranked = sorted(zip(top.column(0).to_pylist(), top.column(1).to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    tokens, c = [w for w, _ in ranked], np.array([n for _, n in ranked], np.int64)
    own = set(tokens[: OWN - 1])
    if tokens:
        own.add(END)
    lex = Lexicon(tokens, c, own, int(row[0] or 0), int(row[1] or 0))
    shared = spark.sparkContext.broadcast(lex.own)

    def by_class(batches):
        own = shared.value
        n, v = np.zeros(SYMBOLS, np.int64), np.zeros(SYMBOLS, np.int64)
        for b in batches:
            cls = np.array([-1 if w in own else token_class(w) for w in b.column(0).to_pylist()], np.int64)
            c = b.column(1).to_numpy()
            n += np.bincount(cls[cls >= 0], c[cls >= 0], minlength=SYMBOLS).astype(np.int64)
            v += np.bincount(cls[cls >= 0], minlength=SYMBOLS)
        at = np.flatnonzero(v)
        yield batch(pa.schema([("s", pa.int32()), ("n", pa.int64()), ("v", pa.int64())]), s=at.astype(np.int32), n=n[at], v=v[at])

    for r in counts.mapInArrow(by_class, "s int, n long, v long").groupBy("s").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():  # at most CLASSES rows
        lex.class_n[r["s"]], lex.class_v[r["s"]] = r["n"], r["v"]
    return lex


_ENC_DDL = "row_id long, doc_id long, held_out boolean, trains boolean, n_tokens long, known long, base double, own double, symbols binary, tail array<binary>"


def encode(spark: SparkSession, docs: DataFrame, lex: Lexicon) -> DataFrame:
    """Per text: its symbols, the sums over head tokens, and the tokens that have to be looked up."""
    shared = spark.sparkContext.broadcast((lex.tokens, lex.counts, lex.own, lex.class_n, lex.class_v))
    schema = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("trains", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("own", pa.float64()), ("symbols", pa.binary()), ("tail", pa.list_(pa.binary()))])

    def run(batches):
        tokens, counts, own, class_n, class_v = shared.value
        at = {w: i for i, w in enumerate(tokens)}
        get = lambda w: at.get(w, -1)
        symbol = np.array([own.get(w, -1) for w in tokens], np.int32)
        miss = np.flatnonzero(symbol < 0)
        symbol[miss] = [token_class(tokens[i]) for i in miss]
        logc = np.log10(np.asarray(counts, float) + 1)
        den = np.log10(class_n + class_v + 1)
        den[:OWN] = 0
        for b in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for row, doc, held, trains, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                w = words(text)
                i = np.fromiter(map(get, w), np.int32, len(w))
                hit = i >= 0
                tail = [w[k] for k in np.flatnonzero(~hit)]
                s = np.empty(len(w), np.int32)
                s[hit] = symbol[i[hit]]
                s[~hit] = [own.get(x, -1) if x in own else token_class(x) for x in tail]
                lc = logc[i[hit]]
                known = int(hit.sum())
                given = float(lc[s[hit] >= OWN].sum()) - float(den[s].sum())
                for k, v in zip(schema.names, (row, doc, held, trains, len(w), known, float(lc.sum()), given, s.astype("<u2").tobytes(), tail), strict=True):
                    out[k].append(v)
            yield batch(schema, **out)

    held = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    trains = F.coalesce(crc_mod("doc_id", 7) != 2, F.lit(False))
    return docs.select(F.monotonically_increasing_id(), "doc_id", held, trains, "text").mapInArrow(run, _ENC_DDL)


# ---------------------------------------------------------------------------------------------
# the chain

class Chain:
    """start (K), move (K, K) and emit (SYMBOLS, K) probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, unigram: np.ndarray, seed: int = 5) -> Chain:
        rng = np.random.default_rng(seed)
        emit = unigram[:, None] * np.exp(rng.normal(0, 1, (len(unigram), STATES)))
        move = np.full((STATES, STATES), 0.1 / (STATES - 1))
        np.fill_diagonal(move, 0.9)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(0))


class Rows(NamedTuple):
    """Texts in rows of SEGMENT symbols, -1 where a text's last row is over; ``head`` and ``last`` mark rows."""

    x: np.ndarray
    head: np.ndarray
    last: np.ndarray


def _rows(seqs: list[np.ndarray]) -> Rows:
    parts, sizes = [np.empty((0, SEGMENT), np.int32)], []
    for s in seqs:
        n = -(-len(s) // SEGMENT)
        x = np.full(n * SEGMENT, -1, np.int32)
        x[: len(s)] = s
        parts.append(x.reshape(n, SEGMENT))
        sizes.append(n)
    end = np.cumsum(sizes, dtype=np.int64)
    head, last = np.zeros(sum(sizes), bool), np.zeros(sum(sizes), bool)
    head[end - np.array(sizes, np.int64)] = True
    last[end - 1] = True
    return Rows(np.concatenate(parts), head, last)


def _borders(chain: Chain, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Per row: the state's distribution at the symbol before it, given all symbols up to there (zeros at
    heads), and the weight of each state of its last symbol, given all symbols after it (ones at ends)."""
    n = len(rows.x)
    before, after = np.zeros((n, STATES)), np.ones((n, STATES))
    many = np.flatnonzero(~(rows.head & rows.last))
    if not len(many):
        return before, after
    # transfer matrices of the rows of longer texts, from the first symbol's state to the last one's; rows
    # stand along the last axis, the longest first, so that those not yet over are a front part
    weight = np.ascontiguousarray((chain.emit / chain.emit.max(1, keepdims=True)).T.astype(np.float32))
    step = np.ascontiguousarray(chain.move.T.astype(np.float32))
    length = (rows.x[many] >= 0).sum(1)
    order = np.argsort(-length, kind="stable")
    many, length = many[order], length[order]
    t = np.empty((n, STATES, STATES), np.float32)
    for lo in range(0, len(many), 2048):
        at, size = many[lo : lo + 2048], length[lo : lo + 2048]
        x = np.ascontiguousarray(rows.x[at].T)
        m = np.eye(STATES, dtype=np.float32)[:, :, None] * weight[:, x[0]]
        for k in range(1, int(size[0])):
            run = int(np.searchsorted(-size, -k, "left"))
            y = np.matmul(step, m[:, :, :run])
            y *= weight[:, x[k, :run]]
            if k % 8 == 0:
                y /= y.max(axis=(0, 1))
            if run < len(at):
                m[:, :, :run] = y
            else:
                m = y
        t[at] = (m / m.max(axis=(0, 1))).transpose(2, 0, 1)
    # texts walk along their rows together, longest first; then back
    first = np.flatnonzero(rows.head)
    size = np.flatnonzero(rows.last) - first + 1
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    for k in range(1, int(size[0])):
        at = first[: np.searchsorted(-size, -k, "left")] + k
        p = np.where(rows.head[at - 1][:, None], chain.start, before[at - 1] @ chain.move)
        a = np.einsum("ni,nij->nj", p, t[at - 1])
        before[at] = a / np.maximum(a.sum(1, keepdims=True), 1e-300)
    for k in range(int(size[0]) - 1, 0, -1):
        at = first[: np.searchsorted(-size, -k, "left")] + k
        b = np.einsum("nij,nj->ni", t[at], after[at]) @ chain.move.T
        after[at - 1] = b / np.maximum(b.max(1, keepdims=True), 1e-300)
    return before, after


def expected(chain: Chain, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions, and the log-likelihood, of whole texts."""
    rows = _rows(seqs)
    before, after = _borders(chain, rows)
    total = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((SYMBOLS, STATES)), 0.0]
    for lo in range(0, len(rows.x), 4096):
        part = slice(lo, lo + 4096)
        for k, v in enumerate(_expected(chain, rows.x[part], rows.head[part], before[part], after[part])):
            total[k] = total[k] + v
    return tuple(total)


def _expected(chain: Chain, x: np.ndarray, head: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    n, t = x.shape
    emit = np.vstack([chain.emit, np.ones(STATES)]).astype(np.float32)  # row -1: nothing is emitted
    move = chain.move.astype(np.float32)
    back = np.ascontiguousarray(move.T)
    x = np.ascontiguousarray(x.T)
    live = x >= 0
    whole = live.all(axis=1)  # steps at which no row is over: the usual case needs no masks
    e = emit[x]
    alpha = np.empty((t, n, STATES), np.float32)
    scale = np.ones((t, n, 1), np.float32)
    for k in range(t):
        a = (alpha[k - 1] @ move if k else np.where(head[:, None], chain.start, before @ chain.move).astype(np.float32)) * e[k]
        c = a @ _ONES
        if not whole[k]:
            mask = live[k][:, None]
            c = np.where(mask, c, 1)
            a = np.where(mask, a, alpha[k - 1] if k else a)
        np.maximum(c, 1e-30, out=c)
        scale[k] = c
        np.divide(a, c, out=alpha[k])
    moves = np.zeros((STATES, STATES))
    gamma = np.empty((t, n, STATES), np.float32)
    beta = after.astype(np.float32)
    beta /= np.maximum((alpha[-1] * beta) @ _ONES, 1e-30)
    for k in range(t - 1, -1, -1):
        g = alpha[k] * beta
        g /= np.maximum(g @ _ONES, 1e-30)
        gamma[k] = g
        v = e[k] * beta
        v /= scale[k]
        if not whole[k]:
            v = np.where(live[k][:, None], v, 0)
        if k:
            moves += alpha[k - 1].T @ v
            beta = v @ back if whole[k] else np.where(live[k][:, None], v @ back, beta)
        else:
            moves += before.T @ v
    at = np.where(live, x, SYMBOLS)[:, :, None] * STATES + np.arange(STATES)
    emitted = np.bincount(at.ravel(), gamma.ravel(), minlength=(SYMBOLS + 1) * STATES).reshape(-1, STATES)
    return gamma[0][head].sum(0, dtype=float), moves * chain.move, emitted[:SYMBOLS], float(np.log(scale).sum(dtype=float))


_ONES = np.ones((STATES, 1), np.float32)


def baum_welch(spark: SparkSession, encoded: DataFrame, chain: Chain, unigram: np.ndarray, rounds: int = ROUNDS) -> tuple[Chain, list[float]]:
    told = []
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(chain)

        def run(batches, shared=shared):
            chain = shared.value
            size = STATES + STATES * STATES + SYMBOLS * STATES + 1
            total = np.zeros(size)
            for b in batches:
                seqs = [np.frombuffer(s, "<u2") for s in b.column(0).to_pylist()]
                s, m, e, ll = expected(chain, seqs)
                total += np.concatenate([s, m.ravel(), e.ravel(), [ll]])
            at = np.flatnonzero(total)
            yield batch(pa.schema([("i", pa.int32()), ("v", pa.float64())]), i=at.astype(np.int32), v=total[at])

        sums = encoded.where("trains").select("symbols").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        total = np.zeros(STATES + STATES * STATES + SYMBOLS * STATES + 1)
        total[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
        s, m, e = np.split(total[:-1], [STATES, STATES + STATES * STATES])
        told.append(total[-1])
        s = s + 1.0
        m = m.reshape(STATES, STATES) + 0.1
        e = e.reshape(SYMBOLS, STATES) + 10.0 * unigram[:, None]
        chain = Chain(s / s.sum(), m / m.sum(1, keepdims=True), e / e.sum(0))
    return chain, told


def forward(chain: Chain, seqs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of every whole symbol sequence (none is empty)."""
    out = np.zeros(len(seqs))
    n = np.array([len(s) for s in seqs])
    for i in np.flatnonzero(n > LONG):
        out[i] = _forward_long(chain, seqs[i])
    order = [i for i in np.argsort(-n, kind="stable") if n[i] <= LONG]
    if not order:
        return out
    # texts step together, longest first, so that those still running are a front part
    lens = n[order]
    flat = np.concatenate([seqs[i] for i in order])
    begin = np.concatenate([[0], np.cumsum(lens)[:-1]])
    a = chain.start * chain.emit[flat[begin]]
    c = a.sum(1)
    log = np.log(c)
    a /= c[:, None]
    for t in range(1, int(lens[0])):
        run = int(np.searchsorted(-lens, -t, "left"))
        a = (a[:run] @ chain.move) * chain.emit[flat[begin[:run] + t]]
        c = a.sum(1)
        log[:run] += np.log(c)
        a /= c[:, None]
    out[order] = log
    return out


def _forward_long(chain: Chain, s: np.ndarray) -> float:
    """The same for one long sequence: spans in step, each as a transfer matrix."""
    v = chain.start * chain.emit[s[0]]
    rest = s[1:]
    step = math.isqrt(len(rest)) + 1
    spans = -(-len(rest) // step)
    x = np.full(spans * step, -1, np.int64)
    x[: len(rest)] = rest
    x = x.reshape(spans, step)
    m = np.broadcast_to(np.eye(STATES), (spans, STATES, STATES)).copy()
    log = np.zeros(spans)
    for t in range(step):
        live = np.flatnonzero(x[:, t] >= 0)
        y = (m[live] @ chain.move) * chain.emit[x[live, t]][:, None, :]
        c = y.max(axis=(1, 2))
        m[live] = y / c[:, None, None]
        log[live] += np.log(c)
    total = math.log(v.sum())
    v = v / v.sum()
    for k in range(spans):
        v = v @ m[k]
        total += log[k] + math.log(v.sum())
        v /= v.sum()
    return total


def _likelihoods(spark: SparkSession, encoded: DataFrame, chain: Chain) -> DataFrame:
    shared = spark.sparkContext.broadcast(chain)
    schema = pa.schema([("row_id", pa.int64()), ("chain", pa.float64())])

    def run(batches):
        ids, seqs, size = [], [], 0
        for b in batches:
            for i, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                seqs.append(np.frombuffer(s, "<u2").astype(np.int32))
                size += len(seqs[-1])
                if size > 3_000_000:
                    yield batch(schema, row_id=ids, chain=forward(shared.value, seqs) / math.log(10))
                    ids, seqs, size = [], [], 0
        if ids:
            yield batch(schema, row_id=ids, chain=forward(shared.value, seqs) / math.log(10))

    return encoded.select("row_id", "symbols").mapInArrow(run, "row_id long, chain double")


def language_model_scores(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    bounded_batches(spark)
    scratch = Scratch(spark, "hmm")
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = src.where(crc_mod("doc_id", 7) != 2).select("text").mapInArrow(_count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))
    counts = scratch.write(counts, "counts")
    scratch.tidy()
    lex = lexicon(spark, counts)
    encoded = scratch.write(encode(spark, src, lex), "encoded", "zstd")
    # tokens beyond the head: their counts come by a join
    tail = encoded.select("row_id", F.explode("tail").alias("token"))
    tail = tail.join(counts, "token").groupBy("row_id").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("found"))
    tail = scratch.write(tail, "tail")
    scratch.tidy()
    unigram = np.concatenate([np.zeros(OWN), lex.class_n[OWN:] + 1.0])
    head = dict(zip(lex.tokens, np.asarray(lex.counts).tolist(), strict=True))
    for w, s in lex.own.items():
        unigram[s] = head.get(w, 1.0)
    unigram = (unigram + 0.5) / (unigram + 0.5).sum()
    chain, _ = baum_welch(spark, encoded, Chain.initial(unigram), unigram)
    like = scratch.write(_likelihoods(spark, encoded, chain), "likelihoods")
    rows = encoded.select("row_id", "doc_id", "held_out", "n_tokens", "known", "base", "own").join(like, "row_id").join(tail, "row_id", "left")
    more, found = F.coalesce("more", F.lit(0.0)), F.coalesce("found", F.lit(0))
    out = rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + found).alias("n_known"), F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * math.log10(lex.total + lex.types + 1)).alias("base_score"),
        (F.col("chain") + F.col("own") + more).alias("score"),
    )
    out = scratch.write(out, "scores")
    scratch.drop("counts", "encoded", "tail", "likelihoods")
    return out
