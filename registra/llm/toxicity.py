"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

Learning takes a bounded sample of labelled documents (at most ``MAX_TRAIN``, the smallest hashes of
their ids), counts words and word beginnings in toxic and clean texts across partitions, and keeps
the units whose log-odds under an informative Dirichlet prior (the pooled counts) stand ``MIN_Z``
standard errors above zero, the ``MAX_UNITS`` highest at most; so the broadcast model has a proven
bound. A word scores its best unit, any other word ``-DRIFT``.

Every text is scanned whole and in linear time for all maximal segments (a list of candidate segments
with their left and right cumulative sums; each hit is pushed and merged once). Under the clean
model, segments of score S turn up about n * exp(-lambda * S) times in n tokens, lambda solving
E[exp(lambda * s)] = 1 over the clean token scores. Each passage gets this expectation; the document
gets the chance of its best passages under the clean model, taken together by the Poisson law of such
segments, and the score is the posterior that follows from this chance and the share of toxic
documents among the learnt ones.

Defined results: null, empty and wordless texts have no passage and score the prior divided down
like any clean text; without labels to learn from every score is 0. Several labels of one document
count as their maximum. Repeated rows score alike; other columns are ignored. Of learnt texts of
one label that share their least shingle (copies and most near copies do) the first is counted, and of the
others those that are no near copy of it (a Jaccard of under 0.75 on 5-word shingles), once each.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, bounded_batches, doc_words, fresh, hash_words, shingle_hashes, signed

MAX_TRAIN = 40_000
MAX_UNITS = 20_000
MIN_TEXTS = 4
MIN_Z = 5.0
MAX_CLEAN = 0.05  # a unit goes where its clean texts are more than this share of all its texts
PRIOR = 0.1  # weight of the pooled counts in the Dirichlet prior
DRIFT = 0.15
PREFIXES = (4, 5)
THRESHOLD = 0.7
EXPECTED = 0.01  # a passage is significant when fewer than so many are expected by chance
FLUSH = 400_000

_WORD = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def units(word: str) -> list[str]:
    """The word itself and its beginnings, marked apart."""
    return [f"={word}", *(word[:n] for n in PREFIXES if len(word) > n)]


_KEYED = pa.schema([("text", pa.string()), ("y", pa.int32()), ("key", pa.int64())])
_COUNT = pa.schema([("unit", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64()), ("told", pa.int64())])


def _shingles(text: str | None) -> np.ndarray:
    data, s, e = doc_words(text)
    return np.unique(shingle_hashes(hash_words(data, s, e)))


def _key(batches):
    """A key that copies and most near copies of a text share: its least 5-word shingle hash."""
    for b in batches:
        sets = [_shingles(t) for t in b.column(0).to_pylist()]
        yield batch(_KEYED, text=b.column(0), y=b.column(1), key=[int(signed(h[:1])[0]) if len(h) else 0 for h in sets])


def _apart(batches):
    """Texts that are no near copy of the one they are told with: a similarity of under 0.75."""
    for b in batches:
        keep = []
        for t, lead in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            x, y = _shingles(t), _shingles(lead)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(not len(x) or 4 * both < 3 * (len(x) + len(y) - both))
        yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _count(batches):
    """Per unit: toxic and clean texts that have it, and its occurrences in clean texts."""
    df: list[Counter] = [Counter(), Counter()]
    tf: Counter = Counter()

    def flush():
        keys = list(df[0].keys() | df[1].keys())
        yield batch(_COUNT, unit=keys, clean=[df[0][u] for u in keys], toxic=[df[1][u] for u in keys], told=[tf[u] for u in keys])
        for c in (*df, tf):
            c.clear()

    for b in batches:
        for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            n = Counter(tokens(t))
            of_text: Counter = Counter()
            for w, k in n.items():
                for u in units(w):
                    of_text[u] += k
            of_text[""] = sum(n.values())
            df[1 if y else 0].update(of_text.keys())
            if not y:
                tf.update(of_text)
            if len(df[0]) + len(df[1]) > FLUSH:
                yield from flush()
    yield from flush()


class Model:
    """Scores of the significant units and the two calibration constants."""

    def __init__(self, units: dict[str, float], lam: float, prior: float):
        self.units, self.lam, self.prior = units, lam, prior

    def word_score(self, w: str) -> float:
        return max((self.units.get(u, 0.0) for u in units(w)), default=0.0)

    def chance(self, n_tokens: int, scores: list[float]) -> float:
        """Probability under the clean model of passages like these: for the r best together, that of r
        or more segments of the r-th score, each r weighted 2 ** -r."""
        p = 0.0
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            mean = n_tokens * math.exp(-self.lam * s)
            if mean < r:  # else the tail is over 1/4 and from r = 2 on no evidence at its weight
                p = min(p, r * math.log(2) + log_poisson_tail(mean, r))
            elif r == 1:
                p = min(p, math.log(2) + math.log(poisson_tail(mean, r)))
        return math.exp(p)

    def score(self, n_tokens: int, scores: list[float]) -> float:
        if not self.units or not 0 < self.prior < 1:
            return 0.0
        p = max(self.chance(n_tokens, scores), 1e-12)
        return self.prior / (self.prior + (1 - self.prior) * p)


def log_poisson_tail(mean: float, r: int) -> float:
    """log P(N >= r) for a Poisson count, exact also where it is tiny."""
    if mean <= 0:
        return -math.inf if r > 0 else 0.0
    if r <= mean:  # by the other side, which is then the smaller or a like one
        first = (r - 1) * math.log(mean) - mean - math.lgamma(r) if r > 0 else -math.inf
        term = total = 1.0
        for k in range(r - 1, 0, -1):
            term *= k / mean
            total += term
            if term < total * 1e-16:
                break
        return math.log1p(-min(math.exp(first) * total, 1 - 1e-16))
    term = total = 1.0
    k = r
    while term > total * 1e-16:
        k += 1
        term *= mean / k
        total += term
    return min(0.0, r * math.log(mean) - mean - math.lgamma(r + 1) + math.log(total))


def poisson_tail(mean: float, r: int) -> float:
    """P(N >= r) for a Poisson count."""
    return math.exp(log_poisson_tail(mean, r))


def solve_lambda(scores: np.ndarray, rates: np.ndarray) -> float:
    """The positive root of E[exp(lambda * s)] = 1; rates are the chances of the positive scores,
    the rest of the tokens score -DRIFT."""
    rest = 1.0 - rates.sum()
    f = lambda lam: float((rates * np.exp(np.minimum(lam * scores, 700))).sum() + rest * math.exp(-lam * DRIFT) - 1)
    lo, hi = 1e-6, 1.0
    while f(hi) < 0 and hi < 1e4:
        lo, hi = hi, 2 * hi
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return lo


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Model:
    """``labels`` has the id and the label of the rows that may be learnt from."""
    bounded_batches(spark)
    lab = labels.select(F.col(doc_id).cast("long").alias("__id"), F.col(label).cast("int").alias("__y")).dropna()
    lab = lab.groupBy("__id").agg(F.max("__y").alias("__y"))
    sample = lab.orderBy(F.xxhash64("__id"), "__id").limit(MAX_TRAIN)
    rows = sample.collect()  # at most MAX_TRAIN pairs of numbers
    if not rows:
        return Model({}, 1.0, 0.0)
    sample = spark.createDataFrame(rows, "__id long, __y int")
    prior = sum(r[1] for r in rows) / len(rows)
    scratch = Scratch(spark, "toxicity")
    src = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text")).join(F.broadcast(sample), "__id").select("__text", "__y")
    keyed = scratch.write(src.mapInArrow(_key, "text string, y int, key long"), "sample")  # at most MAX_TRAIN texts, or rows with their ids
    leads = keyed.groupBy("key", "y").agg(F.min("text").alias("lead"))
    others = keyed.join(leads, ["key", "y"]).where("text <> lead").select("text", "y", "lead").distinct()
    one = leads.select(F.col("lead").alias("text"), "y").unionByName(others.mapInArrow(_apart, "text string, y int"))
    counts = one.mapInArrow(_count, "unit string, toxic long, clean long, told long").groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.sum("told").alias("told"))
    counts = scratch.write(counts.where(F.col("t") >= MIN_TEXTS), "counts")
    total = counts.where("unit = ''").first()
    if not total or not total["c"]:
        return Model({}, 1.0, prior)
    n_t, n_c, n_words = total["t"], total["c"], total["told"]
    n = n_t + n_c
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    a = (t + c) * PRIOR  # pooled counts as the prior
    # less one standard error, so that units of few texts count less
    odds = F.log((t + a) / (n_t + PRIOR * n - t)) - F.log((c + a) / (n_c + PRIOR * n - c)) - F.sqrt(1 / (t + a) + 1 / (c + a))
    # signed root of the likelihood ratio of the two rates against the pooled rate
    pooled = (t + c) / n
    ratio = 2 * (t * F.log(t / (n_t * pooled)) + F.when(c > 0, c * F.log(c / (n_c * pooled))).otherwise(0.0))
    z = F.sqrt(F.greatest(ratio, F.lit(0.0)))
    best = counts.where("unit <> ''").select("unit", "t", "c", "told", odds.alias("s"), z.alias("z")).where((F.col("z") >= MIN_Z) & (F.col("s") > 0) & (F.col("c") <= MAX_CLEAN * (F.col("t") + F.col("c"))))
    found = best.orderBy(F.desc("z"), "unit").limit(MAX_UNITS).collect()
    scratch.drop("sample", "counts")
    if not found:
        return Model({}, 1.0, prior)
    s = np.array([r["s"] for r in found])
    # chance of each unit in clean text; a beginning and its words are told apart, on the safe side
    rate = np.array([(r["told"] + 0.5) / (n_words + 1) for r in found])
    rate = rate / max(1.0, 2 * rate.sum())
    return Model({r["unit"]: float(r["s"]) for r in found}, solve_lambda(s, rate), prior)


def maximal_segments(hits: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first token, last token, score) of a sequence in which the given
    positions score as told and every other position scores -DRIFT."""
    segs: list[list] = []  # start, end, cumulative score before, cumulative score through
    cum, at = 0.0, 0
    for pos, s in hits:
        cum -= DRIFT * (pos - at)
        seg = [pos, pos, cum, cum + s]
        cum, at = cum + s, pos + 1
        while True:
            # the nearest earlier segment that begins lower
            j = len(segs) - 1
            while j >= 0 and segs[j][2] >= seg[2]:
                j = segs[j][4]
            if j < 0 or segs[j][3] >= seg[3]:
                seg.append(j)
                segs.append(seg)
                break
            seg = [segs[j][0], seg[1], segs[j][2], seg[3]]
            del segs[j:]
    return [(a, b, r - lo) for a, b, lo, r, _ in segs]


class _Scores(dict):
    """Scores by word, filled as words turn up; starts anew when it has grown large."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, w: str) -> float:
        if len(self) > 1_000_000:
            self.clear()
        v = self[w] = self.model.word_score(w)
        return v


def passages(text: str | None, scores) -> tuple[int, list[tuple[int, int, float]]]:
    words = tokens(text)
    got = [scores[w] for w in words]
    hits = [(i, s) for i, s in enumerate(got) if s] if any(got) else []
    return len(words), maximal_segments(hits)


def score_texts(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, score, n_tokens and passages: every significant passage with its first and
    last token, score and expected number by chance."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((model.units, model.lam, model.prior))
    src = docs.select(*keep, F.col(text).alias(fresh(docs, "__text")[0]))
    ddl = "array<struct<first: int, last: int, score: double, expected: double>>"
    schema = src.select(*keep, F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast(ddl).alias("passages")).schema
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches):
        model = Model(*shared.value)
        scores = _Scores(model)
        for b in batches:
            score, size, found = [], [], []
            for t in b.column(b.num_columns - 1).to_pylist():
                n, segs = passages(t, scores) if model.units else (len(tokens(t)), [])
                score.append(model.score(n, [s[2] for s in segs]))
                size.append(n)
                tell = [(a, z, s, n * math.exp(-model.lam * s)) for a, z, s in segs]
                found.append([dict(zip(("first", "last", "score", "expected"), x, strict=True)) for x in tell if x[3] < EXPECTED])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score, pa.float64()), pa.array(size, pa.int64()), pa.array(found, kind)], names=schema.names)

    return src.mapInArrow(run, schema)
