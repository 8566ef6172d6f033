"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; every run of characters that are not letters becomes one blank, and the
n-grams of 1 to 3 characters are hashed into ``BUCKETS`` cells. Training counts cells per language
in numpy, one partial matrix per task, and sums the partial matrices in Spark; only the summed
matrix (languages x cells) reaches the driver and is broadcast as log-probabilities. Its size is
bounded: languages beyond ``MAX_LANGS`` raise an error instead of growing it. A text is scored with
its sparse cell counts against the matrix rows of those cells, whole, in blocks of characters.

The score is the posterior of the predicted language, tempered by the number of n-grams so that it
reads as confidence per text rather than as a product over thousands of dependent n-grams.

Defined results: a null text, an empty one or one without a letter gets ``und`` and score 0; so does
every text when there is nothing to learn from. Rows with a null language or null id do not train.
Ties go to the language that sorts first. Repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, bounded_batches, fresh, mix64

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
ALPHA = 0.1
MAX_LANGS = 256
BLOCK_CHARS = 2_000_000
#: A text of this many n-grams or more is scored as if it had this many.
EVIDENCE = 60.0

_letter: list[np.ndarray] = []


def _is_letter(cp: np.ndarray) -> np.ndarray:
    if not _letter:
        import sys

        table = np.zeros(sys.maxunicode + 1, bool)
        table[[i for i in range(sys.maxunicode + 1) if chr(i).isalpha()]] = True
        _letter.append(table)
    return _letter[0][cp]


def cell_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Cells of a whole text and how often each occurs; None without a letter."""
    if not text:
        return None
    low = text.lower()  # whole: how a letter is lowered can depend on its neighbours
    total = np.zeros(BUCKETS, np.int64)
    seen = False
    tail = np.array([32], np.uint64)  # the last two characters before the block, which begin n-grams that end in it
    after_letter = True
    for lo in range(0, len(low), BLOCK_CHARS):
        cp = np.frombuffer(low[lo : lo + BLOCK_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
        ok = _is_letter(cp)
        seen = seen or bool(ok.any())
        keep = ok | np.append(after_letter, ok[:-1])
        after_letter = bool(ok[-1])
        x = np.where(ok, cp, 32)[keep].astype(np.uint64)
        if lo + BLOCK_CHARS >= len(low):
            x = np.append(x, np.uint64(32))
        fresh = len(x) + (lo == 0)  # the blank at the text's head is a 1-gram of the first block
        x = np.concatenate([tail, x])
        for n in ORDERS:
            y = x[max(0, len(x) - fresh - n + 1) :]
            if len(y) >= n:
                h = np.full(len(y) - n + 1, n, np.uint64)
                for j in range(n):
                    h = h * np.uint64(0x100000001B3) + y[j : j + len(h)]
                total += np.bincount((mix64(h) >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
        tail = x[-2:]
    if not seen:
        return None
    at = np.flatnonzero(total)
    return at, total[at]


def train(spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities cells x languages, log-priors) from every row of ``docs``."""
    bounded_batches(spark)
    schema = pa.schema([("lang", pa.string()), ("cell", pa.int32()), ("n", pa.int64())])

    def run(batches):
        part: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for b in batches:
            for t, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if (c := cell_counts(t)) is not None:
                    if g not in part:
                        if len(part) >= MAX_LANGS:
                            raise ValueError(f"more than {MAX_LANGS} languages")
                        part[g] = np.zeros(BUCKETS, np.int64)
                    part[g][c[0]] += c[1]
                    rows[g] = rows.get(g, 0) + 1
        for g, v in part.items():
            at = np.flatnonzero(v)
            yield batch(schema, lang=[g] * (len(at) + 1), cell=np.append(at, -1).astype(np.int32), n=np.append(v[at], rows[g]))

    counts = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(run, "lang string, cell int, n long")
    got = counts.groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    langs = sorted(r[0] for r in got.where("cell = -1").select("lang").limit(MAX_LANGS + 1).collect())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    table = np.zeros((BUCKETS, max(1, len(langs))))
    prior = np.zeros(max(1, len(langs)))
    at = {g: i for i, g in enumerate(langs)}
    # at most MAX_LANGS * (BUCKETS + 1) numbers
    pdf = got.toPandas()
    if len(pdf):
        li, cell, n = pdf["lang"].map(at).to_numpy(), pdf["cell"].to_numpy(), pdf["n"].to_numpy()
        table[cell[cell >= 0], li[cell >= 0]] = n[cell >= 0]
        prior[li[cell < 0]] = n[cell < 0]
    logp = np.log(table + ALPHA) - np.log(table.sum(0) + ALPHA * BUCKETS)
    return langs, logp.astype(np.float32), np.log(np.maximum(prior, 1) / max(1, prior.sum()))


def predict(spark: SparkSession, docs: DataFrame, model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score."""
    bounded_batches(spark)
    langs, logp, prior = model
    shared = spark.sparkContext.broadcast((langs, logp, prior))
    src = docs.select(*keep, F.col(text).alias(fresh(docs, "__text")[0]))
    schema = src.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        langs, logp, prior = shared.value
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            pred, score = [], []
            for t in texts:
                c = cell_counts(t) if langs else None
                if c is None:
                    pred.append("und")
                    score.append(0.0)
                    continue
                at, n = c
                total = float(n.sum())
                s = n.astype(np.float64) @ logp[at].astype(np.float64)
                k = int(np.argmax(s + prior))
                z = s * (min(total, EVIDENCE) / total) + prior * min(1.0, total / EVIDENCE)
                z = np.exp(z - z.max())
                pred.append(langs[k])
                score.append(float(z[k] / z.sum()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return src.mapInArrow(run, schema)
