"""Shared pieces of the training-data operators: word rules, vectorised hashing, scratch tables.

A *word* is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` (``bytes.split()`` uses exactly
that set). Lower-casing touches A-Z only, as ``bytes.lower()`` does.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import itertools
import shutil
import tempfile
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE_RE = r"[ \t-\r]+"
#: Rows of one Arrow batch sent to a Python worker; with whole texts in it a batch must stay small.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough that whole long texts fit in a worker."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: Spark's own Bloom filter over the small side of a join, at any input size: of 1 MB, whatever it holds.
BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB",
}
#: A scratch table is read by the plan that wrote it, so no mark of success is written; without Hadoop's native
#: library each such file costs the driver two processes.
UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
LEAST_LONG = -(1 << 63)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings that hold inside the block only."""
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def selective(rows: DataFrame, key: str) -> DataFrame:
    """All rows with a key (a long): the comparison lets Spark take the side for a Bloom filter."""
    return rows.where(F.col(key) >= LEAST_LONG)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where a column of ``df`` has one of them already."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def rows_by_text(spark: SparkSession, docs: DataFrame, want: DataFrame, once: bool = False) -> DataFrame:
    """Rows of ``docs`` (doc_id, t1, t2, text) with the doc_id and text hashes of ``want`` and its other
    columns. Texts that nobody asks for are not shuffled when this is written with ``bloom``. A row
    without a doc_id is looked up by the hashes alone. With ``once`` repeated rows give each row of
    ``want`` one text only: rows without an id are told apart before they are shuffled, others where the
    join has brought them together."""
    none = docs.where("doc_id is null")
    known = docs.join(selective(want, "doc_id"), ["doc_id", "t1", "t2"])
    if once:
        none = none.dropDuplicates(["t1", "t2"])
        known = known.dropDuplicates(want.columns)
    null = none.join(selective(want.where("doc_id is null").drop("doc_id"), "t1"), ["t1", "t2"])
    return known.unionByName(null)


class KeyFilter:
    """A bitmap of hashed keys (longs): ``maybe`` is true for every one of them and for few others.

    Rows of which it is false pass a join with the keys untouched, without a shuffle. The bitmap has
    about 32 bits a key and at most ``MOST`` bits (8 MB), so beyond two million keys it lets more rows
    through to the join, which stays exact."""

    MOST = 1 << 26

    def __init__(self, spark: SparkSession, keys: DataFrame, key: str):
        n = keys.count()
        bits = 1 << 16
        while bits < 32 * n and bits < self.MOST:
            bits *= 2
        at = keys.select(F.pmod(F.col(key), F.lit(bits)).alias("b")).select(F.shiftright("b", 5).alias("w"), F.expr("shiftleft(1L, cast(b % 32 as int))").alias("m"))
        rows = at.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()  # at most MOST / 32 pairs
        table = np.zeros(bits // 32, np.uint32)
        table[rows.column(0).to_numpy()] = rows.column(1).to_numpy().astype(np.uint32)
        shared = spark.sparkContext.broadcast(table)

        @F.pandas_udf("boolean")
        def maybe(k: pd.Series) -> pd.Series:
            b = np.mod(k.to_numpy(np.int64), bits)
            return pd.Series((shared.value[b >> 5] >> (b & 31).astype(np.uint32)) & 1 == 1)

        self._maybe = maybe

    def maybe(self, key: str):
        return self._maybe(F.col(key))


@functools.cache
def _local_folder() -> str:
    path = tempfile.mkdtemp(prefix="registra-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


_open: list[list] = []


@contextlib.contextmanager
def scratch_scope():
    """Scratch folders made inside the block are removed at its end."""
    made: list[Scratch] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for s in made:
            s.close()


class Scratch:
    """Tables written to the shared folder that ``spark.checkpoint.dir`` names.

    They cut lineage: once written, a lost executor costs no recomputation. ``drop`` removes one as
    soon as no later plan reads it. Where the setting is absent (tests on one machine) a temporary
    folder is used, which goes when the process ends.
    """

    def __init__(self, spark: SparkSession, name: str, broadcast: bool = True):
        """Without ``broadcast`` no join of a written plan sends a side whole: for plans whose tables all
        grow with the input, so that they are the same at every size."""
        self.spark = spark
        self._conf = {} if broadcast else {"spark.sql.autoBroadcastJoinThreshold": "-1"}
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = _local_folder()
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        for made in _open:
            made.append(self)
        self._n = itertools.count()
        self._paths: dict[str, str] = {}

    def write(self, df: DataFrame, label: str, codec: str = "snappy", bloom: bool = False) -> DataFrame:
        """Write and reread; ``label`` only helps to read the folder. Tables of ids and hashes hardly
        compress and take the codec that needs least native memory; texts and token ids take zstd.
        With ``bloom`` Spark filters the large side of shuffled joins by what the other side holds."""
        path = f"{self.root}/{next(self._n)}-{label}"
        with settings(self.spark, self._conf | (BLOOM if bloom else {})):
            df.write.options(**UNMARKED).option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[label] = path
        return out

    def drop(self, *labels: str) -> None:
        jvm = self.spark._jvm
        for label in labels:
            path = self._paths.pop(label, None)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def keep(self, *labels: str) -> None:
        """Drop all tables but these."""
        self.drop(*[x for x in self._paths if x not in labels])

    def close(self) -> None:
        """Remove the whole folder; tables given out by ``write`` can no longer be read."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self._paths.clear()

    def tidy(self) -> None:
        """Let Spark's cleaner remove shuffle files that no live plan needs."""
        import gc

        gc.collect()
        self.spark._jvm.System.gc()


def crc_mod(col: str, n: int):
    """crc32 of the id written as text, modulo n (the split rule of the held-out rows)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def words_col(text):
    """Array of the words of a text column; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RE), lambda w: w != "")


def word_count(text):
    """Number of words without building more than one array; null gives 0."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_RE)
    n = F.size(parts) - F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
    last = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (n - last).cast("long")


# ---------------------------------------------------------------------------------------------
# vectorised hashing

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLOCK = 1 << 20
_tables: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    if not _tables:
        for base in (_P, _PINV):
            t = np.full(_BLOCK + 1, base, np.uint64)
            t[0] = 1
            _tables.append(np.cumprod(t, dtype=np.uint64))
    return _tables


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a byte array."""
    flag = np.empty(len(buf) + 2, np.int8)
    flag[0] = flag[-1] = 0
    flag[1:-1] = ~_SPACE[buf]
    d = np.diff(flag)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _hash_block(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    pw, inv = _powers()
    c = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(buf.astype(np.uint64) * pw[: len(buf)], out=c[1:])
    return mix64((c[e] - c[s]) * inv[s])


def hash_words(data: bytes, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each word data[s:e]; equal bytes give equal hashes wherever they lie."""
    buf = np.frombuffer(data, np.uint8)
    out = np.empty(len(s), np.uint64)
    i = 0
    while i < len(s):
        j = int(np.searchsorted(e, s[i] + _BLOCK, "right"))
        if j > i:
            lo, hi = int(s[i]), int(e[j - 1])
            out[i:j] = _hash_block(buf[lo:hi], s[i:j] - lo, e[i:j] - lo)
            i = j
        else:  # one word longer than a block
            h, step = np.uint64(0), np.uint64(1)
            pw = _powers()[0]
            for k in range(int(s[i]), int(e[i]), _BLOCK):
                part = buf[k : min(k + _BLOCK, int(e[i]))]
                with np.errstate(over="ignore"):
                    h = h + step * np.sum(part.astype(np.uint64) * pw[: len(part)], dtype=np.uint64)
                    step = step * pw[_BLOCK]
            out[i] = mix64(np.array([h], np.uint64))[0]
            i += 1
    return out


def doc_words(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Lower-cased bytes of a text and its word bounds."""
    data = (text or "").encode().lower()
    s, e = word_bounds(np.frombuffer(data, np.uint8))
    return data, s, e


_Q = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def shingle_hashes(w: np.ndarray, n: int = 5) -> np.ndarray:
    """Hash of every n-word shingle, in order; a shorter, non-empty sequence counts as one."""
    if len(w) == 0:
        return np.empty(0, np.uint64)
    k = min(n, len(w))
    m = len(w) - k + 1
    r = np.full(m, k, np.uint64)
    for j in range(k):
        r = mix64(r * _Q[j % 5] + w[j : j + m])
    return r


def minhash_multipliers(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, n, np.uint64)


def minhash(h: np.ndarray, starts: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """(len(starts), n) uint32 minima of n hash functions over the runs of h that begin at starts."""
    a, x = minhash_multipliers(n, seed)
    out = np.empty((len(starts), n), np.uint32)
    if len(starts):
        for j in range(n):
            out[:, j] = np.minimum.reduceat((((h ^ x[j]) * a[j]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def fingerprint(h: np.ndarray) -> tuple[int, int]:
    """Two 64-bit words that identify a sorted hash set or a hash sequence."""
    import xxhash

    d = xxhash.xxh3_128_digest(np.ascontiguousarray(h).tobytes())
    v = np.frombuffer(d, np.int64)
    return int(v[0]), int(v[1])


def crc32(data: bytes) -> int:
    return zlib.crc32(data)


def batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)


# ---------------------------------------------------------------------------------------------
# connected components

#: Edges that a task holds at a time.
EDGES = 1 << 18
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that these edges join with a smaller one, and the smallest that it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[x], root[y]
        apart = x != y
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up
    low = root != np.arange(len(nodes))
    return nodes[low], nodes[root[low]]


def _forests(batches):
    """Edges (a, b) that join the same nodes, no more of them than before: the forests of blocks of ``EDGES``."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for more in itertools.chain(batches, [None]):
        if more is not None:
            held.append((more.column(0).to_numpy(), more.column(1).to_numpy()))
            n += more.num_rows
        if n and (more is None or n >= EDGES):
            a, b = forest(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, n = [(a, b)], len(a)
            if more is None or n > EDGES // 2:
                yield batch(_EDGE, a=a, b=b)
                held, n = [], 0


def stars(scratch: Scratch, edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, comp) for every node of an edge but the smallest that it reaches, which is its comp.

    ``edges`` has long columns a and b. Every task first joins the edges that it holds (``_forests``), before
    and after a shuffle by the larger end, so few rounds are left; a node comes from a task once, so a hub's
    edges are never in one group. A round then hands each node the parent of its parent (a large-star step),
    by a join that adaptive execution splits, until every node points to one root that points to none. Each
    round is written to the scratch folder.
    """

    def joined(e: DataFrame) -> DataFrame:
        return e.mapInArrow(_forests, "a long, b long").repartition("a").mapInArrow(_forests, "a long, b long")

    e = scratch.write(joined(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), f"{label}-0")
    for k in itertools.count(1):
        ends = e.select("a", F.lit(1).alias("up")).union(e.select("b", F.lit(0)))
        if ends.groupBy("a").agg(F.sum("up").alias("n"), F.min("up").alias("low")).where("n > 1 or n = 1 and low = 0").isEmpty():
            break
        low = scratch.write(e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), "m"), f"{label}-{k}m")
        e = scratch.write(joined(e.join(low, "b", "left").select("a", F.coalesce("m", "b").alias("b"))), f"{label}-{k}")
        scratch.drop(f"{label}-{k - 1}", f"{label}-{k}m")
    return e.toDF("node", "comp")


def components(scratch: Scratch, edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, comp) for every node of an edge (a, b); comp is the smallest node that it reaches."""
    found = stars(scratch, edges, label)
    roots = found.select(F.col("comp").alias("node")).distinct()
    return found.union(roots.select("node", F.col("node").alias("comp")))
