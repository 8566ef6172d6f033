"""Media columns: interleaved documents of ordered text and media, with payloads joined by digest.

``parse_pages`` reads HTML into a sequence of structs (position, kind, text, digest, caption) in
document order: runs of text, and a media reference for every img, audio, video, source, embed and
object element; its caption is the figcaption of its figure, else its alt or title text. A reference
names its payload by digest (``media:<sha256>``) or, where it names a URL, by the digest that a table of
``addresses`` (url, digest) gives for it.

``store_samples`` keeps payloads as 8-bit grey images in the plain PGM form (64 samples a row; the
payload is padded with zero bytes to whole rows, at least one) in a Parquet table with digest and
length beside it. ``read_back`` reads the stored bytes, takes the image apart again and computes the
features from what it read. ``resolve`` joins sequences with features by digest; only narrow rows
take part in the join, payload bytes are never shuffled.

Defined results: a null text or payload counts as empty and becomes one row of zero samples; null
HTML gives an empty sequence; a head that is never closed ends where the body's first element begins, and an
element of hidden text that nothing closes hides nothing; a reference
without a payload keeps its place with null features; equal payloads share one digest and all their
values, however often they are stored; empty tables give empty results; other columns ride along.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, bounded_batches, crc32, fresh

WIDTH = 64
MEDIA_TAGS = frozenset({"img", "audio", "video", "source", "embed", "object"})
_BREAKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 tr td th table section article blockquote pre".split())
_SKIP = frozenset({"script", "style", "title", "template", "noscript"})
_HEAD = frozenset({"head", "title", "base", "link", "meta", "script", "style", "template", "noscript"})
ITEMS_DDL = "array<struct<position: int, kind: string, text: string, ref: string, caption: string>>"
_ITEMS = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string())]))


_CLOSER = re.compile(r"</(title|template|noscript|script|style)\b", re.I)


class _Reader(HTMLParser):
    """Collects the items of one page."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        # a skipped element that nothing closes hides nothing
        self.closers = Counter(m.lower() for m in _CLOSER.findall(html))
        self.in_head = False
        self.items: list[dict] = []
        self.run: list[str] = []
        self.skip = 0
        self.figures: list[list[int]] = []  # media items of the open figures
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            self.items.append({"position": len(self.items), "kind": "text", "text": text, "ref": None, "caption": None})

    def handle_starttag(self, tag, attrs):
        if tag == "head":
            self.in_head = True
        elif tag not in _HEAD:
            self.in_head = False  # the body has begun, whether the head was closed or not
        if tag in _SKIP and self.closers[tag] > 0:
            self.skip += 1
        if self.skip or self.in_head:
            return
        if tag in _BREAKS or tag == "figure":
            self.flush()
        if tag == "figure":
            self.figures.append([])
        elif tag == "figcaption":
            self.flush()
            self.caption = []
        elif tag in MEDIA_TAGS:
            a = dict(attrs)
            ref = a.get("src") or a.get("data")
            if ref:
                self.flush()
                if self.figures:
                    self.figures[-1].append(len(self.items))
                self.items.append({"position": len(self.items), "kind": "media", "text": None, "ref": ref, "caption": a.get("alt") or a.get("title")})

    def handle_endtag(self, tag):
        if tag == "head":
            self.in_head = False
        if tag in _SKIP:
            self.closers[tag] -= 1
            self.skip = max(0, self.skip - 1)
        if self.skip or self.in_head:
            return
        if tag == "figcaption" and self.caption is not None:
            text = " ".join("".join(self.caption).split())
            for i in self.figures[-1] if self.figures else []:
                self.items[i]["caption"] = text or self.items[i]["caption"]
            if text and not (self.figures and self.figures[-1]):
                self.run.append(text)  # a caption that captions nothing is text
            self.caption = None
        if tag == "figure" and self.figures:
            self.figures.pop()
        if tag in _BREAKS:
            self.flush()

    def handle_data(self, data):
        if not self.skip and not self.in_head:
            (self.run if self.caption is None else self.caption).append(data)


def parse_html(html: str | None) -> list[dict]:
    r = _Reader(html or "")
    if html:
        r.feed(html)
        r.close()
        if r.caption:
            r.run.extend(r.caption)
        r.flush()
    return r.items


def parse_pages(spark: SparkSession, pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The kept columns and ``items``, the page's sequence."""
    bounded_batches(spark)
    src = pages.select(*keep, F.col(html).alias(fresh(pages, "__html")[0]))
    schema = src.select(*keep, F.lit(None).cast(ITEMS_DDL).alias("items")).schema

    def run(batches):
        for b in batches:
            items = [parse_html(h) for h in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(items, _ITEMS)], names=schema.names)

    return src.mapInArrow(run, schema)


def to_image(payload: bytes) -> bytes:
    """A padded payload as a binary PGM image, 64 samples wide."""
    return b"P5\n%d %d\n255\n" % (WIDTH, len(payload) // WIDTH) + payload


_PGM = re.compile(rb"P5\n(\d+) (\d+)\n255\n")


def from_image(media: bytes) -> np.ndarray:
    m = _PGM.match(media)
    if not m:
        raise ValueError("not a stored image")
    return np.frombuffer(media, np.uint8, int(m[1]) * int(m[2]), m.end()).reshape(int(m[2]), int(m[1]))


def pad(data: bytes) -> bytes:
    return data + bytes(max(WIDTH, -(-len(data) // WIDTH) * WIDTH) - len(data))


def store_samples(scratch: Scratch, docs: DataFrame, text: str, keep: tuple[str, ...], label: str = "media") -> DataFrame:
    """Writes (kept columns, digest, n_bytes, media); digest is that of the payload before padding."""
    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = src.select(*keep, F.lit("").alias("digest"), F.lit(0).cast("long").alias("n_bytes"), F.lit(b"").alias("media")).schema

    def run(batches):
        for b in batches:
            step = 200
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                raw = [(t or "").encode() for t in part.column(part.num_columns - 1).to_pylist()]
                padded = [pad(r) for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([hashlib.sha256(r).hexdigest() for r in raw]), pa.array([len(r) for r in raw], pa.int64()), pa.array([to_image(p) for p in padded], pa.binary())], names=schema.names)

    return scratch.write(src.mapInArrow(run, schema), label, "zstd")


_FEATURES = pa.schema([("digest", pa.string()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
_FEATURES_DDL = "digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature(image: np.ndarray) -> str:
    """Size, mean grey, contrast and a coarse histogram of eight grey bands, all from whole samples."""
    n = image.size
    hist = np.bincount(image.ravel(), minlength=256)
    grey = np.arange(256)
    mean = int((hist * grey).sum()) / n
    var = int((hist * grey * grey).sum()) / n - mean * mean
    bands = hist.reshape(8, 32).sum(1)
    return f"grey8 {image.shape[1]}x{image.shape[0]} mean={mean:.4f} sd={max(var, 0.0) ** 0.5:.4f} bands={','.join(str(int(x)) for x in bands)}"


def read_back(store: DataFrame) -> DataFrame:
    """Features of every stored payload, from its stored bytes; fails on bytes that do not match their digest."""

    def run(batches):
        for b in batches:
            out: dict[str, list] = {f.name: [] for f in _FEATURES}
            for digest, n, media in zip(*(c.to_pylist() for c in b.columns), strict=True):
                image = from_image(media)
                payload = image.tobytes()
                if hashlib.sha256(payload[:n]).hexdigest() != digest:
                    raise ValueError(f"stored payload of {digest} reads back differently")
                row = (digest, n, len(payload), hashlib.sha256(payload).hexdigest(), crc32(payload[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), feature(image))
                for k, v in zip(_FEATURES.names, row, strict=True):
                    out[k].append(v)
            yield batch(_FEATURES, **out)

    return store.select("digest", "n_bytes", "media").mapInArrow(run, _FEATURES_DDL)


def references(sequences: DataFrame, keep: tuple[str, ...], addresses: DataFrame | None = None) -> DataFrame:
    """One row per media reference: kept columns, position, caption, ref, digest. ``addresses`` (url, digest),
    with one row per URL, gives the digests of references that name a URL; of others it is ``''``."""
    x = sequences.select(*keep, F.explode(F.filter("items", lambda i: i["kind"] == "media")).alias("i"))
    own = F.regexp_extract("i.ref", "^media:([0-9a-f]{64})$", 1)
    rows = x.select(*keep, F.col("i.position").alias("position"), F.col("i.caption").alias("caption"), F.col("i.ref").alias("ref"), own.alias("digest"))
    if addresses is None:
        return rows
    named = rows.where("digest <> ''")
    by_url = rows.where("digest = ''").drop("digest").join(addresses.select(F.col("url").alias("ref"), "digest"), "ref", "left")
    return named.unionByName(by_url.withColumn("digest", F.coalesce("digest", F.lit(""))))


def resolve(scratch: Scratch, refs: DataFrame, features: DataFrame) -> DataFrame:
    """References with the features of their payloads; equal digests are one payload. The grouped
    features are written first: a digest that a third of all references share is then a skewed join
    that adaptive execution splits."""
    cols = [c for c in features.columns if c != "digest"]
    one = scratch.write(features.groupBy("digest").agg(*[F.min(c).alias(c) for c in cols]), "payloads")
    return refs.join(one, "digest", "left")


def pages_of(store: DataFrame) -> DataFrame:
    """(doc_id, html): the stored text as a page, its lines as paragraphs and, after the first half of them,
    a figure that shows the stored payload by its URL, captioned with the id. The text is taken out of
    the stored bytes, so the page needs no second read of the documents."""
    padded = F.greatest(F.lit(WIDTH), F.ceil(F.col("n_bytes") / WIDTH) * WIDTH).cast("int")
    raw = F.substring(F.col("media"), F.octet_length("media") - padded + 1, F.col("n_bytes").cast("int"))
    text = F.decode(raw, "UTF-8")
    safe = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    lines = F.transform(F.split(safe, "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>")))
    half = F.expr("cast(size(lines) div 2 as int)")
    figure = F.concat(F.lit("<figure><img src='"), F.col("url"), F.lit("' alt='payload'><figcaption>document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("without id")), F.lit("</figcaption></figure>"))
    d = store.select("doc_id", "url", lines.alias("lines"))
    return d.select("doc_id", F.concat(F.lit("<html><body>"), F.array_join(F.slice("lines", F.lit(1), half), ""), figure, F.array_join(F.slice("lines", half + 1, F.size("lines")), ""), F.lit("</body></html>")).alias("html"))


def documents_as_media(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every text as a stored payload, shown by a page that interleaves it with the text's lines."""
    bounded_batches(spark)
    scratch = Scratch(spark, "media")
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.concat(F.lit("/media/"), F.monotonically_increasing_id().cast("string"), F.lit(".pgm")).alias("url"), F.col(text).alias("text"))
    store = store_samples(scratch, src, "text", ("doc_id", "url"))
    seqs = parse_pages(spark, pages_of(store), keep=("doc_id",))
    feats = scratch.write(read_back(store), "features")
    refs = scratch.write(references(seqs, ("doc_id",), store.select("url", "digest")), "references")
    scratch.drop("media")
    return resolve(scratch, refs, feats)
