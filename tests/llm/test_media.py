import hashlib
import zlib

import numpy as np
import pytest

from registra.llm import media
from registra.llm.common import Scratch

from .docs import DDL, awkward


def test_sequences_keep_order_captions_and_places():
    html = """<html><head><title>t</title><style>p{}</style></head><body><p>One &amp; two<br>three</p>
    <figure><img src="media:aa" alt="alt"><figcaption>Cap <b>tion</b></figcaption></figure>text<img src=x.png title="T"><script>no()</script>
    <video><source src="v.mp4"></video><figure><img src='b.png' alt='kept'></figure><p>end"""
    got = [(i["position"], i["kind"], i["text"] or i["ref"], i["caption"]) for i in media.parse_html(html)]
    assert got == [(0, "text", "One & two", None), (1, "text", "three", None), (2, "media", "media:aa", "Cap tion"), (3, "text", "text", None), (4, "media", "x.png", "T"), (5, "media", "v.mp4", None), (6, "media", "b.png", "kept"), (7, "text", "end", None)]
    assert media.parse_html(None) == media.parse_html("") == [] and media.parse_html("<figcaption>lone</figcaption>")[0]["text"] == "lone"
    assert [i["text"] for i in media.parse_html("<p>a <b>b")] == ["a b"]


def test_open_elements_hide_nothing():
    texts = lambda h: [i["text"] or i["ref"] for i in media.parse_html(h)]
    assert texts("<html><head><title>x</title><body><p>hello</p><img src=a.png>") == ["hello", "a.png"]
    assert texts("<head><title>x</title><meta name=a><p>hello") == ["hello"]
    assert texts("<body><noscript><p>a</p><template><p>b") == ["a", "b"]
    assert texts("<p>a<noscript>b</noscript><template>c</template>d") == ["ad"]


def test_documents_interleave_with_their_payloads(spark):
    rows = awkward() + [(600, "a < b &amp; c\n\nsecond  line\n<img src=x>\nlast", "en", "a", 0, "", "")]
    got = media.documents_as_media(spark, spark.createDataFrame(rows, DDL)).collect()
    want = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        before = [x for x in lines[: len(lines) // 2] if x.split()]
        digest = hashlib.sha256((t or "").encode()).hexdigest()
        want.append((str(i), len(before), f"document {'without id' if i is None else i}", digest))
    assert sorted((str(r.doc_id), r.position, r.caption, r.digest) for r in got) == sorted(want)
    assert all(r.feature for r in got)


def test_references_by_url_and_digest(spark):
    html = "<p>one</p><figure><img src='/a.png'><figcaption>first</figcaption></figure><p>two</p><img src='media:%s'><img src='/gone.png' alt='g'><p>three</p><img src='/a.png'>" % ("1" * 64)
    pages = spark.createDataFrame([(1, html), (2, "<p>no media</p>")], "page_id long, html string")
    urls = spark.createDataFrame([("/a.png", "2" * 64), ("/b.png", "3" * 64)], "url string, digest string")
    got = media.references(media.parse_pages(spark, pages), ("page_id",), urls).collect()
    assert sorted((r.position, r.caption, r.digest) for r in got) == sorted([(1, "first", "2" * 64), (3, None, "1" * 64), (4, "g", ""), (6, None, "2" * 64)], key=lambda x: x[0])


def test_payloads_read_back(spark):
    rows = awkward() + [(500, "ab\x00", "en", "a", 0, "", ""), (501, "ab", "en", "a", 0, "", "")]
    got = media.documents_as_media(spark, spark.createDataFrame(rows, DDL)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t, *_ in rows:
        raw = (t or "").encode()
        p = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        want.setdefault(i, []).append((len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32))
        stored = media.to_image(b"")[:0]
        assert stored == b"" and r.media_bytes > r.payload_bytes and r.feature.startswith("grey8 64x")
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    by = {r.doc_id: r for r in got}
    assert by[103].feature == by[104].feature and by[500].payload_sha256 == by[501].payload_sha256 and by[500].n_bytes == 3
    assert media.documents_as_media(spark, spark.createDataFrame([], DDL)).count() == 0


def test_image_is_lossless():
    rng = np.random.default_rng(1)
    for n in (64, 128, 6400):
        p = rng.integers(0, 256, n, np.uint8).tobytes()
        assert media.from_image(media.to_image(p)).tobytes() == p
    with pytest.raises(ValueError):
        media.from_image(b"P6\n1 1\n255\n...")


def test_missing_payload_keeps_its_place(spark):
    pages = spark.createDataFrame([(1, f"<p>a</p><img src='media:{'0' * 64}'><p>b</p>"), (2, None)], "page_id long, html string")
    seqs = media.parse_pages(spark, pages)
    refs = media.references(seqs, ("page_id",))
    feats = spark.createDataFrame([], media._FEATURES_DDL)
    (r,) = media.resolve(Scratch(spark, "t"), refs, feats).collect()
    assert (r.page_id, r.position, r.feature) == (1, 1, None)


def test_corrupt_store_is_noticed(spark):
    bad = spark.createDataFrame([("00", 1, bytearray(media.to_image(bytes(64))))], "digest string, n_bytes long, media binary")
    with pytest.raises(Exception, match="reads back differently"):
        media.read_back(bad).collect()
