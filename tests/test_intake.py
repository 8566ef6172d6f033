"""Files against the manifest, and a manifest with two writers."""

import hashlib
import json

from pyspark.sql import functions as F

from registra import cli
from registra.plans import intake
from registra.schemas import WORDS
from registra.sources import tables as T
from registra.sources.tables import SMK_MANIFEST

from .test_layout import register_words


def test_reasons(spark, tmp_path):
    good, other = b"%PDF-1.7 good", b"%PDF-1.7 other"
    for name, content in (("a.pdf", good), ("b.pdf", b"<html>"), ("c.pdf", other), ("e.pdf", b""), ("f.pdf", good)):
        (tmp_path / name).write_bytes(content)
    (tmp_path / "again").mkdir()
    (tmp_path / "again" / "c.pdf").write_bytes(good)
    sha = hashlib.sha256(good).hexdigest()
    m = spark.createDataFrame([(n, s) for n, s in (("a", sha), ("b", hashlib.sha256(b"<html>").hexdigest()), ("c", sha), ("d", sha), ("e", sha), ("f", None), ("f", "0"), ("a", sha))], "k string, sha256 string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    x = intake.verify(m, intake.inspect(files), F.concat("k", F.lit(".pdf")))
    assert sorted(r.k for r in x.good.collect()) == ["a", "a", "c"] and x.good.columns == ["k", "sha256"]
    assert sorted((r.k, r.reason) for r in x.bad.collect()) == [("b", "not a pdf"), ("d", "missing"), ("e", "missing"), ("f", "sha256 differs"), ("f", "sha256 differs")]
    none = intake.verify(m, intake.inspect(files.limit(0)), F.concat("k", F.lit(".pdf")))
    assert none.good.count() == 0 and {r.reason for r in none.bad.collect()} == {"missing"}


def rows(spark, *digests):
    return spark.createDataFrame([(f"2024-01-{int(d):02d}", f"t{d}", f"d{d}", f"s{d}", 1) for d in digests], SMK_MANIFEST)


def add(spark, folder, *digests):
    return intake.add_to_manifest(spark, folder, rows(spark, *digests), SMK_MANIFEST, ("digest",), ("generated", "wayback_ts"))


def digests(spark, folder):
    return [r.digest for r in intake.read_manifest(spark, folder, SMK_MANIFEST)[1].orderBy("generated").collect()]


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/m"
    assert intake.read_manifest(spark, folder, SMK_MANIFEST)[0] == 0
    assert add(spark, folder, 3, 1) == 1 and digests(spark, folder) == ["d1", "d3"]
    claim, first = intake._claim, []

    def late(*a):
        if not first:  # another writer is done between our read and our claim
            first.append(1)
            assert add(spark, folder, 2, 9) == 2
        return claim(*a)

    monkeypatch.setattr(intake, "_claim", late)
    assert add(spark, folder, 5, 2) == 3
    assert digests(spark, folder) == ["d1", "d2", "d3", "d5", "d9"]
    monkeypatch.setattr(intake, "_claim", claim)
    assert add(spark, folder, 1) == 4 and len(digests(spark, folder)) == 5


def test_backfill_takes_verified_files_only(spark, tmp_path):
    dates = ["2026-01-01", "2026-01-02", "2026-01-03"]
    pdfs = tmp_path / "pdfs"
    pdfs.mkdir()
    (pdfs / f"pr-{dates[0]}.pdf").write_bytes(b"%PDF a")
    (pdfs / f"pr-{dates[1]}.pdf").write_bytes(b"%PDF changed")
    sha = hashlib.sha256(b"%PDF a").hexdigest()
    (tmp_path / "m.json").write_text(json.dumps([{"date": d, "url": "u", "sha256": sha, "origin": "wayback", "dataset": True} for d in dates]))
    rows = [(f"pr-{d}", *w[1:]) for d in dates for w in register_words()]
    spark.createDataFrame(rows, WORDS).write.parquet(f"{tmp_path}/words")
    got = cli.run(["backfill", f"{tmp_path}/m.json", f"{tmp_path}/store", "--words", f"{tmp_path}/words", "--pdf-dir", str(pdfs)], spark)
    assert got == {"written": dates[:1], "refused": [{"doc_id": "pr-2026-01-02", "reason": "sha256 differs"}, {"doc_id": "pr-2026-01-03", "reason": "missing"}]}
    assert T.snapshots(spark, f"{tmp_path}/store", "documents").count() == 1
