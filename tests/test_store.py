"""Sources, sinks and plans on small stores."""

import csv
import gzip
import hashlib
import io
import json

import pytest
from pyspark.sql import functions as F

from registra import cli
from registra.operators import incremental
from registra.operators import items as I
from registra.plans import archive, candidates, enrich, markdown, parse, publish
from registra.schemas import CACHE, SCHEMAS, WORDS, conform, empty
from registra.sources import http, sinks
from registra.sources import tables as T

from .test_layout import register_words


@pytest.fixture()
def store(spark, tmp_path):
    words = spark.createDataFrame(register_words(), WORDS)
    m = spark.createDataFrame([("2026-01-01", "u1", "h1", 2, 7, "p")], "date string, url string, file_hash string, n_pages int, population_count int, doc_id string")
    assert parse.parse_register(spark, m, words, f"{tmp_path}/store") == ["2026-01-01"]
    assert parse.parse_register(spark, m, words, f"{tmp_path}/store") == []
    return f"{tmp_path}/store", m, words


def item(**k):
    return {f.name: None for f in CACHE["items"].dataType.elementType} | k


def write_cache(spark, path, records):
    sinks.append_cache(spark.createDataFrame(records, CACHE), path)


def test_incremental_parse_and_publish(spark, store, tmp_path):
    root, m, words = store
    again = m.withColumn("file_hash", F.lit("h2"))
    assert parse.parse_register(spark, again, words, root) == ["2026-01-01"]
    blocks = {r.label: r.block_hash for r in T.snapshots(spark, root, "sections").collect()}
    cache = tmp_path / "cache"
    cache.mkdir()
    (cache / "aa.jsonl").write_text("\n" + json.dumps({"block_hash": blocks["Posts"], "items": [], "model": "m0", "prompt_version": "v0"}) + "\n" + json.dumps({"block_hash": blocks["Posts"], "items": [item(item_text=" seat ", amount_nok="12,9"), item(share_pct="0,5")], "model": "m", "prompt_version": "v1"}, ensure_ascii=False) + "\n")
    read, paths = type(spark.read).parquet, []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "parquet", lambda self, *p, **k: (paths.extend(p), read(self, *p, **k))[1])
        report = publish.build(spark, root, f"{tmp_path}/out", str(cache))
    assert paths and not any(p.startswith(f"{tmp_path}/out") for p in paths)  # counted while written
    assert report["n_snapshots"] == 1 and report["date_range"] == ["2026-01-01", "2026-01-01"]
    assert report["rows"] == {"documents": 1, "items": 2, "persons": 2, "sections": 2, "transactions": 1}
    assert (report["sections_nonempty"], report["sections_enriched_unique_blocks"], report["enrichment_coverage"]) == (1, 1, 1.0)
    assert report["snapshots"]["2026-01-01"] == {"n_persons": 2, "population_count": 7, "n_remainder_lines": 1}
    got = spark.read.parquet(f"{tmp_path}/out/items.parquet").orderBy("item_index").collect()
    assert [(r.item_index, r.item_text, r.amount_nok, r.share_pct, r.model) for r in got] == [(1, "seat", 12, None, "m"), (2, None, None, 0.5, "m")]
    done = markdown.export(spark, root, f"{tmp_path}/md", str(cache))
    assert done == {"date": "2026-01-01", "files": 6, "sections": 2, "items": 2}
    assert "| Doe, Ann (X, Oslo) | §9 | Acme | 2022 |" in (tmp_path / "md" / "transactions.md").read_text()
    assert "Board seat<br>since 2020" in (tmp_path / "md" / "sections.md").read_text()


def test_empty_store(spark, tmp_path):
    for name in SCHEMAS:
        df = T.snapshots(spark, f"{tmp_path}/none", name)
        assert df.count() == 0 and df.schema == SCHEMAS[name] == empty(spark, name).schema
    assert T.cache_records(spark, f"{tmp_path}/none").count() == 0
    report = publish.build(spark, f"{tmp_path}/none", f"{tmp_path}/out", f"{tmp_path}/none")
    assert report["enrichment_coverage"] is None and report["date_range"] is None
    with pytest.raises(IndexError):
        markdown.export(spark, f"{tmp_path}/none", f"{tmp_path}/md", f"{tmp_path}/none")


def test_published_formats(spark, tmp_path):
    rows = [(1, 'a "b", c\nd', True, None), (2, "", False, 0.5), (3, None, None, 1.0)]
    df = spark.createDataFrame(rows, "i int, t string, f boolean, d double")
    sinks.publish(df, str(tmp_path), "x")
    text = "".join(gzip.open(p, "rt", encoding="utf-8", newline="").read() for p in sorted((tmp_path / "x.csv.gz").glob("*.gz")))
    got = [r for r in csv.reader(io.StringIO(text)) if r[0] != "i"]
    assert sorted(got) == [["1", 'a "b", c\nd', "True", ""], ["2", "", "False", "0.5"], ["3", "", "", "1.0"]]
    lines = [json.loads(x) for p in (tmp_path / "x.jsonl.gz").glob("*.gz") for x in gzip.open(p, "rt")]
    assert sorted(map(json.dumps, lines)) == sorted(json.dumps(dict(zip("itfd", r))) for r in rows)
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/x.parquet").collect())) == sorted(map(str, df.collect()))


def test_reference_pool(spark, tmp_path):
    def put(name, key, people):
        (tmp_path / name).write_text(json.dumps({"versjon": "1", key: people}))

    put("representanter_1.json", "representanter_liste", [{"id": "A", "etternavn": "Lie", "fornavn": "Kari", "foedselsdato": "/Date(-86400000+0100)/", "kjoenn": "k", "parti": {"id": "X"}, "fylke": {"navn": "Oslo"}}])
    put("representanter_2.json", "representanter_liste", [{"id": "A", "etternavn": "New", "fornavn": "Kari", "foedselsdato": None, "kjoenn": "k", "parti": {"id": "Y"}, "fylke": None}])
    put("regjering_1.json", "regjering_liste", [{"id": "B", "etternavn": "Moe", "fornavn": "Jon", "foedselsdato": None, "kjoenn": "m", "parti": {"id": "Z"}}, {"etternavn": "None"}])
    got = {r.api_person_id: r for r in T.reference_pool(spark, str(tmp_path)).collect()}
    a = got["A"]
    assert (a.etternavn, a.foedselsdato, a.partier, a.fylker, len(a.sources)) == ("Lie", "1969-12-31", ["x", "y"], ["oslo"], 2)
    assert got["B"].partier == [] and got[""].etternavn == "None"
    assert T.reference_pool(spark, f"{tmp_path}/none").count() == 0


def test_manifests(spark, tmp_path):
    assert T.form_manifest(spark, f"{tmp_path}/none.json").count() == 0
    rows = [{"generated": "2024-01-01", "wayback_ts": "1", "digest": d, "sha256": "s", "size_bytes": 1} for d in ("SHORT", "LONGERDIGEST")]
    (tmp_path / "m.json").write_text(json.dumps(rows))
    assert T.form_manifest(spark, f"{tmp_path}/m.json").count() == 2  # every entry
    (r,) = T.form_versions(T.form_manifest(spark, f"{tmp_path}/m.json")).collect()
    assert r.digest == "LONGERDIGEST"
    (tmp_path / "b.json").write_text(json.dumps([{"date": "2020-01-01", "sha256": "a" * 64, "origin": "wayback", "dataset": True}, {"date": "2020-01-01", "sha256": "x", "origin": "other", "dataset": False}]))
    assert T.backfill_manifest(spark, f"{tmp_path}/b.json").count() == 1
    c = incremental.manifest_checks(T.json_table(spark, f"{tmp_path}/b.json", T.BACKFILL)).first()
    assert tuple(c) == (2, 1, 1, 0, 1, 1)
    (tmp_path / "cdx.json").write_text(json.dumps([["timestamp", "digest"], ["3", "D1"], ["2", "D2"], ["1", "D1"]]))
    index = T.capture_index(spark, f"{tmp_path}/cdx.json")
    got = incremental.new_captures(index, spark.createDataFrame([("D2",)], "digest string")).collect()
    assert [(r.digest, r.timestamp) for r in got] == [("D1", "3")]
    assert cli.run(["smk-collect", f"{tmp_path}/m.json", f"{tmp_path}/cdx.json"], spark)[0]["digest"] in ("D1", "D2")


def test_archive_plan(spark, tmp_path):
    files = {"pr-a.pdf": b"%PDF a", "pr-b.pdf": b"%PDF b"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    sha = {n: hashlib.sha256(d).hexdigest() for n, d in files.items()}
    manifest = spark.createDataFrame([("2020-01-01", "u", "x/pr-a.pdf", sha["pr-a.pdf"], None), ("2020-01-02", "u", "x/pr-b.pdf", "other", None)], "date string, url string, pdf_path string, file_hash string, population_path string")
    scan = spark.read.format("binaryFile").load(str(tmp_path / "*.pdf"))
    assert scan.where(incremental.is_pdf()).count() == 2
    entries = archive.mirror_entries(manifest, scan)
    known = spark.createDataFrame([("2020-01-01", sha["pr-a.pdf"], None)], "date string, sha256 string, population_sha256 string")
    assets = spark.createDataFrame([("pr-2020-01-02.pdf", 1)], "name string, id long")
    docs, pops, rows = archive.plan(entries, known, assets)
    (r,) = rows.collect()
    assert r.pdf_asset == f"pr-2020-01-02-{sha['pr-b.pdf'][:8]}.pdf" and r.hash_mismatch and r.size_bytes == 6
    assert archive.stats(entries, known, docs, pops).first().asDict() == {"pdfs_uploaded": 1, "populations_uploaded": 0, "hash_mismatches": 1, "already_archived": 1}
    good = scan.withColumn("sha256", F.sha2("content", 256))
    assert incremental.verified(good).count() == 2
    with pytest.raises(Exception, match="sha256 mismatch"):
        incremental.verified(good.withColumn("sha256", F.lit("bad"))).select("sha256").collect()


def test_form_versions_upload_once(spark):
    m = spark.createDataFrame([("2024-01-01", "1", "s1" * 8), ("2024-01-01", "1", "s1" * 8), ("2024-02-01", "2", "s2" * 8), ("2024-03-01", "3", "s3" * 8)], "generated string, wayback_ts string, sha256 string")
    got = archive.form_versions(m, spark.createDataFrame([("s3" * 8,)], "sha256 string"), spark.createDataFrame([("smk-2024-02-01.pdf", 1)], "name string, id long"))
    assert sorted(r.asset for r in got.collect()) == ["smk-2024-01-01.pdf", "smk-2024-02-01-s2s2s2s2.pdf"]


def test_population_names(spark):
    e = spark.createDataFrame([("d1", "aaaaaaaa1"), ("d2", "bbbbbbbb2"), ("d3", "cccccccc3")], "date string, pop_sha string")
    known = spark.createDataFrame([("d2", "bbbbbbbb2")], "date string, population_sha256 string")
    assets = spark.createDataFrame([("population-d2.json", 1), ("population-d3.json", 2)], "name string, id long")
    got = {r.date: (r.population_asset, r.upload) for r in incremental.population_plan(e, known, assets).collect()}
    assert got == {"d1": ("population-d1.json", True), "d2": ("population-d2.json", False), "d3": ("population-d3-cccccccc.json", True)}


def test_enrich_loop(spark, tmp_path):
    """The extractor runs in a task, so it tells what it was asked through files."""
    blocks = spark.createDataFrame([(f"{i:02d}", i, "§", "l", "  " if i == 0 else f"t{i}") for i in range(8)] + [("03", 9, "§", "l", "t3")], "block_hash string, k int, paragraf string, label string, text string")
    cache, log, waits = f"{tmp_path}/c", tmp_path / "log", tmp_path / "waits"
    write_cache(spark, cache, [("07", [], "m", "v1")])

    def extract(batch):
        with open(log, "a") as f:
            f.write(" ".join(b["block_hash"] for b in batch) + "\n")
        n = len(log.read_text().splitlines())
        if n == 1:
            return enrich.Refusal(5)
        if n == 3:
            raise KeyError("choices")
        return {b["id"]: [{"item_text": b["text"], "amount_nok": 3}] for b in batch if b["id"] != 1}

    def sleep(s):
        with open(waits, "a") as f:
            f.write(f"{s}\n")

    def known():
        return {r.block_hash: len(r["items"]) for r in I.latest_records(T.cache_records(spark, cache)).collect()}

    pace = enrich.Pace(0.0, sleep)
    s = enrich.enrich(spark, blocks, cache, extract, "m", ("k",), max_requests=3, batch_size=2, pace=pace)
    assert s == {"cached": 2, "pending": 6, "requests": 3, "resolved": 2, "failed": 4, "stopped": None}
    assert log.read_text().splitlines() == ["01 02", "01 02", "03 04", "05 06"] and "6" in waits.read_text().split()[0]
    assert known() == {"00": 0, "01": 1, "05": 1, "07": 0}
    # what was answered is not asked again
    s = enrich.enrich(spark, blocks, cache, extract, "m", ("k",), max_requests=1, batch_size=2, pace=pace)
    assert s == {"cached": 4, "pending": 4, "requests": 1, "resolved": 1, "failed": 1, "stopped": "max_requests"}
    assert log.read_text().splitlines()[4:] == ["02 03"]

    def every(batch):
        with open(log, "a") as f:
            f.write("more\n")
        return {b["id"]: [] for b in batch}

    assert enrich.enrich(spark, blocks, cache, every, "m", ("k",), pace=pace)["resolved"] == 3
    before = log.read_text()
    s = enrich.enrich(spark, blocks, cache, every, "m", ("k",), pace=pace)
    assert s == {"cached": 8, "pending": 0, "requests": 0, "resolved": 0, "failed": 0, "stopped": None} and log.read_text() == before
    more = blocks.withColumn("block_hash", F.concat(F.lit("x"), "block_hash"))
    assert enrich.enrich(spark, more, cache, lambda batch: enrich.Refusal(1000), "m", ("k",), pace=pace)["stopped"] == "rate_limited"


def test_last_appended_record_wins(spark, tmp_path):
    from registra.sources import sinks

    cache = f"{tmp_path}/c"
    for k in range(3):
        rows = [(h, [], f"model {k}", "v1") for h in ("aa1", "ab2", f"ac{k}")]
        sinks.append_cache(spark.createDataFrame(rows, CACHE), cache)
    got = {r.block_hash: r.model for r in I.latest_records(T.cache_records(spark, cache)).collect()}
    assert got == {"aa1": "model 2", "ab2": "model 2", "ac0": "model 0", "ac1": "model 1", "ac2": "model 2"}


def test_coverage_counts_empty_items_as_known(spark):
    s = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", " "), ("a", "x"), ("d", "z")], "block_hash string, text string")
    c = spark.createDataFrame([("a",), ("b",), ("c",)], "block_hash string")
    assert tuple(I.coverage(s, c).first()) == (4, 3, 2, 0.75)
    assert I.coverage(s.limit(0), c).first().enrichment_coverage is None


def test_limiter_and_probe():
    lim = candidates.Limiter(18)
    for _ in range(5):
        lim.penalize()
    assert lim.rate == 4.0
    lim.rate = 23.99
    lim.reward()
    assert lim.rate == 24.0
    pauses, saved, hits = [], [], []
    got = candidates.probe(["a", "b", "c", "d"], {"a": 0, "b": 200, "c": 404, "d": 403}.get, hits.append, start=1, save=saved.append, max_blocks=1, sleep=pauses.append)
    assert got == {"index": 3, "hits": 1, "aborted": True} and hits == ["b"] and saved == [3]


def test_http_retries():
    left = [OSError("x"), OSError("y"), b"ok"]

    def opener():
        v = left.pop(0)
        if isinstance(v, OSError):
            raise v
        return v

    pauses = []
    assert http.get("u", 1, 3, 20, opener, pauses.append) == b"ok" and pauses == [20, 20]
    left[:] = [OSError("x")]
    with pytest.raises(OSError):
        http.get("u", 1, 1, 20, opener, pauses.append)
    assert http.HttpBlobs({"urls": "a b"}).reader(None).partitions()[1].value == "b"


def test_pdf_source_takes_a_decoder(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF one two")

    def decoder(content):
        for k, t in enumerate(content.decode().split()[1:]):
            yield {"page": 0, "page_height": 800.0, "text": t, "x0": float(k), "x1": k + 1.0, "top": 0.0, "fontname": "S", "size": 11.0}

    got = T.pdf_words(spark, str(tmp_path / "*.pdf"), decoder).orderBy("x0").collect()
    assert [r.text for r in got] == ["one", "two"] and got[0].doc_id.endswith("a.pdf")


def test_local_or_remote(spark):
    e = spark.createDataFrame([("d1", "http://1"), ("d2", "http://2")], "date string, url string")
    listing = spark.createDataFrame([("file:/x/pr-d1.pdf",)], "path string")
    got = T.local_or_remote(e, listing, F.concat(F.lit("pr-"), "date", F.lit(".pdf"))).collect()
    assert {r.date: r.location for r in got} == {"d1": "file:/x/pr-d1.pdf", "d2": "http://2"}


def test_cli_build_and_export(spark, store, tmp_path):
    root, _, _ = store
    assert cli.run(["build", root, f"{tmp_path}/o", "--cache", f"{tmp_path}/none", "--smk-store", f"{tmp_path}/none"], spark)["rows"]["persons"] == 2
    assert cli.run(["export-md", root, f"{tmp_path}/m", "--cache", f"{tmp_path}/none"], spark)["files"] == 6
