"""Sources: manifests, snapshot stores, the item cache, the person pool, captures, words and blobs.

Everything that a cluster reads goes through Spark's readers; adapters that fetch over a network are
Python data sources or functions given by the caller, and never run in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import scalars as S
from ..schemas import CACHE, SCHEMAS, WORDS, empty

SMK_MANIFEST = "generated string, wayback_ts string, digest string, sha256 string, size_bytes bigint"
BACKFILL = "date string, url string, sha256 string, origin string, dataset boolean, alternate_of string, ajourfort string"
META = "date string, file_hash string, parser_version string, n_persons int, population_count int, n_remainder_lines int, origin string, ajourfort string, url string, n_pages int"


def exists(spark: SparkSession, path: str) -> bool:
    """Does any path match, on whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def mirror_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries that succeeded, by date."""
    return spark.read.parquet(path).where("status = 'success'").orderBy(F.col("date").cast("string"))


def json_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A JSON array as a table; an absent file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("multiLine", True).json(path)


def backfill_manifest(spark: SparkSession, path: str) -> DataFrame:
    return json_table(spark, path, BACKFILL).where("dataset")


def form_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the form register's manifest, as they stand in it; an absent file gives none."""
    return json_table(spark, path, SMK_MANIFEST).orderBy("generated", "wayback_ts")


def form_versions(manifest: DataFrame) -> DataFrame:
    """One entry per version (generated, wayback_ts): the one with the longest digest."""
    best = F.max_by(F.struct("digest", "sha256", "size_bytes"), F.length("digest"))
    return manifest.groupBy("generated", "wayback_ts").agg(best.alias("r")).select("generated", "wayback_ts", "r.*")


def commits(spark: SparkSession, store: str) -> DataFrame:
    """The commit in force of every snapshot: snapshot, version, generation and the columns of META.

    A commit is a row of the store's marker table; of a snapshot the one of the last generation counts.
    Snapshots of the layout with a folder a date (``<date>/meta.json``) have generation 0 and no version."""
    ddl = f"snapshot string, version string, generation bigint, {META}"
    rows = spark.read.schema(ddl).parquet(f"{store}/commits") if listed(spark, f"{store}/commits/*.parquet") else spark.createDataFrame([], ddl)
    if exists(spark, f"{store}/*/meta.json"):
        old = spark.read.schema(META).option("multiLine", True).json(f"{store}/*/meta.json")
        folder = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/meta\\.json$", 1)
        rows = rows.unionByName(old.select(folder.alias("snapshot"), F.lit(None).cast("string").alias("version"), F.lit(0).cast("bigint").alias("generation"), *old.columns))
    rest = [c for c in rows.columns if c not in ("snapshot", "generation")]
    last = rows.groupBy("snapshot").agg(F.max_by(F.struct("generation", *rest), F.struct("generation", "version")).alias("r"))
    return last.select("snapshot", "r.*")


def snapshots(spark: SparkSession, store: str, name: str, columns: list[str] | None = None, date: str | None = None) -> DataFrame:
    """One table of all committed snapshots, or of one; none gives a typed empty table.

    The store keeps a table for all dates in ``<name>/version=<v>/snapshot=<date>``; rows count where the
    commit in force names their version. Both are partition columns, so the join with the few commits
    prunes what is read. The layout with a folder a date is read as well."""
    c = commits(spark, store)
    c = c.where(F.col("snapshot") == date) if date else c
    df = empty(spark, name)
    if exists(spark, f"{store}/{name}/version=*"):
        schema = StructType([*SCHEMAS[name], StructField("version", StringType()), StructField("snapshot", StringType())])
        new = spark.read.schema(schema).parquet(f"{store}/{name}")
        new = new.where(F.col("snapshot") == date) if date else new
        df = new.join(c.select("snapshot", "version"), ["snapshot", "version"], "left_semi").select(*SCHEMAS[name].names)
    if exists(spark, f"{store}/{date or '*'}/{name}.parquet"):
        old = spark.read.schema(SCHEMAS[name]).parquet(f"{store}/{date or '*'}/{name}.parquet")
        old = old.withColumn("snapshot", F.regexp_extract(F.col("_metadata.file_path"), f"/([^/]+)/{name}\\.parquet", 1))
        old = old.join(c.where("generation = 0").select("snapshot"), "snapshot", "left_semi").select(*SCHEMAS[name].names)
        df = df.unionByName(old)
    return df.select(*columns) if columns else df


def snapshot_meta(spark: SparkSession, store: str) -> DataFrame:
    return commits(spark, store).drop("version", "generation", "snapshot")


def latest(df: DataFrame, by: str = "date") -> DataFrame:
    """Rows of the greatest date: a scalar subquery, so a store partitioned by date is pruned."""
    top = df.agg(F.max(by).alias("_top"))
    return df.join(F.broadcast(top), F.col(by) == F.col("_top"), "left_semi")  # one row


def listed(spark: SparkSession, glob: str) -> list[str]:
    """Paths that match, on whatever file system the glob names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return [f.getPath().toString() for f in found or ()]


def last_run(spark: SparkSession, cache: str) -> int:
    """Number of the cache's last run, also where it was compacted and removed."""
    runs = [int(p.rpartition("=")[2]) for p in listed(spark, f"{cache}/run=*")]
    return max([*runs, (generation(spark, cache) or {"last_run": 0})["last_run"]])


def generation(spark: SparkSession, cache: str) -> dict | None:
    """The last generation that was committed: generation, last_run, buckets, folder."""
    markers = sorted(listed(spark, f"{cache}/compact/generation=*.json"))
    ddl = "generation int, last_run bigint, buckets int, folder string"
    return spark.read.schema(ddl).option("multiLine", True).json(markers[-1]).first().asDict() if markers else None


def _compacted(spark: SparkSession, cache: str, g: dict) -> DataFrame:
    """The generation as a bucketed table of the session, so that joins on the hash do not shuffle it."""
    import hashlib

    path = f"{cache}/compact/{g['folder']}"
    name = f"cache_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CACHE)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY (block_hash) SORTED BY (block_hash) INTO {g['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def cache_records(spark: SparkSession, cache: str, after: int = 0, shards: bool = True) -> DataFrame:
    """Records of the JSON Lines cache with file and line, blank lines skipped; absent gives none.

    Both layouts are read: ``<shard>.jsonl``, and what ``sinks.append_cache`` writes in runs numbered over
    ``after``. ``file`` orders them as they were written: shards first, then runs by number. Files may be
    split: ``line`` is the block's start in the file and a number that rises inside the block, which one
    task reads from front to back."""
    ddl = "block_hash string, items " + CACHE["items"].dataType.simpleString() + ", model string, prompt_version string, file string, line struct<block:bigint,place:bigint>"
    paths = [p for p in listed(spark, f"{cache}/run=*") if int(p.rpartition("=")[2]) > after]
    paths += [f"{cache}/*.jsonl"] if shards and exists(spark, f"{cache}/*.jsonl") else []
    if not paths:
        return spark.createDataFrame([], ddl)
    name = F.concat(F.regexp_extract(F.col("_metadata.file_path"), "/(run=[^/]+/)[^/]+$", 1), F.col("_metadata.file_name"))
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    rows = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.json*").text(paths).select("value", name.alias("file"), line.alias("line"))
    rec = rows.where(S.non_empty("value")).select(F.from_json("value", CACHE).alias("r"), "file", "line")
    return rec.select("r.*", "file", "line")


def cache_latest(spark: SparkSession, cache: str, shards: bool = True) -> DataFrame:
    """One record per block hash, the last: shard files come first, then the compacted runs, then the runs
    since. The compacted table is neither aggregated nor shuffled."""
    from ..operators.items import latest_records

    g = generation(spark, cache)
    if not g:
        return latest_records(cache_records(spark, cache, shards=shards))
    out = _compacted(spark, cache, g)
    if any(int(p.rpartition("=")[2]) > g["last_run"] for p in listed(spark, f"{cache}/run=*")):
        late = latest_records(cache_records(spark, cache, g["last_run"], shards=False))
        out = out.join(late.select("block_hash"), "block_hash", "left_anti").unionByName(late)
    if shards and exists(spark, f"{cache}/*.jsonl"):
        early = latest_records(cache_records(spark, cache, 1 << 62))
        out = out.unionByName(early.join(out.select("block_hash"), "block_hash", "left_anti"))
    return out


def reference_pool(spark: SparkSession, directory: str) -> DataFrame:
    """The person pool: of each id the first record gives the scalars, all records add to the sets.

    Member lists come first, then government lists, each by file name; the latter add no party or region."""
    person = "id string, etternavn string, fornavn string, foedselsdato string, kjoenn string, parti struct<id:string>, fylke struct<navn:string>"
    out = None
    for kind, pattern, member in (("0", "representanter_*.json", True), ("1", "regjering_*.json", False)):
        path = f"{directory}/{pattern}"
        if not exists(spark, path):
            continue
        raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
        keys = F.filter(F.json_object_keys("value"), lambda k: F.endswith(k, F.lit("_liste")))
        lists = raw.select("file", F.element_at(F.from_json("value", "map<string,string>"), F.get(keys, F.lit(0))).alias("list"))
        rows = lists.select("file", F.posexplode(F.from_json("list", f"array<struct<{person.replace(' string', ':string').replace(' struct', ':struct')}>>")).alias("k", "p"))
        rows = rows.select(
            F.concat_ws("/", F.lit(kind), "file", F.lpad(F.col("k").cast("string"), 9, "0")).alias("ord"), "file", F.coalesce("p.id", F.lit("")).alias("api_person_id"), F.col("p.etternavn"), F.col("p.fornavn"), S.dotnet_date("p.foedselsdato").alias("foedselsdato"), F.col("p.kjoenn"),
            (F.col("p.parti.id") if member else F.lit(None).cast("string")).alias("parti"), (F.col("p.fylke.navn") if member else F.lit(None).cast("string")).alias("fylke"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], "ord string, api_person_id string, etternavn string, fornavn string, foedselsdato string, kjoenn string, partier array<string>, fylker array<string>, sources array<string>")
    return merge_pool(out)


def merge_pool(rows: DataFrame, nfc: bool = False) -> DataFrame:
    """One row per id from rows with ord, file, api_person_id, names, foedselsdato, kjoenn, parti, fylke."""
    def named(c):
        return F.when(F.coalesce(F.col(c) != "", F.lit(False)), S.norm(c, nfc))

    x = rows.withColumn("_p", named("parti")).withColumn("_f", named("fylke"))
    x = x.groupBy("api_person_id").agg(
        F.min("ord").alias("ord"), F.min_by(F.struct("etternavn", "fornavn", "foedselsdato", "kjoenn"), "ord").alias("r"),
        F.array_sort(F.collect_set("_p")).alias("partier"), F.array_sort(F.collect_set("_f")).alias("fylker"), F.array_sort(F.collect_set("file")).alias("sources"))
    return x.select("ord", "api_person_id", "r.*", "partier", "fylker", "sources")


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows (ord, timestamp, digest) of a capture listing, a JSON array of arrays under a header row."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<array<string>>").alias("a"))
    return raw.select(F.posexplode(F.slice("a", 2, F.greatest(F.size("a") - 1, F.lit(0)))).alias("ord", "r")).select("ord", F.get("r", F.lit(0)).alias("timestamp"), F.get("r", F.lit(1)).alias("digest"))


def asset_listing(spark: SparkSession, pages: str) -> DataFrame:
    """(name, id) of release assets from saved listing pages (JSON arrays)."""
    return spark.read.schema("name string, id bigint").option("multiLine", True).json(pages)


def archive_manifest(spark: SparkSession, path: str) -> DataFrame:
    return json_table(spark, path, "date string, source_url string, sha256 string, mirror_manifest_sha256 string, hash_mismatch boolean, size_bytes bigint, pdf_asset string, population_sha256 string, population_asset string")


def words(spark: SparkSession, path: str) -> DataFrame:
    """The positioned words that a decoder wrote."""
    return spark.read.schema(WORDS).parquet(path)


def pdf_words(spark: SparkSession, paths: str, decoder=None) -> DataFrame:
    """Words of PDF files, one file per row of a binary scan. ``decoder(bytes)`` yields dicts of the
    words relation without doc_id; the default needs pdfplumber on the executors."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def run(batches):
        import pandas as pd

        decode = decoder or _pdfplumber_words
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                rows = [{"doc_id": path, **w} for w in decode(content)]
                yield pd.DataFrame(rows, columns=WORDS.names)

    return files.mapInPandas(run, WORDS)


def _pdfplumber_words(content: bytes):
    import io

    import pdfplumber  # not a dependency; only where PDFs are decoded

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for k, page in enumerate(pdf.pages):
            for w in page.extract_words(extra_attrs=["fontname", "size"]):
                yield {"page": k, "page_height": float(page.height), "text": w["text"], "x0": float(w["x0"]), "x1": float(w["x1"]), "top": float(w["top"]), "fontname": w["fontname"], "size": float(w["size"])}


def local_or_remote(entries: DataFrame, listing: DataFrame, local_name) -> DataFrame:
    """Where to read each entry from: the local file if the listing has it, else its address."""
    have = listing.select(F.col("path").alias("_path"), S.basename("path").alias("_name"))
    return entries.withColumn("_name", local_name).join(have, "_name", "left").withColumn("location", F.coalesce("_path", "url")).drop("_path", "_name")
