"""Registered queries of the register engine: a Spark callable and, where SQL can say it, its SQL.

The register's own inputs are not among the driver's tables, so each query applies an operator to the
driver table whose shape it needs; registers of words, persons and sections are derived from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import form_layout, incremental, lines, register_layout
from .operators import items as I
from .operators.resolve import name_changes, resolve
from .plans import candidates, intake, markdown
from .schemas import CACHE, conform
from .session import shared_folder
from .sources import sinks
from .sources import tables as T


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = Query(f, sql)
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------------------------------------
# scalars


@query("SELECT conv_id, turn, sha256(role || chr(10) || role || chr(10) || text) AS block_hash FROM conversations")
def block_hash(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", S.block_hash("role", "role", "text").alias("block_hash"))


_HEADERS = """WITH h AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name || ', X (' || c_mktsegment || ', ' || n_name || ')' WHEN 1 THEN c_name || ' (' || c_mktsegment || ')'
 WHEN 2 THEN c_name WHEN 3 THEN c_name || ', (7, ' || c_mktsegment || ', ' || n_name || ', x)' ELSE c_name || ' ()' END AS header FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT *, contains(header, '(') AS b, rtrim(trim(string_split(header, '(')[1]), ',') AS before, regexp_extract(header, '^[^(]*\\((.*)\\)', 1) AS inside FROM h),
q AS (SELECT *, list_transform(string_split(inside, ','), lambda x: trim(x)) AS parts FROM p)
"""


@query(_HEADERS.replace("\\\\", "\\") + """SELECT c_custkey, CASE WHEN b THEN before ELSE trim(header) END AS name,
 CASE WHEN NOT b THEN NULL WHEN len(parts) >= 3 AND regexp_full_match(parts[1], '[0-9]+') THEN parts[2] WHEN contains(inside, ',') THEN parts[1] ELSE nullif(trim(inside), '') END AS party,
 CASE WHEN NOT b THEN NULL WHEN len(parts) >= 3 AND regexp_full_match(parts[1], '[0-9]+') THEN array_to_string(parts[3:], ', ') WHEN contains(inside, ',') THEN array_to_string(parts[2:], ', ') END AS constituency FROM q""")
def header_carve(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k, name, seg, n = F.col("c_custkey") % 5, F.col("c_name"), F.col("c_mktsegment"), F.col("n_name")
    header = (
        F.when(k == 0, F.concat(name, F.lit(", X ("), seg, F.lit(", "), n, F.lit(")"))).when(k == 1, F.concat(name, F.lit(" ("), seg, F.lit(")"))).when(k == 2, name)
        .when(k == 3, F.concat(name, F.lit(", (7, "), seg, F.lit(", "), n, F.lit(", x)"))).otherwise(F.concat(name, F.lit(" ()")))
    )
    return c.select("c_custkey", S.header_carve(header).alias("h")).select("c_custkey", "h.name", "h.party", "h.constituency")


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN replace(printf('%.2f', l_extendedprice), '.', ',') WHEN 2 THEN printf('-%d 000,75', l_quantity::BIGINT) WHEN 3 THEN 'abc' WHEN 4 THEN '' WHEN 5 THEN '12d' ELSE printf('%d', l_partkey) END AS raw FROM lineitem),
d AS (SELECT *, try_cast(replace(replace(raw, ' ', ''), ',', '.') AS DOUBLE) AS v FROM t)
SELECT l_orderkey, l_linenumber, v AS as_double, trunc(v)::BIGINT AS as_long, nullif(trim(raw), '') AS as_text FROM d""")
def coerce_numbers(spark, sf):
    l, n = table(spark, sf, "lineitem"), F.col("l_linenumber")
    raw = (
        F.when(n == 1, F.replace(F.format_string("%.2f", "l_extendedprice"), F.lit("."), F.lit(","))).when(n == 2, F.format_string("-%d 000,75", F.col("l_quantity").cast("bigint")))
        .when(n == 3, "abc").when(n == 4, "").when(n == 5, "12d").otherwise(F.col("l_partkey").cast("string"))
    )
    return l.select("l_orderkey", "l_linenumber", raw.alias("raw")).select("l_orderkey", "l_linenumber", S.to_double("raw").alias("as_double"), S.to_long("raw").alias("as_long"), S.to_text("raw").alias("as_text"))


@query("""SELECT doc_id, replace(lower(nfc_normalize(trim(regexp_replace(text, '\\s+', ' ', 'g')))), 'ß', 'ss') AS norm,
 array_to_string(list_sort(list_distinct(list_filter(string_split(replace(replace(replace(lower(nfc_normalize(trim(regexp_replace(text, '\\s+', ' ', 'g')))), 'ß', 'ss'), ',', ' '), '-', ' '), ' '), lambda x: x <> ''))), ' ') AS token_set FROM documents""".replace("\\\\", "\\"))
def norm_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.norm("text").alias("norm"), S.token_set_key(S.tokens("text")).alias("token_set"))


@query("""SELECT o_orderkey, strftime(make_timestamp(epoch_ms(o_orderdate) * 1000 - 946684800000000), '%Y-%m-%d') AS day FROM orders""")
def dotnet_dates(spark, sf):
    """Dates on both sides of the epoch, written as the pool's files do."""
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")) - F.lit(946_684_800_000)
    return table(spark, sf, "orders").select("o_orderkey", S.dotnet_date(F.concat(F.lit("/Date("), ms.cast("string"), F.lit("+0100)/"))).alias("day"))


@query("""SELECT doc_id, replace(replace(text, '|', '\\|'), chr(10), '<br>') AS cell, regexp_replace(text, '\\s', '', 'g') <> '' AS full_text, substr(sha256(text), 1, 2) AS shard FROM documents""".replace("\\\\", "\\"))
def escape_and_shard(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.md_escape("text").alias("cell"), S.non_empty("text").alias("full_text"), S.shard(F.sha2(F.col("text").cast("binary"), 256)).alias("shard"))


@query("""SELECT p_partkey, CASE WHEN tok LIKE '§%' OR regexp_full_match(tok, '[0-9]{1,2}\\.') THEN true ELSE false END AS is_marker, CASE WHEN tok = '§' THEN '§' || p_brand ELSE tok END AS marker,
 'web.archive.org/web/' || p_partkey || 'id_/' || p_type AS capture, string_split('/a/' || p_brand || '/' || p_name, '/')[-1] AS base
 FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN '§' WHEN 1 THEN '§' || p_size WHEN 2 THEN p_size || '.' ELSE p_name END AS tok FROM part)""".replace("\\\\", "\\"))
def markers_and_names(spark, sf):
    k = F.col("p_partkey") % 4
    tok = F.when(k == 0, "§").when(k == 1, F.concat(F.lit("§"), "p_size")).when(k == 2, F.concat("p_size", F.lit("."))).otherwise(F.col("p_name"))
    p = table(spark, sf, "part").withColumn("tok", tok)
    capture = F.regexp_replace(S.capture_url(F.col("p_partkey").cast("string"), ""), "^https://", "")
    return p.select("p_partkey", S.is_marker("tok").alias("is_marker"), S.consume_marker(F.array("tok", "p_brand"))["marker"].alias("marker"), F.concat(capture, "p_type").alias("capture"), S.basename(F.concat(F.lit("/a/"), "p_brand", F.lit("/"), "p_name")).alias("base"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS generated, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS parti, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS fylke FROM orders""")
def form_stamps(spark, sf):
    o = table(spark, sf, "orders")
    text = F.concat(F.lit("Register\nGENERERT  "), F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(" 10:00"))
    aff = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("("), "o_orderstatus", F.lit(", "), "o_orderpriority", F.lit(")"))).otherwise(F.concat(F.lit("( "), "o_orderpriority", F.lit(" )")))
    a = S.affiliation(aff)
    return o.select("o_orderkey", S.generated_date(text).alias("generated"), a["parti"].alias("parti"), a["fylke"].alias("fylke"))


# ---------------------------------------------------------------------------------------------
# memo layer


def blocks(spark, sf) -> DataFrame:
    """Documents as sections, hashed by language and text."""
    d = table(spark, sf, "documents")
    return d.select(F.lit("2026-01-01").alias("date"), F.col("doc_id").cast("int").alias("person_index"), "doc_id", F.col("source").alias("person_header"), F.col("source").alias("section_heading"), F.lit("§1").alias("paragraf"), F.col("lang").alias("label"), "lang", "text", S.block_hash("lang", "source", "text").alias("block_hash"))


def memo(spark, sf) -> DataFrame:
    """Labelled blocks as the cache: items are the text's lines; quality 0 has none."""
    b = blocks(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    item = "struct<item_text: string, organisation: string, role: string, remuneration: string, amount_nok: string, share_count: string, share_pct: string, org_number: string, date_from: string, date_to: string, country: string>"
    entries = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("item_text"), F.lit(None).cast("string"), F.lit("r").alias("role"), F.lit(None).cast("string"), F.length(x).cast("string"), F.lit("12,9"), F.lit("0,5"), F.lit(None).cast("string"), F.lit("2020"), F.lit(""), F.lit(None).cast("string")).cast(item))
    x = b.select("block_hash", F.when(F.col("quality") == 1, entries).otherwise(F.array().cast(f"array<{item}>")).alias("items"), F.lit("m").alias("model"), F.lit("v1").alias("prompt_version"), F.lit("f").alias("file"), F.col("doc_id").cast("int").alias("line"))
    return I.latest_records(x)


_MEMO = """WITH b AS (SELECT *, sha256(lang || chr(10) || source || chr(10) || text) AS block_hash FROM documents),
m AS (SELECT block_hash, arg_max(quality, doc_id) AS quality FROM b JOIN labels USING (doc_id) GROUP BY 1)
"""


@query(_MEMO + """SELECT lang, count(*) AS sections_nonempty, count(*) FILTER (m.block_hash IS NOT NULL) AS sections_covered, count(DISTINCT m.block_hash) AS sections_enriched_unique_blocks,
 round(count(*) FILTER (m.block_hash IS NOT NULL) / count(*), 4) AS enrichment_coverage FROM b LEFT JOIN m USING (block_hash) WHERE regexp_replace(text, '\\s', '', 'g') <> '' GROUP BY lang""".replace("\\\\", "\\"))
def coverage_qa(spark, sf):
    return I.coverage(blocks(spark, sf), memo(spark, sf), ("lang",))


@query(_MEMO + """SELECT doc_id, k AS item_index, nullif(trim(item), '') AS item_text, length(item)::BIGINT AS amount_nok, 12::BIGINT AS share_count, 0.5::DOUBLE AS share_pct, '2020' AS date_from FROM
 (SELECT doc_id, unnest(string_split(text, chr(10))) AS item, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM b JOIN m USING (block_hash) WHERE quality = 1)""")
def memo_items_explode(spark, sf):
    i = I.build_items(blocks(spark, sf), memo(spark, sf))
    return i.select(F.col("person_index").cast("bigint").alias("doc_id"), "item_index", "item_text", "amount_nok", "share_count", "share_pct", "date_from")


@query("""SELECT doc_id, block_hash FROM (SELECT doc_id, sha256(lang || chr(10) || source || chr(10) || text) AS block_hash, row_number() OVER (PARTITION BY sha256(lang || chr(10) || source || chr(10) || text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def distinct_blocks(spark, sf):
    return I.distinct_blocks(blocks(spark, sf).select("doc_id", "block_hash"), ("doc_id",)).select("doc_id", "block_hash")


@query(_MEMO + """SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 6)::INT AS batch_id FROM b ANTI JOIN m USING (block_hash) ORDER BY doc_id LIMIT 720""")
def budget_batches(spark, sf):
    todo = I.pending(blocks(spark, sf).select("doc_id", "block_hash", "text"), memo(spark, sf))
    return I.batches(todo, ("doc_id",), 6, 120).select("doc_id", "batch_id")


@query("""SELECT doc_id % 50 AS block, max_by(text, doc_id) AS text, max(doc_id) AS line FROM documents GROUP BY 1""")
def latest_record_wins(spark, sf):
    d = table(spark, sf, "documents").select((F.col("doc_id") % 50).cast("string").alias("block_hash"), F.col("text").alias("items"), F.lit("m").alias("model"), F.lit("v").alias("prompt_version"), F.lit("f").alias("file"), F.col("doc_id").alias("line"))
    n = d.groupBy("block_hash").agg(F.max("line").alias("line"))
    return I.latest_records(d).join(n, "block_hash").select(F.col("block_hash").cast("bigint").alias("block"), F.col("items").alias("text"), "line")


# ---------------------------------------------------------------------------------------------
# keyed skips and archive planning


_HASH = "sha256(o_orderkey::VARCHAR)"


@query(f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey, {_HASH} AS file_hash FROM orders WHERE NOT (o_orderkey % 3 = 0) OR o_orderkey % 7 = 0""")
def incremental_anti(spark, sf):
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderkey", F.sha2(F.col("o_orderkey").cast("string"), 256).alias("file_hash"))
    stored = o.where("o_orderkey % 3 = 0").withColumn("parser_version", F.when(F.col("o_orderkey") % 7 == 0, "0.9").otherwise("1.2.0"))
    return incremental.changed_snapshots(o, stored, "1.2.0").select("date", "o_orderkey", "file_hash")


_TAKEN = "SELECT DISTINCT CASE k % 3 WHEN 0 THEN 'pr-' || date || '.pdf' ELSE 'pr-' || date || '-' || substr(sha256, 1, 8) || '.pdf' END AS name FROM e WHERE k % 11 < 3"


@query(f"""WITH e AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS date, sha256((o_orderkey // 2)::VARCHAR) AS sha256 FROM orders), taken AS ({_TAKEN}),
known AS (SELECT DISTINCT date, sha256 FROM e WHERE k % 13 = 0), n AS (SELECT date, sha256, min(k) AS k FROM e ANTI JOIN known USING (date, sha256) GROUP BY 1, 2),
x AS (SELECT *, 'pr-' || date || '.pdf' AS plain, 'pr-' || date || '-' || substr(sha256, 1, 8) || '.pdf' AS hashed, row_number() OVER (PARTITION BY date ORDER BY k, sha256) AS nth FROM n),
y AS (SELECT *, nth = 1 AND plain NOT IN (SELECT name FROM taken) AS use_plain FROM x), z AS (SELECT *, row_number() OVER (PARTITION BY date, hashed, use_plain ORDER BY k, sha256) AS same FROM y)
SELECT date, sha256, CASE WHEN use_plain THEN plain ELSE hashed END AS pdf_asset, use_plain OR (same = 1 AND hashed NOT IN (SELECT name FROM taken)) AS upload FROM z""")
def collision_names(spark, sf):
    e = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.sha2(F.expr("cast(o_orderkey div 2 as string)"), 256).alias("sha256"))
    plain = F.concat(F.lit("pr-"), "date", F.lit(".pdf"))
    hashed = F.concat(F.lit("pr-"), "date", F.lit("-"), F.substring("sha256", 1, 8), F.lit(".pdf"))
    taken = e.where("k % 11 < 3").select(F.when(F.col("k") % 3 == 0, plain).otherwise(hashed).alias("name"))
    return incremental.archive_plan(e.withColumnRenamed("k", "ord"), e.where("k % 13 = 0").select("date", "sha256").distinct(), taken).select("date", "sha256", "pdf_asset", "upload")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN true ELSE false END AS hash_mismatch, sha256(o_orderpriority) AS local_sha FROM orders""")
def archive_flags(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").cast("binary").alias("content"), F.when(F.col("o_orderkey") % 5 == 0, "0").otherwise(F.sha2(F.col("o_orderpriority").cast("binary"), 256)).alias("file_hash"))
    return incremental.hash_mismatch(o).select("o_orderkey", "hash_mismatch", "local_sha")


@query("""WITH c AS (SELECT md5(o_custkey::VARCHAR) AS digest, o_orderkey, strftime(o_orderdate, '%Y%m%d') AS timestamp FROM orders), f AS (SELECT digest, arg_min(timestamp, o_orderkey) AS timestamp FROM c GROUP BY 1)
SELECT digest, timestamp FROM f WHERE digest NOT IN (SELECT md5(c_custkey::VARCHAR) FROM customer WHERE c_custkey % 4 = 0)""")
def digest_anti(spark, sf):
    index = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ord"), F.date_format("o_orderdate", "yyyyMMdd").alias("timestamp"), F.md5(F.col("o_custkey").cast("string")).alias("digest"))
    known = table(spark, sf, "customer").where("c_custkey % 4 = 0").select(F.md5(F.col("c_custkey").cast("string")).alias("digest"))
    return incremental.new_captures(index, known).select("digest", "timestamp")


@query("""SELECT count(*) AS entries, count(*) FILTER (o_orderkey % 2 = 0) AS in_dataset, count(*) FILTER (o_orderkey % 9 = 0) AS bad_sha256, 0::BIGINT AS bad_date, count(*) FILTER (o_orderkey % 10 = 0) AS bad_origin, count(*) - count(DISTINCT strftime(o_orderdate, '%Y-%m-%d')) AS repeated_dates FROM orders""")
def manifest_checks(spark, sf):
    k = F.col("o_orderkey")
    sha = F.sha2(k.cast("string"), 256)
    m = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.when(k % 9 == 0, F.upper(F.concat(F.lit("x"), sha))).otherwise(sha).alias("sha256"), F.when(k % 10 != 0, F.when(k % 2 == 0, "wayback").otherwise("live-arkiv")).alias("origin"), (k % 2 == 0).alias("dataset"))
    return incremental.manifest_checks(m)


@query("""SELECT event_id, user_id, event_type FROM events WHERE ts::DATE = (SELECT max(ts::DATE) FROM events)""")
def latest_snapshot(spark, sf):
    e = table(spark, sf, "events").withColumn("date", F.to_date("ts"))
    return T.latest(e).select("event_id", "user_id", "event_type")


# ---------------------------------------------------------------------------------------------
# aggregates and sets


@query("""WITH r AS (SELECT user_id::VARCHAR AS pid, event_type AS name, strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_id % 2 = 0 THEN 'exact' ELSE 'token_set' END AS m, event_id FROM events),
b AS (SELECT pid, arg_max(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE 'y' END, (date, event_id)) AS dob FROM r GROUP BY 1 HAVING count(DISTINCT name) >= 2)
SELECT pid AS api_person_id, dob AS foedselsdato, name AS printed_name, min(date) AS first_date, max(date) AS last_date, count(*)::INT AS n_snapshots, string_agg(DISTINCT m, ',' ORDER BY m) AS match_methods FROM r JOIN b USING (pid) GROUP BY 1, 2, 3""")
def name_intervals(spark, sf):
    e = table(spark, sf, "events")
    r = e.select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_id").cast("int").alias("person_index"), F.col("user_id").cast("string").alias("api_person_id"), F.col("event_type").alias("name"), F.when(F.col("event_id") % 3 == 0, "x").otherwise("y").alias("foedselsdato"), F.when(F.col("event_id") % 2 == 0, "exact").otherwise("token_set").alias("match_method"))
    return name_changes(r)


@query("""SELECT c_custkey % 100 AS pid, arg_min(c_name, c_custkey) AS first_name, array_to_string(list_sort(list_distinct(list(lower(c_mktsegment)))), ',') AS partier, array_to_string(list_sort(list_distinct(list(lower(n_name)))), ',') AS fylker FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def pool_sets(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.select(F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("ord"), F.lit("f").alias("file"), (F.col("c_custkey") % 100).cast("string").alias("api_person_id"), F.col("c_name").alias("etternavn"), F.lit("").alias("fornavn"), F.lit("").alias("foedselsdato"), F.lit("").alias("kjoenn"), F.col("c_mktsegment").alias("parti"), F.col("n_name").alias("fylke"))
    return T.merge_pool(rows, nfc=True).select(F.col("api_person_id").cast("bigint").alias("pid"), F.col("etternavn").alias("first_name"), F.array_join("partier", ",").alias("partier"), F.array_join("fylker", ",").alias("fylker"))


@query("""SELECT l_suppkey::VARCHAR AS doc_id, q - 6.0 AS split FROM (SELECT l_suppkey, q, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, f) AS rn FROM (SELECT l_suppkey, round(l_quantity, 1) AS q, count(*) AS n, min((l_orderkey::INT, l_linenumber)) AS f FROM lineitem GROUP BY 1, 2)) WHERE rn = 1""")
def mode_split(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("doc_id"), F.col("l_quantity").alias("x0"), F.struct(F.col("l_orderkey").cast("int").alias("page"), F.col("l_linenumber").alias("line_no"), F.lit(0).alias("k")).alias("pos"))
    return lines.modal_start(l, 6.0, 205.0, l)


@query("""SELECT lang, n_snapshots, first_date, last_date FROM (SELECT lang, count(*) AS n_snapshots, min(source) AS first_date, max(source) AS last_date FROM documents GROUP BY 1)""")
def snapshot_ranges(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n_snapshots"), F.min("source").alias("first_date"), F.max("source").alias("last_date"))


@query("SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region")
def table_row_counts(spark, sf):
    from .plans.publish import row_counts

    return row_counts({n: table(spark, sf, n) for n in ("customer", "nation", "orders", "region")})


@query("""SELECT key, min(c_custkey) AS first_row FROM (SELECT c_mktsegment AS key, c_custkey FROM customer UNION ALL SELECT 'nation ' || c_nationkey, c_custkey FROM customer) GROUP BY key""")
def dynamic_columns(spark, sf):
    cells = F.to_json(F.create_map("c_mktsegment", "c_name", F.concat(F.lit("nation "), "c_nationkey"), F.lit("x")))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("person_index"), F.lit("").alias("paragraf"), F.lit(0).alias("row_index"), cells.alias("cells_json"))
    return markdown.dynamic_columns(c).select("key", F.col("first.at.person_index").alias("first_row"))


_CELLS = """WITH c AS (SELECT c_custkey, '{"' || c_mktsegment || '":"' || c_name || '","it''s ' || c_nationkey || '":' || CASE c_nationkey % 4 WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN CASE WHEN c_custkey % 2 = 0 THEN '"t"' ELSE '7' END WHEN 2 THEN CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE 'true' END ELSE 'null' END || '}' AS j FROM customer),
k AS (SELECT c_custkey, j, unnest(json_keys(j)) AS key, generate_subscripts(json_keys(j), 1) AS no FROM c)
"""


def _varied_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as transactions: a header by segment and one by nation, with values of several types."""
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    value = F.when(n % 4 == 0, k.cast("string")).when(n % 4 == 1, F.when(k % 2 == 0, '"t"').otherwise("7")).when((n % 4 == 2) & (k % 3 != 0), "true").otherwise("null")
    cells = F.concat(F.lit('{"'), "c_mktsegment", F.lit('":"'), "c_name", F.lit('","it\'s '), n.cast("string"), F.lit('":'), value, F.lit("}"))
    return table(spark, sf, "customer").select(k.alias("person_index"), F.lit("h").alias("person_header"), F.lit("").alias("paragraf"), F.lit(0).alias("row_index"), cells.alias("cells_json"))


@query(_CELLS + """, h AS (SELECT list(key ORDER BY f, a) AS hs FROM (SELECT key, min(c_custkey) AS f, arg_min(no, c_custkey) AS a FROM k GROUP BY 1))
SELECT c_custkey AS person_index, array_to_string(list_transform(hs, lambda x: coalesce(json_extract_string(j, '$."' || x || '"'), '')), ' | ') AS cells FROM c, h""")
def variant_cells(spark, sf):
    """Every row's cells in the order of all headers, as a line of the export."""
    x = markdown.pivot_cells(_varied_cells(spark, sf))
    return x.select("person_index", F.array_join(F.transform("cells", S.md_escape), " | ").alias("cells"))


@query(_CELLS + """, t AS (SELECT key, CASE json_type(j, '$."' || key || '"') WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'NULL' THEN NULL ELSE json_type(j, '$."' || key || '"') END AS t FROM k)
SELECT key, count(*) AS n, CASE count(DISTINCT t) WHEN 0 THEN 'VOID' WHEN 1 THEN min(t) ELSE 'VARIANT' END AS type FROM t GROUP BY 1""")
def variant_types(spark, sf):
    """The headers with the type that holds their values."""
    return markdown.cell_types(_varied_cells(spark, sf))


@query("""SELECT 'customer' AS name, count(*) AS n_rows, count(*) FILTER (c_acctbal < 0) AS n_marked FROM customer UNION ALL SELECT 'documents', count(*), count(*) FILTER (lang = 'en') FROM documents
UNION ALL SELECT 'orders', count(*), count(*) FILTER (o_orderstatus = 'F') FROM orders""")
def observed_counts(spark, sf):
    """Tables published in three formats, with the counts observed while they were written."""
    marks = {"customer": F.col("c_acctbal") < 0, "documents": F.col("lang") == "en", "orders": F.col("o_orderstatus") == "F"}
    out = f"{shared_folder(spark)}/observed-{uuid.uuid4().hex}"
    seen = {n: sinks.publish(table(spark, sf, n), out, n, marked=F.count_if(m)) for n, m in marks.items()}
    sinks.remove(spark, out)
    return spark.createDataFrame([(n, s["rows"], s["marked"]) for n, s in seen.items()], "name string, n_rows long, n_marked long")


# ---------------------------------------------------------------------------------------------
# ordered sequences


def doc_lines(spark, sf, large: float = 13.5) -> DataFrame:
    """Document lines with layout features derived from their text, in place of a decoded PDF.

    A line's features are bound once outside the loop over its words: inlined they would be computed
    anew for every word."""
    x = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "text"))
    w = F.filter(F.split("text", " "), lambda v: v != "")
    x = x.withColumn("ws", w).where(F.size("ws") > 0).withColumn("len", F.length("text"))
    bold, size, x0 = F.col("len") % 3 == 0, F.when(F.col("len") % 5 == 0, 10.0).when(F.col("len") % 7 == 0, large).otherwise(11.0), F.when(F.col("len") % 2 == 0, 60.0).otherwise(220.0)
    word = lambda s, v, k: F.struct((s["x0"] + k * 40.0).alias("x0"), F.lit(0.0).alias("top"), F.lit(0).alias("seq"), (s["x0"] + k * 40.0 + 36.0).alias("x1"), v.alias("text"), s["bold"].alias("bold"), s["size"].alias("size"))
    words = F.transform(F.array(F.struct("x0", "bold", "size")), lambda s: F.transform("ws", lambda v, k: word(s, v, k)))[0]
    x = x.withColumn("bold", bold).withColumn("size", size.cast("double")).withColumn("x0", x0.cast("double"))
    return x.select(F.col("doc_id").cast("string").alias("doc_id"), (F.col("no") + 1 >= 3).cast("int").alias("page"), (F.col("no") + 1).alias("line_no"), words.alias("words"), F.array_join("ws", " ").alias("text"), (F.col("no") * 14.0).alias("top"), "x0", "bold", "size")


_LINES = """WITH l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
l1 AS (SELECT doc_id, line_no, list_filter(string_split(raw, ' '), lambda v: v <> '') AS ws, length(raw) AS len FROM l0),
l AS (SELECT doc_id, line_no, CASE WHEN line_no >= 3 THEN 1 ELSE 0 END AS page, ws, array_to_string(ws, ' ') AS text, len % 3 = 0 AS bold, CASE WHEN len % 5 = 0 THEN 10.0 WHEN len % 7 = 0 THEN 13.5 ELSE 11.0 END AS size, CASE WHEN len % 2 = 0 THEN 60.0 ELSE 220.0 END AS x0 FROM l1 WHERE len(ws) > 0)
"""


@query(_LINES + "SELECT doc_id, line_no, lead(text) OVER (PARTITION BY doc_id ORDER BY line_no) AS next_text FROM l")
def line_lookahead(spark, sf):
    x = doc_lines(spark, sf)
    return x.select(F.col("doc_id").cast("bigint").alias("doc_id"), "line_no", F.lead("text").over(lines.ordered(x)).alias("next_text"))


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = (SELECT max(event_type) FROM events) THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_mark, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_index FROM events""")
def fill_forward(spark, sf):
    e = table(spark, sf, "events")
    top = e.agg(F.max("event_type").alias("_t"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.join(F.broadcast(top), F.lit(True)).select("event_id", "user_id", F.last(F.when(F.col("event_type") == F.col("_t"), F.col("event_id")), ignorenulls=True).over(w).alias("last_mark"), F.row_number().over(w).cast("bigint").alias("row_index"))


@query("""WITH RECURSIVE s AS (SELECT l_orderkey AS k, l_linenumber AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) AS r, l_quantity AS v FROM lineitem),
f AS (SELECT k, n, r, v AS anchor, 1 AS g FROM s WHERE r = 1 UNION ALL SELECT s.k, s.n, s.r, CASE WHEN s.v - f.anchor > 2.5 THEN s.v ELSE f.anchor END, CASE WHEN s.v - f.anchor > 2.5 THEN f.g + 1 ELSE f.g END FROM f JOIN s ON s.k = f.k AND s.r = f.r + 1)
SELECT k AS l_orderkey, n AS l_linenumber, g AS line FROM f""")
def anchored_grouping(spark, sf):
    """Lines of words whose tops are the quantities of an order: anchored, so no gap session."""
    w = F.array_sort(F.collect_list(F.struct(F.col("l_quantity").alias("top"), "l_linenumber")))
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(w.alias("ws"))
    g = g.select("l_orderkey", F.explode(F.arrays_zip("ws", lines.anchored_groups(F.col("ws")).alias("line"))).alias("z"))
    return g.select("l_orderkey", F.col("z.ws.l_linenumber").alias("l_linenumber"), F.col("z.line").alias("line"))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey::VARCHAR AS t, l_quantity * 3 AS x0, l_quantity * 3 + 5 AS x1 FROM lineitem),
q AS (SELECT *, CASE WHEN x0 - lag(x1) OVER w > 8 THEN 1 ELSE 0 END AS new, row_number() OVER w AS rn FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY x0, l_linenumber, t)),
r AS (SELECT *, sum(new) OVER (PARTITION BY l_orderkey ORDER BY rn) AS c FROM q)
SELECT l_orderkey, (c + 1)::INT AS cell, string_agg(t, ' ' ORDER BY rn) AS text, arg_min(x0, rn) AS x0, arg_max(x1, rn) AS x1 FROM r GROUP BY 1, 2""")
def gap_cells(spark, sf):
    w = F.struct((F.col("l_quantity") * 3).alias("x0"), "l_linenumber", (F.col("l_quantity") * 3 + 5).alias("x1"), F.col("l_partkey").cast("string").alias("text"))
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(w)).alias("ws"))
    return g.select("l_orderkey", F.posexplode(lines.cells(F.col("ws"))).alias("k", "c")).select("l_orderkey", (F.col("k") + 1).alias("cell"), "c.text", "c.x0", "c.x1")


@query("""WITH h AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS j, l_quantity * 4 AS hx0, l_quantity * 4 + 12 AS hx1 FROM lineitem WHERE l_linenumber <= 3),
c AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_discount * 2000 AS x0, l_discount * 2000 + 20 AS x1 FROM lineitem WHERE l_linenumber > 3),
o AS (SELECT rid, c.l_orderkey, l_linenumber, j, least(x1, hx1 + 8) - greatest(x0, hx0 - 8) AS ov, abs(x0 - hx0) AS away FROM c JOIN h USING (l_orderkey))
SELECT l_orderkey, l_linenumber, (CASE WHEN max(ov) > 0 THEN arg_max(j, (ov, -j)) ELSE arg_min(j, (away, j)) END - 1)::BIGINT AS header FROM o GROUP BY rid, l_orderkey, l_linenumber""")
def overlap_assign(spark, sf):
    l = table(spark, sf, "lineitem")
    h = l.where("l_linenumber <= 3").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", (F.col("l_quantity") * 4).alias("x0"), (F.col("l_quantity") * 4 + 12).alias("x1")))).alias("spans"))
    c = l.where("l_linenumber > 3").select("l_orderkey", "l_linenumber", F.struct((F.col("l_discount") * 2000).alias("x0"), (F.col("l_discount") * 2000 + 20).alias("x1")).alias("cell"))
    return c.join(h, "l_orderkey").select("l_orderkey", "l_linenumber", lines.assign_header(F.col("cell"), F.col("spans")).alias("header"))


@query(_LINES + """SELECT doc_id, page, string_agg(text, chr(10) ORDER BY line_no) AS text, bool_and(bold) AS bold, max(size)::DOUBLE AS size, count(*) AS n_lines FROM l GROUP BY 1, 2""")
def line_listagg(spark, sf):
    x = doc_lines(spark, sf)
    return x.groupBy(F.col("doc_id").cast("bigint").alias("doc_id"), "page").agg(register_layout._joined(F.col("text"), F.lit(True), "\n").alias("text"), F.bool_and("bold").alias("bold"), F.max("size").alias("size"), F.count("*").alias("n_lines"))


@query(r"""WITH l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
g AS (SELECT doc_id, no, list_transform(string_split(line, ' | '), lambda x: trim(x)) AS cells FROM l0 WHERE contains(line, ' | ')),
h AS (SELECT doc_id, arg_min(cells, no) AS heads, min(no) AS no0 FROM g GROUP BY 1),
z AS (SELECT g.doc_id, g.no, unnest(heads[1:least(len(heads), len(cells))]) AS k, unnest(cells[1:least(len(heads), len(cells))]) AS v, generate_subscripts(heads[1:least(len(heads), len(cells))], 1) AS i FROM g JOIN h USING (doc_id) WHERE g.no > no0),
d AS (SELECT doc_id, no, k, arg_max(v, i) AS v, min(i) AS i FROM z GROUP BY 1, 2, 3)
SELECT doc_id, no AS line, '{' || string_agg(to_json(k) || ':' || to_json(v), ',' ORDER BY i) || '}' AS cells_json FROM d GROUP BY 1, 2""")
def grid_rows_json(spark, sf):
    x = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line")).where(F.col("line").contains(" | "))
    x = x.select("doc_id", (F.col("no") + 1).alias("line"), F.transform(F.split("line", r" \| "), lambda v: F.trim(v)).alias("cells"))
    w = Window.partitionBy("doc_id").orderBy("line")
    x = x.withColumn("heads", F.first("cells").over(w)).withColumn("rn", F.row_number().over(w)).where("rn > 1")
    return x.select("doc_id", F.col("line").cast("bigint").alias("line"), S.zip_json("heads", "cells").alias("cells_json"))


# ---------------------------------------------------------------------------------------------
# layout


_REGISTER = _LINES + r""",
a AS (SELECT *, row_number() OVER w AS pos, page >= 1 AND x0 <= 110 AND coalesce(lead(bold) OVER w AND lead(size) OVER w >= 10.5 AND lead(x0) OVER w <= 110, false)
  AND ((size >= 13 AND len(ws) <= 2) OR (bold AND size >= 10.5 AND len(ws) = 1 AND NOT contains(text, ',') AND NOT contains(text, '('))) AS r1 FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
b AS (SELECT *, sum(r1::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS hid FROM a),
c AS (SELECT *, hid > 0 AND NOT r1 AS inside, hid > 0 AND NOT r1 AND bold AND x0 <= 110 AND size >= 10.5 AS r4 FROM b),
d AS (SELECT *, coalesce(bool_or(r4) OVER (PARTITION BY doc_id, hid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS has_person FROM c),
e AS (SELECT *, inside AND size <= 10.4 AND has_person AS r3 FROM d),
f AS (SELECT *, r4 AND NOT coalesce(last_value(CASE WHEN NOT r3 THEN r4 AND NOT contains(text, ')') END IGNORE NULLS) OVER (PARTITION BY doc_id, hid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS new_person FROM e),
s AS (SELECT doc_id, arg_max(x0, (n, -first_pos)) - 6 AS split FROM (SELECT doc_id, x0, count(*) AS n, min(pos) AS first_pos FROM f WHERE NOT bold AND size >= 10.5 AND x0 > 150 AND x0 < 400 GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT f.*, sum(new_person::INT) OVER (PARTITION BY f.doc_id ORDER BY pos) AS pid, coalesce(split, 205.0) AS split FROM f LEFT JOIN s USING (doc_id)),
h AS (SELECT *, CASE WHEN x0 < split THEN least(len(ws), ceil((split - x0) / 40)::INT) ELSE 0 END AS n_left FROM g),
i AS (SELECT *, len(ws) - n_left AS n_right, inside AND NOT r3 AND NOT r4 AND has_person AS body FROM h),
j AS (SELECT *, body AND n_left > 0 AND (ws[1] LIKE '§%' OR regexp_full_match(ws[1], '[0-9]{1,2}\.')) AS r7 FROM i),
k AS (SELECT *, sum(r7::INT) OVER (PARTITION BY doc_id, pid ORDER BY pos) AS sid, sum((r3 AND bold)::INT) OVER (PARTITION BY doc_id, pid ORDER BY pos) AS tid FROM j),
m AS (SELECT *, coalesce(bool_or(CASE WHEN body THEN n_right > 0 END) OVER (PARTITION BY doc_id, pid, sid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS has_content FROM k)
SELECT doc_id, line_no, CASE WHEN r1 THEN 'R1' WHEN hid = 0 THEN CASE WHEN page = 0 THEN 'R2 cover' ELSE 'R2 preamble' END WHEN r3 THEN CASE WHEN bold THEN 'R3 head' WHEN tid > 0 THEN 'R3 row' ELSE 'remainder' END
 WHEN r4 THEN CASE WHEN new_person THEN 'R4 new' ELSE 'R4 more' END WHEN NOT has_person THEN 'remainder' WHEN r7 THEN 'R7' WHEN sid > 0 AND n_left > 0 AND n_right = 0 AND NOT has_content THEN 'R8'
 WHEN sid = 0 THEN 'R9' WHEN n_right > 0 AND n_left = 0 THEN 'R10' ELSE 'R11' END AS rule, pid::BIGINT AS person_id, sid::BIGINT AS section_id FROM m"""


@query(_REGISTER)
def layout_classify(spark, sf):
    x = doc_lines(spark, sf)
    c = register_layout.classify(x, lines.register_split(x))
    return c.select(F.col("doc_id").cast("bigint").alias("doc_id"), "line_no", "rule", "person_id", "section_id")


@query(_LINES + r""",
v AS (SELECT doc_id, page, line_no, x0 + i * 40 AS wx, i, bold, size FROM (SELECT *, unnest(range(len(ws))) AS i FROM l) WHERE page >= 1),
s AS (SELECT doc_id, arg_max(wx, (n, -f1, -f2)) - 4 AS split FROM (SELECT doc_id, wx, count(*) AS n, min((line_no, i)) AS f, min(line_no) AS f1, arg_min(i, (line_no, i)) AS f2 FROM v WHERE NOT bold AND size < 12 AND wx > 150 AND wx < 400 GROUP BY 1, 2) GROUP BY 1),
a AS (SELECT l.*, coalesce(split, 200.0) AS split, (line_no - 1) * 14.0 AS top, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos FROM l LEFT JOIN s USING (doc_id) WHERE page >= 1),
b AS (SELECT *, CASE WHEN x0 < split THEN least(len(ws), ceil((split - x0) / 40)::INT) ELSE 0 END AS n_left, top - lag(top) OVER (PARTITION BY doc_id, page ORDER BY line_no) AS gap, bold AND size >= 13.5 AS s1 FROM a),
c AS (SELECT *, len(ws) - n_left AS n_right, n_left > 0 AND bold AS left_bold, sum(s1::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS pid FROM b),
d AS (SELECT *, coalesce(bool_or(left_bold AND NOT s1) OVER (PARTITION BY doc_id, pid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS has_field FROM c),
e AS (SELECT *, NOT s1 AND NOT has_field AND n_left > 0 AND n_right = 0 AND NOT bold AND text LIKE '(%' AS like3 FROM d),
f AS (SELECT *, like3 AND NOT coalesce(bool_or(like3) OVER (PARTITION BY doc_id, pid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS s3, NOT s1 AND left_bold AND (gap IS NULL OR gap > 20 OR NOT has_field) AS s4 FROM e)
SELECT doc_id, line_no, CASE WHEN s1 THEN 'S1' WHEN pid = 0 THEN 'remainder' WHEN s3 THEN 'S3' WHEN s4 THEN CASE WHEN n_right > 0 AND bold THEN 'S4 header' ELSE 'S4' END WHEN NOT has_field THEN 'remainder' WHEN NOT left_bold AND n_left > 0 THEN 'remainder' ELSE 'S5' END AS rule, pid::BIGINT AS person_id FROM f""")
def form_fields(spark, sf):
    x = doc_lines(spark, sf, large=14.0)
    c = form_layout.classify(x, lines.form_split(x))
    return c.select(F.col("doc_id").cast("bigint").alias("doc_id"), "line_no", "rule", "person_id")


# ---------------------------------------------------------------------------------------------
# resolution, rendering, candidates, sinks


def _roster_input(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers as persons and suppliers as a pool, named by parts."""
    part = table(spark, sf, "part").select("p_partkey", F.substring_index("p_name", " ", 1).alias("sur"), F.coalesce(F.nullif(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit("")), F.lit("x")).alias("giv"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf, "supplier").join(part, F.col("p_partkey") == F.col("s_suppkey")).join(n, F.col("n_nationkey") == F.col("s_nationkey"))
    pool = s.select(F.col("s_suppkey").alias("ord"), F.col("s_suppkey").cast("string").alias("api_person_id"), F.col("sur").alias("etternavn"), F.concat("giv", F.when(F.col("s_suppkey") % 4 == 0, " second").otherwise("")).alias("fornavn"), (F.col("s_suppkey") % 3).cast("string").alias("foedselsdato"), F.lit("k").alias("kjoenn"), F.array().cast("array<string>").alias("partier"), F.array(F.lower("n_name")).alias("fylker"))
    c = table(spark, sf, "customer").join(part, F.col("p_partkey") == F.col("c_custkey")).join(n, F.col("n_nationkey") == F.col("c_nationkey"))
    form = F.col("c_custkey") % 3
    name = F.when(form == 0, F.concat("sur", F.lit(", "), "giv")).when(form == 1, F.concat("giv", F.lit(" "), "sur")).otherwise(F.concat("sur", F.lit(", "), "giv", F.lit(" third")))
    persons = c.select(F.lit("d").alias("date"), F.col("c_custkey").cast("int").alias("person_index"), F.lit("h").alias("section_heading"), name.alias("person_header"), name.alias("name"), F.lit(None).cast("string").alias("party"), F.col("n_name").alias("constituency"))
    return persons, pool


_CLEAN = "array_to_string(list_sort(list_distinct(string_split({}, ' '))), ' ')"


@query("""WITH pool AS (SELECT s_suppkey AS ord, split_part(p_name, ' ', 1) AS sur, coalesce(nullif(split_part(p_name, ' ', 2), ''), 'x') || CASE WHEN s_suppkey % 4 = 0 THEN ' second' ELSE '' END AS giv, (s_suppkey % 3)::VARCHAR AS dob, n_name AS region, s_suppkey::VARCHAR AS id
 FROM supplier JOIN part ON p_partkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey),
pp AS (SELECT *, lower(sur) || ', ' || lower(giv) AS k1, lower(sur) || chr(1) || split_part(lower(giv), ' ', 1) AS k2, """ + _CLEAN.format("lower(sur) || ' ' || lower(giv)") + """ AS k3, dob || '/' || lower(sur) || '/' || lower(giv) AS ident FROM pool),
per AS (SELECT c_custkey, split_part(p_name, ' ', 1) AS sur, coalesce(nullif(split_part(p_name, ' ', 2), ''), 'x') AS giv, n_name AS region, c_custkey % 3 AS form FROM customer JOIN part ON p_partkey = c_custkey JOIN nation ON n_nationkey = c_nationkey),
pn AS (SELECT *, CASE form WHEN 0 THEN sur || ', ' || giv WHEN 1 THEN giv || ' ' || sur ELSE sur || ', ' || giv || ' third' END AS name FROM per),
pk AS (SELECT *, lower(name) AS k1, lower(split_part(name, ',', 1)) || chr(1) || CASE WHEN contains(name, ',') THEN split_part(trim(lower(split_part(name, ',', 2))), ' ', 1) ELSE '' END AS k2, """ + _CLEAN.format("replace(lower(name), ',', '')") + """ AS k3 FROM pn),
j AS (SELECT c_custkey, pk.region, 1 AS m, pp.ord, pp.ident, pp.id, pp.region AS r FROM pk JOIN pp ON pk.k1 = pp.k1 UNION ALL SELECT c_custkey, pk.region, 2, pp.ord, pp.ident, pp.id, pp.region FROM pk JOIN pp ON pk.k2 = pp.k2 UNION ALL SELECT c_custkey, pk.region, 3, pp.ord, pp.ident, pp.id, pp.region FROM pk JOIN pp ON pk.k3 = pp.k3),
t AS (SELECT c_custkey, m, count(DISTINCT ident) AS n, arg_min(id, ord) AS id, count(DISTINCT ident) FILTER (r = region) AS nr, arg_min(id, ord) FILTER (r = region) AS idr FROM j GROUP BY 1, 2),
u AS (SELECT c_custkey, m, CASE WHEN n = 1 THEN id WHEN nr = 1 THEN idr END AS id, CASE WHEN n = 1 THEN '' WHEN nr = 1 THEN '+context' END AS how FROM t),
b AS (SELECT c_custkey, min(m) FILTER (how IS NOT NULL) AS m, count(*) AS c FROM u GROUP BY 1)
SELECT pn.c_custkey::INT AS person_index, pn.name, u.id AS api_person_id, CASE WHEN b.c IS NULL THEN 'unmatched' WHEN b.m IS NULL THEN 'ambiguous' ELSE ['exact', 'surname_first_token', 'token_set'][b.m] || u.how END AS match_method
FROM pn LEFT JOIN b USING (c_custkey) LEFT JOIN u ON u.c_custkey = pn.c_custkey AND u.m = b.m""")
def resolve_roster(spark, sf):
    return resolve(*_roster_input(spark, sf), nfc=True).select("person_index", "name", "api_person_id", "match_method")


@query("""WITH pool AS (SELECT s_suppkey AS ord, split_part(p_name, ' ', 1) AS sur, coalesce(nullif(split_part(p_name, ' ', 2), ''), 'x') || CASE WHEN s_suppkey % 4 = 0 THEN ' second' ELSE '' END AS giv, (s_suppkey % 3)::VARCHAR AS dob, n_name AS region, s_suppkey::VARCHAR AS id, ['x', 'y', NULL][s_suppkey % 3 + 1] AS party
 FROM supplier JOIN part ON p_partkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey),
pp AS (SELECT *, lower(sur) || ', ' || lower(giv) AS k1, lower(sur) || chr(1) || split_part(lower(giv), ' ', 1) AS k2, """ + _CLEAN.format("lower(sur) || ' ' || lower(giv)") + """ AS k3, dob || '/' || lower(sur) || '/' || lower(giv) AS ident FROM pool),
per AS (SELECT c_custkey, split_part(p_name, ' ', 1) AS sur, coalesce(nullif(split_part(p_name, ' ', 2), ''), 'x') AS giv, n_name AS region, c_custkey % 3 AS form, [NULL, 'x', 'y', 'z'][c_custkey % 4 + 1] AS p FROM customer JOIN part ON p_partkey = c_custkey JOIN nation ON n_nationkey = c_nationkey),
pn AS (SELECT *, CASE form WHEN 0 THEN sur || ', ' || giv WHEN 1 THEN giv || ' ' || sur ELSE sur || ', ' || giv || ' third' END AS name FROM per),
pk AS (SELECT *, lower(name) AS k1, lower(split_part(name, ',', 1)) || chr(1) || CASE WHEN contains(name, ',') THEN split_part(trim(lower(split_part(name, ',', 2))), ' ', 1) ELSE '' END AS k2, """ + _CLEAN.format("replace(lower(name), ',', '')") + """ AS k3 FROM pn),
j AS (SELECT c_custkey, pk.region, 1 AS m, pp.ord, pp.ident, pp.id, pp.region AS r, pk.p, pp.party AS pp FROM pk JOIN pp ON pk.k1 = pp.k1 UNION ALL SELECT c_custkey, pk.region, 2, pp.ord, pp.ident, pp.id, pp.region, pk.p, pp.party FROM pk JOIN pp ON pk.k2 = pp.k2 UNION ALL SELECT c_custkey, pk.region, 3, pp.ord, pp.ident, pp.id, pp.region, pk.p, pp.party FROM pk JOIN pp ON pk.k3 = pp.k3),
t AS (SELECT c_custkey, m, count(DISTINCT ident) AS n, arg_min(id, ord) AS id, count(*) FILTER (r = region) AS cr FROM j GROUP BY 1, 2),
w AS (SELECT j.*, n, t.id AS first_id FROM j JOIN t USING (c_custkey, m) WHERE cr = 0 OR r = region),
v AS (SELECT c_custkey, m, count(*) AS c, count(*) FILTER (pp = p) AS cp FROM w GROUP BY 1, 2),
z AS (SELECT w.* FROM w JOIN v USING (c_custkey, m) WHERE p IS NULL OR c = 1 OR cp = 0 OR pp = p),
y AS (SELECT c_custkey, m, any_value(n) AS n, any_value(first_id) AS first_id, count(DISTINCT ident) AS nz, arg_min(id, ord) AS idz FROM z GROUP BY 1, 2),
u AS (SELECT c_custkey, m, CASE WHEN n = 1 THEN first_id WHEN nz = 1 THEN idz END AS id, CASE WHEN n = 1 THEN '' WHEN nz = 1 THEN '+context' END AS how FROM y),
b AS (SELECT c_custkey, min(m) FILTER (how IS NOT NULL) AS m, count(*) AS c FROM u GROUP BY 1)
SELECT pn.c_custkey::INT AS person_index, pn.name, pn.p AS party, u.id AS api_person_id, CASE WHEN b.c IS NULL THEN 'unmatched' WHEN b.m IS NULL THEN 'ambiguous' ELSE ['exact', 'surname_first_token', 'token_set'][b.m] || u.how END AS match_method
FROM pn LEFT JOIN b USING (c_custkey) LEFT JOIN u ON u.c_custkey = pn.c_custkey AND u.m = b.m""")
def resolve_with_parties(spark, sf):
    """As ``resolve_roster``, with parties on both sides: the second step of the context."""
    persons, pool = _roster_input(spark, sf)
    of = lambda names, k: F.get(F.array(*[F.lit(v).cast("string") for v in names]), (F.col(k) % len(names)).cast("int"))
    pool = pool.withColumn("partier", F.array_compact(F.array(of(("x", "y", None), "ord"))))
    got = resolve(persons.withColumn("party", of((None, "x", "y", "z"), "person_index")), pool, nfc=True)
    return got.select("person_index", "name", "party", "api_person_id", "match_method")


@query("""SELECT '| nation | region |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || replace(n_name, '|', '\\|') || ' | ' || r_name || ' |', chr(10) ORDER BY r_name, n_name) AS md FROM nation JOIN region ON n_regionkey = r_regionkey""".replace("\\\\", "\\"))
def md_render(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    return sinks.md_table(n, ["nation", "region"], ("region", "nation"))


_TOKENS = ", ".join(f"({m + 1}, '{t}{d}')" for m in range(12) for t in (candidates.FULL[m], *candidates.SHORT[m]) for d in ("", "."))


@query(f"""WITH d AS (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2021-12-31', INTERVAL 1 DAY))::DATE AS d), mt(m, t) AS (VALUES {_TOKENS}),
p AS (SELECT d, unnest([(year(d) - 1) || '-' || year(d), year(d) || '-' || (year(d) + 1)]) AS period FROM d)
SELECT DISTINCT 'https://host/arkiv_' || period || '/' || pre || dt || '-' || t || '-' || year(d) || '.pdf' AS url FROM p JOIN mt ON m = month(d), (VALUES ('pr-'), ('pr.-')) x(pre), (SELECT unnest(['', '.']) AS dot) y, LATERAL (SELECT day(d) || dot AS dt) z
UNION SELECT 'https://host/arkiv_' || period || '/' || c || '.pdf' FROM p, LATERAL (SELECT unnest([strftime(d, '%Y-%d%m'), strftime(d, '%Y-%m%d'), strftime(d, '%Y-%d-%m'), strftime(d, '%d%m-%Y')]) AS c) z
UNION SELECT 'https://other/' || c || '.pdf' FROM d, LATERAL (SELECT unnest([strftime(d, '%Y-%d%m'), strftime(d, '%Y-%m%d'), strftime(d, '%Y-%d-%m'), strftime(d, '%d%m-%Y')]) AS c) z""")
def candidate_names(spark, sf):
    days = candidates.dates(spark, "2020-01-01", "2021-12-31")
    return candidates.worklist(candidates.dated(spark, days, "https://host"), candidates.coded(days, "https://host", "https://other"))


@query("SELECT n_nationkey, n_name, n_regionkey, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 'a|\"b\"' || chr(10) || n_name END AS note, n_nationkey % 2 = 0 AS flag FROM nation")
def sink_roundtrip(spark, sf):
    """Rows written as gzipped CSV and JSON Lines and as parquet, read again, and kept where all agree."""
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey", F.when(k % 3 != 0, F.concat(F.lit('a|"b"\n'), "n_name")).alias("note"), (k % 2 == 0).alias("flag"))
    out = f"{shared_folder(spark)}/sinks-{uuid.uuid4().hex}"
    sinks.publish(n, out, "nation")
    csv = spark.read.schema(n.schema).option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/nation.csv.gz")
    return spark.read.parquet(f"{out}/nation.parquet").intersect(csv).intersect(spark.read.schema(n.schema).json(f"{out}/nation.jsonl.gz"))


@query("""WITH r AS (SELECT sha256(text) AS block_hash, lang AS item_text, 'first' AS model, 1 AS run FROM documents WHERE text IS NOT NULL UNION ALL SELECT sha256(text), source, 'second', 2 FROM documents WHERE lang = 'en' AND text IS NOT NULL),
d AS (SELECT block_hash, run, min(item_text) AS item_text, min(model) AS model FROM r GROUP BY 1, 2)
SELECT block_hash, arg_max(model, run) AS model, arg_max(item_text, run) AS item_text FROM d GROUP BY 1""")
def cache_roundtrip(spark, sf):
    """Records appended to the item cache twice and read again: of each block the later record."""
    d = table(spark, sf, "documents").where("text is not null").withColumn("block_hash", F.sha2("text", 256))
    cache = f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}"
    for model, item, rows in (("first", "lang", d), ("second", "source", d.where("lang = 'en'"))):
        sinks.append_cache(_memo_records(rows, item, model), cache)
    return T.cache_latest(spark, cache).select("block_hash", "model", F.col("items")[0]["item_text"].alias("item_text"))


def _memo_records(rows: DataFrame, item: str, model: str) -> DataFrame:
    """A record for each block hash, with one item."""
    items = F.array(F.struct(F.col("item").alias("item_text"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in CACHE["items"].dataType.elementType if f.name != "item_text"]))
    one = rows.groupBy("block_hash").agg(F.min(item).alias("item"))
    return one.select("block_hash", items.cast(CACHE["items"].dataType).alias("items"), F.lit(model).alias("model"), F.lit("v1").alias("prompt_version"))


@query("""WITH b AS (SELECT *, sha256(text) AS block_hash FROM documents WHERE text IS NOT NULL),
r AS (SELECT block_hash, lang AS item_text, 'first' AS model, 1 AS run FROM b UNION ALL SELECT block_hash, source, 'second', 2 FROM b WHERE lang = 'en' UNION ALL SELECT block_hash, lang, 'third', 3 FROM b WHERE source IS NULL OR source < 'src2'),
d AS (SELECT block_hash, run, min(item_text) AS item_text, min(model) AS model FROM r GROUP BY 1, 2),
c AS (SELECT block_hash, arg_max(model, run) AS model, arg_max(item_text, run) AS item_text FROM d GROUP BY 1)
SELECT b.lang, c.model, c.item_text, count(*) AS n_rows, count(DISTINCT block_hash) AS n_blocks FROM b JOIN c USING (block_hash) GROUP BY 1, 2, 3""")
def cache_compaction(spark, sf):
    """Two runs compacted by hash and a third one after, joined to the documents by block."""
    d = table(spark, sf, "documents").where("text is not null").withColumn("block_hash", F.sha2("text", 256))
    cache = f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}"
    sinks.append_cache(_memo_records(d, "lang", "first"), cache)
    sinks.append_cache(_memo_records(d.where("lang = 'en'"), "source", "second"), cache)
    sinks.compact_cache(spark, cache, 8)
    sinks.append_cache(_memo_records(d.where("source is null or source < 'src2'"), "lang", "third"), cache)
    r = T.cache_latest(spark, cache).select("block_hash", "model", F.col("items")[0]["item_text"].alias("item_text"))
    return d.select("lang", "block_hash").join(r, "block_hash").groupBy("lang", "model", "item_text").agg(F.count("*").alias("n_rows"), F.count_distinct("block_hash").alias("n_blocks"))


@query("""SELECT c_mktsegment AS date, CASE WHEN c_mktsegment >= 'FURNITURE' THEN 'h2' ELSE 'h1' END AS file_hash, count(*) AS n_persons, sum(c_custkey)::BIGINT AS ids,
 min(CASE WHEN c_mktsegment >= 'FURNITURE' THEN upper(c_name) ELSE c_name END) AS first_name FROM customer GROUP BY 1, 2""")
def snapshot_commit(spark, sf):
    """Customers as persons of a snapshot a segment: committed, some committed again under another hash, and
    then written once more without a commit, which nobody sees."""
    store = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("date"))

    def meta(h: str) -> DataFrame:
        return c.select("date").distinct().select("date", F.col("date").alias("snapshot"), F.lit(h).alias("file_hash"), F.lit("1").alias("parser_version"))

    def persons(dates: DataFrame, name) -> DataFrame:
        rows = c.join(dates.select("date"), "date", "left_semi").select("date", F.col("c_custkey").alias("person_index"), name.alias("name"))
        return conform(rows, "persons").withColumn("snapshot", F.col("date"))

    for h, name, some in (("h1", F.col("c_name"), F.lit(True)), ("h2", F.upper("c_name"), F.col("date") >= "FURNITURE")):
        new = incremental.changed_snapshots(meta(h).where(some), T.snapshot_meta(spark, store), "1")
        sinks.commit_snapshots(spark, store, {"persons": persons(new, name)}, new)
    sinks.write_version(persons(meta("h3"), F.lit("cut short")), store, "persons", "00000009-cut")
    p = T.snapshots(spark, store, "persons").groupBy("date").agg(F.count("*").alias("n_persons"), F.sum("person_index").alias("ids"), F.min("name").alias("first_name"))
    return p.join(T.snapshot_meta(spark, store).select("date", "file_hash"), "date")


@query("""WITH m AS (SELECT doc_id, text, CASE WHEN doc_id % 7 = 0 THEN 'other' WHEN doc_id % 5 = 0 THEN NULL ELSE sha256('%PDF' || text) END AS sha256 FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN lang = 'de' THEN 'not a pdf' WHEN m.sha256 IS DISTINCT FROM sha256('%PDF' || m.text) THEN 'sha256 differs' ELSE 'good' END AS verdict FROM m JOIN documents USING (doc_id)""")
def verified_intake(spark, sf):
    """Texts as files behind a magic word that one language lacks; some are missing, some entries have
    another hash or none."""
    d = table(spark, sf, "documents").where("text is not null")
    k, word = F.col("doc_id"), F.when(F.coalesce(F.col("lang") == "de", F.lit(False)), "%TXT").otherwise("%PDF")
    files = d.where(k % 11 != 0).select(F.concat(F.lit("/files/"), k.cast("string")).alias("path"), F.concat(word, "text").cast("binary").alias("content"))
    told = F.when(k % 7 == 0, "other").when(k % 5 != 0, F.sha2(F.concat(F.lit("%PDF"), "text"), 256))
    good, bad = intake.verify(d.select("doc_id", told.alias("sha256")), intake.inspect(files), F.col("doc_id").cast("string"))
    return good.select("doc_id", F.lit("good").alias("verdict")).unionByName(bad.select("doc_id", F.col("reason").alias("verdict")))
