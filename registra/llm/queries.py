"""Registered queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    q = quality(_docs(spark, sf_dir).select("doc_id", "text"))
    return q.select(
        "doc_id", F.col("q_n_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"), F.col("q_n_symbols").alias("n_symbols"),
        F.col("q_n_dup_lines").alias("n_dup_lines"), F.col("q_n_repeat_words").alias("n_repeat_words"),
        F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"),
    )


def op1_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    p = pack(spark, _docs(spark, sf_dir), digest={"ids_crc32": F.crc32("ids")})
    return p.placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import Scratch
    from .token_binary import pack_rows, write_matrix

    rows = write_matrix(pack_rows(spark, _docs(spark, sf_dir)), f"{Scratch(spark, 'token-matrix').root}/rows")
    return rows.select("sequence_id", "doc_ids", "starts", "cu_seqlens", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"))


def op4_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(spark, _docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op5_naive_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import crc_mod
    from .langid import predict, train

    docs = _docs(spark, sf_dir)
    model = train(spark, docs.where(crc_mod("doc_id", 5) != 0))
    out = predict(spark, docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_paragraph_banding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import repeated_passages

    p = repeated_passages(spark, _docs(spark, sf_dir))
    return p.select("doc_id", F.col("first").alias("first_word"), "n_words", "class_id", "copies", "removed")


def op7_interleaved_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import documents_as_media

    r = documents_as_media(spark, _docs(spark, sf_dir))
    return r.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")


def op8_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hmm import language_model_scores

    return language_model_scores(spark, _docs(spark, sf_dir))


def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dup import near_duplicates

    return near_duplicates(spark, _docs(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import crc_mod
    from .toxicity import THRESHOLD, score_texts, train

    docs = _docs(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod("doc_id", 3) != 1)
    model = train(spark, docs, labels)
    out = score_texts(spark, docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )


def op11_end_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .align import scores

    return scores(spark, _docs(spark, sf_dir))


def op12_padded_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import digests

    return digests(spark, _docs(spark, sf_dir))


def op13_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import damage, repair

    return repair(spark, damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))).summary


def media_page_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its ordered sequence of text runs and media references."""
    from .media import parse_pages

    s = parse_pages(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return s.select("page_id", F.explode("items").alias("i")).select("page_id", "i.position", "i.kind", "i.text", "i.ref", "i.caption")


def _quality_sql(source: str = "documents") -> str:
    from .quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS

    top = {"mean_word_chars": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "n_words"), "stop_ratio": ("n_stop", "n_words"), "shout_ratio": ("n_shout", "n_words"), "bar_line_ratio": ("n_bar", "n_lines"), "dup_line_ratio": ("n_dup_lines", "n_lines")}
    rules = " AND ".join(f"{a} >= {r.low} * {b} AND {a} <= {r.high} * {b}" for r in RULES for a, b in [top[r.metric]])
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM {source}),
w0 AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\v\f\r]+')) AS w, generate_subscripts(regexp_split_to_array(text, '[ \t\n\v\f\r]+'), 1) AS p FROM t),
w AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i FROM w0 WHERE w <> ''),
ws AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (lower(w) IN ({stops})) AS n_stop, count(*) FILTER (ends_with(w, '!!')) AS n_shout FROM w GROUP BY 1),
g AS (SELECT doc_id, i, w || ' ' || lead(w, 1) OVER z || ' ' || lead(w, 2) OVER z AS tri FROM w WINDOW z AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM g WHERE tri IS NOT NULL) WHERE c > 1),
rw AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) v(k) GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
ls AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (contains(line, ' | ')) AS n_bar FROM l WHERE regexp_matches(line, '[^ \t\n\v\f\r]') GROUP BY 1),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_stop, 0) AS n_stop, coalesce(n_shout, 0) AS n_shout, coalesce(n_lines, 0) AS n_lines, coalesce(n_bar, 0) AS n_bar
  FROM t LEFT JOIN ws USING (doc_id) LEFT JOIN rw USING (doc_id) LEFT JOIN ls USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  base_failed, NOT base_failed AND {rules} AS kept FROM b"""


def _near_sql(source: str = "documents") -> str:
    """Classes of equal sets, pairs of classes by their common shingles, and what each class reaches."""
    from .near_dup import PERCENT

    return rf"""
WITH RECURSIVE t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM {source}),
w0 AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\v\f\r]+')) AS w, generate_subscripts(regexp_split_to_array(text, '[ \t\n\v\f\r]+'), 1) AS p FROM t),
w AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM w0 WHERE w <> ''),
g AS (SELECT doc_id, i, n, concat_ws(' ', w, lead(w, 1) OVER z, lead(w, 2) OVER z, lead(w, 3) OVER z, lead(w, 4) OVER z) AS s FROM w WINDOW z AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, s FROM g WHERE i <= greatest(n - 4, 1)),
d AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS k FROM s GROUP BY 1),
c AS (SELECT k, n, min(doc_id) AS rep FROM d GROUP BY 1, 2),
r AS (SELECT rep, n, s FROM c JOIN s ON doc_id = rep),
e AS (SELECT a.rep AS a, b.rep AS b FROM r a JOIN r b ON a.s = b.s AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
x AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT rep, rep FROM c UNION SELECT reach.a, x.b FROM reach JOIN x ON reach.b = x.a),
m AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY 1)
SELECT t.doc_id, coalesce(d.n, 0)::BIGINT AS n_shingles, coalesce(m.component_id, t.doc_id)::BIGINT AS component_id, t.doc_id = coalesce(m.component_id, t.doc_id) AS kept
FROM t LEFT JOIN d ON d.doc_id = t.doc_id LEFT JOIN c ON c.k = d.k AND c.n = d.n LEFT JOIN m ON m.rep = c.rep"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_shortest_pack_first, op2_quality_rules, op3_token_matrix, op4_pareto_mixing, op5_naive_bayes_language, op6_paragraph_banding,
        op7_interleaved_media, op8_hidden_markov_scores, op9_minhash_forest, op10_toxic_segments, op11_end_dictionaries, op12_padded_bpe, op13_auction_repair,
        media_page_sequences,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": _quality_sql(), "op9_minhash_forest": _near_sql()}
