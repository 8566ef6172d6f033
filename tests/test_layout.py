import json
import random
import time

import numpy as np
from pyspark.sql import functions as F

from registra.operators import form_layout, lines, register_layout
from registra.schemas import WORDS

from . import machines


def word(doc, page, top, x0, text, font="Sans", size=11.0, x1=None, height=800.0):
    return (doc, page, height, text, x0, x0 + 6.0 * len(text) if x1 is None else x1, top, font, size)


def test_footer_and_anchored_lines(spark):
    w = [word("d", 0, t, 10.0, f"t{t}") for t in (0.0, 2.0, 4.0, 5.0, 9.0)] + [word("d", 0, 735.0, 10.0, "footer"), word("d", 0, 734.0, 10.0, "last")]
    got = lines.group_lines(lines.body_words(spark.createDataFrame(w, WORDS))).orderBy("line_no").collect()
    assert [g.text for g in got] == ["t0.0 t2.0", "t4.0 t5.0", "t9.0", "last"]
    assert lines.body_words(spark.createDataFrame(w, WORDS), "form").count() == 7


def test_words_of_a_line_go_by_x(spark):
    w = [word("d", 0, 1.0, 50.0, "b", "Sans-Bold"), word("d", 0, 0.0, 90.0, "c", "Sans-Bold", 9.0), word("d", 0, 2.0, 10.0, "a", "Sans-Bold", 12.0)]
    (g,) = lines.group_lines(lines.body_words(spark.createDataFrame(w, WORDS))).collect()
    assert (g.text, g.x0, g.top, g.bold, g["size"]) == ("a b c", 10.0, 2.0, True, 12.0)


def test_split_falls_back_and_breaks_ties_by_place(spark):
    w = [word("a", 1, 10.0, 200.04, "x"), word("a", 1, 30.0, 300.0, "x"), word("b", 1, 10.0, 20.0, "x"), word("c", 1, 10.0, 300.0, "x"), word("c", 1, 30.0, 200.0, "x"), word("c", 1, 50.0, 200.0, "x")]
    got = {r.doc_id: r.split for r in lines.register_split(lines.group_lines(lines.body_words(spark.createDataFrame(w, WORDS)))).collect()}
    assert got == {"a": 194.0, "b": 205.0, "c": 194.0}


def random_doc(rng, n):
    out = []
    for k in range(n):
        x0 = rng.choice((60.0, 60.0, 220.0))
        texts = rng.choice((["Alfa"], ["§", "1", "lab"], ["12.", "lab"], ["x", "y,"], ["N,", "(A,", "B)"], ["N,", "(A"], ["B)"], ["§2"], ["one", "two", "three"], ["(P,", "F)"]))
        bold, size = rng.random() < 0.45, rng.choice((10.0, 10.45, 11.0, 13.5, 14.0))
        step = rng.choice((40.0, 90.0))
        out.append({"page": min(2, 1 + k // 20) if k > 2 else 0, "top": 20.0 + 25.0 * (k % 20) if rng.random() < 0.7 else 20.0 + 12.0 * (k % 20), "x0": x0, "bold": bold, "size": size, "words": [(t, x0 + step * i) for i, t in enumerate(texts)]})
    return out


def as_lines(spark, docs):
    rows = []
    for d, doc in docs.items():
        for k, r in enumerate(doc):
            words = [(x, r["top"], i, x + 20.0, t, r["bold"], r["size"]) for i, (t, x) in enumerate(r["words"])]
            rows.append((d, r["page"], k + 1, words, " ".join(t for t, _ in r["words"]), r["top"], r["x0"], r["bold"], r["size"]))
    return spark.createDataFrame(rows, "doc_id string, page int, line_no int, words array<struct<x0:double,top:double,seq:int,x1:double,text:string,bold:boolean,size:double>>, text string, top double, x0 double, bold boolean, size double")


def test_register_rules_match_a_sequential_machine(spark):
    rng = random.Random(7)
    docs = {f"d{i}": random_doc(rng, rng.randint(1, 45)) for i in range(150)}
    df = as_lines(spark, docs)
    split = df.select("doc_id").distinct().withColumn("split", F.lit(205.0))
    got: dict = {}
    for r in register_layout.classify(df, split).orderBy("doc_id", "line_no").collect():
        got.setdefault(r.doc_id, []).append(r.rule)
    want = {d: machines.register(doc, 205.0) for d, doc in docs.items()}
    assert got == want
    assert {x for v in want.values() for x in v} >= {"R1", "R2 cover", "R3 head", "R3 row", "R4 new", "R4 more", "R7", "R8", "R9", "R10", "R11", "remainder"}


def test_form_rules_match_a_sequential_machine(spark):
    rng = random.Random(8)
    docs = {f"d{i}": random_doc(rng, rng.randint(1, 45)) for i in range(150)}
    df = as_lines(spark, docs)
    split = df.select("doc_id").distinct().withColumn("split", F.lit(200.0))
    got: dict = {}
    for r in form_layout.classify(df, split).orderBy("doc_id", "line_no").collect():
        got.setdefault(r.doc_id, []).append(r.rule)
    want = {d: machines.form([r | {"words": [(t, x, r["bold"], r["size"]) for t, x in r["words"]]} for r in doc if r["page"] >= 1], 200.0) for d, doc in docs.items()}
    assert got == {d: v for d, v in want.items() if v}
    assert {x for v in want.values() for x in v} >= {"S1", "S3", "S4", "S5", "remainder"}


def register_words():
    b = "Sans-Bold"
    return [
        word("p", 0, 50.0, 60.0, "Cover"),
        word("p", 1, 20.0, 60.0, "Preamble"),
        word("p", 1, 50.0, 60.0, "MEMBERS", b, 14.0),
        word("p", 1, 80.0, 60.0, "Doe,", b), word("p", 1, 80.0, 95.0, "Ann", b),
        word("p", 1, 100.0, 60.0, "(X,", b), word("p", 1, 100.0, 90.0, "Oslo)", b),
        word("p", 1, 120.0, 60.0, "on"), word("p", 1, 120.0, 90.0, "leave"),
        word("p", 1, 140.0, 60.0, "§"), word("p", 1, 140.0, 70.0, "2"), word("p", 1, 140.0, 90.0, "Posts"), word("p", 1, 140.0, 240.0, "Board"), word("p", 1, 140.0, 290.0, "seat"),
        word("p", 1, 160.0, 240.0, "since"), word("p", 1, 160.0, 280.0, "2020"),
        word("p", 1, 180.0, 60.0, "§9"), word("p", 1, 180.0, 90.0, "Shares"),
        word("p", 1, 200.0, 60.0, "bought"),
        word("p", 1, 220.0, 60.0, "Company", b, 9.0), word("p", 1, 220.0, 200.0, "Date", b, 9.0), word("p", 1, 220.0, 300.0, "Date", b, 9.0),
        word("p", 1, 240.0, 62.0, "Acme", size=9.0), word("p", 1, 240.0, 205.0, "2021", size=9.0), word("p", 1, 240.0, 305.0, "2022", size=9.0),
        word("p", 1, 260.0, 60.0, "Roe,", b), word("p", 1, 260.0, 95.0, "Bo", b), word("p", 1, 260.0, 130.0, "(Y)", b),
        word("p", 1, 280.0, 60.0, "stray", size=9.0),
    ]


def test_register_tables(spark):
    meta = spark.createDataFrame([("p", "2026-01-01", "u", "h", 2), ("q", "2026-02-01", "u", "h2", 1)], "doc_id string, date string, url string, file_hash string, n_pages int")
    t = register_layout.parse(spark.createDataFrame(register_words(), WORDS), meta)
    docs = {d.date: d for d in t.documents.collect()}
    assert docs["2026-01-01"].cover_text == "Cover" and docs["2026-01-01"].reglement_text == "Preamble" and docs["2026-01-01"].n_persons == 2
    assert json.loads(docs["2026-01-01"].remainder_json) == [{"page": 1, "top": 280.0, "text": "stray"}]
    assert docs["2026-02-01"].n_persons == 0 and docs["2026-02-01"].column_split == 205.0 and docs["2026-02-01"].remainder_json == "[]"
    a, b = t.persons.orderBy("person_index").collect()
    assert (a.person_header, a.name, a.party, a.constituency, a.note, a.n_sections, a.n_transaction_rows) == ("Doe, Ann (X, Oslo)", "Doe, Ann", "X", "Oslo", "on leave", 2, 1)
    assert (b.name, b.party, b.constituency, b.note, b.section_heading) == ("Roe, Bo", "Y", None, None, "MEMBERS")
    s1, s2 = t.sections.orderBy("section_order").collect()
    assert (s1.paragraf, s1.label, s1.text, s1.n_lines) == ("§2", "Posts", "Board seat\nsince 2020", 2)
    assert (s2.paragraf, s2.label, s2.text, s2.n_lines) == ("§9", "Shares bought", "", 0)
    (x,) = t.transactions.collect()
    assert (x.paragraf, x.row_index, x.cells_json) == ("§9", 1, '{"Company":"Acme","Date":"2022"}')


def test_form_tables(spark):
    b = "Sans-Bold"
    w = [
        word("f", 0, 50.0, 60.0, "Register"), word("f", 0, 80.0, 60.0, "Generert"), word("f", 0, 80.0, 140.0, "05-03-2024"),
        word("f", 1, 40.0, 60.0, "Ann", b, 15.0), word("f", 1, 40.0, 95.0, "Doe", b, 15.0),
        word("f", 1, 70.0, 60.0, "(X,"), word("f", 1, 70.0, 90.0, "Oslo)"),
        word("f", 1, 100.0, 60.0, "Post", b), word("f", 1, 100.0, 300.0, "Minister"),
        word("f", 1, 114.0, 60.0, "held", b), word("f", 1, 114.0, 300.0, "now"),
        word("f", 1, 150.0, 60.0, "Shares", b), word("f", 1, 150.0, 300.0, "Count", b),
        word("f", 1, 165.0, 60.0, "stray"),
    ]
    meta = spark.createDataFrame([("f", "20240307", "u", "w", "h", 2)], "doc_id string, wayback_ts string, source_url string, wayback_url string, file_hash string, n_pages int")
    t = form_layout.parse(spark.createDataFrame(w, WORDS), meta)
    (d,) = t.smk_documents.collect()
    assert (d.generated, d.n_persons, d.n_remainder_lines) == ("2024-03-05", 1, 1)
    (p,) = t.smk_persons.collect()
    assert (p.name, p.affiliation, p.parti, p.fylke, p.n_fields) == ("Ann Doe", "(X, Oslo)", "X", "Oslo", 2)
    f1, f2 = t.smk_fields.orderBy("field_order").collect()
    assert (f1.field_label, f1.value, f1.is_header) == ("Post held", "Minister\nnow", False)
    assert (f2.field_label, f2.value, f2.is_header) == ("Shares", "Count", True)


def test_cells_and_headers(spark):
    w = [(0.0, 5.0, "a"), (13.0, 20.0, "b"), (29.0, 30.0, "c"), (500.0, 510.0, "d")]
    df = spark.createDataFrame([([dict(x0=a, x1=b, text=t) for a, b, t in w], [dict(text="h1", x0=0.0, x1=10.0), dict(text="h2", x0=24.0, x1=40.0)])], "ws array<struct<x0:double,x1:double,text:string>>, hs array<struct<text:string,x0:double,x1:double>>")
    r = df.select(lines.cells(F.col("ws")).alias("c"), lines.map_row(lines.cells(F.col("ws")), F.col("hs")).alias("m")).first()
    assert [c.text for c in r.c] == ["a b", "c", "d"]
    assert r.m == ["a b", "c d"]


def test_line_starts_equal_a_fold():
    rng = random.Random(8)
    for _ in range(2000):
        tops = sorted(round(rng.random() * rng.choice((3, 30, 300)), rng.choice((0, 1, 2))) + rng.choice((0.0, 0.1, 0.7)) for _ in range(rng.randint(0, 40)))
        anchor, want = None, []
        for k, t in enumerate(tops):
            if anchor is None or abs(t - anchor) > 2.5:
                anchor = t
                want.append(k)
        assert lines.line_starts(np.array(tops, float), 2.5) == want
    assert lines.line_starts(np.array([np.nan, np.nan, 1.0, 2.0]), 2.5) == [0, 1, 2]


def test_cells_equal_a_fold(spark):
    rng = random.Random(9)
    rows = []
    for k in range(300):
        x, ws = 0.0, []
        for _ in range(rng.randint(0, 12)):
            x += rng.choice((1.0, 8.0, 8.5, 30.0))
            end = x + rng.randint(1, 5)
            ws.append((x, rng.choice((end, end, end, None)), rng.choice(("a", "b", ""))))
            x = end
        rows.append((k, ws))
    df = spark.createDataFrame([(k, [dict(x0=a, x1=b, text=t) for a, b, t in ws]) for k, ws in rows], "k int, ws array<struct<x0:double,x1:double,text:string>>")
    got = {r.k: [tuple(c) for c in r.c] for r in df.select("k", lines.cells(F.col("ws")).alias("c")).collect()}
    for k, ws in rows:
        want = []
        for x0, x1, t in ws:
            if want and not (want[-1][2] is not None and x0 - want[-1][2] > 8.0):
                old = want[-1]
                want[-1] = (f"{old[0]} {t}", old[1], x1)
            else:
                want.append((t, x0, x1))
        assert got[k] == want


def test_grouping_is_linear_in_a_page(spark):
    """10^5 words on one page, in lines of their own, and 10^5 cells on one line."""
    assert len(lines.line_starts(np.arange(100_000) * 3.0, 2.5)) == 100_000
    page = spark.range(100_000).select(F.lit("d").alias("doc_id"), F.lit(0).alias("page"), F.lit(1e9).alias("page_height"), F.lit("w").alias("text"), F.lit(1.0).alias("x0"), F.lit(2.0).alias("x1"), (F.col("id") * 3.0).alias("top"), F.lit("F").alias("fontname"), F.lit(11.0).alias("size"))
    began = time.monotonic()
    assert lines.group_lines(lines.body_words(page)).count() == 100_000
    row = spark.sql("select transform(sequence(0, 99999), i -> struct(i * 20.0D as x0, i * 20.0D + 5 as x1, 'w' as text)) as ws")
    assert row.select(F.size(lines.cells(F.col("ws")))).first()[0] == 100_000
    assert time.monotonic() - began < 60
