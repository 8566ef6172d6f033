import json

from pyspark.sql import functions as F

from registra.functions import scalars as S


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


def test_header_shapes(spark):
    cases = {
        "Surname, Given (P, Region)": ("Surname, Given", "P", "Region"), "Surname, Given (P)": ("Surname, Given", "P", None), "No Parens Here": ("No Parens Here", None, None),
        "N, (3, P, A, B)": ("N", "P", "A, B"), "N (a (b), c)": ("N", "a (b)", "c"), "N ()": ("N", None, None), "N (x": ("N (x", None, None), "N (, r)": ("N", "", "r"),
    }
    for header, want in cases.items():
        assert tuple(one(spark, header, S.header_carve)) == want, header
    assert tuple(one(spark, None, S.header_carve)) == (None, None, None)


def test_numbers(spark):
    cases = {"12 000": (12000.0, 12000), "12,5": (12.5, 12), "-12.9": (-12.9, -12), "1.000.000": (None, None), "abc": (None, None), "": (None, None), "12d": (None, None), "1_000": (1000.0, 1000), None: (None, None), "1e3": (1000.0, 1000), "1e30": (1e30, None)}
    for v, (d, n) in cases.items():
        assert (one(spark, v, S.to_double), one(spark, v, S.to_long)) == (d, n), v
    assert one(spark, "  ", S.to_text) is None and one(spark, " a ", S.to_text) == "a"


def test_text(spark):
    assert one(spark, "  \n", S.non_empty) is False and one(spark, None, S.non_empty) is False and one(spark, "x", S.non_empty) is True
    assert one(spark, "  Straße  Å ", S.norm) == "strasse å"
    assert one(spark, "Berg-Hansen, Ola", S.tokens) == ["berg", "hansen", "ola"]
    assert one(spark, "a|b\nc", S.md_escape) == "a\\|b<br>c" and one(spark, None, S.md_escape) == ""
    assert one(spark, "/Date(-86400000+0100)/ tail", S.dotnet_date) == "1969-12-31" and one(spark, "x", S.dotnet_date) is None and one(spark, None, S.dotnet_date) is None
    assert one(spark, "a/b/c.pdf", S.basename) == "c.pdf"
    assert one(spark, "GENERERT  05-03-2024 11:00", S.generated_date) == "2024-03-05" and one(spark, "none", S.generated_date) is None
    assert tuple(one(spark, "(P, F, G)", S.affiliation)) == ("P", "F, G") and tuple(one(spark, "()", S.affiliation)) == (None, None)
    assert tuple(one(spark, "Sur, Giv, X", S.name_parts)) == ("Sur", "Giv, X")


def test_zip_json(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["1", None, "3", "4"])], "h array<string>, r array<string>")
    assert df.select(S.zip_json("h", "r").alias("j")).first().j == '{"a":"3","b":null}'
    assert df.select(S.json_cell(S.zip_json("h", "r"), "a").alias("j")).first().j == "3"
    keys = ["a'b", 'a"b', "a'\"b", "a.b[0]", "", "none"]
    cells = spark.createDataFrame([(json.dumps({k: f"v {k} 1.50" for k in keys[:-1]}), "x"), ("no json", "x"), (None, "x"), ("[1]", "x")], "c string, x string")
    got = [[r[k] for k in range(len(keys))] for r in cells.select(*[S.json_cell("c", k) for k in keys]).collect()]
    assert got == [[f"v {k} 1.50" for k in keys[:-1]] + [None]] + [[None] * len(keys)] * 3


def test_markers(spark):
    df = spark.createDataFrame([(["§", "2", "x"],), (["§7", "x"],), (["§"],)], "t array<string>")
    assert [(r.c.marker, r.c.rest) for r in df.select(S.consume_marker("t").alias("c")).collect()] == [("§2", ["x"]), ("§7", ["x"]), ("§", [])]
    assert [one(spark, t, S.is_marker) for t in ("§", "§9", "1.", "12.", "123.", "1", None)] == [True, True, True, True, False, False, False]


def test_block_hash(spark):
    import hashlib

    df = spark.createDataFrame([("§1", "l", "tø")], "a string, b string, c string")
    assert df.select(S.block_hash("a", "b", "c").alias("h")).first().h == hashlib.sha256("§1\nl\ntø".encode()).hexdigest()
