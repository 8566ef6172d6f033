from pyspark.sql import functions as F

from registra.operators.resolve import name_changes, pools, resolve

POOL = "ord long, api_person_id string, etternavn string, fornavn string, foedselsdato string, kjoenn string, partier array<string>, fylker array<string>"
PERSONS = "date string, person_index int, section_heading string, person_header string, name string, party string, constituency string"


def test_all_eight_outcomes(spark):
    pool = [
        (1, "a", "Hansen", "Ola", "1960", "m", ["x"], ["oslo"]), (2, "b", "Hansen", "Ola Per", "1970", "m", ["y"], ["oslo"]),
        (3, "c", "Lie", "Kari", "1950", "k", ["x"], ["viken"]), (4, "d", "Lie", "Kari", "1955", "k", ["y"], ["oslo"]),
        (5, "e", "Berg-Dahl", "Ida Marie", "1980", "k", [], []), (6, "e2", "Berg-Dahl", "Ida Marie", "1980", "k", [], []),
        (7, "f", "Moe", "Jon A", "1940", "m", ["x"], ["troms"]), (8, "g", "Moe", "Jon B", "1941", "m", ["y"], ["agder"]),
        (9, "h", "Vik", "Per Otto", "1930", "m", ["x"], ["rogaland"]), (10, "i", "Otto", "Vik Per", "1931", "m", ["y"], ["oslo"]),
    ]
    names = [
        ("HANSEN,  ola", None, None, "exact", "a"), ("Lie, Kari", "Y", None, "exact+context", "d"), ("Lie, Kari", None, "Viken", "exact+context", "c"), ("Lie, Kari", None, "Nowhere", "ambiguous", None),
        ("Berg-Dahl, Ida M.", None, None, "surname_first_token", "e"), ("Moe, Jon", None, "Agder", "surname_first_token+context", "g"), ("Moe, Jon", "Z", None, "ambiguous", None),
        ("Ida Berg Dahl Marie", None, None, "token_set", "e"), ("Per Vik Otto", "X", "Rogaland", "token_set+context", "h"), ("Nobody, Here", "X", "Oslo", "unmatched", None),
    ]
    persons = spark.createDataFrame([("d", i, "h", n, n, p, r) for i, (n, p, r, _, _) in enumerate(names)], PERSONS)
    got = {r.person_index: (r.match_method, r.api_person_id) for r in resolve(persons, spark.createDataFrame(pool, POOL)).collect()}
    assert got == {i: (m, a) for i, (_, _, _, m, a) in enumerate(names)}
    assert resolve(persons, spark.createDataFrame([], POOL)).where("match_method <> 'unmatched'").count() == 0


def test_name_changes(spark):
    rows = [("2020", 1, "p", "A", "1950", "exact"), ("2021", 1, "p", "A", "1950", "token_set"), ("2022", 1, "p", "B", "1951", "exact"), ("2020", 2, "q", "C", "1", "exact"), ("2020", 3, None, "D", None, "unmatched")]
    df = spark.createDataFrame(rows, "date string, person_index int, api_person_id string, name string, foedselsdato string, match_method string")
    got = [tuple(r) for r in name_changes(df).orderBy("first_date").collect()]
    assert got == [("p", "1951", "A", "2020", "2021", 2, "exact,token_set"), ("p", "1951", "B", "2022", "2022", 1, "exact")]


def test_a_key_that_many_share(spark):
    """10^5 people of one name: summaries by region and party, no list of people."""
    pool = spark.range(100_000).select(
        F.col("id").alias("ord"), F.col("id").cast("string").alias("api_person_id"), F.lit("Lie").alias("etternavn"), F.lit("Kari").alias("fornavn"), F.col("id").cast("string").alias("foedselsdato"), F.lit("k").alias("kjoenn"),
        F.array(F.when(F.col("id") == 70_000, "rare").otherwise("x")).alias("partier"), F.array(F.concat(F.lit("r"), (F.col("id") % 5).cast("string"))).alias("fylker"))
    (row,) = [r for r in pools(pool, True).where("method = 'exact'").collect()]
    assert len(row.groups) == 1 + 5 + 2 + 6 and row.groups[""].n == 100_000 and not row.groups[""].one
    persons = spark.createDataFrame([("d", k, "h", "n", "Lie, Kari", p, r) for k, (p, r) in enumerate((("rare", None), ("rare", "r0"), ("rare", "r1"), ("x", "r1"), (None, None)))], PERSONS)
    got = {r.person_index: (r.match_method, r.api_person_id) for r in resolve(persons, pool, nfc=True).collect()}
    assert got == {0: ("exact+context", "70000"), 1: ("exact+context", "70000"), 2: ("ambiguous", None), 3: ("ambiguous", None), 4: ("ambiguous", None)}
    plan = resolve(persons, pool, nfc=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1


def test_name_changes_are_in_order(spark):
    rows = [(f"20{k % 20:02d}", k, f"p{k % 3}", f"n{k % 7}", "1", "exact") for k in range(60)]
    df = spark.createDataFrame(rows, "date string, person_index int, api_person_id string, name string, foedselsdato string, match_method string")
    got = [(r.api_person_id, r.first_date, r.printed_name) for r in name_changes(df).collect()]
    assert got == sorted(got) and len(got) == 21


def test_names_are_folded_once(spark):
    """However many snapshots print a name, one evaluation in Python; ASCII names none at all."""
    names = [("Åsen, Kåre", "x", "r1"), ("Strauß, Ida", None, "r2"), ("Lie, Kari", "x", None), ("Lie, Kari", None, None), (None, None, None)]
    persons = spark.createDataFrame([(f"d{k}", k * 10 + i, "h", "n", n, p, r) for k in range(40) for i, (n, p, r) in enumerate(names)], PERSONS)
    pool = spark.createDataFrame([(1, "a", "ÅSEN", "Kåre", "1960", "m", [], []), (2, "b", "STRAUSS", "Ida", "1970", "k", [], []), (3, "c", "Lie", "Kari", "1950", "k", [], [])], POOL)
    out = resolve(persons, pool)
    got = {}
    for r in out.collect():
        got.setdefault((r.name, r.party, r.constituency), []).append((r.date, r.api_person_id, r.match_method))
    assert {k: {v[1:] for v in vs} for k, vs in got.items()} == {n: {w} for n, w in zip(names, (("a", "exact"), ("b", "exact"), ("c", "exact"), ("c", "exact"), (None, "unmatched")), strict=True)}
    assert all(len({v[0] for v in vs}) == len(vs) == 40 for vs in got.values())
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    evals = [i for i, line in enumerate(plan) if "ArrowEvalPython" in line]
    assert sorted(plan[i].count("_fold(") for i in evals) == [3, 5]
    assert sum("Aggregate [name" in plan[i + 1] for i in evals) == 1  # of the persons, the distinct ones


def test_norm_is_the_same_on_either_way(spark):
    import unicodedata

    from registra.functions import scalars as S

    texts = ["", " ", "A", "a\x1cB\x1f\tC ", "\x0bx\x0c", "\x00 Q\x7f", "É é", "ﬁ İ ẞ", " Å\u00a0B", None, "A\x85", "x" * 5000 + " Y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(S.norm("t").alias("n")).collect()]
    assert got == [None if t is None else unicodedata.normalize("NFC", " ".join(t.split())).casefold() for t in texts]
