import re
from collections import Counter

from registra.llm.quality import filter_kept, quality

from .docs import DDL, awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    repeat = {i + k for i, t in enumerate(tri) if n[t] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat)


def test_counts_match_brute_force(spark):
    rows = awkward() + [(200, "a b c a b c a b c", "en", "a", 0, "", ""), (201, "p q r\n\np q r\n s|t #", "en", "a", 0, "", ""), (202, "a a a a", "en", "a", 0, "", "")]
    got = quality(spark.createDataFrame(rows, DDL)).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], brute(r[1])) for r in rows)
    assert Counter((g.doc_id, (g.q_n_words, g.q_word_chars, g.q_n_symbols, g.q_n_dup_lines, g.q_n_repeat_words)) for g in got) == want
    for g in got:
        assert g.q_base_failed == (g.q_n_words < 50 or 100 * g.q_n_repeat_words > 50 * g.q_n_words)
        assert not (g.q_base_failed and g.q_kept)


def test_filter_keeps_columns_and_clean_rows(spark):
    df = spark.createDataFrame(awkward(), DDL)
    kept = filter_kept(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(30)) - {None}
    assert filter_kept(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = quality(spark.createDataFrame(awkward(), DDL))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_named_like_metrics_stay(spark):
    df = spark.createDataFrame(awkward(), DDL)
    clash = df.withColumnRenamed("q", "q_words").withColumnRenamed("extra", "QQ_kept")
    got = quality(clash)
    assert got.columns[: len(clash.columns)] == clash.columns and "qqq_n_words" in got.columns
    want = sorted((str(r.doc_id), r.q_n_words, r.q_kept) for r in quality(df).collect())
    assert sorted((str(r.doc_id), r.qqq_n_words, r.qqq_kept) for r in got.collect()) == want
    assert filter_kept(clash).columns == clash.columns and filter_kept(clash).count() == filter_kept(df).count()
