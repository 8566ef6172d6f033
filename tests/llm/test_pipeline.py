"""Every stage of the corpus pipeline against a plain version of itself, and the whole run."""

from collections import Counter

import corpus_pipeline
from registra.llm.tokens import default_paths

from .docs import DDL, awkward
from .test_near_dup import brute as groups
from .test_quality import brute as counts


def docs(spark):
    rows = [r[:5] for r in awkward()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, tmp_path):
    names = ["quality_rules", "minhash_near_dedup", "substring_dedup", "mix_sources", "pack_sequences"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    df, before = docs(spark), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, "")
        if k < 4:
            assert out.columns == df.columns
        out.write.parquet(f"{tmp_path}/{name}")
        before, df = df, spark.read.parquet(f"{tmp_path}/{name}")
        old, new = [tuple(r) for r in before.collect()], [tuple(r) for r in df.collect()]
        if name == "quality_rules":
            assert set(new) <= set(old)
            for r in set(old) - set(new):
                n, _, _, _, rep = counts(r[1])
                assert n < 50 or 100 * rep > 50 * n or n == 9000
        elif name == "minhash_near_dedup":
            want = groups([(r[0], r[1]) for r in old])
            assert sorted({r[0] for r in new}, key=str) == sorted({w[0] for w in want if w[0] == w[2]}, key=str)
            assert len(new) == len({r[0] for r in new})
        elif name == "substring_dedup":
            assert {r[0] for r in new} <= {r[0] for r in old}
            assert all(len(r[1]) <= len(dict((o[0], o[1]) for o in old)[r[0]]) for r in new)
        elif name == "mix_sources":
            assert set(new) <= set(old) and max(Counter(new).values()) <= 3
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(default_paths()[0])
            want = sum(len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in old)
            assert sum(r[2] for r in new) == want


def test_run(spark, tmp_path):
    docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_registered():
    import __spark_entry__ as e

    q = e.queries()
    assert "pipeline" in q and all(any(k.startswith(f"op{n}_") for k in q) for n in range(1, 11))


def test_scratch_tables_have_no_marker_file(spark):
    """Each such file costs the driver processes of its memory's size; the tables are read all the same."""
    from registra.llm.common import Scratch

    scratch = Scratch(spark, "marks")
    for rows in (spark.range(10), spark.range(0)):
        out = scratch.write(rows, "t")
        path = spark._jvm.org.apache.hadoop.fs.Path(scratch._paths["t"])
        found = [f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
        assert "_SUCCESS" not in found and out.count() == rows.count()
    scratch.close()
