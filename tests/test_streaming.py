import json

from registra.streaming import incremental as stream

SCHEMA = "date string, file_hash string"


def test_available_now_takes_each_change_once(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def put(name, *rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(("date", "file_hash"), r))) for r in rows))

    stored, seen = [], []

    def store():
        return spark.createDataFrame([(*r, "1") for r in stored], "date string, file_hash string, parser_version string")

    def handle(df, epoch):
        new = [tuple(r)[:2] for r in df.select("date", "file_hash").collect()]
        seen.append(sorted(new))
        stored.extend(new)

    def go():
        s = stream.manifest_stream(spark, str(tmp_path / "in"), SCHEMA)
        stream.run_available(s, str(tmp_path / "ck"), store, handle, "1")

    put("a.json", ("2020", "h"), ("2020", "h"), ("2021", "h"))
    go()
    put("b.json", ("2021", "h"), ("2021", "h2"))
    go()
    go()
    assert seen == [[("2020", "h"), ("2021", "h")], [("2021", "h2")]]


def test_state_is_dropped_and_the_store_refuses_late_repeats(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stored, taken, kept = [], [], []

    def handle(df, epoch):
        new = [tuple(r)[:2] for r in df.select("date", "file_hash").collect()]
        taken.extend(new)
        stored.extend(new)

    def go(name, *rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(("date", "file_hash", "seen"), r))) for r in rows))
        s = stream.manifest_stream(spark, str(tmp_path / "in"), SCHEMA + ", seen timestamp")
        store = lambda: spark.createDataFrame([(*r, "1") for r in stored], "date string, file_hash string, parser_version string")
        q = stream.run_available(stream.deduplicated(s, "seen"), str(tmp_path / "ck"), store, handle, "1")
        kept.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])

    go("a.json", ("1", "h", "2026-01-01"), ("1", "h", "2026-01-02"), ("2", "h", "2026-01-01"))
    assert sorted(taken) == [("1", "h"), ("2", "h")] and kept == [2]
    go("b.json", ("1", "h", "2026-01-03"))  # still in the state
    go("c.json", ("3", "h", "2026-03-01"))
    go("d.json", ("1", "h", "2026-03-02"), ("4", "h", None))  # no longer known here, but in the store
    assert sorted(taken) == [(k, "h") for k in "1234"]
    assert kept[1] == 2 and kept[3] <= 3  # the keys of January are gone
