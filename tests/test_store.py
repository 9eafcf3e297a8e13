import pytest
from pyspark.sql import functions as F

from skein.sources import store
from skein.streaming import sinks

SCHEMA = "id long, name string"


def rows_of(spark, path):
    return sorted(tuple(r) for r in store.read_store(spark, path, SCHEMA).collect())


def test_a_store_is_rewritten_where_it_lies(spark, tmp_path):
    path = str(tmp_path / "store")
    assert rows_of(spark, path) == []
    assert store.rewrite_store(spark.createDataFrame([(1, "a"), (2, None), (2, None)], SCHEMA), path) == 3
    stored = store.read_store(spark, path, SCHEMA)
    assert store.rewrite_store(stored.filter("id = 2").unionAll(stored), path) == 5
    assert rows_of(spark, path) == [(1, "a")] + [(2, None)] * 4
    assert sorted(p.name for p in (tmp_path / "store").iterdir() if not p.name.startswith("."))[0] == "CURRENT"
    assert len(list((tmp_path / "store").glob("version-*"))) == 1
    assert store.rewrite_store(stored.limit(0), path) == 0 and rows_of(spark, path) == []


@pytest.mark.parametrize("step", ["validate", "replace_text", "delete"])
def test_a_failure_between_the_steps_leaves_a_whole_store(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "store")
    store.rewrite_store(spark.createDataFrame([(1, "old")], SCHEMA), path)
    new = store.read_store(spark, path, SCHEMA).withColumn("name", F.lit("new"))

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store if step == "validate" else store.Folder, step, fail)
        with pytest.raises(RuntimeError):
            store.rewrite_store(new, path)
    assert rows_of(spark, path) == [(1, "new" if step == "delete" else "old")]
    store.rewrite_store(store.read_store(spark, path, SCHEMA), path)
    assert len(list((tmp_path / "store").glob("version-*"))) == 1


def test_too_few_rows_are_not_switched_to(spark, tmp_path):
    path = str(tmp_path / "store")
    store.rewrite_store(spark.createDataFrame([(1, "old")], SCHEMA), path)
    with pytest.raises(ValueError):
        store.validate(spark, store.current_version(spark, path), spark.createDataFrame([], SCHEMA).schema, "json", 2)


def test_lines_are_rolled_by_rows_and_bytes(spark, tmp_path):
    path = str(tmp_path / "out")
    lines = [f"{i:03d}" for i in range(50)] + ["é" * 60, None, "", "x" * 20]
    frame = spark.createDataFrame([(x, 1) for x in lines], "value string, _file int").coalesce(1)
    names = store.rolled_text(frame, path, "log", ".txt", max_rows=7, max_bytes=40)
    files = [(tmp_path / "out" / n).read_bytes() for n in names]
    assert b"".join(files).decode().split("\n")[:-1] == [x or "" for x in lines]
    for data in files:
        assert data.count(b"\n") <= 7 and (len(data) <= 40 or data.count(b"\n") == 1)
    assert all(n.startswith("log-0-00000-") and n.endswith(".txt") for n in names)
    # The same run again replaces its files; another run adds to them.
    assert store.rolled_text(frame.limit(3), path, "log", ".txt") == ["log-0-00000-00000.txt"]
    store.rolled_text(frame.limit(3), path, "log", ".txt", run="1")
    assert sorted(p.name for p in (tmp_path / "out").glob("log*")) == ["log-0-00000-00000.txt", "log-1-00000-00000.txt"]
    assert store.rolled_text(frame.limit(0), path, "none", ".txt") == []


def merged(spark, path, batches, every=3):
    for at, batch in batches:
        sinks.merge_changes(spark.createDataFrame(batch, "k string, n long"), at, path, ["k"], every)
    return {r.k: r.n for r in sinks.read_changes(spark, path, ["k"], "k string, n long").collect()}


def test_changes_are_compacted_and_batches_may_come_again(spark, tmp_path):
    path = str(tmp_path / "counts")
    assert merged(spark, path, []) == {}
    batches = [(i, [("a", i), (f"k{i}", i), (None, -i)]) for i in range(8)]
    expected = {"a": 7, None: -7} | {f"k{i}": i for i in range(8)}
    assert merged(spark, path, batches) == expected
    assert sorted(p.name for p in (tmp_path / "counts").iterdir()) == ["changes-6", "changes-7", "snapshot-5"]
    assert merged(spark, path, [(5, [("a", 500)]), (4, [("z", 1)])]) == expected  # held by the snapshot already
    assert merged(spark, path, [batches[7]]) == expected
    # A crash after the snapshot leaves what it holds; the next merge clears it.
    (tmp_path / "counts" / "snapshot-3").mkdir()
    spark.createDataFrame([("a", 1)], "k string, n long").write.parquet(f"{path}/changes-2")
    assert merged(spark, path, [(8, [("a", 8)])]) == expected | {"a": 8}
    assert sorted(p.name for p in (tmp_path / "counts").iterdir()) == ["snapshot-8"]


def test_late_rows_are_kept_apart(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part, rows in (("a", [(1, "2024-01-05 00:00:00"), (2, None)]), ("b", [(3, "2024-01-01 00:00:00"), (4, "2024-01-09 00:00:00")]),
                       ("c", [(5, "2024-01-07 23:59:59"), (6, "2024-01-08 00:00:00"), (7, None)])):
        spark.createDataFrame(rows, "id long, at string").selectExpr("id", "cast(at as timestamp) as at").coalesce(1).write.parquet(f"{source}/{part}")
    stream = spark.readStream.schema("id long, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    sinks.finish(sinks.split_late(stream, out, "at", "1 day", availableNow=True))
    rows = spark.read.parquet(f"{out}/rows")
    assert sorted(r.id for r in rows.filter("part = 'late'").collect()) == [3, 5]
    assert rows.count() == 7
    assert spark.read.parquet(f"{out}/counts").agg(F.sum("n"), F.sum("n_late")).first()[:] == (7, 2)
