import random
import time

import pytest
from pyspark.sql import functions as F

from skein.functions.skew import hot_keys, is_shuffled, is_small, lookup
from skein.operators.order import (advanced_since_previous, arg_extreme, day_of, first_ranks, previous_value,
                                   with_row_index)


def skewed(spark, n=300):
    pick = random.Random(7)
    rows = [(i, None if i % 11 == 0 else 0 if i % 3 == 0 else pick.randrange(40), pick.randrange(5))
            for i in pick.sample(range(10 * n), n)]
    return rows, spark.createDataFrame(rows, "pos int, key int, day int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffled_lookup_equals_plain_join(spark, how):
    _, rows = skewed(spark)
    per_key = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40, 2)], "key int, name string")
    plain = rows.join(per_key, "key", how)
    key = lambda r: r.pos
    for side in (per_key, per_key.groupBy("key").agg(F.max("name").alias("name"))):
        found = lookup(rows, side, "key", how, max_rows=0)
        assert found.columns == plain.columns
        assert sorted(found.collect(), key=key) == sorted(plain.collect(), key=key)


def test_lookup_shuffles_rows_once_and_can_be_split(spark):
    _, rows = skewed(spark)
    grouped = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = lookup(rows, grouped, "key", max_rows=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Aggregate" not in plan and plan.count("Exchange") == 2 == plan.count("ENSURE_REQUIREMENTS")


def test_rows_of_a_hot_key_are_split_at_run_time(spark):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 400_000, 1, 8).selectExpr("if(id % 4 = 0, id, 7) as key", "xxhash64(id) as load")
        per_key = spark.range(400_000).selectExpr("id as key", "id as n")
        joined = lookup(rows, per_key, "key", max_rows=0).groupBy(F.spark_partition_id().alias("at")).agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor("load"))
        assert max(r.n for r in joined.collect()) < 200_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_measures(spark):
    _, rows = skewed(spark)
    assert is_small(rows) and not is_small(rows, max_rows=10) and not is_small(rows, max_bytes=100)
    assert {r.key for r in hot_keys(rows, ["key"], 50).collect()} == {0}


def test_row_index(spark):
    rows, frame = skewed(spark)
    found = with_row_index(frame, ["day", F.col("pos").desc()]).collect()
    expected = sorted(rows, key=lambda r: (r[2], -r[0]))
    assert [r.pos for r in sorted(found, key=lambda r: r.row_index)] == [r[0] for r in expected]
    assert sorted(r.row_index for r in found) == list(range(len(rows)))


@pytest.mark.parametrize("key,sizes", [
    ("key", {}), ("key", {"group_rows": 20, "block_rows": 7}), (None, {"block_rows": 7})])
def test_previous_value(spark, key, sizes):
    rows, frame = skewed(spark)
    last, expected = {}, {}
    for pos, k, day in sorted(rows):
        expected[pos] = last.get(k if key else 0)
        last[k if key else 0] = day
    found = {r.pos: r.previous for r in previous_value(frame, "day", ["pos"], key, **sizes).collect()}
    assert found == expected


def test_advances(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01-01"), (2, "2024-01-03"), (3, "2024-01-02"), (4, "2024-01-02"), (5, "2024-02-01")],
        "pos int, time string")
    assert sorted(r.pos for r in advanced_since_previous(rows, "time", ["pos"], block_rows=2).collect()) == [2, 5]


@pytest.mark.parametrize("start,stop", [(1, 3), (2, 1500)])
def test_first_ranks(spark, start, stop):
    rows, frame = skewed(spark)
    groups = {}
    for pos, k, _ in sorted(r for r in rows if r[1] is not None):
        groups.setdefault(k, []).append(pos)
    expected = sorted(p for positions in groups.values() for p in positions[start - 1:stop])
    found = first_ranks(frame.dropna(), "key", ["pos"], start, stop)
    assert sorted(r.pos for r in found.collect()) == expected


def test_ranks_need_no_window_over_a_key(spark):
    _, frame = skewed(spark)
    plan = first_ranks(frame, "key", ["pos"], 1, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and "hashpartitioning(key" not in plan.split("Scan")[0]


def test_days_do_not_follow_the_session_zone(spark):
    rows = spark.createDataFrame([(1, 1_704_063_600)], "pos int, s long").selectExpr("pos", "timestamp_seconds(s) as t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", session)
            assert str(rows.select(day_of(rows, "t", "Europe/Prague").alias("d")).first().d) == "2024-01-01"
            assert str(rows.select(day_of(rows, "t").alias("d")).first().d) == "2023-12-31"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_first_of_tied_rows(spark):
    rows = spark.createDataFrame([(3, 9), (1, 9), (2, 5), (4, None)], "pos int, n int")
    assert arg_extreme(rows, "n", "max", "pos").first().pos == 1
    assert arg_extreme(rows, "n", "min", "pos").first().pos == 2


def test_a_probe_ends_early_on_a_large_side(spark):
    start = time.time()
    assert not is_small(spark.range(10**11))
    wide = spark.range(10**10).selectExpr("repeat('x', 100000) as x")
    assert not is_small(wide, max_rows=10**9)
    assert time.time() - start < 20
    assert is_small(spark.range(0)) and is_small(spark.range(9), max_rows=9) and not is_small(spark.range(10), max_rows=9)


def test_large_files_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(200_000).selectExpr("id", "xxhash64(id) as h").write.parquet(path)
    rows = spark.read.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    assert not is_small(rows.select("id"), max_bytes=1000)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert is_small(rows.filter("id < 5"), max_bytes=1000)


def test_shuffling_steps_are_told_by_the_plan(spark):
    rows = spark.range(5).selectExpr("id", "'Join (Aggregate [Window [' as text")
    assert not is_shuffled(rows) and not is_shuffled(rows.filter("text = 'Join '"))
    assert is_shuffled(rows.groupBy("text").count()) and is_shuffled(rows.distinct()) and is_shuffled(rows.join(rows.select("id"), "id"))
