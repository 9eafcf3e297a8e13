import random

import pytest

from skein.operators import splits


@pytest.mark.parametrize("n,k", [(7, 5), (20, 5), (3, 5)])
def test_folds_are_contiguous_and_the_first_are_larger(spark, n, k):
    frame = spark.createDataFrame([(i,) for i in range(n)], "pos int")
    size, larger = divmod(n, k)
    expected = [f + 1 for f in range(k) for _ in range(size + (f < larger))]
    found = splits.contiguous_folds(frame, k, ["pos"]).orderBy("pos").collect()
    assert [r.fold for r in found] == expected
    test, train = splits.fold_pair(splits.contiguous_folds(frame, k, ["pos"]), 1, ["pos"])
    assert test.count() + train.count() == n


@pytest.mark.parametrize("cap", [0, 9, 10_000])
def test_leave_n_per_user(spark, cap):
    pick = random.Random(3)
    rows = [(i, 0 if i % 3 == 0 else pick.randrange(8)) for i in range(200)]
    seen, taken, expected = {}, 0, set()
    for pos, user in rows:
        seen[user] = seen.get(user, 0) + 1
        if (taken < cap or cap <= 0) and 2 <= seen[user] <= 4:
            taken += 1
            expected.add(pos)
    frame = spark.createDataFrame(rows, "pos int, user int")
    marked = splits.leave_n_per_user(frame, "user", ["pos"], 2, 4, cap)
    assert marked.count() == len(rows)
    assert {r.pos for r in marked.filter("is_test").collect()} == expected


def test_random_split_repeats_under_any_partitioning(spark):
    frame = spark.range(2000)
    one = splits.random_split(frame, [0.9, 0.1], 42, ["id"])
    other = splits.random_split(frame.repartition(7), [0.9, 0.1], 42, ["id"])
    ids = [sorted(r.id for r in part.collect()) for part in one]
    assert ids == [sorted(r.id for r in part.collect()) for part in other]
    assert sum(map(len, ids)) == 2000 and 120 < len(ids[1]) < 280
    assert sum(p.count() for p in splits.random_split(frame, [0.5, 0.5], 1)) == 2000
