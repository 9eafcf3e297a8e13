import hashlib
from collections import Counter, defaultdict

import numpy as np

from skein.llm import quotient

from .messy import lower, messy, messy_rows


def test_messy_table_against_brute_force(spark):
    rows = quotient.exact_groups(messy(spark)).collect()
    groups = defaultdict(list)
    for key, text, *_ in messy_rows():
        groups[lower(text)].append(key)
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows)
    wanted = Counter()
    for text, keys in groups.items():
        best = max((k for k in keys if k is not None), default=None)
        for key in keys:
            wanted[key, best, len(keys), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert found == wanted
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_rows_come_along(spark):
    docs = messy(spark)
    kept = quotient.exact_groups(docs, rows=True).filter("kept").select("row.*")
    assert kept.columns == docs.columns
    assert kept.count() == len({lower(t) for _, t, *_ in messy_rows()})
    assert quotient.exact_groups(messy(spark, 0)).collect() == []


def test_large_group_of_copies_and_many_partitions(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'Same text', concat('text ', id)) as text").repartition(40)
    rows = quotient.exact_groups(docs).collect()
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id % 3 == 0} == {(2997, 1000)}
    assert all(r.group_size == 1 and r.kept for r in rows if r.doc_id % 3)


def test_merging_filters_loses_nothing(spark):
    docs = spark.range(500).selectExpr("cast(id % 90 as string) as text").repartition(7)
    parts = quotient.filters(docs)
    for whole in (quotient.merged(parts),):
        counts = Counter()
        for row in whole.collect():
            assert row.remainders == sorted(set(row.remainders))
            for remainder, n in zip(row.remainders, row.counts):
                counts[(row.quotient << (64 - quotient.QUOTIENT_BITS)) | remainder] += n
        wanted = Counter(quotient.fingerprint(hashlib.sha256(str(i % 90).encode()).digest()) for i in range(500))
        assert counts == wanted


def test_colliding_places_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(quotient, "repeated_bits", lambda whole: b"\xff" * (1 << (quotient.ROUTE_BITS - 3)))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    rows = {r.doc_id: (r.keep_id, r.group_size) for r in quotient.exact_groups(docs).collect()}
    assert rows == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


def test_pack_keeps_all_bits():
    values = np.unique(np.array([0, 1, 1 << 63, (1 << 64) - 1, 12345678901234567890], np.uint64))
    batch = quotient.pack(values, np.arange(1, len(values) + 1))
    back = [(q << 52) | r for q, rs in zip(batch["quotient"].to_pylist(), batch["remainders"].to_pylist()) for r in rs]
    assert back == values.tolist()
