import hashlib
import random
import re

from skein.llm import phrase_index

from .messy import lower, messy, messy_rows

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(docs, items, size=13):
    windows = set()
    for item, text in items:
        found = re.findall(WORD, lower(text))
        for at in range(max(1, len(found) - size + 1) if found else 0):
            windows.add((str(item) if item is not None else "null", tuple(found[at:at + size])))
    out = []
    for key, text in docs:
        found, hit, names = re.findall(WORD, lower(text)), set(), set()
        for item, window in windows:
            for at in range(len(found) - len(window) + 1):
                if tuple(found[at:at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    names.add(item)
        out.append((key, len(found), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(found)))
    return sorted(out, key=repr)


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_random_texts_against_brute_force(spark):
    draw = random.Random(11)
    text = lambda n, k: " ".join(draw.choices("a b c the of É 7x".split()[:k], k=n))
    items = [(at, text(draw.choice([0, 1, 2, 3, 12, 13, 14, 20, 30]), draw.choice([2, 7]))) for at in range(25)]
    docs = [(at, text(draw.randint(0, 60), draw.choice([2, 7]))) for at in range(60)]
    docs += [(100 + at, f"{text(5, 7)}. {items[at][1].upper()}-{text(300 * (at % 2), 7)}") for at in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = phrase_index.contamination(frame, table(spark, items)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(docs, items)


def test_messy_tables(spark):
    items = [(1, "one TWO three"), (2, None), (3, ""), (None, "dolor sit amet lorem"), (1, "one TWO three"), (4, "日本語")]
    rows = [(k, t) for k, t, *_ in messy_rows()]
    found = phrase_index.contamination(messy(spark), table(spark, items)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, items)
    assert phrase_index.contamination(messy(spark, 0), table(spark, items)).collect() == []
    clean = phrase_index.contamination(messy(spark), table(spark, [])).collect()
    assert len(clean) == len(rows) and not any(r.contaminated or r.n_items for r in clean)


def test_blocks_of_queries_and_small_segments(spark, monkeypatch):
    monkeypatch.setattr(phrase_index, "BLOCK_WORDS", 5)
    monkeypatch.setattr(phrase_index, "SEGMENT_BYTES", 40)
    monkeypatch.setattr(phrase_index, "STEP", 3)
    items = [(at, f"p{at} q r s") for at in range(6)] + [(9, "q r s")]
    docs = [(at, f"x p{at} q r s y p{at + 1} q r s") for at in range(8)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    found = phrase_index.contamination(frame, table(spark, items)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(docs, items)


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox"), (2, "the quick red brown fox"), (3, "fox brown quick the"),
                                  (4, "quick"), (5, "brown fox")], "doc_id long, text string").coalesce(1)
    index = phrase_index.build(docs)
    queries = spark.createDataFrame([("a", "quick brown fox")], "name string, text string")
    exact = phrase_index.matches(index, queries, "name").collect()
    assert [tuple(r) for r in exact] == [(1, "a", 3, 1)]
    near = phrase_index.matches(index, queries, "name", slop=1).collect()
    assert {r.doc_id for r in near} == {1, 2}
