import random
import time

import public_tokenizers
import pytest

from skein.llm import edit_counts

from .messy import messy, messy_rows

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def counter():
    assert edit_counts.PATTERN == public_tokenizers.PATTERN
    return edit_counts.Counter(edit_counts.rank_file(PATH))


def test_counts_after_random_edits_equal_a_fresh_count(counter):
    draw = random.Random(5)
    signs = "ab 'sre\n\t 12,.!éñ 　\x85中ll"
    words = ["".join(draw.choices("abcdést'", k=draw.randint(1, 9))) for _ in range(200)]
    starts = [" ".join(draw.choices(words, k=draw.randint(0, 900))) for _ in range(40)]
    encoded = total = 0
    for text in [*starts, "", "a", " " * 3000, "x" * 5000 + " y" * 900]:
        sizes, sums = counter.tree(text)
        assert sum(sizes) == len(text) and sums[1] == counter.count(text)
        for _ in range(4):
            edits, at = [], 0
            for _ in range(draw.randint(0, 4)):
                start = draw.randint(at, len(text))
                at = min(len(text), start + draw.choice([0, 0, 1, 3, 40, 700]))
                edits.append((start, at, "".join(draw.choices(signs, k=draw.choice([0, 1, 5, 30]))) * draw.choice([1, 1, 200])))
                if at == len(text):
                    break
            wanted, at = "", 0
            for start, stop, new in edits:
                wanted += text[at:start] + new
                at = stop
            wanted += text[at:]
            text, sizes, sums, n = counter.edit(text, sizes, sums, edits)
            assert text == wanted and sum(sizes) == len(text) and sums[1] == counter.count(text)
            width = len(sums) // 2
            assert all(sums[node] == sums[2 * node] + sums[2 * node + 1] for node in range(1, width))
            encoded, total = encoded + n, total + len(text)
    assert encoded < total


def test_a_small_edit_encodes_a_small_region(counter):
    text = "some words of a text that is long enough. " * 500
    _, _, _, encoded = counter.edit(text, *counter.tree(text), [(10_000, 10_003, "new")])
    assert encoded < 3 * edit_counts.LEAF


def test_messy_table(spark, counter):
    from pyspark.sql import functions as F
    edits = F.when(F.col("doc_id") % 2 == 0, F.expr("""array(
        struct(3 as start, 1 as stop, null as new), struct(cast(null as int) as start, 5 as stop, 'z' as new),
        struct(-4 as start, 2 as stop, 'Q ' as new), struct(1 as start, 99999999 as stop, 'end' as new))"""))
    trees = edit_counts.build(messy(spark).withColumn("edits", edits), PATH, keep=("edits",))
    rows = edit_counts.apply_edits(trees, PATH).collect()
    assert len(rows) == len(messy_rows())
    by_key = {}
    for key, text, *_ in messy_rows():
        by_key.setdefault(key, []).append(text or "")
    for row in rows:
        assert row.n_after == counter.count(row.text) == row.tree["sums"][1]
        assert row.n_before in [counter.count(t) for t in by_key[row.doc_id]]
        if row.doc_id is not None and row.doc_id % 2:
            assert row.text in by_key[row.doc_id] and row.n_encoded == 0
    empty = edit_counts.build(messy(spark, 0).withColumn("edits", edits), PATH, keep=("edits",))
    assert edit_counts.apply_edits(empty, PATH).collect() == []


def test_house_edits_on_messy_rows(spark, counter):
    docs = messy(spark).withColumn("edits", edit_counts.house_edits())
    rows = edit_counts.apply_edits(edit_counts.build(docs, PATH, keep=("edits",)), PATH).collect()
    assert all(row.n_after == counter.count(row.text) for row in rows)


def test_a_text_without_borders_is_cut_in_linear_time(counter):
    start = time.time()
    assert counter.leaves("x" * 200_000) == ["x" * 200_000]
    assert "".join(counter.leaves("日本語" * 70_000)) == "日本語" * 70_000
    assert time.time() - start < 5
