import random

import pytest

from skein.operators import dedupe
from skein.operators.dedupe import dedupe_greedy, duplicate_count, kept_positions
from skein.session import write_cut


def sequential(rows):
    urls, titles, kept = set(), set(), []
    for pos, url, title in sorted(rows):
        if url not in urls and title not in titles:
            kept.append(pos)
            urls.add(url)
            titles.add(title)
    return kept


def random_rows(seed, n, hot):
    pick = random.Random(seed)
    name = lambda kind, k: None if pick.random() < 0.05 else f"{kind}{0 if pick.random() < hot else pick.randrange(k)}"
    return [(pos, name("u", n // 2), name("t", n // 2)) for pos in pick.sample(range(10 * n), n)]


@pytest.mark.parametrize("seed,hot", [(1, 0.0), (2, 0.3), (3, 0.3)])
def test_equals_the_sequential_walk(spark, seed, hot):
    rows = random_rows(seed, 60, hot)
    frame = spark.createDataFrame(rows, "pos int, url string, title string")
    kept = sorted(r.pos for r in dedupe_greedy(frame, ["url", "title"], "pos").collect())
    assert kept == sequential(rows)
    assert duplicate_count(frame, ["url", "title"], "pos").first()[0] == len(rows) - len(kept)


def test_long_chain_and_empty(spark):
    chain = [(2 * i + j, f"u{i + j}", f"t{i}") for i in range(12) for j in range(2)]
    frame = spark.createDataFrame(chain, "pos int, url string, title string")
    assert sorted(r.pos for r in dedupe_greedy(frame, ["url", "title"], "pos").collect()) == sequential(chain)
    assert dedupe_greedy(frame.filter("pos < 0"), ["url", "title"], "pos").count() == 0


@pytest.mark.parametrize("seed,hot", [(4, 0.0), (5, 0.3), (6, 0.8)])
def test_chains_are_settled_from_the_first_round(spark, seed, hot):
    rows = random_rows(seed, 80, hot)
    frame = spark.createDataFrame(rows, "pos int, url string, title string")
    kept = kept_positions(frame, ["url", "title"], "pos", plain_rounds=0)
    assert sorted(r.pos for r in kept.collect()) == sequential(rows)


def test_a_chain_of_a_hundred_thousand_rows_takes_logarithmic_rounds(spark, monkeypatch):
    n, written = 100_000, []
    monkeypatch.setattr(dedupe, "write_cut", lambda df: written.append(df) or write_cut(df))
    # Row i shares its url with one neighbour and its title with the other.
    frame = spark.range(n).selectExpr("id * 3 as pos", "concat('u', id div 2) as url", "concat('t', (id + 1) div 2) as title")
    kept = kept_positions(frame, ["url", "title"], "pos")
    assert kept.count() == n // 2 and kept.filter("pos % 6 != 0").count() == 0
    assert len(written) <= 6
