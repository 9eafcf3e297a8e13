import itertools
import random
from collections import Counter

import xxhash

from skein.llm import simhash
from skein.llm.components import components

from .messy import lower, messy, messy_rows


def brute_fingerprint(text, size=3):
    found = [w for w in "".join(" " if c in "\t\n\r\x0b\x0c" else c for c in lower(text)).split(" ") if w]
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[at:at + size]).encode(), 42) for at in range(max(1, len(found) - size + 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def joined(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_near_copies_against_brute_force(spark):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(400)]
    docs = []
    for base in range(12):
        text = draw.choices(words, k=150)
        for copy in range(25):
            text = list(text)
            text[draw.randrange(150)] = draw.choice(words)
            docs.append((len(docs), " ".join(text)))
    rows = simhash.near_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)).collect()
    prints = {key: brute_fingerprint(text) for key, text in docs}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert len(links) > 100
    wanted = joined(prints, links)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {k: (f"{prints[k]:016x}", wanted[k]) for k in prints}
    assert sum(r.kept for r in rows) == len(set(wanted.values()))


def test_messy_table(spark):
    rows = simhash.near_groups(messy(spark)).collect()
    prints = {brute_fingerprint(t) for _, t, *_ in messy_rows()}
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter(
        (k, f"{brute_fingerprint(t):016x}") for k, t, *_ in messy_rows())
    assert sum(r.kept for r in rows) <= len(prints)
    assert all(r.component_id is not None for r in rows if r.doc_id is not None)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {0}
    assert simhash.near_groups(messy(spark, 0)).collect() == []
    whole = simhash.near_groups(messy(spark), rows=True)
    assert whole.select("row.*").columns == messy(spark).columns


def close_pairs(values, limit):
    return {(a, b) for a, b in itertools.combinations(sorted(values), 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= limit}


def test_masks_and_budgets_lose_no_pair_within_the_limit(spark):
    draw = random.Random(9)
    for limit in (0, 1, 2, 4):
        pairs = []
        for _ in range(300):
            one = two = draw.getrandbits(64)
            for bit in draw.sample(range(64), limit + draw.randint(0, 1)):
                two ^= 1 << bit
            pairs.append((one, two))
            if (one ^ two).bit_count() <= limit:
                masks = [m for m in simhash.chain_masks(limit) if (one ^ two) & m == 0]
                assert masks
                for m in masks:
                    assert any((one ^ two) & f == 0 for f in simhash.finer_masks(m, limit)) or m == (1 << 64) - 1
        sign = lambda x: x - (1 << 64) if x >> 63 else x
        frame = spark.createDataFrame([(sign(a ^ b),) for a, b in pairs], "differ long")
        within = [r[0] for r in frame.select(simhash.in_budget(frame["differ"], limit)).collect()]
        assert within == [(a ^ b).bit_count() <= limit for a, b in pairs]


def test_a_key_of_very_many_values_is_split(spark, monkeypatch):
    """All values agree in 40 bits, a third of them in 54, and every pair within the limit is still found."""
    draw = random.Random(6)
    values = {7 << 50 | draw.getrandbits(24) for _ in range(600)} | {draw.getrandbits(10) | 7 << 50 for _ in range(400)} | {-1, -2, -4}
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long").repartition(3)
    for paired in (2, 64):
        monkeypatch.setattr(simhash, "PAIRED", paired)
        assert {tuple(r) for r in simhash.links(frame, 2).collect()} == close_pairs(values, 2)


def test_links_of_a_wider_limit(spark):
    draw = random.Random(2)
    values = {draw.getrandbits(64) >> 1 for _ in range(30)}
    for value in list(values)[:10]:
        for _ in range(3):
            values.add(value ^ sum(1 << b for b in draw.sample(range(63), 4)))
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    for limit in (3, 4):
        assert {tuple(r) for r in simhash.links(frame, limit).collect()} == close_pairs(values, limit)
    assert simhash.links(frame, 0).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(1)
    links = [(at, at + 1) for at in range(200)] + [(1000, 1001 + at) for at in range(150)] + [(5000, 5001), (5001, 5000), (7, 7)]
    links += [(draw.randint(6000, 6300), draw.randint(6000, 6300)) for _ in range(150)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "one long, two long")).collect()}
    nodes = {n for link in links if link[0] != link[1] for n in link}
    wanted = joined(nodes, links)
    assert found.keys() == nodes
    assert len({(found[n], wanted[n]) for n in nodes}) == len(set(wanted.values())) == len(set(found.values()))
    assert components(spark.createDataFrame([], "one long, two long")).collect() == []
