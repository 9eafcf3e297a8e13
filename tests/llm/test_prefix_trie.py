import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from skein.llm import contraction, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, k string, depth int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def truncated(a, b):
    return abs(a) % b * (1 if a >= 0 else -1)


def brute(rows):
    logs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            logs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    logs = {c: [x[2:] for x in sorted(v)] for c, v in logs.items()}
    built = {}
    for c, own in logs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(logs.get(c - truncated(c, 20), [])[:h] + own[h:])
    members = {}
    for c, log in built.items():
        for d in range(len(log) + 1):
            members.setdefault(log[:d], []).append(c)
    out = []
    for node, ids in members.items():
        below = [x for x in members if x[:len(node)] == node]
        children = lambda n: [x for x in members if len(x) == len(n) + 1 and x[:-1] == n]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^ \t-\r]+", x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in sorted(ids) if built[c] == node)
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children(node)),
                    sum(not children(x) for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **sizes):
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(frame, **sizes).collect()), key=repr)


def logs(draw, n=70):
    rows = []
    for conv in range(-5, n):
        for turn in range(draw.randint(1, 7)):
            rows.append((conv * draw.choice([1, 1, 1, 3]), turn, draw.choice(["user", "assistant"]), draw.choice(["a", "b c", "d  e f"])))
    return rows


def test_trie_against_brute_force(spark):
    rows = logs(random.Random(3))
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_repeats_long_texts_and_turnless_conversations(spark):
    rows = [(0, None, "user", "x y"), (0, 4, None, None), (0, 4, "", ""), (1, None, None, "z" * 300_000), (1, 2, "user", "w " * 50_000),
            (None, 1, "user", "lost"), (7, 0, "user", "a"), (7, 0, "user", "a"), (33, 0, "user", "only"), (34, 1, "user", "b"),
            (45, 0, "user", "s"), (61, 0, "u", "t"), (62, 0, "u", "t"), (63, 0, "u", "t"), (-7, 1, "user", "minus")]
    assert found(spark, rows) == brute(rows)


def test_no_conversations_give_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "a")]) == []


def test_a_long_conversation_in_blocks_and_a_shared_one(spark):
    long = [(0, t, "user", str(t % 7)) for t in range(40)]
    shared = [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(4)]
    assert found(spark, long + shared, block_turns=16) == brute(long + shared)


@pytest.mark.parametrize("shape", ["path", "star", "random", "forest"])
def test_subtree_sums(spark, shape):
    draw, n = random.Random(5), 90
    parent = {"path": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: draw.randrange(i),
              "forest": lambda i: i - 1 if i % 20 else None}[shape]
    rows = [(i, parent(i) if i else None, draw.randint(-3, 9), 1) for i in range(n)]
    sums = {i: [v, w] for i, _, v, w in rows}
    for i, up, _, _ in reversed(rows):
        if up is not None:
            sums[up] = [a + b for a, b in zip(sums[up], sums[i])]
    # Ids are spread out, so that their bits differ and their order says nothing.
    name = lambda i: None if i is None else i * 7_919_777 + 13
    frame = spark.createDataFrame([(name(i), name(up), v, w, "x") for i, up, v, w in rows],
                                  "id long, parent long, value long, one long, n string").repartition(3)
    result = {r.id: [r.value, r.one] for r in contraction.subtree_sums(frame, ["value", "one"]).collect()}
    assert result == {name(i): s for i, s in sums.items()}


def test_subtree_sums_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, parent long, value long")
    assert contraction.subtree_sums(empty, ["value"]).collect() == []
    one = empty.union(spark.range(1).select(F.lit(5), F.lit(None), F.lit(None)))
    assert [tuple(r) for r in contraction.subtree_sums(one, ["value"]).collect()] == [(5, 0)]
