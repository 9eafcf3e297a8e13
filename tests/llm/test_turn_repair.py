import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np

from skein.llm import turn_repair as tr

SCHEMA = "conv_id long, turn long, role string, text string, conv string, at string, audit int"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """Shortest path over (rows done, roles so far as a state), paths compared by cost, then letters."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, letters, at, state, kept = heapq.heappop(queue)
        if at == len(rows) and state in ("", "a"):
            return cost, letters, kept
        if (at, state) in done:
            continue
        done.add((at, state))
        new = "assistant" if state == "u" else "user"
        heapq.heappush(queue, (cost + 3, letters + "I", at, new[0], kept + (new + ":",)))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(queue, (cost + 4, letters + "D", at + 1, state, kept))
            if fault not in ("blank", "duplicate"):
                add = 3 * (fault == "truncated")
                if state + role[:1] in ("s", "u", "su", "ua", "au"):
                    heapq.heappush(queue, (cost + add, letters + "K", at + 1, role[0], kept + (f"{role}:{text}",)))
                heapq.heappush(queue, (cost + add + 3, letters + "R", at + 1, new[0], kept + (f"{new}:{text}",)))


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        held += [(turn is not None, turn or 0, "user" if draw == 4 else role, text)] * (1 + (draw == 3))
    out = []
    for conv, held in convs.items():
        held.sort()
        seen, marked, counts = set(), [], dict.fromkeys(["blank", "duplicate", "truncated", None], 0)
        for _, _, role, text in held:
            body = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        turns = {t for known, t, _, _ in held if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, letters, kept = cheapest(marked)
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, letters,
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **sizes):
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r[c] for c in COLUMNS) for r in tr.audit(frame, **sizes).collect()), key=repr)


def logs(seed, n=150):
    draw, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, turn + draw.randint(0, 1) * 3, draw.choice(["user", "assistant", "system", "tool", "u"]),
                         draw.choice(["Yes.", "no", "Why? ", "", " \n", f"t{turn}!", "so!\x1c"])))
    return rows


def test_repair_against_shortest_paths(spark):
    rows = logs(1)
    assert found(spark, rows) == brute(rows)


def test_pieces_of_any_length_give_the_same(spark):
    rows = logs(2, 40) + [(900, t, ["user", "assistant", "system", "x"][t * t % 7 % 4], f"{t % 11}{'.!'[:t % 2]}") for t in range(300)]
    assert found(spark, rows, piece_turns=7) == brute(rows)


def test_nulls_repeats_empty_and_long(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "user", None), (2, 2, None, "x."), (2, 2, None, "x."), (2, 2, None, "x."),
            (3, 0, "user", "long " * 60_000 + "."), (3, 1, "", "end."), (4, 0, "user", " " * 200_000), (5, 3, "assistant", "z?"), (5, None, "assistant", "q?")]
    rows += [(7, t, "user", "one.") for t in range(40)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_block_tables_against_single_steps():
    vectors, step, cost, block, block_cost = tr.tables()
    assert len(block) == tr.SYMBOLS ** tr.BLOCK and len(vectors) < 100
    draw = random.Random(4)
    for _ in range(500):
        symbols = np.array([draw.randrange(12) for _ in range(draw.randint(1, 4))])
        v = draw.randrange(len(vectors))
        code, at, total = int(tr.codes(symbols)[0]), v, 0
        for symbol in symbols[::-1]:
            total += cost[symbol, at]
            at = step[symbol, at]
        assert (block[code, v], block_cost[code, v]) == (at, total)
