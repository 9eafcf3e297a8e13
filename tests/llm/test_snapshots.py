import random

from skein.llm import snapshots


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role, text))
    first = lambda x: (x is not None, x if x is not None else 0)
    word = lambda x: (x is not None, x or "")
    logs = {c: tuple((r, t) for _, r, t in sorted(ts, key=lambda x: (first(x[0]), word(x[1]), word(x[2])))) for c, ts in turns.items()}
    shorter = {log[:n] for log in logs.values() for n in range(1, len(log))}
    copies = {}
    for conv, log in logs.items():
        copies.setdefault(log, []).append(conv)
    clean = lambda x: (x or "").replace("<|", "< |")
    return {min(convs): (len(log), len(convs), "".join(f"<|im_start|>{clean(r)}\n{clean(t)}<|im_end|>\n" for r, t in log))
            for log, convs in copies.items() if log not in shorter}


def collapsed(spark, rows, **sizes):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "conv_id long, turn long, role string, text string, rendered string, k long").repartition(4)
    out = {}
    for row in sorted(snapshots.collapse(frame, **sizes).collect(), key=lambda r: (r.conv_id, r.part)):
        n, copies, text = out.get(row.conv_id, (row.n_turns, row.n_copies, ""))
        out[row.conv_id] = (n, copies, text + row.rendered)
    return out


def logs(draw):
    rows, base = [], [[(draw.choice(["user", "assistant", None]), draw.choice(["hi", "yes", "<|x", "", None]))
                       for _ in range(9)] for _ in range(5)]
    for conv in range(60):
        for turn, (role, text) in enumerate(draw.choice(base)[:draw.randint(1, 9)]):
            rows.append((conv, turn, role, text))
    return rows


def test_snapshots_against_brute_force(spark):
    rows = logs(random.Random(8))
    assert collapsed(spark, rows) == brute(rows)


def test_long_conversations_in_blocks(spark):
    rows = logs(random.Random(9)) + [(100, t, "user", str(t % 3)) for t in range(50)] + [(101, t, "user", str(t % 3)) for t in range(37)]
    assert collapsed(spark, rows, block_turns=4) == brute(rows)


def test_nulls_repeats_and_gaps(spark):
    rows = [(1, None, "user", "a"), (1, 0, "user", "b"), (2, 5, "user", "a"), (2, 9, "user", "b"), (3, 1, None, None),
            (None, 0, "user", "lost"), (4, 0, "user", "a"), (4, 0, "user", "a"), (5, -3, "user", "c"), (6, 0, "user", "")]
    assert collapsed(spark, rows) == brute(rows)
    assert collapsed(spark, []) == {}
