"""Cheapest repair of damaged conversations: edit distance to the alternation of roles, by Four-Russians block tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.digests import run_digests
from skein.operators.order import with_row_index
from skein.session import cut

# States: what the kept turns end in. Nothing yet, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
# The one state that a new user or assistant turn leads to.
NEXT = (USER, USER, ASSISTANT, USER)
# States that a kept turn leads to, by the initial of its role.
KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
INITIALS = "sua"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
FAR = 10 ** 6
# A turn's symbol is 3 * class of its initial (the fourth: any other) + 0 sound, 1 truncated, 2 to be deleted; PAD changes nothing.
PAD, SYMBOLS = 12, 13
# Symbols of a block that is looked up at once.
BLOCK = 4
# Turns that lie side by side in one piece, whatever conversations they belong to.
PIECE_TURNS = 4096
SPACE = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text`` after the damage that the CRC-32 of ``conv_id:turn``, modulo 20, asks for.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes it the user's. A null in any of the
    four columns is one space; ``conv`` is the id as text.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(spaced("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), spaced("turn").alias("at"),
                                spaced("role").alias("role"), spaced("text").alias("text"))
    rows = rows.withColumn("draw", F.crc32(F.concat_ws(":", "conv", "at").cast("binary")) % 20).filter("draw != 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(copies).alias("copy")).drop("copy")


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv, turn, role, text``) with ``at``, their place in the order of conversation, turn (null first), role and text.

    One range shuffle, in which a hot conversation or a row repeated very often is split.
    """
    return with_row_index(turns.withColumn("tie", F.monotonically_increasing_id()),
                          ["conv", F.col("turn").asc_nulls_first(), "role", "text", "tie"], "at", keep=["conv", "turn", "role", "text"])


def faults(rows: DataFrame) -> DataFrame:
    """``at, conv, turn, blank, duplicate, truncated, symbol`` of every row of :func:`numbered`; the first fault counts.

    A row is a duplicate unless it is the first of its role and text in its conversation. Firsts come from a minimum
    combined on the map side and are joined by place, so equal rows never meet in one task.
    """
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    seen = rows.select("at", "conv", "turn", F.substring("role", 1, 1).alias("initial"), F.xxhash64(F.lit(1), "role", "text").alias("one"),
                       F.xxhash64(F.lit(2), "text", "role").alias("two"), (body == "").alias("blank"),
                       (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("open"))
    seen = cut(seen)
    firsts = seen.groupBy("conv", "one", "two").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    joined = seen.join(firsts, "at", "left")
    duplicate = ~F.col("blank") & F.col("first").isNull()
    truncated = ~F.col("blank") & ~duplicate & F.col("open")
    kind = F.coalesce(*[F.when(F.col("initial") == x, at) for at, x in enumerate(INITIALS)], F.lit(len(INITIALS)))
    state = F.when(F.col("blank") | duplicate, 2).when(truncated, 1).otherwise(0)
    return cut(joined.select("at", "conv", "turn", F.col("blank").cast("long").alias("blank"), duplicate.cast("long").alias("duplicate"),
                             truncated.cast("long").alias("truncated"), (kind * 3 + state).alias("symbol")))


def _closed(v: list[int]) -> tuple[int, ...]:
    """Costs to the end when new turns may come first."""
    for _ in NEXT:
        v = [min(v[q], INSERT + v[NEXT[q]]) for q in range(4)]
    return tuple(v)


def _before(symbol: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end from before a turn, given those from after it."""
    if symbol == PAD:
        return v
    kind, state = divmod(symbol, 3)
    out = [DELETE + v[q] for q in range(4)]
    if state < 2:
        for q in range(4):
            kept = v[KEPT[kind][q]] if q in KEPT[kind] else FAR
            out[q] = min(out[q], TRUNCATED * state + min(kept, REROLE + v[NEXT[q]]))
    return _closed(out)


@lru_cache(maxsize=1)
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All normalised cost vectors, and what turns them into which, by one symbol and by every block of ``BLOCK`` symbols.

    A vector holds the cost to the end of a conversation from each state, less the smallest of them. Differences are
    bounded by the price of a few edits, so few vectors can be met; they are found from the one at the end (number 0).
    ``step[s, v]`` and ``block[b, v]`` give the vector before, ``step_cost`` and ``block_cost`` what was taken off; a block's number has its
    first symbol as the highest digit.
    """
    end = _closed([0, FAR, FAR, 0])
    vectors, at = [end], {end: 0}
    moves: list[list[tuple[int, int]]] = []
    for v in vectors:
        row = []
        for symbol in range(SYMBOLS):
            out = _before(symbol, v)
            low = min(out)
            out = tuple(x - low for x in out)
            if out not in at:
                at[out] = len(vectors)
                vectors.append(out)
            row.append((at[out], low))
        moves.append(row)
    step = np.array([[m[0] for m in row] for row in moves], np.int32).T.copy()
    cost = np.array([[m[1] for m in row] for row in moves], np.int32).T.copy()
    block, block_cost = step, cost
    while len(block) < SYMBOLS ** BLOCK:  # twice as many symbols: the right half first, then the left one
        right = block[None, :, :]
        left = np.arange(len(block))[:, None, None]
        block_cost = (block_cost[None, :, :] + block_cost[left, right]).reshape(-1, len(vectors))
        block = block[left, right].reshape(-1, len(vectors))
    return vectors, step, cost, block, block_cost


def codes(symbols: np.ndarray) -> np.ndarray:
    """Block numbers of a piece; the last block is filled up."""
    padded = np.full(-(-len(symbols) // BLOCK) * BLOCK, PAD, np.int64)
    padded[:len(symbols)] = symbols
    return padded.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


def borders(symbols: np.ndarray, after: int) -> list[int]:
    """Vectors at the borders of a piece's blocks, the last being ``after``; one look-up a block, from the end."""
    block = tables()[3]
    out = [after]
    for code in codes(symbols)[::-1].tolist():
        out.append(int(block[code, out[-1]]))
    return out[::-1]


def trace(symbols: np.ndarray, vectors_at: list[int], state: int, last: bool) -> tuple[int, int, list[tuple[str, int | None, int]]]:
    """State after a piece, its cost and its edits as ``(letter, turn or None, new state)``, the ASCII-least of the cheapest.

    Each block is expanded backward by single steps from the vector after it; then edits are read forward, taking
    the least letter that still leads to the least cost. An edit sequence fixes its states, so the first letter decides.
    """
    vectors, step, step_cost, _, _ = tables()
    edits, paid = [], 0

    def insert() -> None:
        nonlocal state, paid
        state = NEXT[state]
        edits.append(("I", None, state))
        paid += INSERT

    for start in range(0, len(symbols), BLOCK):
        piece = symbols[start:start + BLOCK].tolist()
        inside = [vectors_at[start // BLOCK + 1]]
        for symbol in piece[::-1]:
            inside.append(int(step[symbol, inside[-1]]))
        inside.reverse()
        for at, symbol in enumerate(piece):
            here, after = vectors[inside[at]], vectors[inside[at + 1]]
            off = int(step_cost[symbol, inside[at + 1]])
            while True:
                kind, fault = divmod(symbol, 3)
                left = here[state] + off
                if left == DELETE + after[state]:
                    edits.append(("D", start + at, state))
                    paid += DELETE
                    break
                if here[state] == INSERT + here[NEXT[state]]:
                    insert()
                    continue
                add = TRUNCATED * fault
                to = KEPT[kind].get(state)
                if to is not None and left == add + after[to]:
                    letter, price = "K", add
                else:
                    letter, price, to = "R", add + REROLE, NEXT[state]
                edits.append((letter, start + at, to))
                state, paid = to, paid + price
                break
    while last and vectors[0][state]:
        insert()
    return state, paid, edits


def _rights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each conversation from its last to its first: adds the vector after each, and whether it is the last."""
    conv, vector = None, 0
    for batch in batches:
        after, last = [], []
        for name, symbols in zip(batch.column("conv").to_pylist(), batch.column("symbols").to_pylist()):
            last.append(name != conv)
            if name != conv:
                conv, vector = name, 0
            after.append(vector)
            vector = borders(np.frombuffer(symbols.encode(), np.uint8) - 65, vector)[0]
        yield batch.append_column("after", pa.array(after, pa.int32())).append_column("last", pa.array(last))


EDITS = pa.list_(pa.struct([("ord", pa.int32()), ("at", pa.int64()), ("role", pa.string())]))


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each conversation from its first to its last: edits, their letters and cost, and illegal neighbours."""
    conv, state, before = None, START, ""
    legal = {"su", "ua", "au"}
    for batch in batches:
        rows = []
        for name, symbols, first, after, last in zip(*[batch.column(c).to_pylist() for c in ("conv", "symbols", "first", "after", "last")]):
            if name != conv:
                conv, state, before = name, START, ""
            codes_of = np.frombuffer(symbols.encode(), np.uint8).astype(np.int64) - 65
            initials = before + "".join((INITIALS + "-")[x // 3] for x in codes_of.tolist())
            illegal = sum(a + b not in legal for a, b in zip(initials, initials[1:]))
            before = initials[-1:]
            state, paid, edits = trace(codes_of, borders(codes_of, after), state, last)
            kept = [{"ord": at, "at": None if turn is None else first + turn,
                     "role": None if letter == "K" else "assistant" if to == ASSISTANT else "user"}
                    for at, (letter, turn, to) in enumerate(edits) if letter != "D"]
            rows.append((paid, illegal, "".join(e[0] for e in edits), kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("piece"), *[pa.array([r[at] for r in rows], t) for at, t in enumerate(
                (pa.int64(), pa.int64(), pa.string(), EDITS))]], ["conv", "piece", "cost", "illegal", "audit", "edits"])


def edits(marked: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """``conv, piece, cost, illegal, audit, edits`` for the rows of :func:`faults`: the cheapest repair, in pieces.

    Symbols of ``piece_turns`` neighbouring rows are put together first, so a conversation of any length is a few
    short rows. They stream through one task, from the last to the first for the cost vectors at their borders, then forward
    for the edits; nothing of a conversation is gathered. ``edits`` holds what stays: place of the row (null: a new
    turn) and its new role (null: as it is).
    """
    pieces = marked.groupBy("conv", F.floor(F.col("at") / piece_turns).alias("piece")).agg(
        F.min("at").alias("first"),
        F.sort_array(F.collect_list(F.struct("at", F.char(F.col("symbol") + 65).alias("x")))).alias("all")).select(
        "conv", "piece", "first", F.array_join(F.transform("all", lambda x: x["x"]), "").alias("symbols"))
    schema = "conv string, piece long, first long, symbols string"
    rights = pieces.repartition("conv").sortWithinPartitions("conv", F.col("piece").desc()).mapInArrow(
        _rights, f"{schema}, after int, last boolean")
    return rights.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(
        _traced, "conv string, piece long, cost long, illegal long, audit string, edits array<struct<ord int, at long, role string>>")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, piece, ord, role, text``: the turns of the repaired conversations, in the order of ``piece`` and ``ord``."""
    turns = found.select("conv", "piece", F.explode("edits").alias("e")).select("conv", "piece", "e.ord", "e.at", F.col("e.role").alias("new"))
    new = turns.filter("at is null").select("conv", "piece", "ord", F.col("new").alias("role"), F.lit("").alias("text"))
    old = turns.filter("at is not null").join(rows.select("at", "role", "text"), "at").select(
        "conv", "piece", "ord", F.coalesce("new", "role").alias("role"), "text")
    return old.union(new)


def audit(conversations: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """A row per ``conv_id``: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` after :func:`damage`.

    Rows go by turn, null first, then role and text as damaged. Each row counts under its first fault: blank, duplicate
    (role and text seen earlier), truncated (its last character that is not blank is none of ``.!?``). ``illegal``
    counts neighbours whose role initials are not ``su``, ``ua`` or ``au``. The repair is the cheapest sequence of Keep (0), Rerole to user
    or assistant (3), Delete (4, a must for blank and duplicate rows) and Insert (an empty turn, 3) whose roles read ``(s?(ua)+)?`` by
    initials; a truncated row that stays costs 3 more. Of equal costs the ASCII-least ``audit`` (initials in order) is
    taken. ``gaps`` are turn numbers missing between the least and the greatest.

    A null ``conv_id`` is a conversation of its own, kept null; other nulls are one space (a null ``turn`` has no number for
    ``gaps``). A conversation without rows after the damage has zeros, an empty audit and the empty text's hash. No rows give no
    rows; other columns are not looked at.
    """
    rows = numbered(damage(conversations))
    marked = faults(rows)
    found = cut(edits(marked, piece_turns))
    per_turn = marked.groupBy("conv", "turn").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    counts = per_turn.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    whole = found.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    lines = repaired(rows, found).select("conv", "piece", "ord", F.concat_ws(":", "role", "text").alias("line"))
    digests = run_digests(lines, ["conv"], ["piece", "ord"], "line", "\n", "repaired_sha256")
    every = conversations.groupBy("conv_id").agg(F.lit(0)).select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"))
    joined = every.join(counts, "conv", "left").join(whole, "conv", "left").join(digests, "conv", "left")
    zero: Column = F.lit(0).cast("long")
    return joined.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
