"""Language-model scores from a probabilistic suffix tree over words."""

from __future__ import annotations

import gc
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.rows import key_type, slices, texts
from skein.session import cut, delete_folder, write_cut

# Shares of all training tokens. They say what is sent to all tasks, not what is in the tree. A context is common from
# CONTEXT_SHARE on, so there are at most 1 / CONTEXT_SHARE of each length; a next symbol travels with a common context,
# and a word with its count, from LISTED_SHARE on, so there are at most a million of each. These bounds hold for any table,
# and are all that is broadcast or held by the driver. What the other next symbols of common contexts and the other words
# have is looked up, see :func:`looked_up`; contexts that are not common are partitioned by their hash, see :func:`rare_deltas`.
CONTEXT_SHARE = 5e-5
LISTED_SHARE = 1e-6
# Occurrences from which a next symbol is listed with a rare context of one word, whatever the table.
LEAST_SEEN = 2
# Longest context in words.
DEPTH = 3
# What each listed symbol's count gives up to the shorter context's distribution, in observations.
DISCOUNT = 0.8
# Weight of unseen words in the base distribution, in observations for each word.
ADDED = 0.1
# Log-likelihood a context must gain over its suffix, in nats; a rare one for each of its words, as the longer they are the
# more there are that gain a little by chance.
GAIN = 3.0
# Sequence end, also what stands before the first word. Words never hold white space.
END = b"\n"
SEED = 42
# Distinct pairs a counting task holds before it hands them on.
HELD_PAIRS = 1 << 19
# Bytes of text whose tokens make one row of the token table. The more, the fewer words and symbols are looked up twice.
TOKEN_BYTES = 2 << 20
# Occurrences of rare contexts a task holds before it hands them on, and training tokens for each group of contexts.
HELD_RARE = 1 << 18
GROUP_TOKENS = 1 << 20
# Parts the large shuffles are done in, one after the other, so that less lies on disk at once.
ROUNDS = 3
# The same for looking up symbols.
LOOKUPS = 2
# Keys from which values are told apart and sorted before they are searched for, as numpy finds values in order much faster.
MANY = 1 << 12


def held_out(key: Column) -> Column:
    """One document in ten by a checksum of its key, a null key as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def shared(values: np.ndarray) -> bytes:
    """Floats of which many are equal, packed."""
    place, few = told_apart(values)
    few = planes(few)
    return len(few).to_bytes(8, "little") + few + planes(place.astype(np.int32))


def floats(data: bytes) -> np.ndarray:
    """The other way round."""
    ends = 8 + int.from_bytes(data[:8], "little")
    return numbers(data[8:ends], np.float64)[numbers(data[ends:], np.int32)]


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs without ASCII white space, A to Z in lower case, of all texts one after the other; how many each text has."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, ends = found.flatten(), np.asarray(found.offsets, np.int64) - found.offsets[0].as_py()
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))  # white space at an end leaves an empty one there
    return flat.filter(pa.array(full)), np.diff(np.append(0, np.cumsum(full))[ends])


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, SEED)


def word_hashes(found: pa.Array) -> np.ndarray:
    """:func:`word_hash` of texts."""
    if not len(found):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(found.buffers()[1], np.int32)[found.offset:found.offset + len(found) + 1].tolist()
    data = memoryview(found.buffers()[2] or b"")
    return np.fromiter((word_hash(data[a:b]) for a, b in zip(ends, ends[1:])), np.uint64, len(found))


def mixed(node: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a symbol at a node."""
    return word ^ ((node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted ``keys`` hold the wanted ones, and which they hold."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    if len(keys) > MANY:
        place, few = told_apart(wanted)
        at, known = find_sorted(keys, few)
        return at[place], known[place]
    return find_sorted(keys, wanted)


def find_sorted(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def told_apart(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value among the distinct ones, and these.

    Integers are sorted together with their places in one number, which takes numpy a fraction of sorting places by value.
    """
    bits = len(values).bit_length()
    if values.dtype == np.int64 and len(values) and 0 <= values.min() and int(values.max()) >> (63 - bits) == 0:
        order = values << bits
        order |= np.arange(len(values))
        order.sort()
        order &= (1 << bits) - 1
        ordered = values[order]
    elif values.dtype == np.uint64:
        order = by_high_bits(values)
        ordered = values[order]
    else:
        order = None
    if order is not None:
        first = np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)]
        few = ordered[first]
        if values.dtype == np.int64 or (few[1:] > few[:-1]).all():
            place = np.empty(len(values), np.int64)
            place[order] = np.cumsum(first, dtype=np.int32) - 1
            return place, few
    coded = pa.array(values).dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), np.asarray(coded.dictionary)


def by_high_bits(values: np.ndarray) -> np.ndarray:
    """Order of unsigned numbers that leaves out as many low bits as their places take: for hashes, nearly always their order."""
    low = np.uint64((1 << len(values).bit_length()) - 1)
    order = values & ~low
    order |= np.arange(len(values), dtype=np.uint64)
    order.sort()
    order &= low
    return order.view(np.int64)


def first_places(place: np.ndarray, size: int) -> np.ndarray:
    """Where each of the distinct values comes first."""
    out = np.empty(size, np.int64)
    out[place[::-1]] = np.arange(len(place))[::-1]
    return out


@dataclass
class Level:
    """The nodes of one length: who they are and their next symbols."""

    children: np.ndarray  # sorted keys (node of the suffix, word before it)
    nodes: np.ndarray  # node of each child
    symbols: np.ndarray  # sorted keys (node, next word)
    log_p: np.ndarray  # log10 probability of each listed symbol
    log_rest: np.ndarray  # by node: what the suffix's probability of any other symbol is multiplied with, as log10
    tested: np.ndarray  # sorted keys of all contexts of this length that were tested, kept or not
    up: np.ndarray  # node of the suffix, in the order of the nodes
    first: int  # the least of the nodes

    @cached_property
    def number(self) -> np.ndarray:
        """Node of each tested context, -1 if it was not kept."""
        out = np.full(len(self.tested), -1, np.int64)
        out[find(self.tested, self.children)[0]] = self.nodes
        return out


@dataclass
class Tree:
    """Base distribution of listed words, and the nodes by length. Node 0 is the root."""

    tokens: int
    vocabulary: int
    words: np.ndarray  # sorted hashes of listed words
    log_p: np.ndarray
    levels: list[Level] = field(default_factory=list)

    def log_unseen(self, counts) -> np.ndarray:
        return np.log10((np.asarray(counts) + ADDED) / (self.tokens + ADDED * (self.vocabulary + 1)))

    def walk(self, before: list[np.ndarray], names: np.ndarray | None = None,
             rare: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length, positions whose context of that length is in the tree, and their nodes.

        ``before[k]`` holds the hash of the word ``k + 1`` places back, 0 beyond the start; with ``names``, the place of
        its hash in there. A node's suffix is always in the tree, so the longest suffix state is found by going back word by word.
        ``rare`` is set where that ends before a context that is not common; such a context starts with a word that is not, or
        was not tested.
        """
        if names is None:
            place, names = told_apart(np.concatenate(before))
            before = np.split(place, len(before))
        at, node, out, there = np.arange(len(before[0])), np.zeros(len(before[0]), np.int64), [], names != 0
        for size, (level, places) in enumerate(zip(self.levels, before)):
            word = places[at]
            if not size:  # by word
                child, start = find(level.tested, mixed(np.zeros(len(names)), names))
                place, known = child[word], (start & there)[word]
            else:
                place, known = np.zeros(len(at), np.int64), start[word] & there[word]
                here = np.flatnonzero(known)
                place[here], known[here] = find(level.tested, mixed(node[here], names[word[here]]))
            if rare is not None:
                rare[at] = there[word] & ~known
            number = np.where(known, level.number[place], -1)
            at, node = at[number >= 0], number[number >= 0]
            out.append((at, node))
        if rare is not None and len(out) < len(before):
            rare[at] = there[before[len(out)][at]]
        return out

    def state(self, before: list[np.ndarray], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node of every token's longest suffix state, and whether the word before it makes a context that is not common."""
        node, rare = np.zeros(len(before[0]), np.int64), np.zeros(len(before[0]), bool)
        for at, found in self.walk(before, names, rare):
            node[at] = found
        return node, rare

    def length(self, node: np.ndarray) -> np.ndarray:
        """Words of the contexts that nodes stand for."""
        return sum(((node >= level.first).astype(np.int64) for level in self.levels), np.zeros(len(node), np.int64))

    def listed(self, node: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether words are listed at nodes other than the root, and their log10 probability there, else 0."""
        known, log_p = np.zeros(len(word), bool), np.zeros(len(word))
        for level in self.levels:
            here = np.flatnonzero((node >= level.first) & (node < level.first + len(level.nodes)))
            place, known[here] = find(level.symbols, mixed(node[here], word[here]))
            if len(level.log_p):
                log_p[here] = np.where(known[here], level.log_p[place], 0.0)
        return known, log_p

    def given(self, node: np.ndarray, word: np.ndarray, base: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of words at nodes; ``base`` is that at the root, without it words must be listed ones."""
        out, node, open_ = np.zeros(len(word)), node.copy(), np.ones(len(word), bool)
        for level in reversed(self.levels):
            here = np.flatnonzero(open_ & (node >= level.first))
            place, listed = find(level.symbols, mixed(node[here], word[here]))
            if len(level.log_p):
                out[here[listed]] += level.log_p[place[listed]]
            open_[here[listed]] = False
            rest = here[~listed]
            out[rest] += level.log_rest[node[rest]]
            node[rest] = level.up[node[rest] - level.first]
        out[open_] += self.log_p[find(self.words, word[open_])[0]] if base is None else base[open_]
        return out

    def score(self, base: np.ndarray, before: list[np.ndarray], word: np.ndarray) -> np.ndarray:
        """log10 probability of every token given its longest suffix state."""
        node = np.zeros(len(word), np.int64)
        for at, found in self.walk(before):
            node[at] = found
        return self.given(node, word, base)


class Sequences:
    """Documents of one row of the token table as hashed tokens, with the words before each."""

    def __init__(self, hashes: np.ndarray, flat: np.ndarray, lengths: np.ndarray, depth: int):
        self.hashes, self.flat, self.lengths = hashes, flat, lengths
        inside = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.places = []  # of the words before, -1 beyond the start
        for back in range(1, depth + 1):
            shifted = np.concatenate([np.zeros(min(back, len(flat)), flat.dtype), flat[:-back or None]])[:len(flat)]
            self.places.append(np.where(inside >= back, shifted, np.where(inside == back - 1, 0, -1)))

    @cached_property
    def tokens(self) -> np.ndarray:
        return self.hashes[self.flat]

    @cached_property
    def names(self) -> np.ndarray:
        """Hashes of the words, at last 0 for what is beyond the start."""
        return np.append(self.hashes, np.uint64(0))

    def training(self, held: np.ndarray, depth: int) -> Sequences:
        """The documents that are learnt from."""
        return Sequences(self.hashes, self.flat[np.repeat(~held, self.lengths)], self.lengths[~held], depth)


def planes(values: np.ndarray) -> bytes:
    """Numbers by byte, lowest bytes first, which shrinks small ones; compressed, after their length in bytes."""
    data = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def numbers(data: bytes, kind) -> np.ndarray:
    """The other way round."""
    width = np.dtype(kind).itemsize
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def as_list(values) -> pa.ListArray:
    """All values as the list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def tokenise(rows: DataFrame) -> DataFrame:
    """The token table: a row holds some documents' keys, lengths and tokens, as places in the row's list of word hashes.

    Texts are read here and never again. A word is known by its 64-bit hash; the first of a row is the end. The numbers in
    ``slice`` hold once the table is written.
    """
    def run(batches):
        for part in slices(batches, limit=TOKEN_BYTES):
            found, lengths = words(part.column("text").cast(pa.string()))
            found = found.dictionary_encode()
            hashes = np.append(np.uint64(word_hash(END)), word_hashes(found.dictionary))
            flat = np.insert(np.asarray(found.indices) + 1, np.cumsum(lengths), 0)  # the end behind each text's words
            row = {"docs": part.column("doc_id"), "held": part.column("held_out"), "lengths": pa.array(lengths + 1, pa.int64())}
            lists = [as_list(column) for column in row.values()]
            yield pa.RecordBatch.from_arrays(
                [*lists, pa.array([hashes.tobytes()], pa.binary()), pa.array([planes(flat.astype(np.int32))], pa.binary())],
                [*row, "hashes", "flat"])

    schema = f"docs array<{key_type(rows)}>, held array<boolean>, lengths array<bigint>, hashes binary, flat binary"
    # Task and row in it, so that 20 more bits number the documents of a row.
    number = F.monotonically_increasing_id()
    return rows.mapInArrow(run, schema).withColumn(
        "slice", F.shiftleft(F.shiftright(number, 33), 20) + number.bitwiseAND(F.lit((1 << 20) - 1)))


def read_tokens(batches, depth: int, tree: Tree | None = None):
    """Row, sequences and held-out marks, row by row of the token table; with the tree, as :func:`placed` left it."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            lengths = np.asarray(row.column("lengths").flatten(), np.int64)
            held = np.asarray(row.column("held").flatten().to_pylist(), bool)
            hashes = read_hashes(row, tree)[0] if tree else np.frombuffer(row.column("hashes")[0].as_py(), np.uint64)
            yield row, Sequences(hashes, numbers(row.column("flat")[0].as_py(), np.int32), lengths, depth), held
        pa.default_memory_pool().release_unused()


def vocabulary(tokens: DataFrame) -> DataFrame:
    """``word, n``: hash of all tokens, ends included, and their count in training, which is 0 for those held out alone.

    Counted in the task before anything is shuffled.
    """
    def run(batches):
        held, size = [], 0
        for _, seq, marks in read_tokens(batches, 0):
            seq = seq.training(marks, 0)
            held.append((seq.hashes, np.bincount(seq.flat, minlength=len(seq.hashes))))
            size += len(seq.hashes)
            if size > HELD_PAIRS:
                held = [combined(held)]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    def combined(held):
        place, keys = told_apart(np.concatenate([h[0] for h in held]))
        return keys, np.bincount(place, weights=np.concatenate([h[1] for h in held]), minlength=len(keys)).astype(np.int64)

    def batch(held):
        keys, counts = combined(held)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["word", "n"])

    parts = tokens.select("held", "lengths", "hashes", "flat").mapInArrow(run, "word long, n long")
    return cut(parts.groupBy("word").agg(F.sum("n").alias("n")))


def next_counts(tokens: DataFrame, tree: Tree, candidates: np.ndarray, suffixes: DataFrame, suffix: np.ndarray) -> DataFrame:
    """``context, word, n, log_suffix``: for every candidate, all its next symbols and how often they follow it in training.

    ``candidates`` are sorted keys (node of the suffix, word before it). All text is read; a symbol that follows only in
    documents held out has the count 0. ``suffixes`` has ``node, word, log_p`` of all symbols of the contexts one word shorter,
    and ``suffix`` the nodes of the candidates' suffixes. Both meet in groups of words, where a word comes at most once a node.
    """
    depth, groups = len(tree.levels) + 1, tree.tokens // GROUP_TOKENS + 1

    def pack(held):
        context, word, counts = (np.concatenate(x) for x in zip(*held))
        place, few = told_apart(mixed(context, word.view(np.uint64)))
        first = first_places(place, len(few))
        return context[first], word[first], np.bincount(place, weights=counts, minlength=len(few)).astype(np.int64)

    def batch(held):
        *columns, group = *(packed := pack(held)), packed[1] % groups
        order = np.argsort(group.astype(np.min_scalar_type(groups)), kind="stable")
        *columns, group = (x[order] for x in (*columns, group))
        names, bounds = np.unique(group, return_index=True)
        parts = [slice(*x) for x in zip(bounds, np.append(bounds[1:], len(group)))]
        return pa.RecordBatch.from_arrays(
            [pa.array(names.astype(np.int32)), *[pa.array([planes(x[y]) for y in parts], pa.binary()) for x in columns]],
            ["bucket", "contexts", "words", "counts"])

    def run(batches):
        held, size = [], 0
        for _, seq, marks in read_tokens(batches, depth):
            places = seq.places[depth - 1]
            if depth > 1:
                at, node = tree.walk(seq.places, seq.names)[-1]
                place, known = find(candidates, mixed(node, seq.names[places[at]]))
            else:
                at, (place, known) = np.arange(len(seq.flat)), find(candidates, mixed(np.zeros(len(seq.names)), seq.names))
                place, known = place[places], known[places]
            known &= places[at] >= 0
            # Pairs in order, the mark in the last bit.
            pairs = place[known] * len(seq.hashes) + seq.flat[at[known]]
            pairs = np.sort((pairs << 1) + np.repeat(marks, seq.lengths)[at[known]])
            first = np.flatnonzero(np.append(True, pairs[1:] >> 1 != pairs[:-1] >> 1)[:len(pairs)])
            counts = np.add.reduceat(1 - (pairs & 1), first) if len(first) else pairs
            pairs = pairs[first] >> 1
            context, word = np.divmod(pairs, len(seq.hashes))
            held.append((context.astype(np.int32), seq.hashes[word].view(np.int64), counts.astype(np.int64)))
            size += len(pairs)
            if size > HELD_PAIRS:
                held = [pack(held)]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    def meet(counted: pa.Table, known: pa.Table) -> pa.Table:
        context, word, counts = pack([tuple(np.concatenate([numbers(x, kind) for x in counted.column(name).to_pylist()] or [np.zeros(0, kind)])
                            for name, kind in (("contexts", np.int32), ("words", np.int64), ("counts", np.int64)))])
        above = mixed(np.asarray(known["node"], np.int64), np.asarray(known["word"], np.int64).view(np.uint64))
        order = np.argsort(above)
        place, found = find(above[order], mixed(suffix[context], word.view(np.uint64)))
        assert found.all(), "a symbol follows a context, but not its suffix"
        return pa.table({"context": pa.array(context), "word": pa.array(word), "n": pa.array(counts),
                         "log_suffix": pa.array(np.asarray(known["log_p"], float)[order][place] if len(place) else np.zeros(0))})

    parts = tokens.select("held", "lengths", "hashes", "flat").mapInArrow(
        run, "bucket int, contexts binary, words binary, counts binary")
    needed = F.broadcast(tokens.sparkSession.createDataFrame(pa.table({"node": np.unique(suffix).astype(np.int32)})))
    suffixes = suffixes.join(needed, "node", "left_semi").select(
        "node", "word", "log_p", F.pmod("word", F.lit(groups)).cast("int").alias("bucket"))
    return parts.groupBy("bucket").cogroup(suffixes.groupBy("bucket")).applyInArrow(
        meet, "context int, word long, n long, log_suffix double")


def divergence(context: np.ndarray, n: np.ndarray, p_suffix: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """How much contexts diverge from their suffixes; log10 probability of listed symbols, and by context that of the rest.

    A listed symbol's probability is its count less ``DISCOUNT``, and what all gave up is dealt out as the suffix does;
    the rest goes to all other symbols in proportion to the suffix's probabilities, so every distribution sums to one.
    The divergence of a context is the log-likelihood of its own next symbols over that under its suffix, where each
    occurrence is judged by the counts without it, so that symbols seen once speak against a context.
    :func:`common_symbols` says the same of common contexts, in columns.
    """
    sums = lambda x: np.bincount(context, weights=x, minlength=len(size)).astype(float)
    kinds, total = sums(np.ones(len(n))), np.maximum(size, 1)
    p = (n - DISCOUNT + DISCOUNT * kinds[context] * p_suffix) / total[context]
    others = np.where(n > 1, kinds[context], kinds[context] - 1)
    p_without = (np.maximum(n - 1 - DISCOUNT, 0) + DISCOUNT * others * p_suffix) / np.maximum(total[context] - 1, 1)
    gain = sums(n * np.log(np.maximum(p_without, 1e-300) / p_suffix))
    rest = (1 - np.minimum(sums(p), 1 - 1e-9)) / (1 - np.minimum(sums(p_suffix), 1 - 1e-9))
    gain += np.maximum(size - sums(n), 0) * np.log(rest)
    return gain, np.log10(p), np.log10(rest)


def common_symbols(pairs: DataFrame, contexts: int) -> tuple[DataFrame, str, np.ndarray, np.ndarray]:
    """Counted symbols of common contexts with ``log_p`` and ``log_suffix``, and their folder; the contexts to keep, and their rest.

    ``pairs`` comes from :func:`next_counts`. Every symbol seen in training is listed, so nothing is left over but what was never seen. Only a few sums a context reach the driver.
    """
    spark, kinds, size = pairs.sparkSession, np.zeros(contexts, np.int64), np.zeros(contexts, np.int64)
    small = lambda **columns: F.broadcast(spark.createDataFrame(pa.table(
        {"context": pa.array(np.arange(contexts), pa.int32()), **columns})))
    folder = write_cut(pairs)
    counted = spark.read.schema(pairs.schema).parquet(folder)
    found = counted.groupBy("context").agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("kinds")).toArrow()
    at = np.asarray(found["context"])
    kinds[at], size[at] = np.asarray(found["kinds"]), np.asarray(found["n"])
    n, share, seen = F.col("n"), F.pow(F.lit(10.0), F.col("log_suffix")), F.col("n") > 0
    others = F.col("kinds") - F.when(n > 1, 0).otherwise(1)
    p = (n - DISCOUNT + DISCOUNT * F.col("kinds") * share) / F.col("size")
    without = (F.greatest(n - 1 - DISCOUNT, F.lit(0.0)) + DISCOUNT * others * share) / F.greatest(F.col("size") - 1, F.lit(1))
    symbols = counted.join(small(size=np.maximum(size, 1), kinds=kinds), "context")
    sums = symbols.filter(seen).groupBy("context").agg(
        F.sum(n * F.log(F.greatest(without, F.lit(1e-300)) / share)).alias("gain"), F.sum(p).alias("mass"),
        F.sum(share).alias("mass_suffix")).toArrow()
    at, gain, rest = np.asarray(sums["context"]), np.zeros(contexts), np.zeros(contexts)
    gain[at] = np.asarray(sums["gain"])
    mass, mass_suffix = (np.minimum(np.asarray(sums[name], float), 1 - 1e-9) for name in ("mass", "mass_suffix"))
    rest[at] = np.log10((1 - mass) / (1 - mass_suffix))
    symbols = symbols.select("context", "word", "n", "log_suffix", F.when(seen, F.log10(p)).alias("log_p"))
    return symbols, folder, (gain > GAIN) & (size > 0), rest


def fit(tokens_table: DataFrame, words_table: DataFrame) -> Tree:
    """The common contexts over all training text, with the symbols that go to all tasks."""
    return grown(tokens_table, words_table)[0]


def grown(tokens_table: DataFrame, words_table: DataFrame) -> tuple[Tree, DataFrame, list[str]]:
    """The common contexts over all training text, one length after the other; ``node, word, log_p`` of other symbols, and
    the folders these lie in.

    Contexts of one word are the frequent words and the start. A longer one is a retained context with a word before
    it that occurs often enough, which the counts of that word's own next symbols bound from above. All symbols that
    were seen after a context are counted and listed with it. The tree holds the listed ones that are frequent; the rest
    comes as a table, and in it also the symbols that follow a context or occur in held-out documents alone.
    """
    sizes = words_table.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    tokens, size = int(sizes["n"] or 0), int(sizes["v"] or 0)
    least = max(LISTED_SHARE * tokens, 1)
    frequent = words_table.filter(F.col("n") >= least).select(F.col("word").alias("w"), "n").toArrow()
    hashes, counts = np.asarray(frequent["w"], np.int64).view(np.uint64), np.asarray(frequent["n"], np.int64)
    order = np.argsort(hashes)
    tree = Tree(tokens, size, hashes[order], np.zeros(0))
    tree.log_p = tree.log_unseen(counts[order])
    symbols = words_table.select(F.lit(0).alias("node"), "word", "n", F.log10(
        (F.col("n") + ADDED) / F.lit(tokens + ADDED * (size + 1))).alias("log_p"))
    unlisted = symbols.filter(F.col("n") < least).drop("n")
    if not tokens:
        return tree, unlisted, []
    starts = np.sort(hashes[counts >= CONTEXT_SHARE * tokens])
    root = np.zeros(len(starts), np.int64)
    keys = mixed(root, starts)
    order = np.argsort(keys)
    candidates, suffix, names = keys[order], root, [(int(w),) for w in starts[order]]

    first_node, folders = 1, []
    while len(candidates) and len(tree.levels) < DEPTH:
        scored, folder, keep, rest = common_symbols(
            next_counts(tokens_table, tree, candidates, symbols.drop("n"), suffix), len(candidates))
        folders.append(folder)
        release(words_table.sparkSession)
        number = np.full(len(candidates), -1, np.int64)
        number[keep] = first_node + np.arange(keep.sum())
        kept = F.broadcast(words_table.sparkSession.createDataFrame(pa.table({
            "context": pa.array(np.flatnonzero(keep), pa.int32()), "node": number[keep].astype(np.int32), "rest": rest[keep]})))
        symbols = scored.join(kept, "context").select(
            "node", "word", "n", F.coalesce("log_p", F.col("log_suffix") + F.col("rest")).alias("log_p"))
        unlisted = unlisted.unionByName(symbols.filter(F.col("n") < least).drop("n"))
        found = scored.filter(F.col("n") >= least).select("context", "word", "n", "log_p").toArrow()
        context, n = np.asarray(found["context"], np.int64), np.asarray(found["n"], np.int64)
        symbol, log_p = np.asarray(found["word"], np.int64).view(np.uint64), np.asarray(found["log_p"], float)
        used = keep[context]
        keys = mixed(number[context[used]], symbol[used])
        order = np.argsort(keys)
        log_rest = np.zeros(first_node + int(keep.sum()))
        log_rest[number[keep]] = rest[keep]
        level = Level(candidates[keep], number[keep], keys[order], log_p[used][order], log_rest, candidates, suffix[keep], first_node)

        # A word before a retained context: the pair must be among the listed next symbols of that word or context.
        ids = {name: node for name, node in zip([n for n, k in zip(names, keep) if k], level.nodes.tolist())}
        longer = {}
        for at in np.flatnonzero(n >= CONTEXT_SHARE * tokens).tolist():
            name = names[context[at]] + (int(symbol[at]),)
            if name[1:] in ids:
                longer[name] = ids[name[1:]]
        tree.levels.append(level)
        first_node += int(keep.sum())
        names = list(longer)
        suffix = np.fromiter(longer.values(), np.int64, len(longer))
        keys = mixed(suffix, np.array([name[0] for name in names], np.uint64))
        order = np.argsort(keys)
        candidates, suffix, names = keys[order], suffix[order], [names[at] for at in order.tolist()]
    return tree, unlisted, folders


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what was written and is not used any more.

    Its listeners hold on to the last query until the next one comes.
    """
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# Tells the groups of one word at several nodes apart; products with a node stay below 63 bits.
SPREAD_NODES = 0x9E3779B97


PLACED = ["slice", "docs", "held", "lengths", "flat", "hashes", "spoken", "codes", "keys"]
SUMS = {"n_known": "bigint", "base_score": "double", "common_score": "double"}


def placed(tokens: DataFrame, tree: Tree) -> DataFrame:
    """The token table, each token at its state; this is found once and never again.

    ``codes`` holds four times the state's node, plus 2 where a context that is not common follows, plus 1 where the tree has the
    token's probability. ``spoken`` are the places of the row's words in the tree, UNLISTED for those it does not have, and ``hashes``
    are of the latter alone. ``keys`` are the words and symbols the tree does not have, in order, see :func:`looked_up`. The sums by
    document are over what it has. ``part`` is the part of ``ROUNDS``.
    """
    def run(batches):
        for row, seq, held in read_tokens(batches, DEPTH):
            node, rare = tree.state(seq.places, seq.names)
            known, log_p = tree.listed(node, seq.tokens)
            at, spoken = find(tree.words, seq.hashes)
            base = np.where(spoken, tree.log_p[at] if len(tree.log_p) else 0.0, 0.0)
            known, log_p = np.where(node > 0, known, spoken[seq.flat]), np.where(node > 0, log_p, base[seq.flat])
            keys = np.sort(np.concatenate([np.flatnonzero(~spoken), (node * len(seq.hashes) + seq.flat)[~known]]))
            keys = keys[np.append(True, keys[1:] != keys[:-1])[:len(keys)]]
            sums = by_document(seq, spoken[seq.flat], base[seq.flat], log_p)
            yield pa.RecordBatch.from_arrays(
                [*[row.column(name) for name in PLACED[:5]], pa.array([seq.hashes[~spoken].tobytes()], pa.binary()),
                 pa.array([planes(np.where(spoken, at, UNLISTED).astype(np.int32))], pa.binary()), pa.array([planes((node * 4 + rare * 2 + known).astype(np.int32))], pa.binary()),
                 pa.array([planes(np.diff(keys, prepend=0))], pa.binary()), *map(as_list, sums)],
                [*PLACED, *SUMS])

    lists = ", ".join(f"{name} array<{kind}>" for name, kind in SUMS.items())
    fields = ", ".join(f"{name} {tokens.schema[name].dataType.simpleString()}" for name in PLACED[:6])
    return tokens.select(*PLACED[:6]).mapInArrow(run, f"{fields}, spoken binary, codes binary, keys binary, {lists}").withColumn(
        "part", F.col("slice") % ROUNDS)


def by_document(seq: Sequences, known: np.ndarray, base: np.ndarray, log_p: np.ndarray) -> list[np.ndarray]:
    """What the tokens add to ``SUMS``."""
    doc = np.repeat(np.arange(len(seq.lengths)), seq.lengths)
    known, base, log_p = (np.bincount(doc, weights=x, minlength=len(seq.lengths)) for x in (known, base, log_p))
    return [known.astype(np.int64), base, log_p]


def read_hashes(row: pa.RecordBatch, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a row, and their places in the tree."""
    spoken = numbers(row.column("spoken")[0].as_py(), np.int32)
    hashes = np.append(tree.words, np.uint64(0))[spoken]
    hashes[spoken == UNLISTED] = np.frombuffer(row.column("hashes")[0].as_py(), np.uint64)
    return hashes, spoken


def read_placed(batches, tree: Tree):
    """The same as :func:`read_tokens`, and the nodes, marks and keys of :func:`placed`."""
    for row, seq, held in read_tokens(batches, DEPTH, tree):
        codes = numbers(row.column("codes")[0].as_py(), np.int32).astype(np.int64)
        yield row, seq, held, codes >> 2, codes & 2 > 0, codes & 1 > 0, read_keys(row)


def read_keys(row: pa.RecordBatch) -> np.ndarray:
    return np.cumsum(numbers(row.column("keys")[0].as_py(), np.int64))


def in_groups(keys: np.ndarray, hashes: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """Keys of a row of the token table in order of the groups of their symbols: group, place in ``keys``, node and word's place."""
    nodes, places = keys // len(hashes), keys % len(hashes)
    group = (hashes[places].view(np.int64) ^ (nodes * SPREAD_NODES)) % groups
    order = np.argsort(group, kind="stable")
    return group[order], order, nodes[order], places[order]


def looked_up(tokens: DataFrame, tree: Tree, unlisted: DataFrame, groups: int, part: int) -> DataFrame:
    """``slice, bucket, answer``: for each row of the token table, log10 probabilities of its ``keys``, by group.

    These are the groups of one part of ``LOOKUPS``. A group holds all requests for its symbols, each at most once a row of the
    token table; no symbol in it has more than ``LISTED_SHARE`` of the training tokens.
    """
    def ask(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                hashes = read_hashes(row, tree)[0]
                group, _, nodes, places = in_groups(read_keys(row), hashes, groups)
                here = group % LOOKUPS == part
                group, nodes, found = group[here], nodes[here].astype(np.int32), hashes[places[here]]
                names, bounds = np.unique(group, return_index=True)
                parts = [slice(*x) for x in zip(bounds, np.append(bounds[1:], len(group)))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int32)), pa.array([row.column("slice")[0].as_py()] * len(names), pa.int64()),
                     pa.array([planes(nodes[x]) for x in parts], pa.binary()), pa.array([planes(found[x]) for x in parts], pa.binary())],
                    ["bucket", "slice", "nodes", "words"])

    def answer(requests: pa.Table, symbols: pa.Table) -> pa.Table:
        keys = mixed(np.asarray(symbols["node"]), np.asarray(symbols["word"], np.int64).view(np.uint64))
        order = np.argsort(keys)
        keys, log_p, out = keys[order], np.asarray(symbols["log_p"])[order], []
        for nodes, found in zip(requests["nodes"].to_pylist(), requests["words"].to_pylist()):
            out.append(shared(log_p[find(keys, mixed(numbers(nodes, np.int32), numbers(found, np.uint64)))[0]]))
        return pa.table({"slice": requests["slice"], "bucket": requests["bucket"], "answer": pa.array(out, pa.binary())})

    requests = tokens.select("slice", "hashes", "spoken", "keys").mapInArrow(
        ask, "bucket int, slice long, nodes binary, words binary")
    symbols = unlisted.withColumn("bucket", F.pmod(
        F.col("word").bitwiseXOR(F.col("node").cast("long") * F.lit(SPREAD_NODES)), F.lit(groups)).cast("int")).filter(
        F.col("bucket") % LOOKUPS == part)
    return requests.groupBy("bucket").cogroup(symbols.groupBy("bucket")).applyInArrow(answer, ANSWERS)


ANSWERS = "slice long, bucket int, answer binary"


def in_order(answers: pa.Table) -> np.ndarray:
    """All answers to one row of the token table, in the order of :func:`in_groups`."""
    found = answers["answer"].to_pylist()
    found = [floats(found[at]) for at in np.argsort(np.asarray(answers["bucket"]))]
    return np.concatenate(found) if found else np.zeros(0)


# A word is its place among the listed ones, UNLISTED with its hash in ``hashes``, or NONE beyond the start.
UNLISTED, NONE = -1, -2
RARE = (("contexts", np.uint64), ("nodes", np.int32), ("sizes", np.int32), ("symbols", np.int32), ("docs", np.int64),
        ("log_p", np.float64), *[(f"before{n}", np.int32) for n in range(1, DEPTH)], ("hashes", np.uint64))
RARE_SCHEMA = ", ".join(["bucket int", *[f"{name} binary" for name, _ in RARE]])


def bucket_of(context: np.ndarray, buckets: int) -> np.ndarray:
    """Group of each context."""
    return ((context * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.int64) % buckets


def rare_rows(held: list[tuple[np.ndarray, ...]], buckets: int) -> pa.RecordBatch:
    """Occurrences as one row a group of contexts, sorted by context; one that shares its high bits may come in several runs.

    An occurrence is ``(context, node, symbol, document)``; then may follow the symbol's log10 probability at the node, 0 if
    the tree has it, the ``DEPTH - 1`` words before the context, and the hashes of the symbol and these words.
    """
    context, node, symbol, doc, *more = (np.concatenate(x) for x in zip(*held))
    if not more:
        nothing, no_hash = np.full(len(context), NONE, np.int32), np.zeros(len(context), np.uint64)
        more = [np.zeros(len(context)), *[nothing] * (DEPTH - 1), *[no_hash] * DEPTH]
    bucket, order = bucket_of(context, buckets).astype(np.min_scalar_type(buckets)), by_high_bits(context)
    order = order[np.argsort(bucket[order], kind="stable")]
    hashes = more[DEPTH:]
    context, node, symbol, doc, log_p, *before, bucket = (x[order] for x in (context, node, symbol, doc, *more[:DEPTH], bucket))
    names, bounds = np.unique(bucket, return_index=True)
    rows = []
    for start, end in zip(bounds, np.append(bounds[1:], len(bucket))):
        first = start + np.flatnonzero(np.append(True, context[start + 1:end] != context[start:end - 1]))
        words_here = [x[start:end] for x in (symbol, *before)]
        strays = np.concatenate([h[order[start:end][w == UNLISTED]] for w, h in zip(words_here, hashes)])
        rows.append((context[first], node[first], np.diff(np.append(first, end)).astype(np.int32),
                     words_here[0], doc[start:end], log_p[start:end], *words_here[1:], strays))
    return pa.RecordBatch.from_arrays(
        [pa.array(names.astype(np.int32)), *[pa.array([planes(x) if x.dtype != np.float64 else shared(x) for x in column], pa.binary()) for column in zip(*rows)]],
        ["bucket", *[name for name, _ in RARE]])


def rare_deltas(tree: Tree, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """What rare contexts add to the scores of documents, for one group of contexts with all their occurrences.

    One value for each context and document it occurs in. Added up over the group there would be fewer in a small corpus, but
    their number would grow with documents times groups until it is the same.

    Contexts whose next symbols diverge enough become nodes below the common ones, and so do the longer ones that end with
    them, all of which are in the group; the test and the smoothing are those of :func:`divergence`. With contexts of one word
    symbols are listed from ``LEAST_SEEN`` occurrences on, with longer ones all that were seen, as with common contexts.
    A document's number is even if it is learnt from.
    """
    listed = np.append(tree.words, np.zeros(2, np.uint64))  # the last two for UNLISTED and NONE
    columns = [[numbers(x, kind) if kind != np.float64 else floats(x) for x in table.column(name).to_pylist()] for name, kind in RARE]
    kinds = np.concatenate(columns[3]).astype(np.int64)
    spoken = [[listed[x] for x in columns[at]] for at in (3, *range(6, 5 + DEPTH))]
    for at, strays in enumerate(columns[-1]):
        start = 0
        for codes, hashes in zip((columns[3][at], *[c[at] for c in columns[6:-1]]), [x[at] for x in spoken]):
            places = np.flatnonzero(codes == UNLISTED)
            hashes[places] = strays[start:start + len(places)]
            start += len(places)
    del columns[6:], columns[3]
    # Each list goes as soon as its values lie together, so that a group is held once.
    symbol, *before = (np.concatenate(spoken.pop(0)) for _ in range(DEPTH))
    contexts, nodes, sizes, doc, log_p = (np.concatenate(columns.pop(0)) for _ in range(5))
    own, node = np.repeat(told_apart(contexts)[0], sizes), np.repeat(nodes, sizes)
    length = np.repeat((1 + tree.length(nodes)).astype(np.int8), sizes)  # of the contexts, in words
    del contexts, nodes, sizes
    context, learnt, strays = own, (doc & 1) == 0, kinds == UNLISTED
    kinds[strays] = len(tree.words) + told_apart(symbol[strays])[0]
    del strays
    width, live, gained = int(kinds.max(initial=0)) + 1, np.arange(len(own)), np.zeros(len(own))
    for step in range(DEPTH):
        size = np.bincount(own, weights=learnt[live]).astype(np.int64)
        again = size[own] > 1  # a context learnt from once gains nothing
        own, live = own[again], live[again]
        place, pair = told_apart(own * width + kinds[live])
        first = first_places(place, len(pair))
        n = np.bincount(place, weights=learnt[live], minlength=len(pair)).astype(np.int64)
        if not step:  # the common state's probabilities, where the tree has them
            known = log_p[live[first]]
            inside = live[first[known == 0]]
            known[known == 0] = tree.given(node[inside].astype(np.int64), symbol[inside])
            log_p[live] = known[place]
            del symbol
        used = np.flatnonzero(n >= (1 if step else np.where(node[live[first]] == 0, LEAST_SEEN, 1)))
        number = np.full(len(pair), -1)
        number[used] = np.arange(len(used))
        gain, log_listed, log_rest = divergence(own[first[used]], n[used], 10.0 ** log_p[live[first[used]]], size)
        kept = gain[own] > GAIN * (length[live] + step)
        own, live, number = own[kept], live[kept], number[place[kept]]
        new = log_p[live] + log_rest[own]
        new[number >= 0] = log_listed[number[number >= 0]]
        gained[live] += new - log_p[live]
        log_p[live] = new
        if step < DEPTH - 1:
            on = before[step][live] != 0
            own, live = own[on], live[on]
            word, several = told_apart(before[step][live])
            own = told_apart(own * len(several) + word)[0]
        if not len(live):
            break
    chosen = np.flatnonzero(gained)
    number, numbered = told_apart(doc[chosen])
    place, pair = told_apart(context[chosen] * max(len(numbered), 1) + number)
    return numbered[pair % max(len(numbered), 1)], np.bincount(place, weights=gained[chosen], minlength=len(pair)).astype(float)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Learns from the documents that :func:`held_out` leaves. A text's tokens are its words and one end; a null or empty
    text is its end alone. ``base_score`` is the log10 probability under smoothed word counts, ``score`` that under the
    tree; unknown words share what the base distribution leaves for one more word. ``n_known`` counts tokens seen in
    training. Repeated rows come out repeated, and count as often in training; other columns are not looked at.
    Without training documents every token is unknown and ``train_tokens`` is 0.

    Texts are read once, into a table of hashed tokens. Frequent words, common contexts and their frequent symbols are bounded
    in number (see the constants above) and go to the tasks. Each row of the token table looks up the probabilities of its other
    words and symbols, once each. Where a token's state ends before a context that is not common, its occurrence goes to the
    group of that context with the words before it; the group counts the context and all longer ones, decides which are nodes, and
    hands back what they add to each document. The number of such contexts grows with the input.
    """
    rows = texts(docs, key, text).withColumn("held_out", held_out(F.col("doc_id")))
    spark = rows.sparkSession
    plain = write_cut(tokenise(rows))
    tokens = spark.read.parquet(plain)
    known = vocabulary(tokens)
    release(spark)
    tree, unlisted, folders = grown(tokens, known)
    buckets = tree.tokens // GROUP_TOKENS + 1
    release(spark)
    at_states = placed(tokens, tree)
    schema, states = at_states.schema, write_cut(at_states, "part")
    delete_folder(spark, plain)
    tokens = spark.read.schema(schema).parquet(states)
    answers = []
    for part in range(min(LOOKUPS, buckets)):
        answers.append(write_cut(looked_up(tokens, tree, unlisted, buckets, part).withColumn("part", F.col("slice") % ROUNDS), "part"))
        release(spark)
    for folder in folders:
        delete_folder(spark, folder)
    del known, unlisted
    release(spark)

    def enriched(own: pa.Table, answered: pa.Table) -> pa.Table:
        out = []
        for row, seq, held, node, _, listed, keys in read_placed(own.to_batches(), tree):
            _, order, *_ = in_groups(keys, seq.hashes, buckets)
            found, base, log_p = np.zeros(len(keys)), np.zeros(len(seq.hashes)), np.zeros(len(seq.flat))
            found[order] = in_order(answered)
            alone = keys < len(seq.hashes)
            base[keys[alone]] = found[alone]
            other = np.flatnonzero(~listed)
            log_p[other] = found[find(keys, node[other] * len(seq.hashes) + seq.flat[other])[0]]
            known = (base > tree.log_unseen(0.5)) & (base < 0) if tree.tokens else np.zeros(len(base), bool)
            sums = by_document(seq, known[seq.flat], base[seq.flat], log_p)
            sums = [np.asarray(row.column(name).flatten()) + more for name, more in zip(SUMS, sums)]
            out.append(pa.RecordBatch.from_arrays(
                [*[row.column(name) for name in PLACED], pa.array([shared(found)], pa.binary()),
                 *map(as_list, sums)], [*PLACED, "log_p", *SUMS]))
        return pa.Table.from_batches(out)

    def occurrences(part):
        def of(batches):
            held, size = [], 0
            for row, seq, marks, node, rare, listed, keys in read_placed(batches, tree):
                length, back = tree.length(node), [*seq.places, *[np.full(len(seq.flat), -1)] * (DEPTH - 1)]
                last = np.choose(length, back[:DEPTH + 1])
                context = mixed(node, seq.names[last])
                at = np.flatnonzero(rare & (bucket_of(context, buckets) % ROUNDS == part))
                context, length, node = context[at], length[at], node[at]
                code = np.append(read_hashes(row, tree)[1], np.int32(NONE))
                back = np.stack([places[at] for places in back])
                spoken = [seq.flat[at], *[back[length + step, np.arange(len(at))] for step in range(1, DEPTH)]]
                log_p, other = np.zeros(len(at)), np.flatnonzero(~listed[at])
                found = floats(row.column("log_p")[0].as_py())
                log_p[other] = found[find(keys, node[other] * len(seq.hashes) + spoken[0][other])[0]]
                doc = np.repeat(np.arange(len(marks)), seq.lengths)[at]
                # A document's number in the task's rows: row of the token table, place in it, and the mark.
                doc = (row.column("slice")[0].as_py() << 21) + (doc << 1) + marks[doc]
                held.append((context, node.astype(np.int32), code[spoken[0]], doc, log_p,
                             *[code[x] for x in spoken[1:]], *[seq.names[x] for x in spoken]))
                size += len(at)
                if size > HELD_RARE:
                    yield rare_rows(held, buckets)
                    held, size = [], 0
            if size:
                yield rare_rows(held, buckets)
        return of

    def deltas(table: pa.Table) -> pa.Table:
        numbered, sums = rare_deltas(tree, table)
        return pa.table({"tag": numbered >> 1, "rare_context": sums})

    fields = [f"{name} {schema[name].dataType.simpleString()}" for name in (*PLACED, *SUMS)]
    schema = ", ".join([*fields[:len(PLACED)], "log_p binary", *fields[len(PLACED):]])
    joined = []
    for part in range(ROUNDS):
        own, *found = (spark.read.schema(kind).parquet(folder).filter(F.col("part") == part).drop("part")
                       for folder, kind in ((states, at_states.schema), *[(folder, f"{ANSWERS}, part long") for folder in answers]))
        found = reduce(DataFrame.unionByName, found)
        joined.append(write_cut(own.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(enriched, schema)))
        release(spark)
        for folder in (states, *answers):
            delete_folder(spark, f"{folder}/part={part}")
    for folder in (states, *answers):
        delete_folder(spark, folder)
    tokens = spark.read.schema(schema).parquet(*joined)
    found = tokens.select("slice", F.posexplode(F.arrays_zip("docs", "held", "lengths", "n_known", "base_score", "common_score"))).select(
        (F.shiftleft("slice", 20) + F.col("pos")).alias("tag"), F.col("col.docs").alias("doc_id"), F.col("col.held").alias("held_out"),
        F.col("col.lengths").alias("n_tokens"), "col.n_known", "col.base_score", "col.common_score")
    parts = []
    for part in range(min(ROUNDS, buckets) if tree.tokens else 0):
        per_group = tokens.select("slice", "held", "lengths", "flat", "hashes", "spoken", "codes", "keys", "log_p").mapInArrow(
            occurrences(part), RARE_SCHEMA).groupBy("bucket")
        parts.append(cut(per_group.applyInArrow(deltas, "tag long, rare_context double").groupBy("tag").agg(
            F.sum("rare_context").alias("rare_context"))))
        release(spark)
    added = F.lit(0.0)
    for at, sums in enumerate(parts):
        found = found.join(sums.withColumnRenamed("rare_context", f"rare{at}"), "tag", "left")
        added = added + F.coalesce(f"rare{at}", F.lit(0.0))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tree.tokens).cast("long").alias("train_tokens"),
                        "base_score", (F.col("common_score") + added).alias("score"))
