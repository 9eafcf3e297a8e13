"""Byte-pair encoding by speculation: longest matches are proposed, adjacent pairs verified."""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from skein.llm.rows import key_type, slices, texts

WORD_END = "</w>"
# The end of a word as a symbol after the 256 bytes.
END = 256
NEVER = 1 << 40
# Words a worker remembers before it starts anew, and the longest it remembers, in characters.
CACHE_ENTRIES = 300_000
CACHE_BYTES = 64
# Bytes of text split into words at once; each word is an object of some sixty bytes until the texts are encoded.
BATCH_BYTES = 1 << 19
# Longer words are merged one by one with a queue instead of side by side in arrays.
ARRAY_SYMBOLS = 64
# Printable ASCII and the letters of Latin-1: already composed, each in lower case by itself. The words
# are the classes of the tokenizer's own pattern for these characters; all others go through its library.
SPACES = re.compile("[ \t-\r]+")
SIMPLE = re.compile("[ \t-\r!-~À-ÖØ-öø-ÿ]*")
SIMPLE_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
SIMPLE_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_symbols() -> list[str]:
    """The public byte alphabet: printable bytes stand for themselves, the others for signs from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


@dataclass
class Tables:
    """What a worker needs of a tokenizer file, as arrays made once by the driver."""

    definition: str
    tokens: list[str]
    special: dict[str, int]
    symbols: np.ndarray  # id of each byte, and at 256 + byte of the byte that ends a word
    made: np.ndarray  # rank of the merge that makes a token, -1 for symbols
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_tokens: np.ndarray
    edges: np.ndarray  # sorted keys node * 257 + symbol of the trie of all tokens
    children: np.ndarray
    ends: np.ndarray  # token that ends in a node, or -1
    sound: np.ndarray = field(default=None)

    @classmethod
    def read(cls, path: str) -> Tables:
        with open(path, encoding="utf-8") as file:
            definition = file.read()
        parts = json.loads(definition)
        model, special = parts["model"], {t["content"]: t["id"] for t in parts["added_tokens"]}
        pattern = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if model.get("end_of_word_suffix") != WORD_END or pattern != SIMPLE_PATTERN:
            raise ValueError(f"{path} is not a vocabulary of words that end in {WORD_END}")
        vocab = model["vocab"]
        size = max([*vocab.values(), *special.values()]) + 1
        tokens = [""] * size
        for token, at in chain(vocab.items(), special.items()):
            tokens[at] = token
        made, left, right = np.full(size, -1, np.int64), np.arange(size), np.arange(size)
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        for rank, (one, two, both) in enumerate(merges):
            made[both], left[both], right[both] = rank, one, two
        keys = np.array([one * size + two for one, two, _ in merges], np.int64)
        order = np.argsort(keys)
        alphabet = byte_symbols()
        symbols = np.array([vocab[c] for c in alphabet] + [vocab[c + WORD_END] for c in alphabet], np.int64)
        byte_of = {c: b for b, c in enumerate(alphabet)}
        edges: dict[int, int] = {}
        ends = [-1]
        for token, at in vocab.items():
            path_symbols = [byte_of[c] for c in token.removesuffix(WORD_END)] + [END] * token.endswith(WORD_END)
            node = 0
            for symbol in path_symbols:
                child = edges.setdefault(node * (END + 1) + symbol, len(ends))
                if child == len(ends):
                    ends.append(-1)
                node = child
            ends[node] = at
        edge_keys = np.fromiter(edges, np.int64, len(edges))
        edge_order = np.argsort(edge_keys)
        tables = cls(definition, tokens, special, symbols, made, left, right,
                     keys[order], np.arange(len(keys))[order], np.array([m[2] for m in merges], np.int64)[order],
                     edge_keys[edge_order], np.fromiter(edges.values(), np.int64, len(edges))[edge_order],
                     np.array(ends, np.int64))
        tables.sound = tables._sound_tokens()
        return tables

    def pairs(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of each pair (``NEVER`` where there is none), and where it stands."""
        keys = one * len(self.tokens) + two
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER), at

    def crossings(self, one: np.ndarray, two: np.ndarray, top: np.ndarray | int = 2 * NEVER) -> np.ndarray:
        """Which pairs are merged across their border when their texts stand side by side.

        Goes back in time from the finished neighbours. ``x`` and ``y`` touch the border from when the
        younger of them was made until the first of them is taken up by its successor (``x_until``,
        ``y_until``). Their own merge goes ahead if its rank comes before that; at equal ranks the merge
        further left goes first, which is the one that takes up ``x``, but not the one that takes up ``y``.
        """
        x, y = one.copy(), two.copy()
        x_until, y_until = np.zeros(len(x), np.int64) + top, np.zeros(len(x), np.int64) + top
        crossed = np.zeros(len(x), bool)
        live = np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            rank, _ = self.pairs(a, b)
            hit = (rank < x_until[live]) & (rank <= y_until[live]) & (rank < NEVER)
            crossed[live[hit]] = True
            older_right = self.made[a] > self.made[b]
            done = hit | ((self.made[a] < 0) & (self.made[b] < 0))
            on_left, on_right = live[older_right & ~done], live[~older_right & ~done]
            x_until[on_left] = self.made[x[on_left]]
            x[on_left] = self.right[x[on_left]]
            y_until[on_right] = self.made[y[on_right]]
            y[on_right] = self.left[y[on_right]]
            live = live[~done]
        return crossed

    def _sound_tokens(self) -> np.ndarray:
        """Tokens that merging their own text gives back: no merge crosses before the one that makes them."""
        at = np.flatnonzero(self.made >= 0)
        sound = np.ones(len(self.tokens), bool)
        sound[at] = ~self.crossings(self.left[at], self.right[at], self.made[at])
        for token in at[np.argsort(self.made[at])].tolist():
            sound[token] &= sound[self.left[token]] and sound[self.right[token]]
        return sound


def packed(ids: tuple[int, ...]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class Codec:
    """Encoder and decoder for a vocabulary whose words end in ``</w>``.

    Normalising and cutting a text into words is the tokenizer file's definition; chunks between white
    space never influence each other. A word is encoded once and remembered. All new words are cut greedily into the longest tokens, side by side along a trie. That cut is what
    merging gives exactly if no merge ever crosses a border between neighbours, which is tested for all
    new pairs at once. Only words with a failing pair are merged, and words of more than ``ARRAY_SYMBOLS`` characters, which
    would hold up all others in the cut.
    """

    def __init__(self, tables: Tables):
        self.tables = tables
        self.decimal = [str(i) for i in range(len(tables.tokens))]
        self.special_split = re.compile("(" + "|".join(map(re.escape, tables.special)) + ")")
        # Ids as the bytes of 32-bit numbers, a fourth of what tuples of numbers take.
        self.words: dict[str | int, bytes] = {}
        self.tried = self.failed = 0
        self.library = self.cutter = self.ranks = None

    def greedy(self, flat: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest tokens from left to right for all words: word numbers and tokens, words in order.

        ``flat`` holds bytes with ``END`` after each word. A word that cannot be finished ends in -1.
        """
        t = self.tables
        at, node = starts.copy(), np.zeros(len(starts), np.int64)
        best, best_at = np.full(len(starts), -1, np.int64), starts.copy()
        live, found = np.arange(len(starts)), []
        while len(live):
            here = at[live]
            inside = here < stops[live]
            keys = node[live] * (END + 1) + flat[np.minimum(here, len(flat) - 1)]
            edge = np.minimum(np.searchsorted(t.edges, keys), len(t.edges) - 1)
            go = inside & (t.edges[edge] == keys)
            on = live[go]
            node[on] = t.children[edge[go]]
            at[on] += 1
            token = t.ends[node[on]]
            # A token that would leave only the end of the word helps nobody.
            good = (token >= 0) & (at[on] != stops[on] - 1)
            best[on[good]], best_at[on[good]] = token[good], at[on[good]]
            stuck = live[~go]
            found.append((stuck, best[stuck]))
            at[stuck] = best_at[stuck]
            node[stuck] = 0
            over = stuck[(best[stuck] < 0) | (best_at[stuck] >= stops[stuck])]
            best[stuck] = -1
            keep = np.ones(len(starts), bool)
            keep[over] = False
            live = live[keep[live]]
        words = np.concatenate([f[0] for f in found])
        tokens = np.concatenate([f[1] for f in found])
        order = np.argsort(words, kind="stable")
        return words[order], tokens[order]

    def merge_all(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Exact merging of short words side by side: per step each word's pair of lowest rank, leftmost first."""
        t = self.tables
        lengths = np.array([len(w) for w in words])
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        last = np.cumsum(lengths) - 1
        symbols[last] += 256
        symbols = t.symbols[symbols]
        of = np.repeat(np.arange(len(words)), lengths)
        done: list = [None] * len(words)
        while len(of):
            rank, at = t.pairs(symbols[:-1], symbols[1:])
            rank = np.append(np.where(of[:-1] == of[1:], rank, NEVER), NEVER)
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            ended = lowest == NEVER
            stops = np.append(first[1:], len(of))
            for n in np.flatnonzero(ended).tolist():
                done[of[first[n]]] = tuple(symbols[first[n]:stops[n]].tolist())
            sizes = stops - first
            hit = np.flatnonzero((rank == np.repeat(lowest, sizes)) & (rank < NEVER))
            hit = hit[np.append(True, of[hit][1:] != of[hit][:-1])] if len(hit) else hit
            symbols[hit] = t.pair_tokens[at[hit]]
            keep = np.repeat(~ended, sizes)
            keep[hit + 1] = False
            symbols, of = symbols[keep], of[keep]
        return done

    def merge_long(self, word: bytes) -> tuple[int, ...]:
        """Exact merging of one word with a queue of its pairs."""
        t = self.tables
        if self.ranks is None:
            size = len(t.tokens)
            self.ranks = {divmod(k, size): (r, m) for k, r, m in zip(
                t.pair_keys.tolist(), t.pair_ranks.tolist(), t.pair_tokens.tolist())}
        ranks = self.ranks
        symbols = t.symbols[np.frombuffer(word, np.uint8)].tolist()
        symbols[-1] = int(t.symbols[256 + word[-1]])
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(ranks[p][0], at, p) for at, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        heapq.heapify(queue)
        while queue:
            _, at, pair = heapq.heappop(queue)
            nxt = after[at]
            if symbols[at] != pair[0] or nxt >= n or symbols[nxt] != pair[1]:
                continue
            symbols[at], symbols[nxt] = ranks[pair][1], -1
            after[at] = after[nxt]
            if after[at] < n:
                before[after[at]] = at
            for one in (before[at], at):
                if one >= 0 and after[one] < n:
                    p = symbols[one], symbols[after[one]]
                    if p in ranks:
                        heapq.heappush(queue, (ranks[p][0], one, p))
        return tuple(s for s in symbols if s >= 0)

    def learn(self, wanted: set[str]) -> None:
        """Encode words not met before."""
        if len(self.words) > CACHE_ENTRIES:
            self.words.clear()
        new = [w for w in wanted if w not in self.words]
        # The greedy cut walks all words side by side, as many steps as the longest has bytes: very long ones are merged alone.
        for word in [w for w in new if len(w) > ARRAY_SYMBOLS]:
            self.words[word] = packed(self.merge_long(word.encode()))
        new = [w for w in new if len(w) <= ARRAY_SYMBOLS]
        if not new:
            return
        joined = ("\0".join(new) + "\0").encode()
        flat = np.frombuffer(joined, np.uint8).astype(np.int64)
        stops = np.flatnonzero(flat == 0) + 1
        if len(stops) != len(new):  # some words hold the separator
            lengths = np.array([len(w.encode()) + 1 for w in new])
            stops = np.cumsum(lengths)
        starts = np.append(0, stops[:-1])
        flat[stops - 1] = END
        of, tokens = self.greedy(flat, starts, stops)
        bad = np.zeros(len(new), bool)
        bad[of[(tokens < 0) | ~self.tables.sound[tokens]]] = True
        inside = np.flatnonzero((of[:-1] == of[1:]) & (tokens[:-1] >= 0) & (tokens[1:] >= 0))
        size = len(self.tables.tokens)
        keys, back = np.unique(tokens[inside] * size + tokens[inside + 1], return_inverse=True)
        bad[of[inside[self.tables.crossings(keys // size, keys % size)[back]]]] = True
        self.tried += len(new)
        self.failed += int(bad.sum())
        bounds = (np.searchsorted(of, np.arange(len(new) + 1)) * 4).tolist()
        ids = tokens.astype(np.int32).tobytes()
        merged = np.flatnonzero(bad)
        short = merged[(stops - starts)[merged] <= ARRAY_SYMBOLS + 1].tolist()
        known = self.words
        for at, word in enumerate(new):
            known[word] = ids[bounds[at]:bounds[at + 1]]
        pieces = [joined[starts[at]:stops[at] - 1] for at in short]
        if pieces:
            known.update(zip((new[at] for at in short), map(packed, self.merge_all(pieces))))
        for at in merged[(stops - starts)[merged] > ARRAY_SYMBOLS + 1].tolist():
            known[new[at]] = packed(self.merge_long(joined[starts[at]:stops[at] - 1]))

    def split(self, text: str) -> list[str | int]:
        """Words of a text, and ids of the special tokens written in it."""
        if "<|" in text:
            found = [self.tables.special.get(p, p) for p in self.special_split.split(text) if p]
            return list(chain.from_iterable([p] if type(p) is int else self.split_plain(p) for p in found))
        return self.split_plain(text)

    def split_plain(self, text: str) -> list[str]:
        if SIMPLE.fullmatch(text):
            return SIMPLE_WORDS.findall(text.lower())
        if self.library is None:
            self.library = Tokenizer.from_str(self.tables.definition)
            self.cutter = pre_tokenizers.Split(Regex(SIMPLE_PATTERN), "removed", invert=True)
        normal = self.library.normalizer.normalize_str
        words = []
        for chunk in SPACES.split(text):
            if SIMPLE.fullmatch(chunk):
                words += SIMPLE_WORDS.findall(chunk.lower())
            else:
                words += [word for word, _ in self.cutter.pre_tokenize_str(normal(chunk))]
        return words

    def encode_batch(self, batch: list[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        split = [self.split(text) for text in batch]
        wanted = set(chain.from_iterable(split))
        self.learn({w for w in wanted if type(w) is not int})
        self.words.update((w, packed((w,))) for w in self.tables.special.values())
        get = self.words.__getitem__
        for words in split:
            yield np.frombuffer(b"".join(map(get, words)), np.int32).tolist()
        for word in [w for w in wanted if type(w) is not int and len(w) > CACHE_BYTES]:
            del self.words[word]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: the file names no decoder."""
        return " ".join(map(self.tables.tokens.__getitem__, ids))


def _long_lived(run):
    """Run a task's loop without the collector of cycles, which would walk the remembered words over and over."""
    def quiet(batches):
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()
    return quiet


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, as the tokenizers library gives them.

    No special tokens are added; those written in a text become their ids. A null or empty text, and one
    of white space only, has no ids. One row per input row, repeated rows included; other columns are
    ignored. No shuffle. A worker holds one slice of texts and a bounded memory of words.
    """
    tables = Tables.read(path)

    def run(batches):
        codec = Codec(tables)
        for part in slices(batches, limit=BATCH_BYTES):
            ids = list(codec.encode_batch(part.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = texts(docs, key, text)
    return rows.mapInArrow(_long_lived(run), f"doc_id {key_type(rows)}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``, special tokens included; null ids give an empty text."""
    tables = Tables.read(path)

    def run(batches):
        codec = Codec(tables)
        for part in batches:
            out = [codec.decode(ids or []) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {key_type(encoded)}, text string")


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: :func:`encode` and :func:`decode` in one pass.

    Hashes of the decimal ids joined by one space and of the decoded text; cases as for :func:`encode`.
    """
    tables = Tables.read(path)

    def run(batches):
        codec = Codec(tables)
        for part in slices(batches, limit=BATCH_BYTES):
            counts, ids_hash, text_hash = [], [], []
            for ids in codec.encode_batch(part.column("text").to_pylist()):
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(" ".join(map(codec.decimal.__getitem__, ids)).encode()).hexdigest())
                text_hash.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = texts(docs, key, text)
    return rows.mapInArrow(_long_lived(run), f"doc_id {key_type(rows)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
