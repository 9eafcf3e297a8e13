"""Quality and toxicity of documents, learnt by two views that teach each other."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.rows import key_type, slices, with_text
from skein.session import cut

# Labelled rows the classifiers are fitted on at most, and unlabelled ones they teach each other with. Rows beyond are
# left out by a hash of their key. This bounds what the driver holds; scores cover all rows.
LABELLED_ROWS = 12_000
POOL_ROWS = 6_000
# Text features (words and their beginnings) a classifier looks at: those that tell the classes apart best.
FEATURES = 3_000
# Log-likelihood ratio, in nats, below which a feature's link to a label may be chance among so many features.
LEAST_RATIO = 9.0
# Length of word beginnings that are features of their own.
STEMS = (4, 5, 6)
ROUNDS = 3
# A view labels a row for the other one when it is this sure.
SURE = 0.98
# Share of the labelled rows kept for calibration.
HELD_SHARE = 0.25
RIDGE = 1.0
SEED = 42
# Chance from which a row is rejected: of being toxic, or of not being good.
REJECT = 0.5

SHAPES = ("upper", "signs", "bars", "digits", "repeated", "distinct", "length", "word_length")


def text_features(text: str) -> set[str]:
    """Words of a text (letters only, in lower case), and their beginnings with a dash."""
    words = set(WORD.findall(text.lower()))
    return words.union(word[:n] + "-" for word in words for n in STEMS if len(word) > n)


WORD = re.compile(r"[^\W\d_]+")


def shape(text: str) -> list[float]:
    """Measures of how a text is written, in the order of ``SHAPES``."""
    n = max(len(text), 1)
    words = text.split()
    m = max(len(words), 1)
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÍÎÏÑÓÔÖÚÙÛÜ"))
    return [upper / n, sum(map(text.count, "!#$%&*<>{}[]=_~^\\")) / n, text.count("|") / m, sum(map(text.count, "0123456789")) / n,
            sum(a == b for a, b in zip(words, words[1:])) / m, len(set(words)) / m, math.log1p(len(words)), n / m]


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> list[str]:
    """What is known of a page without its text; null is a value of its own."""
    size = "none" if n_chars is None else str(int(math.log2(max(n_chars, 1)) * 2))
    return [f"lang={lang}", f"source={source}", f"size={size}", f"lang={lang} size={size}"]


class Sparse:
    """Rows of features as index pairs, with a column of ones and dense columns after the sparse ones."""

    def __init__(self, row: np.ndarray, column: np.ndarray, width: int, dense: np.ndarray):
        self.row, self.column, self.width, self.n = row, column, width, len(dense)
        self.dense = np.hstack([dense, np.ones((len(dense), 1))])

    @classmethod
    def of(cls, rows: list[list[int]], width: int, dense: np.ndarray) -> Sparse:
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return cls(row, np.fromiter((c for r in rows for c in r), np.int64, len(row)), width, dense)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column], minlength=self.n) + self.dense @ w[self.width:]

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.column, weights=g[self.row], minlength=self.width), self.dense.T @ g)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logistic(x: Sparse, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE, steps: int = 300) -> np.ndarray:
    """Weights of a logistic regression with a ridge on all but the constant, by accelerated gradient steps."""
    w = np.zeros(x.width + x.dense.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    # Each column's own bound on the curvature keeps a step from overshooting where features meet in one row.
    per_row = np.bincount(x.row, minlength=x.n) + np.abs(x.dense).sum(axis=1)
    curve = np.append(np.bincount(x.column, weights=(weight * per_row)[x.row], minlength=x.width),
                      np.abs(x.dense).T @ (weight * per_row)) / 4 + penalty
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        step = ahead - (x.back(weight * (sigmoid(x.dot(ahead)) - y)) + penalty * ahead) / curve
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead = step + (t - 1) / t_next * (step - w)
        w, t = step, t_next
    return w


@dataclass
class Classifier:
    """Both views of one label, calibrated and combined."""

    features: dict[str, int]  # text features looked at
    centre: np.ndarray
    scale: np.ndarray
    text: np.ndarray  # weights
    metadata: dict[str, float]
    metadata_constant: float
    combine: np.ndarray  # weight of either view's log-odds, and a constant

    def text_rows(self, found: list, shapes: np.ndarray) -> Sparse:
        """``found`` holds text features, of which only those of this classifier count."""
        rows = [[self.features[f] for f in features if f in self.features] for features in found]
        return Sparse.of(rows, len(self.features), (shapes - self.centre) / self.scale)

    def metadata_odds(self, rows: list[list[str]]) -> np.ndarray:
        return np.array([sum(self.metadata.get(f, 0.0) for f in r) + self.metadata_constant for r in rows])

    def chance(self, found: list, shapes: np.ndarray, metadata: list[list[str]]) -> np.ndarray:
        odds = np.stack([self.text_rows(found, shapes).dot(self.text), self.metadata_odds(metadata)], axis=1)
        return sigmoid(odds @ self.combine[:2] + self.combine[2])


def part_of_ratio(n: Column, of: Column, share: Column) -> Column:
    return F.when(n > 0, n * F.log(n / (of * share))).otherwise(0.0)


def telling(sample: DataFrame, label: str) -> list[str]:
    """The ``FEATURES`` text features whose presence says most about a label, by the log-likelihood ratio.

    Counted over the training rows of the sample; a task adds up its documents before anything is shuffled.
    """
    training = sample.filter(f"not held and {label} is not null")
    total = training.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("n1")).first()
    if not total["n"] or not 0 < total["n1"] < total["n"]:
        return []

    def run(batches):
        for part in slices(batches):
            counts, ones = defaultdict(int), defaultdict(int)
            for content, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                for feature in text_features(content or ""):
                    counts[feature] += 1
                    if y:
                        ones[feature] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts)), pa.array(list(counts.values()), pa.int64()),
                 pa.array([ones.get(f, 0) for f in counts], pa.int64())], ["feature", "n", "n1"])

    counted = training.select("text", F.col(label).alias("y")).mapInArrow(run, "feature string, n long, n1 long").groupBy(
        "feature").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    n, n1, all_n, all_n1 = F.col("n"), F.col("n1"), F.lit(total["n"]), F.lit(total["n1"])
    share = F.lit(total["n1"] / total["n"])
    ratio = (part_of_ratio(n1, n, share) + part_of_ratio(n - n1, n, 1 - share)
             + part_of_ratio(all_n1 - n1, all_n - n, share) + part_of_ratio(all_n - n - all_n1 + n1, all_n - n, 1 - share))
    best = counted.withColumn("ratio", ratio).filter(F.col("ratio") > LEAST_RATIO).orderBy(F.desc("ratio"), "feature").limit(FEATURES)
    return [row["feature"] for row in best.collect()]


def fit_one(sample: dict, features: list[str], y: np.ndarray, labelled: np.ndarray, held: np.ndarray) -> Classifier:
    """Co-training: in every round each view labels, for the other one only, the pool rows it is sure of.

    Both views start from the labelled rows not held back. Sure means a calibrated chance beyond ``SURE`` either way. The
    held rows then calibrate the final views (a line through each view's log-odds) and weigh them against each other.
    """
    found, shapes, metadata = sample["found"], sample["shapes"], sample["metadata"]
    train, pool = labelled & ~held, ~labelled
    fitted = Classifier({f: i for i, f in enumerate(features)}, shapes[train].mean(axis=0), shapes[train].std(axis=0) + 1e-9, None, {}, 0.0, None)
    # Features are numbered over both labels; those of this one are picked out.
    number = np.full(len(sample["wanted"]) + 1, -1, np.int64)
    number[[sample["wanted"][f] for f in features]] = np.arange(len(features))
    own = number[found[1]] >= 0
    x_text = Sparse(found[0][own], number[found[1][own]], len(features), (shapes - fitted.centre) / fitted.scale)
    names = {f: i for i, f in enumerate(sorted({f for i in np.flatnonzero(train) for f in metadata[i]}))}
    x_meta = Sparse.of([[names[f] for f in r if f in names] for r in metadata], len(names), np.zeros((len(metadata), 0)))
    taught = [(train.astype(float), np.where(train, y, 0).astype(float)) for _ in range(2)]
    weights: list = [None, None]
    lines = [np.array([1.0, 0.0]), np.array([1.0, 0.0])]
    for turn in range(ROUNDS + 1):
        for view, x in enumerate((x_text, x_meta)):
            weights[view] = logistic(x, taught[view][1], taught[view][0])
            lines[view] = calibrate(x.dot(weights[view])[held], y[held])
        if turn == ROUNDS:
            break
        for view, x in enumerate((x_text, x_meta)):
            chance = sigmoid(x.dot(weights[view]) * lines[view][0] + lines[view][1])
            sure = pool & (np.abs(chance - 0.5) > SURE - 0.5)
            weight, label = taught[1 - view]
            fresh = sure & (weight == 0)
            weight[fresh], label[fresh] = 0.5, chance[fresh] > 0.5
    odds = np.stack([x_text.dot(weights[0]) * lines[0][0] + lines[0][1], x_meta.dot(weights[1]) * lines[1][0] + lines[1][1]], axis=1)
    both = logistic(Sparse.of([[]] * int(held.sum()), 0, odds[held]), y[held].astype(float), np.ones(int(held.sum())), 0.1)
    both = np.array([max(both[0], 0.0), max(both[1], 0.0), both[2]])
    fitted.combine = np.array([both[0] * lines[0][0], both[1] * lines[1][0], both[0] * lines[0][1] + both[1] * lines[1][1] + both[2]])
    fitted.text, fitted.metadata = weights[0], dict(zip(names, weights[1][:len(names)].tolist()))
    fitted.metadata_constant = float(weights[1][-1])
    return fitted


def calibrate(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and shift that turn a view's scores into log-odds on rows it has not seen."""
    scale = np.abs(odds).mean() + 1e-9
    w = logistic(Sparse.of([[]] * len(odds), 0, odds[:, None] / scale), y.astype(float), np.ones(len(odds)), 0.1)
    return np.array([max(w[0], 0.05) / scale, w[1]])


def sample_rows(docs: DataFrame, labels: DataFrame, key: str, label_key: str) -> DataFrame:
    """The rows the classifiers see, written out: labelled and unlabelled ones, each the first by a hash of their key."""
    known = labels.select(F.col(label_key).alias("k"), F.col("quality").cast("int"), F.col("toxic").cast("int")).dropna().groupBy(
        "k").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    ids = docs.select(F.col(key).alias("k")).filter("k is not null").distinct()
    both = ids.join(known, "k", "left").withColumn("draw", F.xxhash64("k"))
    first = both.filter("quality is not null").orderBy("draw", "k").limit(LABELLED_ROWS)
    pool = both.filter("quality is null").orderBy("draw", "k").limit(POOL_ROWS)
    drawn = F.broadcast(cut(first.unionByName(pool)))
    rows = docs.select(F.col(key).alias("k"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    held = F.col("quality").isNotNull() & (F.pmod(F.xxhash64(F.lit(SEED), "k"), F.lit(1000)) < int(1000 * HELD_SHARE))
    # Of rows that repeat a key, the least by text and metadata is learnt from, so every run learns from the same.
    first = F.min(F.struct("text", "lang", "source", "n_chars")).alias("x")
    kept = rows.join(drawn, "k").groupBy("k", "quality", "toxic", "draw").agg(first)
    return cut(kept.select("k", "x.*", "quality", "toxic", "draw").withColumn("held", held))


def measures(part: pa.RecordBatch, wanted: frozenset[str]) -> tuple[list[set[str]], np.ndarray, list[list[str]]]:
    """Wanted text features, shapes and metadata features of a slice of rows."""
    contents = [t or "" for t in part.column("text").to_pylist()]
    metadata = [metadata_features(*r) for r in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "n_chars")))]
    return [text_features(t) & wanted for t in contents], np.array([shape(t) for t in contents]).reshape(-1, len(SHAPES)), metadata


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label_key: str = "doc_id") -> dict[str, Classifier | float]:
    """A classifier for ``quality`` and one for ``toxic``; the plain share of a label where one class has too few rows.

    Features are chosen and measured by tasks; the driver gets, for the bounded sample, the chosen ones of each row.
    """
    drawn = sample_rows(docs, labels, key, label_key)
    chosen = {name: telling(drawn, name) for name in ("quality", "toxic")}
    numbered = {f: at for at, f in enumerate(sorted({*chosen["quality"], *chosen["toxic"]}))}
    wanted = frozenset(numbered)

    def run(batches):
        for part in slices(batches):
            found, shapes, metadata = measures(part, wanted)
            found = [sorted(map(numbered.__getitem__, f)) for f in found]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("draw", "held", "quality", "toxic")),
                 pa.array(found, pa.list_(pa.int32())),
                 pa.array(shapes.tolist(), pa.list_(pa.float64())), pa.array(metadata, pa.list_(pa.string()))],
                ["draw", "held", "quality", "toxic", "found", "shapes", "metadata"])

    table = drawn.withColumn("draw", F.xxhash64("k")).mapInArrow(
        run, "draw long, held boolean, quality int, toxic int, found array<int>, shapes array<double>, metadata array<string>"
    ).toArrow().combine_chunks().sort_by("draw")
    flat = lambda c: pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c
    ids, shapes = flat(table["found"]), flat(table["shapes"])
    sample = {"found": (np.repeat(np.arange(len(ids)), np.diff(np.asarray(ids.offsets))), np.asarray(ids.flatten()).astype(np.int64)),
              "wanted": numbered, "shapes": np.asarray(shapes.flatten()).reshape(-1, len(SHAPES)),
              "metadata": table["metadata"].to_pylist()}
    labelled, held = ~np.asarray(table["quality"].is_null()), np.asarray(table["held"], bool)
    truth = {name: np.asarray(table[name].fill_null(0)).astype(int) for name in ("quality", "toxic")}
    del table, ids, shapes
    out: dict[str, Classifier | float] = {}
    for name in ("quality", "toxic"):
        y = truth[name]
        enough = all((y[rows] == c).sum() >= 2 for rows in (held, labelled & ~held) for c in (0, 1))
        out[name] = (fit_one(sample, chosen[name], y, labelled, held) if enough
                     else float((y[labelled].sum() + 1) / (labelled.sum() + 2)))
    return out


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label_key: str = "doc_id", rows: bool = False) -> DataFrame:
    """``doc_id, p_quality, p_toxic, rejected`` for every row; with ``rows`` also the row as ``row``.

    ``docs`` has ``text, lang, source, n_chars`` beside the key; any of them may be null, an empty or null text has no
    words. Rows with a null key are scored, but not learnt from; of rows that repeat a key one is learnt from. Labels with a
    null or without a document are left out, of repeated ones the greater counts. A label with fewer than four rows of a
    class gets its share among the labels as everybody's chance, 0.5 without labels. ``rejected`` is more than an even
    chance of being toxic or of not being good. Whole texts are scored where they are read, without a shuffle.
    """
    models = fit(docs, labels, key, label_key)
    wanted = frozenset(f for m in models.values() if isinstance(m, Classifier) for f in m.features)
    metadata = [F.col(c).cast(kind).alias(c) for c, kind in (("lang", "string"), ("source", "string"), ("n_chars", "long"))]
    content = F.struct(*[docs[c] for c in docs.columns]).alias("row") if rows else F.col("text").cast("string").alias("text")
    named = docs.select(F.col(key).alias("doc_id"), content, *metadata)

    def run(batches):
        for part in slices(with_text(batches, "text") if rows else batches):
            seen = measures(part, wanted)
            chances = [np.full(part.num_rows, m) if isinstance(m, float) else m.chance(*seen)
                       for m in (models["quality"], models["toxic"])]
            rejected = (chances[0] < REJECT) | (chances[1] > REJECT)
            arrays = [part.column("doc_id"), pa.array(chances[0]), pa.array(chances[1]), pa.array(rejected)]
            arrays += [part.column("row")] if rows else []
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "p_quality", "p_toxic", "rejected", "row"][:len(arrays)])

    schema = f"doc_id {key_type(named)}, p_quality double, p_toxic double, rejected boolean"
    return named.mapInArrow(run, schema + (f", row {key_type(named, 'row')}" if rows else ""))
