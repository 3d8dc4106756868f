"""Quality rules: gradient-boosted trees over document statistics.

Trees are grown on histograms with monotonic constraints on chosen features,
flattened into numpy node arrays, and score whole batches at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_slices, table, texts_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_TRAIN = 20_000           # labelled documents used for fitting, at most
KEEP_AT = 0.5

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))
_ASCII_LETTERS = _UPPER + bytes(range(0x61, 0x7B))
_MULTIPLIERS = np.random.default_rng(8).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)

# Features of the trees; sign of the constraint on quality (0: free).
FEATURES = [("symbol_ratio", -1), ("dup_line_ratio", -1), ("repeat_ratio", -1), ("upper_ratio", -1),
            ("shout_ratio", -1), ("pipe_ratio", -1), ("log_words", 0), ("mean_word", 0),
            ("digit_ratio", 0), ("letter_ratio", 0), ("distinct_ratio", 0), ("line_words", 0)]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        mixed += hashes[k:k + n] * _MULTIPLIERS[k]
    in_order = np.sort(mixed)
    twice = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(twice):
        return 0
    places: dict[tuple[bytes, ...], list[int]] = {}
    for i in np.flatnonzero(np.isin(mixed, twice)).tolist():
        places.setdefault(tuple(words[i:i + window]), []).append(i)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for found in places.values():
        if len(found) > 1:
            np.add.at(edge, found, 1)
            np.add.at(edge, np.array(found) + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the
    features of a whole text; null is empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE.encode())]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    letters = len(raw) - len(raw.translate(None, _ASCII_LETTERS))
    digits = len(raw) - len(raw.translate(None, _DIGITS))
    per_word = max(n, 1)
    features = [symbols / per_word, dup_lines / max(len(lines), 1), repeats / per_word,
                upper / max(letters, 1), text.count("!") / per_word, text.count("|") / per_word,
                float(np.log1p(n)), chars / per_word, digits / max(chars, 1),
                letters / max(len(raw), 1), len(set(words)) / per_word, n / max(len(lines), 1)]
    return [n, chars, symbols, dup_lines, repeats], features


@dataclass
class Trees:
    """All nodes of all trees in flat arrays.  A leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        margin = self.base + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int], rounds: int = 60, depth: int = 3,
              rate: float = 0.2, bins: int = 64, penalty: float = 1.0,
              min_weight: float = 2.0) -> Trees:
    """Boosted trees for the log loss.  A feature of sign s may only split so
    that s * (right - left) >= 0, and the halves' midpoint bounds the leaves
    below on either side, so the whole score is monotonic in it.

    Without rows, or with one class, there are no trees and the probability is
    the smoothed share of ones (1/2 without rows).
    """
    share = (y.sum() + 1) / (len(y) + 2)
    nodes: list[list[float]] = []                # feature, threshold, left, right, value
    roots: list[int] = []
    base = float(np.log(share / (1 - share)))
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
                for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left")
                           for f, c in enumerate(cuts)], axis=1)
        margin = np.full(len(y), base)

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            g, h = gradient[rows], hessian[rows]
            value = float(np.clip(-g.sum() / (h.sum() + penalty), low, high))
            me = len(nodes)
            nodes.append([0, np.inf, me, me, rate * value])
            best = None
            if level < depth:
                total = g.sum() ** 2 / (h.sum() + penalty)
                for f, c in enumerate(cuts):
                    gl = np.cumsum(np.bincount(binned[rows, f], g, len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[rows, f], h, len(c) + 1))[:-1]
                    gr, hr = g.sum() - gl, h.sum() - hl
                    left = np.clip(-gl / (hl + penalty), low, high)
                    right = np.clip(-gr / (hr + penalty), low, high)
                    gain = gl ** 2 / (hl + penalty) + gr ** 2 / (hr + penalty) - total
                    fits = ((hl >= min_weight / 4) & (hr >= min_weight / 4) & (gain > 1e-6)
                            & (signs[f] * (right - left) >= 0))
                    gain = np.where(fits, gain, -np.inf)
                    if len(gain) and gain.max() > (best[0] if best else 0):
                        k = int(gain.argmax())
                        best = (gain[k], f, k, float(left[k] + right[k]) / 2)
            if best is None:
                margin[rows] += rate * value
                return me
            _, f, k, middle = best
            bounds = {0: (low, high, low, high), -1: (middle, high, low, middle),
                      1: (low, middle, middle, high)}[signs[f]]
            is_left = binned[rows, f] <= k
            nodes[me][:2] = [f, float(cuts[f][k])]
            nodes[me][2] = grow(rows[is_left], level + 1, *bounds[:2])
            nodes[me][3] = grow(rows[~is_left], level + 1, *bounds[2:])
            return me

        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            gradient, hessian = p - y, p * (1 - p)
            roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    flat = np.array(nodes, dtype=np.float64).reshape(-1, 5)
    as_int = lambda k: flat[:, k].astype(np.int32)
    return Trees(as_int(0), flat[:, 1], as_int(2), as_int(3), flat[:, 4],
                 np.array(roots, dtype=np.int32), depth, base)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the contract's counts and ``features`` (array of doubles).
    A null, empty or blank text has zeros.  Columns of these names are replaced."""
    def make():
        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            found = [statistics(t) for t in texts_of(part, text)]
            counts = [pa.array([c[k] for c, _ in found], pa.int64()) for k in range(5)]
            return [*counts, pa.array([f for _, f in found], pa.list_(pa.float64()))]
        return fn

    return map_slices(docs, make, "n_words long, word_chars long, n_symbols long, "
                                  "n_dup_lines long, n_repeat_words long, features array<double>")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", max_train: int = MAX_TRAIN) -> Trees:
    """Trees from at most ``max_train`` labelled documents, those whose ids hash
    lowest.  Null labels and ids are left out; of several labels of a document
    the least counts, of several rows of an id one."""
    chosen = (labels.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
              .groupBy(F.col(f"`{doc_id}`").alias("id"))
              .agg(F.min(F.col(f"`{label}`")).cast("int").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(max_train))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = (with_statistics(texts.join(F.broadcast(chosen), "id"))
            .groupBy("id").agg(F.min(F.struct("features", "y")).alias("r"))
            .select("id", "r.*").orderBy("id").collect())
    x = np.array([r["features"] for r in rows], dtype=np.float64).reshape(-1, len(FEATURES))
    y = np.array([min(max(r["y"], 0), 1) for r in rows], dtype=np.float64)
    return fit_trees(x, y, [s for _, s in FEATURES])


def judge(docs: DataFrame, trees: Trees, text: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """``docs`` with the counts, base_failed, quality (probability) and kept.

    base_failed: fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT
    percent of them in repeated windows; such documents are not kept, nor those
    of a quality below ``keep_at``.  A null text has no words and so fails.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def make():
        model = shared.value

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            rows = part.column(part.schema.names.index("features"))
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            return [pa.array(model.probability(x))]
        return fn

    scored = map_slices(with_statistics(docs, text), make, "quality double").drop("features")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= keep_at))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = judge(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept",
                        F.round("quality", 6).alias("quality"))
