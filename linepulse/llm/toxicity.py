"""Toxicity severity by cumulative-link ordinal regression on sparse features.

P(grade >= k) = sigmoid(s - theta_k) with one score s = sum of w_j * log1p(count
of feature j) for all grades and ordered thresholds theta_1 < theta_2 < ...; the
expected severity is the sum of these probabilities.  Features are words and
the beginnings of longer words.  Weights are fitted under an L1 penalty on a
bounded sample of labelled documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_slices, numbered, stage, table, texts_of
from linepulse.llm.decontaminate import words_of

MAX_TRAIN = 20_000       # labelled documents used for fitting, at most
MIN_DOCS = 3             # documents of the sample that a feature must occur in
MIN_Z = 2.5              # and by how many deviations its share must differ between labels
BEGINNINGS = (4, 6)      # characters of a longer word that count as a feature
REMEMBERED = 300_000     # words whose features a task remembers
MARKER_LOG_ODDS = 3.0
REJECT_AT = 0.4          # expected severity from which a document is toxic
ROUNDS = 600
L1 = 2e-4


def words(text: str | None) -> list[bytes]:
    return words_of((text or "").lower())


def features(word: bytes) -> list[bytes]:
    """The word, and its beginnings, marked by a hyphen."""
    if len(word) <= min(BEGINNINGS):
        return [word]
    letters = word.decode("utf-8", "surrogatepass")
    return [word, *((letters[:n] + "-").encode("utf-8", "surrogatepass")
                    for n in BEGINNINGS if n < len(letters))]


def feature_counts(text: str | None) -> Counter:
    counts: Counter = Counter()
    for w, c in Counter(words(text)).items():
        for f in features(w):
            counts[f] += c
    return counts


@dataclass
class OrdinalModel:
    """Weights by feature and ascending thresholds, one for each grade above 0."""

    weights: dict[bytes, float]
    thresholds: np.ndarray

    def __post_init__(self):
        self.remembered: dict[bytes, tuple[bytes, ...]] = {}

    def score(self, text: str | None) -> float:
        weights, known = self.weights, self.remembered
        if len(known) > REMEMBERED:
            known.clear()
        found: Counter = Counter()
        for w in words(text):
            own = known.get(w)
            if own is None:
                own = known[w] = tuple(f for f in features(w) if f in weights)
            if own:
                found.update(own)
        return float(sum(weights[f] * np.log1p(c) for f, c in sorted(found.items())))

    def at_least(self, score: float) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(score - self.thresholds, -40, 40)))


@dataclass
class Sample:
    """Labelled documents as rows of a sparse matrix of word counts."""

    vocabulary: list[bytes]
    labels: np.ndarray
    lengths: np.ndarray          # entries of each row
    word: np.ndarray             # by entry
    count: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.labels), dtype=np.int32), self.lengths)


def sample_words(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
                 max_train: int, min_docs: int = MIN_DOCS) -> Sample:
    """At most ``max_train`` labelled documents: those whose ids hash lowest, so
    the sample is the same each time.  Features of fewer than ``min_docs`` of
    them, or about as frequent whether the label is above 0 or not, are left
    out; they are counted in Spark, and the driver gets numbers of the rest."""
    chosen = (labels.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
              .groupBy(F.col(f"`{doc_id}`").alias("id"))
              .agg(F.max(F.col(f"`{label}`")).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(max_train))
    texts = (docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
             .join(F.broadcast(chosen), "id"))

    def count():
        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            counted = [feature_counts(t) for t in texts_of(part)]
            return [pa.array([list(c) for c in counted], pa.list_(pa.binary())),
                    pa.array([list(c.values()) for c in counted], pa.list_(pa.int32()))]
        return fn

    held = stage(map_slices(texts, count, "words array<binary>, counts array<int>").drop("text")
                 .groupBy("id").agg(F.min(F.struct("words", "counts", "label")).alias("r"))
                 .select("id", "r.*"), "toxicity_sample")
    sizes = held.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") > 0).alias("n1")).first()
    n1, n0 = max(sizes["n1"], 1), max(sizes["n"] - sizes["n1"], 1)
    share = F.col("n") / (n1 + n0)
    spread = F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    differs = F.abs(F.col("k1") / n1 - (F.col("n") - F.col("k1")) / n0) >= MIN_Z * spread
    vocabulary = [bytes(r["w"]) for r in held.select("label", F.explode("words").alias("w"))
                  .groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") > 0).alias("k1"))
                  .filter((F.col("n") >= min_docs) & differs).select("w").orderBy("w").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def number():
        at = {w: k for k, w in enumerate(shared.value)}

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            names = part.schema.names
            out = []
            for ws, cs in zip(part.column(names.index("words")).to_pylist(),
                              part.column(names.index("counts")).to_pylist()):
                known = [(at[w], c) for w, c in zip(ws, cs) if w in at]
                out.append(np.array(known, dtype="<i4").reshape(-1, 2).tobytes())
            return [pa.array(out, pa.binary())]
        return fn

    rows = map_slices(held, number, "entries binary").select("id", "label", "entries").orderBy("id").collect()
    entries = [np.frombuffer(bytes(r["entries"]), "<i4").reshape(-1, 2) for r in rows]
    every = np.concatenate(entries) if entries else np.zeros((0, 2), np.int32)
    return Sample(vocabulary, np.array([r["label"] for r in rows], dtype=np.int64),
                  np.array([len(e) for e in entries], dtype=np.int64),
                  np.ascontiguousarray(every[:, 0]), np.ascontiguousarray(every[:, 1]))


def severity_grades(sample: Sample) -> np.ndarray:
    """Ordered grades from toxic yes/no labels: 0 for no; yes splits in two at
    the median count of marker words, those with a log odds ratio above
    MARKER_LOG_ODDS between toxic and other documents."""
    toxic, row, size = sample.labels > 0, sample.row, len(sample.vocabulary)
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    with1 = np.bincount(sample.word, toxic[row], size)
    with0 = np.bincount(sample.word, minlength=size) - with1
    odds = np.log((with1 + .5) / (n1 + 1)) - np.log((with0 + .5) / (n0 + 1))
    marker = (with1 >= MIN_DOCS) & (odds > MARKER_LOG_ODDS)
    found = np.bincount(row, sample.count * marker[sample.word], len(toxic))
    middle = np.median(found[toxic]) if n1 else 0
    return np.where(toxic, np.where(found > middle, 2, 1), 0)


def fit_ordinal(sample: Sample, grades: np.ndarray, l1: float = L1, rounds: int = ROUNDS) -> OrdinalModel:
    """Minimise the mean negative log-likelihood plus l1 * |w| over w >= 0 by
    accelerated proximal gradient steps; thresholds are kept in order.  As no
    weight is negative, a text without known features is the least severe, and
    none is made milder by words added to it.

    Without rows, or with one grade only, no word has a weight and the
    thresholds follow the shares of the grades (smoothed by one row each).
    """
    top = max(int(grades.max(initial=0)), 1)
    n, size = len(grades), len(sample.vocabulary)
    share = np.array([((grades >= k).sum() + 1) / (n + top + 1) for k in range(1, top + 1)])
    theta = np.log(1 - share) - np.log(share) + 1e-3 * np.arange(top)
    if not size or len(np.unique(grades)) < 2:
        return OrdinalModel({}, theta)
    j, row = sample.word, sample.row
    v = np.log1p(sample.count.astype(np.float32))
    at = np.arange(n)

    def gradient(w: np.ndarray, th: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = np.bincount(row, weights=v * w[j], minlength=n)
        # cdf[:, k] = P(grade <= k - 1), with 0 and 1 at the ends
        z = np.clip(th[None, :] - s[:, None], -40, 40)
        cdf = np.hstack([np.zeros((n, 1)), 1 / (1 + np.exp(-z)), np.ones((n, 1))])
        density = cdf * (1 - cdf)
        p = np.maximum(cdf[at, grades + 1] - cdf[at, grades], 1e-12)
        ds = (density[at, grades + 1] - density[at, grades]) / p / n   # of -log p by s
        dth = np.zeros(top + 2)
        np.add.at(dth, grades + 1, -density[at, grades + 1] / p / n)
        np.add.at(dth, grades, density[at, grades] / p / n)
        return np.bincount(j, weights=v * ds[row], minlength=size), dth[1:-1]

    # A diagonal step: the curvature by a weight is at most a quarter of its
    # feature's mean square times the features that share its rows.
    mass = np.bincount(row, weights=v, minlength=n)
    step = 2.0 / np.maximum(np.bincount(j, weights=v * mass[row], minlength=size) / n, 1e-9)
    w, look, momentum = np.zeros(size), np.zeros(size), 1.0
    for _ in range(rounds):
        gw, gth = gradient(look, theta)
        moved = look - step * gw
        new = np.maximum(moved - step * l1, 0)
        nxt = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        look, w, momentum = new + (momentum - 1) / nxt * (new - w), new, nxt
        theta = np.maximum.accumulate(theta - 1.0 * gth + 1e-6 * np.arange(top))
    return OrdinalModel({sample.vocabulary[k]: float(w[k])
                         for k in np.flatnonzero(np.abs(w) > 1e-6)}, theta)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", graded: bool = False, max_train: int = MAX_TRAIN) -> OrdinalModel:
    """The model of at most ``max_train`` labelled documents.  ``graded``:
    the labels are ordered grades 0, 1, 2, ... already; else yes/no labels are
    split by ``severity_grades``.  Null labels and ids are left out; of several
    labels of a document the greatest counts."""
    sample = sample_words(docs, labels, doc_id, text, label, max_train)
    return fit_ordinal(sample, np.maximum(sample.labels, 0) if graded else severity_grades(sample))


def score(docs: DataFrame, model: OrdinalModel, text: str = "text",
          reject_at: float = REJECT_AT) -> DataFrame:
    """``docs`` with severity (expected grade), grade (the most probable) and
    toxic (severity >= reject_at).

    Whole texts are scored; a null, empty or wordless text has score 0, the
    severity of a document without any known word.  Repeated rows get equal
    results, other columns stay, and columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            above = np.array([m.at_least(m.score(t)) for t in texts_of(part, text)])
            above = above.reshape(-1, len(m.thresholds))
            severity = above.sum(axis=1)
            edges = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
            grade = np.argmax(edges[:, :-1] - edges[:, 1:], axis=1)
            return [pa.array(severity), pa.array(grade.astype(np.int32)),
                    pa.array(severity >= reject_at)]
        return fn

    return map_slices(docs, make, "severity double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """``docs`` without the toxic rows; columns stay as they are."""
    plain, text = numbered(docs, text)
    return score(plain, model, text).filter(~F.col("toxic")).drop(
        "severity", "grade", "toxic").toDF(*docs.columns)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = score(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", F.round("severity", 6).alias("severity"), "grade", "toxic")
