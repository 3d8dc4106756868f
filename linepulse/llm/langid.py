"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams weighted by TF-IDF; weights are trained
by follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalties),
and a temperature fitted on documents set apart calibrates the probabilities.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import (VECTOR_FIELDS, map_slices, table, texts_of, vector_rows,
                                  vector_sum)

ORDERS = (1, 2, 3)
FEATURE_BITS = 16
MAX_TRAIN = 8_000            # documents used for fitting, at most; shared over the languages
CALIBRATE = 5                # every fifth of them sets the temperature instead
UNKNOWN = "und"
CHUNK = 1 << 20              # characters hashed at once
_SPACE = 32
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of a whole text and how often each occurs.

    Characters are lower-cased, others than letters count as a space, and
    n-grams of spaces alone are left out; a text without a letter has none.
    """
    text = " " + (text or "").lower() + " "
    counts = np.zeros(1 << FEATURE_BITS, dtype=np.int64)
    reach = max(ORDERS) - 1
    for lo in range(0, len(text), CHUNK):
        part = text[lo:lo + CHUNK + reach].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(part, "<u4")
        codes = np.where(_letters()[codes], codes, _SPACE).astype(np.uint64)
        for n in ORDERS:
            starts = min(CHUNK, len(codes) - n + 1)
            if starts <= 0:
                continue
            mixed = np.full(starts, n, dtype=np.uint64)
            letter = np.zeros(starts, dtype=bool)
            for k in range(n):
                at = codes[k:k + starts]
                mixed = (mixed + at) * np.uint64(_FACTORS[k])
                letter |= at != _SPACE
            hashed = (mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
            counts += np.bincount(hashed[letter], minlength=len(counts))
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray          # by feature
    weights: np.ndarray      # [feature, language]
    bias: np.ndarray
    temperature: float

    def logits(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = tf_idf(found, counts, self.idf)
        return x @ self.weights[found] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found, counts = ngram_counts(text)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0
        z = self.logits(found, counts) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def tf_idf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[found]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Number of documents with a letter, and of those with each feature."""
    def run(batches):
        df, n = np.zeros(1 << FEATURE_BITS), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found, _ = ngram_counts(t)
                df[found] += 1
                n += len(found) > 0
        part = TaskContext.get().partitionId()
        rows = [*vector_rows("df", part, df), *vector_rows("n", part, np.array([n]))] if n else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.binary())], names=["name", "part", "vec"])

    sums = vector_sum(docs.select(F.col(f"`{text}`")).mapInArrow(run, VECTOR_FIELDS))
    if not sums:
        return 0, np.zeros(1 << FEATURE_BITS)
    return int(sums["n"][0]), sums["df"]


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, alpha: float = 1.0,
             beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, epochs: int = 4,
             batch: int = 32, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights [feature, class] and bias by FTRL-proximal with an elastic net.

    A weight is zero while |z| <= l1, else -(z - sign(z) l1) / ((beta + sqrt(n))
    / alpha + l2), with z the adjusted sum of gradients and n that of their
    squares.  The last feature stands for the bias and is not penalised.
    """
    size = (1 << FEATURE_BITS) + 1
    z, n = np.zeros((size, classes)), np.zeros((size, classes))
    rng = np.random.default_rng(seed)

    def weights(at: np.ndarray) -> np.ndarray:
        zz, free = z[at], (at == size - 1)[:, None]
        one = np.where(free, 0.0, l1)
        two = np.where(free, 0.0, l2)
        return np.where(np.abs(zz) > one, -(zz - np.sign(zz) * one)
                        / ((beta + np.sqrt(n[at])) / alpha + two), 0.0)

    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            chosen = order[lo:lo + batch]
            col = np.concatenate([np.append(rows[i][0], size - 1) for i in chosen])
            val = np.concatenate([np.append(rows[i][1], 1.0) for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) + 1 for i in chosen])
            at, inv = np.unique(col, return_inverse=True)
            w = weights(at)
            logit = np.stack([np.bincount(row, val * w[inv, k], len(chosen))
                              for k in range(classes)], axis=1)
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            g = np.stack([np.bincount(inv, val * p[row, k], len(at)) for k in range(classes)], axis=1)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    final = weights(np.arange(size))
    return final[:-1], final[-1]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by a search on a log scale."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        z = logits / t
        top = z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z - top).sum(axis=1)) + top[:, 0] - z[np.arange(len(y)), y]))

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 61))
    best = int(np.argmin([loss(t) for t in grid]))
    fine = np.exp(np.linspace(np.log(grid[max(best - 1, 0)]), np.log(grid[min(best + 1, 60)]), 41))
    return float(fine[int(np.argmin([loss(t) for t in fine]))])


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          max_train: int = MAX_TRAIN) -> LanguageModel:
    """A model of the documents with a language; those of other columns are not read.

    Document frequencies cover all of them; the weights are fitted on at most
    ``max_train``, an equal number of each language as far as there are, chosen
    by the hashes of their ids.  Texts without a letter teach nothing.
    """
    known = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"),
                        F.col(f"`{lang}`").alias("lang")).filter(F.col("lang").isNotNull())
    per = {r["lang"]: r["n"] for r in
           known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(per)
    total, df = document_frequencies(known)
    idf = np.log((1 + total) / (1 + df)) + 1
    if not total:
        return LanguageModel([], idf, np.zeros((1 << FEATURE_BITS, 0)), np.zeros(0), 1.0)
    share = F.lit(0.0)
    for name, n in per.items():
        share = F.when(F.col("lang") == name, max_train / len(languages) / n).otherwise(share)
    place = F.pmod(F.xxhash64("id", F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.withColumn("place", place).filter(F.col("place") < share)

    def make():
        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            found = [ngram_counts(t) for t in texts_of(part)]
            return [pa.array([f.astype("<u4").tobytes() for f, _ in found], pa.binary()),
                    pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary())]
        return fn

    sample = (map_slices(chosen, make, "found binary, counts binary").drop("text")
              .orderBy("place", "id", "lang", "found").limit(max_train).collect())
    rows, y = [], []
    for r in sample:
        found = np.frombuffer(bytes(r["found"]), "<u4").astype(np.int64)
        if len(found):
            rows.append((found, tf_idf(found, np.frombuffer(bytes(r["counts"]), "<u4"), idf)))
            y.append(languages.index(r["lang"]))
    y = np.array(y, dtype=np.int64)
    set_apart = np.arange(len(rows)) % CALIBRATE == CALIBRATE - 1
    weights, bias = fit_ftrl([rows[i] for i in np.flatnonzero(~set_apart)], y[~set_apart],
                             len(languages))
    logits = np.array([x @ weights[f] + bias for f, x in
                       (rows[i] for i in np.flatnonzero(set_apart))]).reshape(-1, len(languages))
    return LanguageModel(languages, idf, weights, bias, fit_temperature(logits, y[set_apart]))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, its calibrated probability, from whole
    texts.  A null text, one without a letter, or any text under a model
    without languages is ``und`` with score 0.  Repeated rows get equal results;
    columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            found = [m.predict(t) for t in texts_of(part, text)]
            return [pa.array([x for x, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64())]
        return fn

    return map_slices(docs, make, "lang_pred string, score double")


def op3_langid(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose fold is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held = F.coalesce(fold == 2, F.lit(False))
    model = train(docs.filter(~held))
    return identify(docs.select("doc_id", "text", held.alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", F.round("score", 6).alias("score"))
