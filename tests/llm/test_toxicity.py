import numpy as np
import pytest
from pyspark.sql import functions as F

from linepulse.llm import toxicity as tx
from tests.llm.cases import docs, messy, sentence
import random


def corpus(seed=1, n=240):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = sentence(rng, rng.randint(5, 60)).split()
        if bad:
            for _ in range(1 + i % 8):
                words.insert(rng.randrange(len(words)), rng.choice(["Vile", "nasty!", "RÜDE"]))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learns_and_grades_in_order(spark):
    rows, labels = corpus()
    df = docs(spark, rows)
    lab = spark.createDataFrame(labels + [(0, 1, None), (None, 1, 1), (9999, 0, 1)],
                                "doc_id long, quality int, toxic int")
    model = tx.train(df.filter("doc_id < 160"), lab)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    assert {b"vile", b"nasty", "rüde".encode()} <= set(model.weights)
    found = tx.score(df.withColumn("Severity", F.lit("clash")), model).collect()
    assert [r.toxic for r in sorted(found, key=lambda r: r.doc_id)] == [i % 4 == 0 for i in range(240)]
    held = {r.doc_id: r.severity for r in found if r.doc_id >= 160}
    assert np.mean([s for i, s in held.items() if i % 8 == 4]) > np.mean(
        [s for i, s in held.items() if i % 8 == 0])
    for r in found:
        above = model.at_least(model.score(rows[r.doc_id][1]))
        assert r.severity == pytest.approx(above.sum()) and all(np.diff(above) <= 0)


def test_gradient_fits_given_grades(spark):
    rows, _ = corpus()
    grades = [(i, 3 if "RÜDE" in r[1] else 1 if "Vile" in r[1] else 0) for i, r in enumerate(rows)]
    model = tx.train(docs(spark, rows), spark.createDataFrame(grades, "doc_id long, g int"),
                     label="g", graded=True)
    found = {r.doc_id: r.grade for r in tx.score(docs(spark, rows), model).collect()}
    assert np.mean([found[i] == g for i, g in grades]) > 0.93


def test_awkward_rows_and_bound(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = tx.sample_words(docs(spark, rows + rows[:5]), lab, "doc_id", "text", "toxic", 50)
    assert len(sample.labels) == 50
    model = tx.train(docs(spark, rows), lab)
    df = docs(spark, messy())
    found = tx.score(df, model).collect()
    assert len(found) == len(messy()) and not any(r.toxic for r in found)
    empty = model.at_least(0.0).sum()
    assert all(r.severity == pytest.approx(empty) for r in found if not (r.text or "").strip())
    assert tx.keep_clean(df, model).dtypes == df.dtypes
    assert tx.score(docs(spark, []), model).count() == 0


def test_without_labels_nothing_is_toxic(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = tx.train(docs(spark, messy()), none)
    assert model.weights == {}
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    found = tx.score(docs(spark, messy()), tx.train(docs(spark, messy()), one))
    assert found.filter("toxic").count() == 0


def test_severity_equals_plain_arithmetic(spark):
    """Words, beginnings of 4 and 6 letters, log counts and sigmoids by hand."""
    import math
    import re

    weights = {b"vile": 1.5, b"nast-": .75, b"nasty": .25, b"nastie-": 2.0, "rüde-".encode(): .5, b"a": .125}
    model = tx.OrdinalModel(dict(weights), np.array([1.0, 2.5]))
    texts = ["Vile, vile nasty!", "nastiest RÜDER a a a", "", None, "nothing here", "vile " * 400,
             *[r[1] for r in messy()]]
    df = docs(spark, [(k, t, "en", "s", 1) for k, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in tx.score(df, model).collect()}
    for k, text in enumerate(texts):
        counts = {}
        for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()):
            w = w.encode()
            own = [w]
            if len(w) > 4:
                own += [(w.decode()[:n] + "-").encode() for n in (4, 6) if n < len(w.decode())]
            for f in own:
                counts[f] = counts.get(f, 0) + 1
        s = sum(weights[f] * math.log(1 + c) for f, c in counts.items() if f in weights)
        above = [1 / (1 + math.exp(-(s - t))) for t in (1.0, 2.5)]
        assert got[k]["severity"] == pytest.approx(sum(above), abs=1e-12)
        shares = [1 - above[0], above[0] - above[1], above[1]]
        assert got[k]["grade"] == shares.index(max(shares))
        assert got[k]["toxic"] == (sum(above) >= tx.REJECT_AT)


def test_fitted_weights_are_a_minimum_by_differences():
    """The objective's slopes at the fitted model, taken by differences of a
    plainly written likelihood: none for positive weights, none downwards for
    zero ones."""
    import math

    rng = np.random.default_rng(3)
    n, size = 120, 6
    counts = rng.integers(0, 4, (n, size))
    grades = np.clip((counts[:, 0] + counts[:, 1] + rng.integers(0, 3, n)) // 3, 0, 2)
    row, word = np.nonzero(counts)
    sample = tx.Sample([b"w%d" % k for k in range(size)], (grades > 0).astype(np.int64),
                       np.bincount(row, minlength=n), word.astype(np.int32), counts[row, word].astype(np.int32))
    model = tx.fit_ordinal(sample, grades.astype(np.int64), rounds=4000)
    w = np.array([model.weights.get(b"w%d" % k, 0.0) for k in range(size)])

    def objective(w, th):
        total = 0.0
        for x, g in zip(counts, grades):
            s = sum(wk * math.log1p(c) for wk, c in zip(w, x))
            at_least = [1.0, *[1 / (1 + math.exp(-(s - t))) for t in th], 0.0]
            total -= math.log(at_least[g] - at_least[g + 1])
        return total / n + tx.L1 * sum(w)

    h = 1e-5
    for k in range(size):
        step = np.eye(size)[k] * h
        if w[k] > 1e-3:
            slope = (objective(w + step, model.thresholds) - objective(w - step, model.thresholds)) / (2 * h)
            assert abs(slope) < 2e-3, k
        else:
            assert (objective(w + step, model.thresholds) - objective(w, model.thresholds)) / h > -2e-3, k
    for k in range(2):
        step = np.eye(2)[k] * h
        slope = (objective(w, model.thresholds + step) - objective(w, model.thresholds - step)) / (2 * h)
        assert abs(slope) < 2e-3
    assert (w > 1e-3).sum() >= 2
