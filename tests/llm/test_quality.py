import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linepulse.llm import quality as q
from tests.llm.cases import docs, messy, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1
               for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


@pytest.mark.parametrize("text", [r[1] for r in messy()] + [
    "a b " * 30, "#*$ %&|<>#", "x y z\nx y z\n\n \nx y z ", "  　 \x85w", "one " * 8, "one " * 9,
    " ".join(map(str, [*range(20), *range(5, 17), 99]))])
def test_statistics(text):
    counts, features = q.statistics(text)
    assert counts == plain(text)
    assert len(features) == len(q.FEATURES) and np.isfinite(features).all()


def learned(signs=None, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((600, 3))
    y = ((np.sin(6 * x[:, 0]) > 0) & (x[:, 1] < .7)).astype(float)
    y = np.where(rng.random(600) < .05, 1 - y, y)
    return x, y, q.fit_trees(x, y, signs or [0, -1, 0], rounds=40)


def test_trees_learn_and_keep_their_constraints():
    x, y, trees = learned()
    fresh = np.random.default_rng(9).random((2000, 3))
    want = (np.sin(6 * fresh[:, 0]) > 0) & (fresh[:, 1] < .7)
    assert ((trees.probability(fresh) > .5) == want).mean() > .93
    for _ in range(50):
        grid = np.tile(np.random.default_rng(_).random(3), (101, 1))
        grid[:, 1] = np.linspace(-1, 2, 101)
        assert (np.diff(trees.probability(grid)) <= 1e-12).all()
    _, _, free = learned([0, 0, 0])
    assert free.probability(x).shape == (600,)


def test_flat_nodes_equal_a_walk():
    x, _, trees = learned()
    for row in x[:50]:
        margin = trees.base
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            margin += trees.value[at]
        assert trees.probability(row[None])[0] == pytest.approx(1 / (1 + np.exp(-margin)))


def test_verdicts(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(200):
        words = sentence(rng, rng.randint(25, 80)).split()
        bad = i % 3 == 0
        rows.append((i, " ".join(w + "%%%" if bad else w for w in words), "en", "s", 1))
        labels.append((i, int(not bad), 0))
    lab = spark.createDataFrame(labels + [(0, None, 0), (None, 1, 0)],
                                "doc_id long, quality int, toxic int")
    trees = q.train(docs(spark, rows).filter("doc_id < 150"), lab)
    every = rows + messy()
    df = docs(spark, every).withColumn("Kept", F.lit("clash")).withColumn("features", F.lit(0))
    found = q.judge(df, trees).collect()
    assert len(found) == len(every)
    for r in found:
        n, chars, symbols, dup, repeats = plain(r.text)
        assert [n, chars, symbols, dup, repeats] == [r.n_words, r.word_chars, r.n_symbols,
                                                     r.n_dup_lines, r.n_repeat_words]
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert r.kept == (not r.base_failed and r.quality >= .5)
    assert all(r.kept == (r.doc_id % 3 != 0) for r in found if r.doc_id is not None
               and r.doc_id in range(150, 200) and "d" != r.source)


def test_without_labels_the_base_decides(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    trees = q.train(docs(spark, messy()), none)
    assert not len(trees.roots)
    found = q.judge(docs(spark, messy()), trees).collect()
    assert all(r.kept != r.base_failed for r in found)
    assert q.judge(docs(spark, []), trees).count() == 0
