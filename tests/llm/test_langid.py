import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linepulse.llm import langid
from tests.llm.cases import docs, messy


def text_of(rng, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
                    for _ in range(rng.randint(5, 50)))


def corpus(seed=2, n=200):
    rng = random.Random(seed)
    kinds = {"xx": "aeiouthsnr", "yy": "aeiouäößkzw", "zz": "aeiouñcdlq"}
    return [(i, text_of(rng, kinds[k]), k, "s", 1)
            for i, k in enumerate(rng.choice(sorted(kinds)) for _ in range(n))]


@pytest.mark.parametrize("text", ["", None, "a", "Ab c!", "éé 12 x", "\U0001d400 ok", "1 2 3 --"])
def test_ngrams(text):
    low = [c if c.isalpha() else " " for c in f" {(text or '').lower()} "]
    grams = {}
    for n in langid.ORDERS:
        for i in range(len(low) - n + 1):
            if any(c != " " for c in low[i:i + n]):
                mixed = n
                for k, c in enumerate(low[i:i + n]):
                    mixed = (mixed + ord(c)) * langid._FACTORS[k] % (1 << 64)
                f = mixed >> 64 - langid.FEATURE_BITS
                grams[f] = grams.get(f, 0) + 1
    found, counts = langid.ngram_counts(text)
    assert dict(zip(found.tolist(), counts.tolist())) == grams


def test_chunks_change_nothing(monkeypatch):
    text = " ".join(f"w{i} ä{i}" for i in range(200))
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "CHUNK", 17)
    assert all((a == b).all() for a, b in zip(whole, langid.ngram_counts(text)))


def test_held_out_accuracy_and_sparsity(spark):
    rows = corpus()
    model = langid.train(docs(spark, rows[:150]))
    found = {r.doc_id: r for r in langid.identify(docs(spark, rows[150:]), model).collect()}
    assert np.mean([found[r[0]].lang_pred == r[2] for r in rows[150:]]) > .95
    assert all(0 <= r.score <= 1 for r in found.values())
    used = (langid.document_frequencies(docs(spark, rows[:150]))[1] > 0).sum()
    assert 0 < (model.weights != 0).any(axis=1).sum() < used
    assert model.temperature > 0


def test_temperature_minimises_log_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 3000)
    true = rng.normal(size=(3000, 3)) + 1.5 * np.eye(3)[y]
    p = np.exp(true) / np.exp(true).sum(axis=1, keepdims=True)
    drawn = np.array([rng.choice(3, p=q) for q in p])
    assert langid.fit_temperature(true * 4, drawn) == pytest.approx(4, rel=.15)


def test_awkward_rows(spark):
    model = langid.train(docs(spark, corpus()))
    df = docs(spark, messy()).withColumn("Score", F.lit("clash"))
    found = langid.identify(df, model).collect()
    assert len(found) == len(messy())
    for r in found:
        none = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == none and (r.score == 0) == none
    assert langid.identify(docs(spark, []), model).count() == 0
    nobody = langid.train(docs(spark, [(1, "text", None, "s", 1), (2, "12", "en", "s", 1)]))
    assert {r.lang_pred for r in langid.identify(docs(spark, corpus(n=5)), nobody).collect()} == {"und"}


def test_query_learns_from_other_folds_only(spark, tmp_path):
    import zlib
    rows = [(i, t, lang, s, n) for i, t, lang, s, n in corpus(n=120)]
    docs(spark, rows + [(None, "aeiou", "xx", "s", 1)]).write.parquet(f"{tmp_path}/documents.parquet")
    first = {r.doc_id: r for r in langid.op3_langid(spark, str(tmp_path)).collect()}
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in first.items() if r.held_out} == held
    wrong = [(i, t, "bogus" if i in held else lang, s, n) for i, t, lang, s, n in rows]
    docs(spark, wrong + [(None, "aeiou", "xx", "s", 1)]).write.parquet(f"{tmp_path}/b/documents.parquet")
    second = {r.doc_id: r for r in langid.op3_langid(spark, f"{tmp_path}/b").collect()}
    assert first == second
