import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from linepulse.llm import mixing
from tests.llm import cases


def by_hand(rows, weights=(3, 1, 2), share=Fraction(3, 2), most=2, seed=mixing.SEED):
    """(doc_id, size, source_size, target, taken) by plain loops."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = [len(re.findall(rb"[^\x20\x09-\x0D]+", (r[1] or "").encode())) for r in rows]
    held = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    full: set = set()
    while True:
        left = [s for s in sources if s not in full]
        words = share * sum(held.values()) - sum(most * held[s] for s in full)
        target = {s: Fraction(words * weight[s], sum(weight[x] for x in left)) for s in left}
        above = {s for s in left if target[s] > most * held[s]}
        if not above:
            break
        full |= above
    target |= {s: Fraction(most * held[s]) for s in full}
    out = []
    for s in sources:
        budget = int(target[s])
        epochs = budget // held[s] if held[s] else 0
        rest = budget - epochs * held[s]
        groups = defaultdict(list)
        for k, r in enumerate(rows):
            if r[3] == s:
                text = f"{seed}:{'' if r[0] is None else r[0]}:{r[1] or ''}"
                groups[hashlib.md5(text.encode()).hexdigest()].append(k)
        for key in sorted(groups):
            ks = groups[key]
            words = size[ks[0]] * len(ks)
            part = size[ks[0]] if words <= rest else rest // len(ks)
            rest = max(0, rest - words)
            out += [(rows[k][0], size[k], held[s], float(target[s]), epochs * size[k] + part) for k in ks]
    return sorted(out, key=repr)


def skewed(seed=3, rows=400):
    rng = random.Random(seed)
    out = []
    for k in range(rows):
        source = "hot" if rng.random() < 0.4 else rng.choice(["é", "Z", "a", "", None, "tiny"])
        text = cases.sentence(rng, 2 if source == "tiny" else rng.randint(0, 60))
        out.append((k, text, "en", source, 0))
    return out + [(7, "same text here", "en", "hot", 0)] * 50


@pytest.mark.parametrize("rows", [cases.messy(), skewed(), [(1, None, "", "a", 0), (2, "", "", "b", 0)]])
def test_equals_plain_loops(spark, rows):
    got = mixing.mix(cases.docs(spark, rows).repartition(5))
    assert cases.by_id(got, "doc_id", "size", "source_size", "target", "taken") == by_hand(rows)


def test_other_weights_and_shares(spark):
    rows = skewed(8)
    got = mixing.mix(cases.docs(spark, rows), weights=(5, 2), share=Fraction(9, 4), most=3, seed="x")
    want = by_hand(rows, (5, 2), Fraction(9, 4), 3, "x")
    assert cases.by_id(got, "doc_id", "size", "source_size", "target", "taken") == want


def test_words_meet_the_budget_and_no_row_is_taken_too_often(spark):
    rows = skewed()[:400]           # no repeated rows: the cut is exact
    got = mixing.mix(cases.docs(spark, rows)).toPandas()
    assert (got.taken <= 2 * got["size"]).all()
    for _, part in got.groupby(got.source.fillna("no source")):
        assert part.taken.sum() == int(part.target.iloc[0])


def test_mixed_texts_are_the_mix(spark):
    mixed = mixing.mix(cases.docs(spark, cases.messy()).withColumn("epoch", F.lit("mine")))
    texts = mixing.mixed_texts(mixed).toPandas()
    words = texts.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert words.sum() == mixed.agg(F.sum("taken")).first()[0]
    assert sorted(texts.epoch.unique()) == [0, 1]
    whole = {r[1] for r in cases.messy()}
    assert (~texts.text.isin(whole)).sum() <= 6        # a cut a source


def test_empty_table_and_clashing_columns(spark):
    docs = cases.docs(spark, cases.messy()).withColumn("Size", F.lit("x")).withColumn("_key", F.lit(1))
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken"]
    assert cases.by_id(got, "doc_id", "size", "source_size", "target", "taken") == by_hand(cases.messy())
    assert mixing.mix(docs.limit(0)).collect() == []


def test_sql_gives_the_same(spark, tmp_path):
    rows = skewed(5) + cases.messy()
    path = str(tmp_path / "documents.parquet")
    cases.docs(spark, rows).write.parquet(path)
    got = cases.by_id(mixing.op12_mixing(spark, str(tmp_path)), "doc_id", "size", "source_size", "target", "taken")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.op12_oracle_sql()})")
    assert got == sorted(want.fetchall(), key=repr)
