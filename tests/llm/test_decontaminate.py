import re

import pytest
from pyspark.sql import functions as F

from linepulse.llm import decontaminate as dc
from tests.llm.cases import docs, messy

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(text, items):
    w, hit, listed = words(text), set(), set()
    for item, body in items:
        b = words(body)
        width = min(13, len(b))
        for j in range(len(b) - width + 1 if b else 0):
            for i in range(len(w) - width + 1):
                if w[i:i + width] == b[j:j + width]:
                    hit.update(range(i, i + width))
                    if item is not None:
                        listed.add(str(item))
    return len(w), len(hit), sorted(listed), bool(hit) and 20 * len(hit) >= len(w)


def case():
    body = " ".join(f"q{i}" for i in range(30))
    items = [(1, body), (2, "Short one"), (3, None), (4, ""), (5, "?!"), (None, "no id here at all"),
             (10, body.replace("q20", "z")), (2, "Short one"), (11, "a a a a a a a a a a a a a a a")]
    texts = [("intro " + body.upper() + " outro"), "a short ONE, a short-one.", "no id here at all",
             "x " * 400 + " ".join(f"q{i}" for i in range(12)), "x " * 300 + " ".join(
                 f"q{i}" for i in range(5, 19)), "a " * 40, "q3 q4", None, "",
             " ".join(f"q{i}" for i in range(18, 30)), "short one" * 3]
    rows = messy() + [(500 + i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 64])
def test_equals_brute_force(spark, block_bytes):
    rows, items = case()
    df = docs(spark, rows).withColumn("n_hit", F.lit("clash")).withColumn("Contaminated", F.lit(1))
    found = dc.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"),
                             block_bytes=block_bytes)
    got = sorted(((r.doc_id, r.text, r.n_words, r.n_hit, list(r.item_ids), r.n_items, r.contaminated)
                  for r in found.collect()), key=repr)
    want = []
    for r in rows:
        n, hit, listed, bad = plain(r[1], items)
        want.append((r[0], r[1], n, hit, listed, len(listed), bad))
    assert got == sorted(want, key=repr)


def test_prefix_is_the_rarest_shingle():
    item = "the of the of the rare the of the of the of the of"
    p = dc.Prefixes([item], 13, 3, {b"the of the": 9, b"of the of": 9, b"of the rare": 1,
                                    b"the rare the": 1, b"rare the of": 1})
    assert set(p.by_shingle) <= {(b"of", b"the", b"rare"), (b"rare", b"the", b"of"),
                                 (b"the", b"rare", b"the")}


def test_filter_and_empty_tables(spark):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(spark, rows)
    kept = dc.drop_contaminated(df, bench)
    assert kept.dtypes == df.dtypes
    assert kept.count() == sum(not plain(r[1], items)[3] for r in rows)
    assert dc.drop_contaminated(docs(spark, []), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.drop_contaminated(df, none).count() == len(rows)
