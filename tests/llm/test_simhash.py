import random

import pytest
import xxhash
from pyspark.sql import functions as F

from linepulse.llm import simhash
from linepulse.llm.components import components
from tests.llm.cases import FIELDS, by_id, docs, messy


def plain_fingerprint(text):
    import re
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
                if len(words) >= 3 else [" ".join(words)])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, bound):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bound:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


@pytest.mark.parametrize("text", ["", None, "one", "One two", "a b c", "A  b\tc\nD e f a b c",
                                  "É É é", "\x1c\x85 x y", "w " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(str(i * i % 91) for i in range(300))
    monkeypatch.setattr(simhash, "SHINGLE_BLOCK", 7)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def clustered(seed=3):
    rng = random.Random(seed)
    values = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(60):
            v = centre
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    return sorted(values)


@pytest.mark.parametrize("group", [2, 16])
@pytest.mark.parametrize("thresholds", [None, "halves", "thirds"])
def test_links_join_exactly_the_connected(spark, monkeypatch, group, thresholds):
    monkeypatch.setattr(simhash, "PAIR_GROUP", group)
    values = clustered()
    classes = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    low, full = (1 << 32) - 1, (1 << 64) - 1
    probes = {None: None, "halves": [low ^ (1 << b) for b in range(32)] + [full ^ low],
              "thirds": [(1 << 21) - 1, ((1 << 42) - 1) ^ ((1 << 21) - 1), full ^ ((1 << 42) - 1)],
              }[thresholds]
    links = simhash.near_pairs(classes, 2, probes)
    pairs = [(r.u % (1 << 64), r.v % (1 << 64)) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    got = {r.u: r.root for r in components(links).collect()}
    roots = [got.get(simhash._signed(v), simhash._signed(v)) for v in values]
    want = plain_components(values, 2)
    assert len(set(zip(roots, want))) == len(set(roots)) == len(set(want))


def test_allocation_is_optimal():
    costs = [{-1: 0.0, 0: 5.0, 1: 9.0, 2: 50.0}, {-1: 0.0, 0: 1.0, 1: 30.0, 2: 60.0}]
    price, chosen = simhash.allocate(costs, 1)
    assert (price, sum(chosen)) == (10.0, 1) and chosen == [1, 0]


def test_components_of_chain_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    found = {r.u: r.root for r in components(
        spark.createDataFrame(chain + star + [(7, 7)], "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    rows = messy()
    values = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(values, 2)
    least = {}
    for r, k in zip(rows, roots):
        if r[0] is not None:
            least[k] = min(r[0], least.get(k, r[0]))
    want = sorted(((r[0], simhash._signed(v), least.get(k)) for r, v, k in zip(rows, values, roots)),
                  key=repr)
    got = by_id(simhash.near_duplicates(docs(spark, rows)), "doc_id", "fp", "component_id")
    assert got == want


def test_keep_one_of_each_component(spark):
    rows = messy()
    df = docs(spark, rows).withColumn("fp", F.lit("mine")).withColumn("_id", F.lit(1))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = kept.collect()
    values = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(values, 2)
    assert len(got) == len(set(roots))
    of = dict(zip([r[1] for r in rows], roots))
    assert len({of[r.text] for r in got}) == len(got)
    ids = {}
    for r, k in zip(rows, roots):
        ids.setdefault(k, []).append(r[0])
    for r in got:
        known = [i for i in ids[of[r.text]] if i is not None]
        assert r.doc_id == (min(known) if known else None)


def test_empty_table(spark):
    none = docs(spark, [], FIELDS)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
