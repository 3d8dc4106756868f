import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linepulse.llm import packing as pk
from tests.llm.cases import docs, messy

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


ALPHABET = list("ab Z9é²Ⅷ '.,\n\t\x1c\x85　ß中") + ["  ", "'s", " the", "<|endoftext|>", "ing "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=25).map("".join), max_size=6))
def test_chunks_give_the_tokenizers_ids(texts):
    encoder = pk.encoder(PATH)          # keeps what it learned from earlier examples
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [plain_ids(t) for t in texts]


def test_forgetting_chunks(monkeypatch):
    monkeypatch.setattr(pk, "CACHED_CHUNKS", 5)
    monkeypatch.setattr(pk, "CACHED_CHARS", 3)
    encoder, texts = pk.ChunkEncoder(PATH), ["the quick brown fox, jumps", "over  the lazy\n dog.", "a b"] * 4
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == list(map(plain_ids, texts))


def held(plan):
    total = Counter()
    for pattern, n in plan.items():
        total.update({s: k * n for s, k in Counter(pattern).items()})
    return +total


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25), st.integers(60, 100))
def test_plans_hold_all_pieces(counts, capacity):
    first, plan = pk.best_fit(counts, capacity), pk.plan_bins(counts, capacity)
    assert held(first) == held(plan) == Counter(counts)
    assert all(sum(p) <= capacity for p in plan)
    assert pk.lower_bound(counts, capacity) <= sum(plan.values()) <= sum(first.values())


def test_best_fit_equals_one_by_one():
    rng = random.Random(4)
    for _ in range(30):
        items = sorted((rng.randint(1, 50) for _ in range(rng.randint(1, 200))), reverse=True)
        bins = []
        for s in items:
            fits = [b for b in bins if sum(b) + s <= 60]
            if fits:
                max(fits, key=sum).append(s)
            else:
                bins.append([s])
        assert sum(pk.best_fit(Counter(items), 60).values()) == len(bins)


def test_exchanges_empty_bins():
    # two for one, one for one and a move, each needed to reach the bound
    start = Counter({(6, 3): 1, (5, 4): 1, (1, 1): 1})
    assert pk.improve(start, 10, 2)[(6, 3, 1)] == 1
    assert sum(pk.improve(start, 10, 2).values()) == 2
    assert sum(pk.improve(Counter({(7,): 2, (5, 3): 2}), 10, 3).values()) == 3
    assert sum(pk.improve(Counter({(7, 2): 1, (3, 3, 2): 1, (2, 1): 1}), 10, 2).values()) == 2
    assert held(pk.improve(Counter({(4, 4): 3, (3, 3, 2): 2, (6,): 2}), 10, 1)) == held(
        Counter({(4, 4): 3, (3, 3, 2): 2, (6,): 2}))


@pytest.mark.parametrize("capacity", [2048, 16])
def test_pieces_and_places(spark, capacity):
    rows = messy()
    df = docs(spark, rows).withColumn("offset", F.lit(1)).withColumn("piece", F.lit("x"))
    found = pk.pack_documents(df, PATH, capacity, keep_ids=True).collect()
    bins, pieces = {}, {}
    for r in found:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.piece, r.start, r.length), []).append(bytes(r.ids))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    want = {}
    for doc_id, text, *_ in rows:
        ids, start = plain_ids(text) + [0], 0
        for k, size in enumerate(pk.cut(len(ids), capacity)):
            body = np.array(ids[start:start + size], "<u4").tobytes()
            want.setdefault((doc_id, k, start, size), []).append(body)
            start += size
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    total = -(-sum(r.length for r in found) // capacity)
    assert total <= len(bins) <= total + 2


def test_one_length_over_many_parts(spark):
    pieces = spark.range(5000, numPartitions=7).select(F.lit(300).cast("long").alias("length"), "id")
    found = pk.pack(pieces, 1000).collect()
    assert len({(r.sequence_id, r.offset) for r in found}) == 5000
    assert len({r.sequence_id for r in found}) == -(-5000 // 3)


def test_empty_table_and_bad_lengths(spark):
    assert pk.pack_documents(docs(spark, []), PATH).count() == 0
    with pytest.raises(ValueError):
        pk.pack(spark.createDataFrame([(0,)], "length long"), 10)
