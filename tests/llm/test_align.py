import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linepulse.llm import align
from tests.llm import cases

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = ["<|endoftext|> and <s>x</s> <unk>", "a\x00b\tc \n d", "  two  spaces  ", "tab\t tab \x1c x \x85 y", "don't we'll 's",
       "日本語 テキスト 😀😀 é é", "underscore ▁ piece", "<0x0A> <0x41>", " nbsp 　wide", "x" * 3000,
       "1234567890 3.14 --- !!!", "ﬁne ŒUVRE ǅ", "﻿mark", "trailing ", " ", "\n", "a", "​", "İ ı ſ"]


def rows():
    rng = random.Random(2)
    some = [(1000 + k, t, "en", "a", 0) for k, t in enumerate(ODD)]
    some += [(2000 + k, " ".join(rng.choices([*ODD, "plain", "words", "of text\nover lines"], k=12)), "en", "a", 0)
             for k in range(30)]
    return cases.messy() + some


def plain_tokens(text):
    """Ids of the whole text by both tokenizers, and its bytes by token."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    v = align.vocabularies(A, B)
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    return ids_a, ids_b, [v.bytes_a[i] for i in ids_a], [v.bytes_b[i] for i in ids_b]


def places(tokens):
    at, out = 0, []
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def by_hand(docs):
    held, counts = [], Counter()
    for doc_id, text, *_ in docs:
        a, b, bytes_a, bytes_b = plain_tokens(text) if text else ([], [], [], [])
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            held.append((doc_id, 0, 0, "", []))
            continue
        ends_a, ends_b = places(bytes_a), places(bytes_b)
        groups, links, i, j = [], [], 0, 0
        after_a, after_b = ({e: k + 1 for k, e in enumerate(ends)} for ends in (ends_a, ends_b))
        for end in sorted({*ends_a} & {*ends_b}):
            x, y = after_a[end], after_b[end]
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        counts.update(links)
        held.append((doc_id, len(a), len(b), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    most = Counter()
    for (a, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(((d, na, nb, len(ls), len(ls), sum(counts[x] == most[x[1]] for x in ls),
                    sum(counts[x] for x in ls), text) for d, na, nb, text, ls in held), key=repr)


def test_query_equals_whole_text_encoding(spark, tmp_path):
    cases.docs(spark, rows()).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = cases.by_id(align.op13_align(spark, str(tmp_path)), *FIELDS)
    assert got == by_hand(rows())
    assert any(r[1] == 0 for r in got) and any(r[1] > 1000 for r in got)


def test_galloping_equals_binary_search():
    rng = np.random.default_rng(1)
    for n, m in [(0, 0), (0, 5), (5, 0), (1, 1000), (50, 50), (30, 2000)]:
        short = np.unique(rng.integers(0, 3000, n))
        long = np.unique(rng.integers(0, 3000, m))
        assert align.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


def test_groups_and_overlaps_equal_plain_loops():
    rng = random.Random(9)
    for _ in range(200):
        total = rng.randint(1, 40)
        ends = [np.array(sorted({*rng.sample(range(1, total + 1), rng.randint(1, total)), total})) for _ in "ab"]
        cut_a, cut_b, ranks = align.common_ends(*ends)
        both = sorted({*ends[0].tolist()} & {*ends[1].tolist()})
        assert ends[0][cut_a].tolist() == both == ends[1][cut_b].tolist()
        first, last = align.overlaps(*ends, ranks)
        spans = [list(zip([0, *e.tolist()], e.tolist())) for e in ends]
        for (lo, hi), f, t in zip(spans[0], first, last):
            assert [k for k, (x, y) in enumerate(spans[1]) if x < hi and lo < y] == list(range(f, t + 1))


def test_operator_returns_tokens_cuts_and_overlaps(spark):
    docs = cases.docs(spark, [(1, "a fine day", "en", "a", 0), (2, None, "en", "a", 0)]).withColumn("IDS_A", F.lit(1))
    got = {r["doc_id"]: r for r in align.align(docs, A, B).collect()}
    a, b, bytes_a, bytes_b = plain_tokens("a fine day")
    r = got[1]
    assert (r["ids_a"], r["ids_b"]) == (a, b)
    assert [places(bytes_a)[k] for k in r["cut_a"]] == [places(bytes_b)[k] for k in r["cut_b"]]
    assert len(r["first_b"]) == len(a) and r["last_b"][-1] == len(b) - 1
    assert got[2]["ids_a"] == got[2]["cut_b"] == got[2]["last_b"] == [] and got[2]["text"] is None


def test_empty_table(spark):
    docs = cases.docs(spark, [])
    assert align.align_counts(docs, A, B).collect() == []
    assert "text" not in align.align_counts(docs, A, B).columns


def test_pairs_that_end_together_have_numbers_of_their_own():
    v, pairs = align.vocabularies(A, B), align.vocabulary_pairs(A, B)
    found = {}
    for text in [*ODD, "AaBb the them <0x41>"]:
        a, b, bytes_a, bytes_b = plain_tokens(text)
        if b"".join(bytes_a) == b"".join(bytes_b):
            at = dict(zip(places(bytes_b), b))
            found.update({(x, at[e]): 0 for x, e in zip(a, places(bytes_a)) if e in at})
    found.update({(32, k): 0 for k, x in enumerate(v.bytes_b) if v.bytes_a[32] == x})    # ids of equal bytes
    a, b = np.array(list(found)).T
    numbers = pairs.numbers(a, b)
    assert len(set(numbers.tolist())) == len(found) > 50 and numbers.max() < pairs.size
    assert pairs.b_of(numbers).tolist() == b.tolist()
    assert pairs.size <= 2 * (sum(map(len, v.bytes_a)) + sum(map(len, v.bytes_b)))
