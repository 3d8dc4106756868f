import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linepulse.llm import spelling
from linepulse.llm.common import stage
from tests.llm import cases

FIELDS = ("word", "form", "root", "n", "n_near", "form_n")


def one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def counted(rows, every=spelling.TYPO_EVERY, shortest=6, least=5) -> Counter:
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    words: Counter = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                words[run] += 1
    return Counter({w: n for w, n in words.items() if n >= least})


def by_hand(words: Counter, ratio=5):
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    best = {w: min(near[w], key=lambda x: (-words[x], x.encode())) for w in words if near[w]}
    form = {w: x for w, x in best.items() if words[x] >= ratio * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def variants_of(seed: int, bases: int = 12, each: int = 40) -> Counter:
    """Words, their edits and edits of those, many with one beginning."""
    rng, letters = random.Random(seed), "abcdeéÿ"
    words: Counter = Counter()

    def edit(w: str) -> str:
        k = rng.randrange(len(w) + 1)
        return rng.choice([w[:k] + rng.choice(letters) + w[k:], w[:k] + w[k + 1:],
                           w[:k] + rng.choice(letters) + w[k + 1:]])

    for b in range(bases):
        base = "abcabd" * (b % 2) + "".join(rng.choice(letters) for _ in range(rng.randint(6, 12)))
        words[base] = rng.choice([3, 200, 4000])
        for _ in range(each):
            w = edit(base)
            words[w] = rng.choice([5, 6, 39, 40, 41, 800])
            words[edit(w)] = rng.choice([5, 8, 160])
    return Counter({w: n for w, n in words.items() if len(w) >= 6})


@pytest.mark.parametrize("hot_pairs", [0, 8, 1 << 11])
def test_variants_equal_all_pairs(spark, hot_pairs):
    words = variants_of(hot_pairs + 1)
    table = stage(spark.createDataFrame(list(words.items()), "word string, n long"), "test_words")
    assert cases.by_id(spelling.variants(table, hot_pairs=hot_pairs), *FIELDS) == by_hand(words)


def test_every_pair_once_in_both_directions(spark):
    words = variants_of(77)
    table = stage(spark.createDataFrame(list(words.items()), "word string, n long"), "test_words")
    for hot_pairs in (0, 1 << 11):
        got = Counter((r["word"], r["near"]) for r in spelling.near_pairs(table, hot_pairs).collect())
        assert got == Counter((a, b) for a in words for b in words if one_apart(a, b))


def test_long_chains_end_at_their_last_form(spark):
    words = {"a" * (6 + k): 5 * 5 ** k for k in range(11)}
    table = stage(spark.createDataFrame(list(words.items()), "word string, n long"), "test_words")
    got = {r["word"]: r["root"] for r in spelling.variants(table).collect()}
    assert set(got.values()) == {"a" * 16}


def test_counts_equal_plain_loops(spark):
    rng = random.Random(4)
    names = ["Straße", "ÀÉÎõü", "colour", "color", "letters", "lettres", "ABCDEF", "x" * 900, "short", "naïveté"]
    rows = [(k if k % 7 else None, " ".join(rng.choices(names, k=30)) + "-" + rng.choice(names), "en", "a", 0)
            for k in range(150)] + cases.messy()
    rows += [(3000 + k, "×÷ " + rng.choice(names) + "1" + rng.choice(names), "en", "a", 0) for k in range(40)]
    docs = cases.docs(spark, rows).repartition(4)
    got = spelling.spelling_variants(docs, typo_every=spelling.TYPO_EVERY)
    assert cases.by_id(got, *FIELDS) == by_hand(counted(rows))
    plain = spelling.word_counts(docs, typo_every=0, min_length=4, min_count=2)
    assert {r["word"]: r["n"] for r in plain.collect()} == counted(rows, 0, 4, 2)


def test_empty_tables_nulls_and_other_columns(spark):
    empty = cases.docs(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])
    assert spelling.spelling_variants(empty).collect() == []
    assert spelling.spelling_variants(empty.limit(0)).collect() == []
    docs = cases.docs(spark, [(k, "variant Variant", "en", "a", 0) for k in range(4)])
    named = docs.withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("_run", F.lit(2))
    assert cases.by_id(spelling.spelling_variants(named), *FIELDS) == [("variant", None, "variant", 8, 0, None)]
    with pytest.raises(ValueError):
        spelling.variants(named.select("word", "n"), ratio=1)
