"""Spelling variants by asymmetric chunks.

Of two words one edit apart the shorter (of equal ones: either) contributes two
disjoint chunks, its halves, and the longer all grams of the chunks' lengths
with their places.  One edit leaves one chunk whole: the first in its place, if
the edit is behind it, or else the second, moved by the difference in length,
zero or one.  Chunks meet equal grams in a join and the pairs are verified.
Chunks that meet very many grams (words with a common beginning) are cut again:
the edit is in the other chunk, which leaves one of that chunk's halves whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import if_small, stage, table

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 6
MIN_COUNT = 5
TYPO_EVERY = 199
RATIO = 5
HOT_PAIRS = 1 << 11     # pairs that a chunk may bring together before it is cut again


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                typo_every: int = TYPO_EVERY) -> DataFrame:
    """(word, n): the words of all texts with at least ``min_length`` code
    points and ``min_count`` occurrences.

    A run of letters, A-Z lower-cased, loses one letter wherever the CRC-32 of
    "<doc_id>:<run>" is a multiple of ``typo_every`` (0: nowhere).  Null or
    empty texts have no words; a null id is written as nothing; repeated rows
    count each.
    """
    pattern = f"[{LETTERS}]{{{min_length},}}"      # a run is matched whole or not at all
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"({pattern})"))).alias("_run"))
    runs = runs.withColumn("_run", F.translate("_run", UPPER, LOWER))
    word: Column = F.col("_run")
    if typo_every:
        h = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
        at = (h % F.length("_run")).cast("int")
        cut = F.concat(F.substring(F.col("_run"), F.lit(1), at),
                       F.substring(F.col("_run"), at + 2, F.length("_run")))
        word = F.when(h % typo_every == 0, cut).otherwise(word)
    return (runs.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def _cut(word: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start``, counted from 0."""
    return F.substring(word, start + 1, length)


def _sides(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks and grams, each (which, base, moved, part, other, word, n).

    ``base`` is the chunking word's length and ``moved`` the gram word's excess
    over it; ``part`` is the chunk or gram, ``other`` what the edit lies in.  A
    chunk is at place 0 or half; of a word's grams only those in the place that
    the chunk of such a pair keeps can meet one.
    """
    length = F.length("word")
    both = F.explode(F.array(F.lit(0), F.lit(1)))
    chunks = (words.withColumn("base", length).withColumn("which", both)
              .withColumn("moved", F.explode(F.array(F.lit(0), F.lit(1)))))
    grams = (words.withColumn("moved", both).withColumn("base", length - F.col("moved"))
             .withColumn("which", F.explode(F.array(F.lit(0), F.lit(1)))))

    def parts(side: DataFrame, moved: Column) -> DataFrame:
        half = F.floor(F.col("base") / 2).cast("int")
        first = F.col("which") == 0
        head = _cut(F.col("word"), F.lit(0), F.when(first, half).otherwise(half + moved))
        tail = _cut(F.col("word"), F.when(first, half).otherwise(half + moved), F.col("base") + moved)
        return side.select("which", "base", "moved", F.when(first, head).otherwise(tail).alias("part"),
                           F.when(first, tail).otherwise(head).alias("other"), "word", "n")

    return parts(chunks, F.lit(0)), parts(grams, F.col("moved"))


def _again(side: DataFrame, moved: Column) -> DataFrame:
    """The rows once for each half of ``other`` that the edit may leave whole."""
    half = F.floor((F.length("other") - moved) / 2).cast("int")
    first = F.col("again") == 0
    piece = F.when(first, _cut(F.col("other"), F.lit(0), half)).otherwise(
        _cut(F.col("other"), half + moved, F.length("other")))
    return side.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("piece", piece)


def near_pairs(words: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of distinct words of
    ``words`` (word, n; distinct, staged) one inserted, deleted or replaced code
    point apart, each once.  No pair is lost and none is capped: a chunk that
    would bring together more than ``hot_pairs`` pairs is cut again."""
    chunks, grams = _sides(words)
    key = ["which", "base", "moved", "part"]
    met = (chunks.groupBy(*key).agg(F.count(F.lit(1)).alias("_c"))
           .join(grams.groupBy(*key).agg(F.count(F.lit(1)).alias("_g")), key)
           .filter(F.col("_c") * F.col("_g") > hot_pairs))
    hot = if_small(stage(met.select(*key), "spelling_hot"))
    right = [F.col(c).alias(f"{c}_2") for c in ("word", "n", "other")]

    def apart(left: DataFrame, other: DataFrame, on: list[str], once: Column) -> DataFrame:
        pairs = left.join(other.select(*on, *right), on)
        # Equal lengths meet from both sides: the smaller word's chunk counts.
        ordered = (F.col("moved") == 1) | (F.col("word") < F.col("word_2"))
        return (pairs.filter(ordered & once)
                .filter(F.levenshtein(F.col("word"), F.col("word_2"), 1) == 1)
                .select("word", "n", F.col("word_2").alias("near"), F.col("n_2").alias("near_n")))

    half = F.floor(F.col("base") / 2).cast("int")
    # What met by the first chunk does not count again by the second.
    new = (F.col("which") == 0) | (_cut(F.col("word"), F.lit(0), half) != _cut(F.col("word_2"), F.lit(0), half))
    cold = apart(chunks.join(hot, key, "left_anti"), grams, key, new)
    moved = F.col("moved")
    deep = F.floor(F.length("other") / 2).cast("int")
    again = new & ((F.col("again") == 0)
                   | (_cut(F.col("other"), F.lit(0), deep) != _cut(F.col("other_2"), F.lit(0), deep)))
    split = apart(_again(chunks.join(hot, key, "left_semi"), F.lit(0)),
                  _again(grams.join(hot, key, "left_semi"), moved), [*key, "again", "piece"], again)
    pairs = cold.unionByName(split)
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                        F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(back)


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form; staged): the last
    form of the chain that starts at the word.  Chains double their reach in
    every round, so a chain of length k takes about log2(k) rounds."""
    links = forms.select("word", F.col("form").alias("root"))
    for _ in range(max_rounds):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = stage(links.join(onward, "root", "left")
                     .select("word", F.coalesce("_next", "root").alias("root"),
                             F.col("_next").isNotNull().alias("_moved")), "spelling_roots")
        links = step.select("word", "root")
        if step.filter("_moved").isEmpty():
            return links
    raise RuntimeError(f"chains of forms did not end in {max_rounds} rounds")


def variants(words: DataFrame, ratio: int = RATIO, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words of ``words`` (word,
    n): the near word of largest n (ties: the first in code-point order) if
    that n is at least ``ratio`` times the word's, and the last of the forms
    that follow each other (the word itself without one).  ``ratio`` must be
    over 1, so that forms grow and chains end.  Words without near words have
    n_near 0; an empty table stays empty."""
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    near = near_pairs(words, hot_pairs).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    held = words.join(near, "word", "left")
    follows = -F.col("best.n") >= F.col("n") * ratio
    held = stage(held.select(
        "word", F.when(follows, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(follows, -F.col("best.n")).alias("form_n")), "spelling_forms")
    ends = roots(held.filter(F.col("form").isNotNull()).select("word", "form"))
    return (held.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      typo_every: int = 0, ratio: int = RATIO) -> DataFrame:
    """``variants`` of the words of all texts of ``docs``."""
    words = stage(word_counts(docs, doc_id, text, min_length, min_count, typo_every), "spelling_words")
    return variants(words, ratio)


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """The words of all documents, with planted typing errors, and their forms."""
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"),
                             typo_every=TYPO_EVERY)
