"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

Lines are sequences of lower-cased words; the edit bound is one word inserted,
deleted or replaced.  Two lines within it are equal, or have a common variant:
both without the word at one place (a replacement), or one whole and the other
without one word.  Variants are joined as hashes and verified on the words.

Equal lines are found by their hashes alone, whatever their length; lines of
fewer than MIN_WORDS words match no other line within an edit.

Lines within the bound also share the first or the last half of the shorter
one's words, so only lines that share a half with another line emit variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepulse.llm.common import if_small, stage, table

MIN_WORDS = 5
SPACE = "[\\x20\\x09-\\x0D]+"
_PLACE = ("none", "id", "th", "line")


def _place() -> Column:
    """Order of lines: by document id (null ids last), text, line number."""
    return F.struct(*_PLACE)


def _words(line: str) -> Column:
    """Lower-cased words of a line.  White space other than spaces is rare, so
    it is looked for before it is replaced."""
    low, others = F.lower(line), "\t\x0b\x0c\r"
    found = F.lit(False)
    for c in others:
        found = found | F.contains(F.col(line), F.lit(c))
    plain = F.when(found, F.translate(low, others, " " * len(others))).otherwise(low)
    return F.array_remove(F.split(plain, " "), "")


def _lines(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    body = F.col(f"`{text}`")
    cut = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(body).alias("th"),
                      F.posexplode(F.split(body, "\n")).alias("line", "raw"))
    return (cut.withColumn("words", _words("raw")).filter(F.size("words") >= min_words)
            .select(F.col("id").isNull().alias("none"), "id", "th", "line", "words")
            .withColumn("h1", F.xxhash64("words")).withColumn("h2", F.xxhash64(F.lit(1), "words")))


def _halves() -> Column:
    """Hashes of the first and last halves by which a line of n words meets
    lines of n - 1, n and n + 1 words; a half is of the shorter line."""
    def half(first: bool, n: Column) -> Column:
        a = F.floor(n / 2).cast("int")
        part = F.slice("words", F.lit(1), a) if first else F.slice("words", -(n - a), n - a)
        return F.xxhash64(F.lit(first), part)

    n = F.size("words")
    return F.array_distinct(F.array(half(True, n), half(False, n), half(True, n - 1),
                                    half(False, n - 1)))


def _words_at(docs: DataFrame, doc_id: str, text: str, places: DataFrame) -> DataFrame:
    """``places`` (h1, h2, first) with the words of the line there; only the
    lines asked for are cut into words."""
    asked = stage(places.groupBy(F.col("first.id").alias("_id"), F.col("first.th").alias("_th"))
                  .agg(F.collect_set(F.struct(F.col("first.line").alias("line"), "h1", "h2", "first"))
                       .alias("asked")), "asked_lines")
    body = F.col(f"`{text}`")
    held = docs.select(F.col(f"`{doc_id}`").alias("id"), body.alias("text")).join(
        if_small(asked), F.col("id").eqNullSafe(F.col("_id"))
        & (F.xxhash64("text") == F.col("_th")))
    cut = (held.select(F.split("text", "\n").alias("lines"), F.explode("asked").alias("a"))
           .select("a.h1", "a.h2", "a.first", F.col("lines")[F.col("a.line")].alias("raw")))
    return cut.select("h1", "h2", "first", _words("raw").alias("words")).dropDuplicates(["h1", "h2"])


def _sharing(distinct: DataFrame) -> DataFrame:
    """(h1): the lines that share a half with another line."""
    keys = distinct.select("h1", F.explode("halves").alias("key"))
    groups = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("h1").alias("lo"),
                                           F.max("h1").alias("hi")).filter("n > 1"), "halves")
    more = groups.filter("n > 2").select("key")
    return stage(groups.filter("n = 2").select(F.explode(F.array("lo", "hi")).alias("h1"))
                 .unionByName(keys.join(more, "key", "left_semi").select("h1")).distinct(), "sharing")


def _variants(lines: DataFrame) -> DataFrame:
    """(key, v) of the deletion neighbourhood of ``lines`` (seq, words): v is
    2 * seq, plus 1 for a whole line.

    A sequence's hash is the exclusive or of its words' hashes with their
    places, so the hash without word k follows from running values.  The rows
    of a line stay where the line is: no shuffle of single words.
    """
    cut = lines.repartition("seq").select("seq", F.size("words").alias("n"),
                                          F.posexplode("words").alias("k", "word"))
    line = Window.partitionBy("seq").orderBy("k")
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    after = line.rowsBetween(1, Window.unboundedFollowing)
    cut = (cut.withColumn("here", F.xxhash64("word", "k"))
           .withColumn("left", F.xxhash64("word", F.col("k") - 1)))
    cut = (cut.withColumn("whole", F.bit_xor("here").over(upto))
           .withColumn("total", F.bit_xor("left").over(Window.partitionBy("seq")))
           .withColumn("seen", F.bit_xor("left").over(upto)))
    without = (F.col("whole").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("total"))
               .bitwiseXOR(F.col("seen")))
    cut = cut.withColumn("without", without).withColumn("v", F.col("seq") * 2)
    options = F.array(
        F.struct(F.xxhash64(F.lit("replaced"), "n", "k", "without").alias("key"), "v"),
        F.struct(F.xxhash64(F.lit("deleted"), F.col("n") - 1, "without").alias("key"), "v"),
        F.when(F.col("k") == F.col("n") - 1, F.struct(
            F.xxhash64(F.lit("deleted"), "n", "whole").alias("key"), (F.col("v") + 1).alias("v"))))
    return cut.select(F.explode(options).alias("o")).filter("o is not null").select("o.*")


def _one_edit(a: str, b: str) -> Column:
    """Whether b comes from a by at most one word replaced, inserted or deleted."""
    short = F.least(F.size(a), F.size(b))
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x == y), False).cast("int")
    at = F.when(differs > 0, F.least(differs, short + 1)).otherwise(short + 1)

    def rest(words: str, skip: Column) -> Column:
        start = at + skip
        return F.slice(words, start, F.greatest(F.size(words) - start + 1, F.lit(0)))

    longer = F.size(a) - F.size(b)
    return ((F.abs(longer) <= 1) & (rest(a, F.when(longer >= 0, 1).otherwise(0))
                                    == rest(b, F.when(longer <= 0, 1).otherwise(0))))


def _near(lines: DataFrame) -> DataFrame:
    """(seq): the lines with an earlier line exactly one edit away.

    Lines with the same word left out are all one edit apart, so the first of
    the group stands for the earlier ones.  Lines that equal a whole line but
    for one word more are each one edit from that line.  Either way the pairs
    of a group are as many as its members, and every pair is verified.
    """
    variants = _variants(lines)
    whole = F.max(F.when(F.col("v") % 2 == 1, F.col("v")))
    groups = stage(variants.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        whole.alias("whole")).filter("lo < hi"), "variant_groups")
    two = groups.filter("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    centres = stage(groups.filter("n > 2").select("key", F.coalesce("whole", "lo").alias("a")),
                    "variant_centres")
    more = variants.join(if_small(centres), "key").select("a", F.col("v").alias("b"))
    pairs = two.unionByName(more).select(F.floor(F.col("a") / 2).alias("a"),
                                         F.floor(F.col("b") / 2).alias("b")).filter("a <> b")
    pairs = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), "variant_pairs")
    wa = lines.select(F.col("seq").alias("a"), F.col("words").alias("wa"))
    wb = lines.select(F.col("seq").alias("b"), F.col("words").alias("wb"))
    return (pairs.join(wa, "a").join(wb, "b").filter(_one_edit("wa", "wb"))
            .select(F.col("b").alias("seq")).distinct())


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  min_words: int = MIN_WORDS, copy_words: int = 1) -> DataFrame:
    """(id, th, gone): by document id and hash of its text, the numbers (from 0)
    of its lines that go; only documents that lose a line."""
    if min_words < 2:
        raise ValueError("min_words must be at least 2")
    if copy_words < 1:
        raise ValueError("copy_words must be at least 1")
    lines = _lines(docs, doc_id, text, min(copy_words, min_words))
    near = F.when(F.size("words") >= min_words, _halves()).otherwise(F.array().cast("array<bigint>"))
    found = stage(lines.withColumn("halves", near).drop("words"), "lines")
    distinct = stage(found.groupBy("h1", "h2").agg(
        F.min(_place()).alias("first"), F.min("halves").alias("halves"),
        F.count(F.lit(1)).alias("copies")), "distinct_lines")
    places = distinct.join(if_small(_sharing(distinct)), "h1", "left_semi")
    sharing = stage(_words_at(docs, doc_id, text, places.select("h1", "h2", "first")),
                    "sharing_lines")
    ordered = stage(sharing.orderBy("first").withColumn("seq", F.monotonically_increasing_id()),
                    "ordered_lines")
    near = ordered.join(_near(ordered.select("seq", "words")), "seq", "left_semi")
    marks = stage(distinct.filter("copies > 1").select("h1", "h2", "first")
                  .unionByName(near.select("h1", "h2", F.lit(None).cast(
                      distinct.schema["first"].dataType).alias("first"))), "marks")
    gone = found.drop("halves").join(if_small(marks), ["h1", "h2"]).filter(
        F.col("first").isNull() | (_place() != F.col("first")))
    return stage(gone.groupBy("id", "th").agg(F.collect_set("line").alias("gone")), "gone")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_words: int = MIN_WORDS, copy_words: int = 1) -> DataFrame:
    """``docs`` with the lines gone from ``text`` that have an earlier line,
    anywhere in the corpus, equal or one word's edit away; n_removed counts them.

    Lines are cut at newlines and compared as words: lower-cased, between white
    space.  Lines of fewer than ``min_words`` words go only where an earlier line
    equals them, those of fewer than ``copy_words`` (at most ``min_words``)
    stay, and so do lines without a word.
    Earlier means a smaller document id (null ids last), then a smaller hash of
    the text, then a smaller line number; a line goes even where the earlier
    one goes too, so chains keep their first line.  Rows of the same id and
    text are one document: their lines are judged alike.  A null or empty text
    stays as it is.  Other columns stay; a column n_removed is replaced.
    """
    gone = removed_lines(docs, doc_id, text, min_words, copy_words).select(
        F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("gone").alias("_gone"))
    body = F.col(f"`{text}`")
    kept = [c for c in docs.columns if c.lower() != "n_removed"]
    out = docs.select(*[F.col(f"`{c}`") for c in kept]).join(
        if_small(gone), F.col(f"`{doc_id}`").eqNullSafe(F.col("_id"))
        & (F.xxhash64(body) == F.col("_th")), "left")
    stays = F.array_join(F.filter(F.split(body, "\n"),
                                  lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    return out.select(*[F.when(F.col("_gone").isNull(), body).otherwise(stays).alias(c)
                        if c.lower() == text.lower() else F.col(f"`{c}`") for c in kept],
                      F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))


def keep_first_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later copies of lines gone; documents left without any
    word by that go too.  n_chars, where it is a column, follows the text."""
    out = dedup_lines(docs, doc_id, text)
    body = F.col(f"`{text}`")
    out = out.filter((F.col("n_removed") == 0) | body.rlike("[^\\x20\\x09-\\x0D]"))
    types = dict(docs.dtypes)
    return out.select(*[F.when(F.col("n_removed") > 0, F.char_length(body)).otherwise(F.col(f"`{c}`"))
                        .cast(types[c]).alias(c) if c.lower() == "n_chars" else F.col(f"`{c}`")
                        for c in docs.columns])


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines: copies of any line with a
    word, and lines of MIN_WORDS words or more within an edit of an earlier one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "n_removed")


def op6_oracle_sql() -> str:
    """The same in SQL, on the texts of all variants."""
    return f"""
WITH raw AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw,
                    generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents),
lines AS (SELECT doc_id, line, list_filter(string_split_regex(lower(raw), '{SPACE}'),
                                           lambda w: w <> '') AS w FROM raw),
held AS (SELECT doc_id, line, w, array_to_string(w, ' ') AS body FROM lines WHERE len(w) >= 1),
uniq AS (SELECT body, any_value(w) AS w, min({{'d': doc_id, 'l': line}}) AS first FROM held GROUP BY body),
long AS (SELECT * FROM uniq WHERE len(w) >= {MIN_WORDS}),
cut AS (SELECT body, first, len(w) AS n, unnest(range(1, len(w) + 1)) AS i, w FROM long),
var AS (SELECT body, first, n, i,
               array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS v FROM cut),
heads AS (SELECT n, i, v, min(first) AS first FROM var GROUP BY n, i, v),
near AS (SELECT var.body FROM var JOIN heads USING (n, i, v) WHERE var.first > heads.first
         UNION
         SELECT CASE WHEN var.first > long.first THEN var.body ELSE long.body END
         FROM var JOIN long ON long.body = var.v),
gone AS (SELECT held.doc_id, held.line FROM held JOIN uniq USING (body)
         WHERE {{'d': held.doc_id, 'l': held.line}} <> uniq.first
            OR body IN (SELECT body FROM near)),
kept AS (SELECT raw.doc_id, string_agg(raw, chr(10) ORDER BY line) AS text,
                count(*) FILTER (WHERE false) AS z FROM raw
         WHERE (doc_id, line) NOT IN (SELECT (doc_id, line) FROM gone) GROUP BY raw.doc_id),
counts AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)"""
