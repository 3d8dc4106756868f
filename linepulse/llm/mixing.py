"""Mixing sources to target weights by range-sorted hash-random keys.

Every document gets a random key, a hash of a seed, its id and its text.  A
source's documents in the order of their keys are a random order of it; the
documents are range-sorted by source and key, prefix sums of their words come
from sums within and before the ranges, and the source's budget falls into one
document, the cut.  Documents before the cut are taken whole, those after it
not, beside the whole epochs that the budget holds.  Once the cut is known, a
document's share follows from its own key: no row is joined to its prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepulse.llm.common import if_small, stage, table, without

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)         # of the sources in order, repeating
SHARE = Fraction(3, 2)      # words of the mix to words of all documents
MOST = 2                    # times that a source is taken, at most
SEED = "mix-1"
ADDED = ("size", "source_size", "target", "taken", "_key", "_none", "_src")


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
            seed: str = SEED) -> DataFrame:
    """``docs`` with size (words of the text; null: 0), _key (random, the same
    for rows of one id and text) and _none, _src (the source, nulls apart)."""
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")),
                         F.lit(":"), plain).cast("binary"))
    src = F.col(f"`{source}`").cast("string")
    return without(docs, ADDED).withColumns({
        "size": F.regexp_count(plain, F.lit(WORD)).cast("long"), "_key": key,
        "_none": src.isNull(), "_src": F.coalesce(src, F.lit(""))})


def prefix_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str,
                name: str) -> tuple[DataFrame, DataFrame]:
    """(rows, ranges): ``df`` range-sorted by ``by`` and ``order`` and staged,
    with _part and _run (the sum of ``value`` before the row in its range), and
    a row per range and group with its _sum, its first _run and _before, the
    group's sum in earlier ranges.  A row's prefix sum within its group is
    ``_before + _run - _first``.  A range is a task of the sort, so a hot group
    is as many ranges as it takes; of ranges only a row each meets in a window.
    """
    at = df.columns.index(value)
    schema = df.select("*", F.lit(0).cast("int").alias("_part"), F.lit(0).cast("long").alias("_run")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sums = np.cumsum(batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)) + total
            before = np.concatenate([[total], sums[:-1]]).astype(np.int64)[:batch.num_rows]
            total = int(sums[-1]) if len(sums) else total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=schema.names)

    rows = (df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
            .withColumn("_part", F.spark_partition_id()).mapInArrow(run, schema))
    rows = stage(rows, name)
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (rows.groupBy("_part", *by).agg(F.sum(value).alias("_sum"), F.min("_run").alias("_first"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))))
    return rows, ranges


def targets(sources: DataFrame, weights: Sequence[int], share: Fraction, most: int) -> DataFrame:
    """``sources`` (_none, _src, source_size) with target, the words that each
    should give.

    Sources in code-point order, null last, weigh ``weights`` in turn.  A
    target stops at ``most`` times its source; the excess is shared anew by
    weight until none is above, a pass over the sources each time, of which
    only two sums reach the driver.
    """
    rows, ranges = prefix_sums(sources.withColumn("_one", F.lit(1).cast("long")), [], ["_none", "_src"],
                               "_one", "mix_sources")
    place = F.col("_before") + F.col("_run") - F.col("_first")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = rows.join(if_small(ranges), "_part").select(
        "_none", "_src", "source_size",
        F.element_at(cycle, (place % len(weights) + 1).cast("int")).cast("decimal(38,0)").alias("_w"),
        (F.col("source_size") * most).cast("decimal(38,0)").alias("_cap"))
    total, left = ranked.agg(F.sum("source_size"), F.sum("_w")).first()
    total, left, full = int(total or 0), int(left or 0), 0

    def offer() -> Column:
        """What the weight gives of the words left, times ``left`` and the share's denominator."""
        return F.lit(share.numerator * total - share.denominator * full).cast("decimal(38,0)") * F.col("_w")

    while left:
        above = offer() > F.col("_cap") * F.lit(share.denominator * left).cast("decimal(38,0)")
        row = ranked.agg(F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_w")))).first()
        now = int(row[0] or 0), int(row[1] or 0)
        if now == (full, left):
            break
        full, left = now
    target = F.col("_cap").cast("double") if not left else F.least(
        F.col("_cap").cast("double"),
        offer().cast("double") / F.lit(share.denominator * left).cast("double"))
    return ranked.select("_none", "_src", "source_size", target.alias("target"))


def plan(measured: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE,
         most: int = MOST) -> DataFrame:
    """A row per source: (_none, _src, source_size, target, _epochs, _cut, _rest).

    The budget, the target's whole words, is _epochs times the source and a
    rest that ends in the document of key _cut (null: there is no rest), of
    which _rest words are taken.  Rows of one id and text are one document of
    that many copies, which share its rest evenly in whole words.
    """
    by = ["_none", "_src"]
    units = stage(measured.groupBy(*by, "_key").agg(F.count(F.lit(1)).alias("_copies"),
                                                    F.sum("size").alias("_words")), "mix_units")
    sources = stage(units.groupBy(*by).agg(F.sum("_words").alias("source_size")), "mix_sizes")
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    shares = stage(targets(sources, weights, share, most).withColumn("_epochs", whole)
                   .withColumn("_left", budget - F.col("_epochs") * F.col("source_size")), "mix_targets")
    rows, ranges = prefix_sums(units, by, ["_key"], "_words", "mix_sums")
    left = shares.filter(F.col("_left") > 0).select(*by, "_left")
    ends = stage(ranges.join(if_small(left), by).filter(
        (F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("_sum"))), "mix_ends")
    before = F.col("_before") + F.col("_run") - F.col("_first")
    cuts = (rows.join(if_small(ends.drop("_sum")), ["_part", *by])
            .filter((before <= F.col("_left")) & (F.col("_left") < before + F.col("_words")))
            .select(*by, F.col("_key").alias("_cut"),
                    F.floor((F.col("_left") - before) / F.col("_copies")).alias("_rest")))
    return stage(shares.join(stage(cuts, "mix_cuts"), by, "left").drop("_left"), "mix_plan")


def apply_plan(measured: DataFrame, shares: DataFrame) -> DataFrame:
    """``measured`` with source_size, target and taken; a map over its rows
    where the sources are few, by the hash of the source beyond that."""
    rest = (F.when(F.col("_key") < F.col("_cut"), F.col("size"))
            .when(F.col("_key") == F.col("_cut"), F.col("_rest")).otherwise(0))
    return (measured.join(if_small(shares), ["_none", "_src"])
            .withColumn("taken", (F.col("_epochs") * F.col("size") + rest).cast("long")))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most: int = MOST,
        seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and taken, the words that the
    mix takes of the row, repeats counted.

    A source's taken words are its target's whole words (less than a word a
    copy fewer where the cut falls on repeated rows).  No row is taken more
    than ``most`` times.  A null or empty text has no words and gives none; a
    null source is a source, the last one; a null id is like an empty one, and
    rows of equal id and text are treated alike.  An empty table stays empty.
    Input columns of the new names are replaced.  The same rows and seed give
    the same mix, whatever their order and partitions.
    """
    measured = measure(docs, doc_id, text, source, seed)
    shares = plan(stage(measured.select("_none", "_src", "_key", "size"), "mix_keys"), weights, share, most)
    return apply_plan(measured, shares).select(*without(docs, ADDED).columns, *ADDED[:4])


def mixed_texts(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: rows of ``mix`` once per epoch, with epoch (from 0) and
    the text; a last, partial epoch has the text's first words, joined by
    single spaces.  Rows of which nothing is taken are left out."""
    count = F.ceil(F.col("taken") / F.col("size")).cast("int")
    words = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size")).cast("int")
    part = F.array_join(F.slice(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"({WORD})")), 1, words), " ")
    cut = F.when(words < F.col("size"), part).otherwise(F.col(f"`{text}`"))
    return (without(mixed, ["epoch"]).filter(F.col("taken") > 0)
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), count - 1)))
            .withColumn(text, cut))


def op12_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    measured = stage(measure(docs).drop("text", "source"), "mix_documents")
    return apply_plan(measured, plan(measured)).select("doc_id", *ADDED[:4])


def op12_oracle_sql() -> str:
    """The same in SQL: prefix sums over all keys of a source in one window."""
    return rf"""
WITH d AS (SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS src,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
                  md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k
           FROM documents),
s AS (SELECT none, src, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY none, src) - 1) % 3
                  WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS w
      FROM d GROUP BY none, src),
-- with every source of a smaller size by weight at its limit: is this one above its own?
a AS (SELECT s.*, (SELECT sum(source_size) FROM s) AS total,
             (SELECT coalesce(sum({MOST} * t.source_size), 0) FROM s t
              WHERE t.source_size * s.w < s.source_size * t.w) AS full_before,
             (SELECT sum(t.w) FROM s t WHERE t.source_size * s.w >= s.source_size * t.w) AS w_from FROM s),
b AS (SELECT *, (3 * total - 2 * full_before) * w > 2 * w_from * {MOST} * source_size AS above FROM a),
c AS (SELECT *, (SELECT coalesce(sum({MOST} * source_size), 0) FROM b WHERE above) AS filled,
             (SELECT sum(w) FROM b WHERE NOT above) AS w_left FROM b),
t AS (SELECT none, src, source_size,
             CASE WHEN above OR w_left IS NULL THEN CAST({MOST} * source_size AS DOUBLE)
                  ELSE least(CAST({MOST} * source_size AS DOUBLE),
                             CAST((3 * total - 2 * filled) * w AS DOUBLE) / CAST(2 * w_left AS DOUBLE)) END AS target
      FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs
      FROM t),
u AS (SELECT none, src, k, count(*) AS copies, sum(size) AS words FROM d GROUP BY none, src, k),
p AS (SELECT *, sum(words) OVER (PARTITION BY none, src ORDER BY k) - words AS before FROM u)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE
            WHEN before + words <= CAST(floor(target) AS BIGINT) - epochs * source_size THEN size
            WHEN before >= CAST(floor(target) AS BIGINT) - epochs * source_size THEN 0
            ELSE (CAST(floor(target) AS BIGINT) - epochs * source_size - before) // copies END AS BIGINT) AS taken
FROM d JOIN e USING (none, src) JOIN p USING (none, src, k)"""
