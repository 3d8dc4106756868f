"""Gaps-and-islands over state samples.

Samples are sorted once, inside units of a key and an hour; a unit's runs of
equal state follow from the state before.  Units are then summed up in a row
each (runs, first and last state), and one window over a key's units says
where a unit's first run continues the run before and how many runs came
earlier.  Runs that continue meet in a last group-by.  Raw samples are
shuffled once; everything after works on runs and units.

The samples of hours with more than ``hot_rows`` of them are range-partitioned
in their own order, (key, hour, time, tie), by splitters that Spark samples from
them: each range of an hour is a unit, whether the samples spread over the hour
or fall into one second or instant, and however the ties lie.  The ranges are
written once, so every reader sees the same units.  Finding such hours takes
one count per key and hour before the plan is made.

Interval semantics as in the source: an island starts at its first sample
and ends at its **last** sample (not at the next island's start).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepulse.functions import MICROS_PER_HOUR, epoch_micros, floor_div
from linepulse.operators.joins import bounded_broadcast
from linepulse.session import work_path

HOT_ROWS = 1 << 20
_BEFORE = (Window.unboundedPreceding, -1)


def _in_units(df: DataFrame, part: Sequence[str], ts: str, order: Sequence[Column],
              hot_rows: int, repeats_matter: bool) -> DataFrame:
    """``df`` with ``_pk`` (the key as a struct, so NULLs group like values),
    ``_us`` and ``_unit``, whose order is that of the samples by ``_us`` and
    ``order``."""
    base = (df.withColumn("_pk", F.struct(*part)).withColumn("_us", epoch_micros(ts))
            .withColumn("_hour", floor_div("_us", MICROS_PER_HOUR)))
    hours = (base.groupBy("_pk", "_hour").agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > hot_rows))
    rows = hours.agg(F.sum("_n")).first()[0]
    if not rows:
        return base.withColumn("_unit", F.struct("_hour", F.lit(0).alias("_range"))).drop("_hour")
    hot = bounded_broadcast(hours.select("_pk", "_hour"))
    dealt = base.join(hot, ["_pk", "_hour"], "left_semi")
    if not repeats_matter:
        dealt = dealt.distinct()        # equal samples are one run anyway
    # Twice as many ranges as even ones would take: sampled splitters are not exact.
    ranges = 2 * -(-rows // hot_rows)
    dealt = (dealt.repartitionByRange(ranges, "_pk", "_hour", "_us", *order)
             .withColumn("_range", F.spark_partition_id()))
    path = work_path(df.sparkSession, "islands", "hot_hours", unique=True)
    dealt.write.parquet(path)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(path)
    cold = base.join(hot, ["_pk", "_hour"], "left_anti").withColumn("_range", F.lit(0))
    return (cold.unionByName(dealt).withColumn("_unit", F.struct("_hour", "_range"))
            .drop("_hour", "_range"))


def state_islands(samples: DataFrame, key: str = "machine_id", ts: str = "time_input",
                  state: str = "state", tie: str | None = "event_id",
                  with_last_flag: bool = False, with_first_tie: bool = False,
                  with_last_tie: bool = False, with_number: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, state, start_time, end_time[, is_last][, first_tie]
    [, last_tie][, number]) per run of equal states.

    ``tie`` orders samples sharing a timestamp (the host database leaves
    that order arbitrary); NULL ties come last and the state orders samples
    that the tie does not (all of them where it is NULL throughout or
    ``tie=None``).  NULL states form runs like any other value, NULL keys
    group like any other key.
    ``is_last`` (C9) marks intervals ending at the machine's last sample;
    ``first_tie`` and ``last_tie`` are the tie values of the island's first and
    last sample; ``number`` is the island's place among its key's.
    """
    cols = [key, ts, state, *([tie] if tie else [])]
    order = [*([F.col(tie).asc_nulls_last()] if tie else []), F.col(state).asc_nulls_last()]
    base = _in_units(samples.select(*cols), [key], ts, order, hot_rows, repeats_matter=False)
    w0 = Window.partitionBy("_pk", "_unit").orderBy("_us", *order)
    change = (F.lag(F.lit(1)).over(w0).isNull()
              | ~F.col(state).eqNullSafe(F.lag(state).over(w0))).cast("bigint")
    base = base.withColumn("_change", change).withColumn(
        "_j", F.sum("_change").over(w0.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct(F.col(ts), F.col(tie).isNull().alias("none"), F.col(tie).alias("_t")) if tie else None
    ties = {"first_tie": F.min} if with_first_tie and tie else {}
    ties |= {"last_tie": F.max} if with_last_tie and tie else {}
    runs = base.groupBy("_pk", "_unit", "_j").agg(
        F.first(state).alias(state), F.min(ts).alias("start_time"), F.max(ts).alias("end_time"),
        *[f(place).alias(f"_{c}") for c, f in ties.items()])
    return _joined(runs, key, state, ties, with_last_flag, with_number)


def _joined(runs: DataFrame, key: str, state: str, ties: Mapping[str, Callable] = {},
            with_last_flag: bool = False, with_number: bool = False) -> DataFrame:
    """The islands of keys ``_pk`` from the runs of their units ``_unit``, numbered
    by ``_j`` from 1: a unit's first run may continue the unit before."""
    units = runs.groupBy("_pk", "_unit").agg(
        F.max("_j").alias("_n"), F.min_by(state, "_j").alias("_first"),
        F.max_by(state, "_j").alias("_last"), F.max("end_time").alias("_end"))
    w = Window.partitionBy("_pk").orderBy("_unit")
    merged = (F.lag("_n").over(w).isNotNull()
              & F.col("_first").eqNullSafe(F.lag("_last").over(w))).cast("bigint")
    units = units.withColumn("_m", merged).withColumn(
        "_pos", F.coalesce(F.sum(F.col("_n") - F.col("_m")).over(w.rowsBetween(*_BEFORE)), F.lit(0)))
    extra = []
    if with_last_flag:
        units = units.withColumn("_machine_end", F.max("_end").over(Window.partitionBy("_pk")))
        extra = ["_machine_end"]
    placed = runs.join(units.select("_pk", "_unit", "_pos", "_m", *extra), ["_pk", "_unit"])
    placed = placed.withColumn("_island", F.col("_pos") + F.col("_j") - F.col("_m"))
    out = placed.groupBy("_pk", "_island").agg(
        F.first(state).alias(state), F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"), *[F.max(c).alias(c) for c in extra],
        *[f(f"_{c}").getField("_t").alias(c) for c, f in ties.items()])
    out_cols: list[Column | str] = [F.col(f"_pk.{key}").alias(key), state, "start_time", "end_time"]
    if with_last_flag:
        out_cols.append((F.col("end_time") == F.col("_machine_end")).alias("is_last"))
    return out.select(*out_cols, *ties, *([F.col("_island").alias("number")] if with_number else []))


def numbered_runs(samples: DataFrame, keys: Sequence[str], ts: str, state: str, tie: str) -> DataFrame:
    """(keys, state, start_time, end_time, number): the islands of keys of some
    samples each, a key's samples being sorted as one unit.  Equal to
    ``state_islands``, which also takes keys of any size."""
    w = Window.partitionBy(*keys).orderBy(epoch_micros(ts), F.col(tie).asc_nulls_last(),
                                          F.col(state).asc_nulls_last())
    change = (F.lag(F.lit(1)).over(w).isNull()
              | ~F.col(state).eqNullSafe(F.lag(state).over(w))).cast("bigint")
    numbered = samples.withColumn("_change", change).withColumn(
        "number", F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "number").agg(
        F.first(state).alias(state), F.min(ts).alias("start_time"), F.max(ts).alias("end_time")) \
        .select(*keys, state, "start_time", "end_time", "number")


def joined_runs(runs: DataFrame, key: str, unit: str, state: str = "state") -> DataFrame:
    """(key, state, start_time, end_time): the islands of keys from the numbered
    runs (state, start_time, end_time, number) of their units."""
    return _joined(runs.select(F.struct(key).alias("_pk"), F.col(unit).alias("_unit"), state, "start_time",
                               "end_time", F.col("number").alias("_j")), key, state)


def row_numbers(df: DataFrame, partition: Sequence[str], ts: str, tie: str,
                name: str = "rn", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY partition ORDER BY ts, tie)``
    as the number within the unit plus the rows of the key's earlier units.
    NULL ties come last; rows of equal ties are ordered by a hash of the row."""
    order = [F.col(tie).asc_nulls_last(), F.xxhash64(*df.columns)]
    base = _in_units(df, partition, ts, order, hot_rows, repeats_matter=True)
    w0 = Window.partitionBy("_pk", "_unit").orderBy("_us", *order)
    counts = base.groupBy("_pk", "_unit").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("_pk").orderBy("_unit").rowsBetween(*_BEFORE)
    counts = counts.select("_pk", "_unit", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_p"))
    out = base.withColumn("_local", F.row_number().over(w0)).join(counts, ["_pk", "_unit"])
    return out.select(*df.columns, (F.col("_p") + F.col("_local")).alias(name))


def islands_from_row_numbers(samples: DataFrame, key: str = "machine_id",
                             ts: str = "time_input", state: str = "state",
                             tie: str = "event_id") -> DataFrame:
    """E3 in the source's own form: group by (key, state, rn - rn_state)."""
    numbered = row_numbers(row_numbers(samples, [key], ts, tie, "rn"),
                           [key, state], ts, tie, "rn_state")
    return (numbered.groupBy(key, state, (F.col("rn") - F.col("rn_state")).alias("_g"))
            .agg(F.min(ts).alias("start_time"), F.max(ts).alias("end_time"))
            .select(key, state, "start_time", "end_time"))
