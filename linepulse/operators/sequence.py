"""Per-key "next event" lookups that stay bounded under key skew.

A window ``lead(ts) OVER (PARTITION BY key ORDER BY ts)`` sends every row of a
key to one task; a hot machine holding a third of all samples would run in a
single task.  Here the rows are first collapsed to distinct (key, ts) (map-side
partial aggregation absorbs hot timestamps), the lead is taken inside
(key, second) partitions (at most 10^6 distinct microsecond timestamps), and
the step across second and bucket edges uses per-second and per-bucket
summaries, which are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepulse.functions import MICROS_PER_SECOND, epoch_micros, floor_div


def next_time_within(df: DataFrame, keys: Sequence[str], ts: str, horizon_us: int,
                     aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per distinct (keys, ts) with ``next_us``: the next distinct
    timestamp of the same key, or NULL when none lies within ``horizon_us``.

    ``aggs`` are aggregate expressions evaluated over the rows sharing
    (keys, ts), e.g. ``max_by(state, event_id)`` for the last tie.
    Output columns: keys, ts, ``us`` (epoch micros of ts), aggs, ``next_us``.
    Timestamps further than one ``horizon_us`` bucket ahead are never needed,
    because the next bucket's first sample is already beyond the horizon.
    """
    if horizon_us % MICROS_PER_SECOND:
        raise ValueError("horizon must be whole seconds")
    keys = list(keys)
    spb = horizon_us // MICROS_PER_SECOND          # seconds per bucket
    distinct = (df.groupBy(*keys, ts).agg(*aggs) if aggs
                else df.select(*keys, ts).distinct())
    pts = (distinct.withColumn("us", epoch_micros(ts))
           .withColumn("_sec", floor_div("us", MICROS_PER_SECOND)))
    in_second = Window.partitionBy(*keys, "_sec").orderBy("us")
    pts = pts.withColumn("_nxt_same_sec", F.lead("us").over(in_second))

    secs = (pts.groupBy(*keys, "_sec").agg(F.min("us").alias("_first_us"))
            .withColumn("_bkt", floor_div("_sec", spb)))
    in_bucket = Window.partitionBy(*keys, "_bkt").orderBy("_sec")
    secs = secs.withColumn("_nxt_sec_first", F.lead("_first_us").over(in_bucket))
    next_bucket = (secs.groupBy(*keys, "_bkt").agg(F.min("_first_us").alias("_nxt_bkt_first"))
                   .withColumn("_bkt", F.col("_bkt") - 1))
    secs = (secs.join(next_bucket, [*keys, "_bkt"], "left")
            .select(*keys, "_sec",
                    F.coalesce("_nxt_sec_first", "_nxt_bkt_first").alias("_after_sec")))
    out = (pts.join(secs, [*keys, "_sec"], "left")
           .withColumn("next_us", F.coalesce("_nxt_same_sec", "_after_sec")))
    out = out.withColumn(
        "next_us", F.when(F.col("next_us") - F.col("us") <= F.lit(horizon_us), F.col("next_us")))
    return out.drop("_sec", "_nxt_same_sec", "_after_sec")
