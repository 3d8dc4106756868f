"""Continuous island maintenance over any arrival order.

The source rebuilds every touched machine from its whole history on each
insert.  Here the result is kept as runs of equal states within a machine and a
day, in the total order (time, tie, state); a batch changes nothing but the
days that its samples fall in.  Per batch:

* its samples are stored under the batch id, partitioned by machine bucket and day;
* the runs of the touched (bucket, day) pairs are made anew by the batch
  operator from the samples stored there, and replace what was there.

A replayed batch replaces its own samples and makes the same runs again, so a
crash at any point is repaired by the replay.  A run has its number within the
machine and day, so ``read`` merges the runs of neighbouring days without
another sort of them.  A machine's day is sorted as one unit, but in (bucket,
day) pairs of more than ``hot_rows`` samples, which the batch operator cuts.

With ``lateness`` the job has a watermark: rows earlier than the greatest time
of the batches before less ``lateness`` are late.  They are counted, not
merged, and the samples of days that can no longer change are deleted, so what
the job reads and keeps beside the runs is bounded by the lateness.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.functions import ntz_literal
from linepulse.operators.islands import HOT_ROWS, joined_runs, numbered_runs, state_islands
from linepulse.sources.versioned import delete_path, path_exists

DEFAULT_BUCKETS = 4
ISLAND_COLUMNS = ["machine_id", "state", "start_time", "end_time"]
SAMPLES = "machine_id string, state string, time_input timestamp_ntz, event_id bigint"
PARTS = "mbucket int, day date"
RUNS = f"{', '.join(f'{c} string' for c in ISLAND_COLUMNS[:2])}, start_time timestamp_ntz, " \
       f"end_time timestamp_ntz, number bigint, {PARTS}"
LOG = "batch_id bigint, newest timestamp_ntz, late bigint"


def machine_bucket(machine_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(machine_id), F.lit(buckets)).cast("int")


class IslandsJob:
    """``buckets``: machine buckets a day is stored in, the unit of rewriting; as
    many as keep a bucket's day to some files (the default suits small plants).
    ``lateness``: None absorbs every late row and keeps all samples."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS,
                 lateness: dt.timedelta | None = None, hot_rows: int = HOT_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.lateness = lateness
        self.hot_rows = hot_rows
        self.samples_path = f"{self.root}/samples"
        self.runs_path = f"{self.root}/day_runs"
        self.log_path = f"{self.root}/log"

    def _read(self, path: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(path)

    def _watermark(self, batch_id: int) -> dt.datetime | None:
        """From the batches before, so that a replay has the same."""
        if self.lateness is None:
            return None
        newest = self._read(self.log_path, LOG).filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        return None if newest is None else newest - self.lateness

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch (machine_id, state, time_input and, if the source has
        one, event_id).  NULL machines are a machine, rows without a time none."""
        tie = F.col("event_id") if "event_id" in batch.columns else F.lit(None)
        batch = batch.select("machine_id", "state", "time_input", tie.cast("bigint").alias("event_id")) \
            .filter(F.col("time_input").isNotNull())
        watermark = self._watermark(batch_id)
        if self.lateness is not None:
            late = F.lit(False) if watermark is None else F.col("time_input") < ntz_literal(watermark)
            log = batch.agg(F.lit(batch_id).cast("bigint").alias("batch_id"),
                            F.max("time_input").alias("newest"), F.count_if(late).alias("late"))
            self._replace(log, self.log_path, "batch_id")
            batch = batch.filter(~late)
        parts = (batch.withColumn("mbucket", machine_bucket(F.col("machine_id"), self.buckets))
                 .withColumn("day", F.to_date("time_input"))
                 .withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        # Few files a part, but a part too large for one task is split.
        self._replace(parts.hint("rebalance", "mbucket", "day"), self.samples_path, "batch_id", "mbucket", "day")
        touched = self._pairs(self._samples().filter(F.col("batch_id") == batch_id))
        if touched:
            stored = self._samples().filter(self._among(touched))
            # Of these counts the files' own row counts are read, no sample.
            hot = self._pairs(stored, self.hot_rows)
            cold = {b: days - hot.get(b, set()) for b, days in touched.items()}
            runs = [f(self._samples().filter(self._among(pairs))) for f, pairs in
                    ((self._runs_of, cold), (self._hot_runs_of, hot)) if any(pairs.values())]
            self._replace(reduce(DataFrame.unionByName, runs).hint("rebalance", "mbucket", "day"),
                          self.runs_path, "mbucket", "day")
        if watermark is not None:
            self._expire(watermark.date())

    def _samples(self) -> DataFrame:
        return self._read(self.samples_path, f"{SAMPLES}, batch_id bigint, {PARTS}")

    def _replace(self, df: DataFrame, path: str, *parts: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(path))

    def _pairs(self, samples: DataFrame, beyond: int = 0) -> dict[int, set[dt.date]]:
        """The days by bucket of stored samples, where they are more than ``beyond``."""
        found = samples.groupBy("mbucket", "day").count().filter(F.col("count") > beyond).collect()
        days: dict[int, set[dt.date]] = {}
        for r in found:
            days.setdefault(r["mbucket"], set()).add(r["day"])
        return days

    def _among(self, pairs: dict[int, set[dt.date]]) -> Column:
        """A filter on the partitions; buckets of the same days share a term."""
        buckets: dict[frozenset, list[int]] = {}
        for b, days in pairs.items():
            buckets.setdefault(frozenset(days), []).append(b)
        hit = F.lit(False)
        for days, some in buckets.items():
            if days:
                hit = hit | (F.col("mbucket").isin(some) & F.col("day").isin(sorted(days)))
        return hit

    def _runs_of(self, samples: DataFrame) -> DataFrame:
        """Runs within (machine, day) of the stored samples; a day's runs never
        go on in the next one, which ``read`` makes up for."""
        return numbered_runs(samples.select("machine_id", "mbucket", "day", "state", "time_input", "event_id"),
                             ["machine_id", "mbucket", "day"], "time_input", "state", "event_id")

    def _hot_runs_of(self, samples: DataFrame) -> DataFrame:
        """The same, for machines and days of any number of samples."""
        keyed = samples.select(F.struct("machine_id", "mbucket", "day").alias("_md"), "state",
                               "time_input", "event_id")
        runs = state_islands(keyed, key="_md", with_number=True, hot_rows=self.hot_rows)
        return runs.select("_md.machine_id", "_md.mbucket", "_md.day", "state", "start_time", "end_time",
                           "number")

    def _expire(self, first_day: dt.date) -> None:
        """Delete the samples of days before ``first_day``: no row to come that
        is not late falls there.  A replay of this batch has the same watermark."""
        old = self._samples().filter(F.col("day") < F.lit(first_day))
        for r in old.select("batch_id", "mbucket", "day").distinct().collect():
            delete_path(self.spark, f"{self.samples_path}/batch_id={r['batch_id']}/mbucket={r['mbucket']}/day={r['day']}")

    def late(self) -> int:
        """How many rows came after the watermark."""
        return self._read(self.log_path, LOG).agg(F.sum("late")).first()[0] or 0

    def read(self) -> DataFrame:
        """All islands, equal to ``state_islands`` over everything received
        (but the late rows); the empty table before the first batch."""
        return joined_runs(self._read(self.runs_path, RUNS), "machine_id", "day")

    def run(self, samples_stream: DataFrame, checkpoint: str) -> DataFrame:
        q = (samples_stream.writeStream.foreachBatch(self.handle)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        return self.read()
