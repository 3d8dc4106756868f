"""I1, second form: islands as a stream with one open island per machine as state.

A ``foreachBatch`` job: the state of a machine is its open island (state,
first sample, last sample), O(1) per machine, kept as a table version per
micro-batch, of which the last few stay.  Each micro-batch is reduced to its runs by
``operators.islands.state_islands``, which sorts in units of an hour and cuts
hot hours and instants, so no task holds a machine's rows at once.  Only the
machine's first run of the batch may extend the open island, and its last run
is the new open one.  A batch appends the islands it closes and the open ones
(``is_open``) under its id; the table of islands is the closed ones plus each
machine's newest open row.

Exact only when samples arrive in time order across micro-batches (a late
sample cannot reopen a closed island); ``IslandsJob`` is exact for any
arrival order and is the default.  A batch reads only the state of earlier
ones, so a replayed batch overwrites exactly its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.operators.islands import state_islands
from linepulse.operators.joins import bounded_broadcast
from linepulse.sources.versioned import VersionedTable

COLUMNS = ["machine_id", "state", "start_time", "end_time"]
EMPTY = "machine_id string, state string, start_time timestamp_ntz, end_time timestamp_ntz"
KEEP_VERSIONS = 3       # of the open islands; a replay reads the one before its batch


def _key() -> Column:
    """Order of a machine's runs: that of their first samples."""
    return F.struct("start_time", F.col("first_tie").isNull().alias("no_tie"), "first_tie",
                    F.col("state").isNull().alias("no_state"), "state")


def advance(batch: DataFrame, opened: DataFrame | None) -> DataFrame:
    """(machine_id, state, start_time, end_time, is_open): the islands that the
    batch closes and the open ones of its machines."""
    runs = state_islands(batch, with_first_tie=True).withColumn("_key", _key())
    whole = F.struct("_key", "end_time")
    ends = runs.groupBy("machine_id").agg(F.min(whole).alias("_first"), F.max("_key").alias("_last"))
    if opened is None:
        opened = batch.sparkSession.createDataFrame([], runs.select(*COLUMNS).schema)
    opened = opened.select(F.col("machine_id").alias("_m"), F.struct(
        F.lit(True).alias("known"), "state", "start_time", "end_time").alias("_open"))
    ends = ends.join(opened, F.col("machine_id").eqNullSafe(F.col("_m")), "left").select(
        F.col("machine_id").alias("_m"), F.col("_first._key").alias("_first"), "_last", "_open",
        F.coalesce(F.col("_open.known") & F.col("_open.state").eqNullSafe(F.col("_first._key.state")),
                   F.lit(False))
        .alias("_extends"))
    first = F.col("_key").eqNullSafe(F.col("_first")) & F.col("_extends")
    found = (runs.join(bounded_broadcast(ends), F.col("machine_id").eqNullSafe(F.col("_m")))
             .select("machine_id", "state",
                     F.when(first, F.col("_open.start_time")).otherwise(F.col("start_time"))
                     .alias("start_time"),
                     F.when(first, F.greatest("end_time", "_open.end_time"))
                     .otherwise(F.col("end_time")).alias("end_time"),
                     F.col("_key").eqNullSafe(F.col("_last")).alias("is_open")))
    closed = ends.filter(F.col("_open.known") & ~F.col("_extends")).select(
        F.col("_m").alias("machine_id"), "_open.state", "_open.start_time", "_open.end_time",
        F.lit(False).alias("is_open"))
    return found.unionByName(closed)


class StatefulIslandsJob:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/island_updates"
        self.open = VersionedTable(spark, f"{root.rstrip('/')}/open_islands")

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.select("machine_id", "state", "time_input", "event_id").persist()
        try:
            if not batch.isEmpty():
                self._handle(batch, batch_id)
        finally:
            batch.unpersist()

    def _handle(self, batch: DataFrame, batch_id: int) -> None:
        before = self.open.latest_before(batch_id)
        opened = None if before is None else self.open.read(before)
        updates = advance(batch, opened)
        (updates.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(self.path))
        new = (self.spark.read.schema(updates.schema).parquet(f"{self.path}/batch_id={batch_id}")
               .filter("is_open").select(*COLUMNS))
        if opened is not None:
            touched = new.select(F.col("machine_id").alias("_m"))
            new = new.unionByName(opened.select(*COLUMNS).join(
                touched, F.col("machine_id").eqNullSafe(F.col("_m")), "left_anti"))
        self.open.write(new, version=batch_id)
        self.open.expire(KEEP_VERSIONS)

    def read(self) -> DataFrame:
        """All islands so far; the empty table before the first sample."""
        if self.open.latest_version() is None:
            return self.spark.createDataFrame([], EMPTY)
        closed = self.spark.read.parquet(self.path).filter(~F.col("is_open"))
        return closed.select(*COLUMNS).unionByName(self.open.read().select(*COLUMNS))

    def run(self, samples_stream: DataFrame, checkpoint: str) -> DataFrame:
        q = (samples_stream.writeStream.foreachBatch(self.handle)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        return self.read()
