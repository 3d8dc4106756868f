"""Continuous lot counters, throughput and today's OEE.

The source's triggers join the current lot table on every insert, so a lot
that opens, closes or moves gets the pieces that came before.  Per
micro-batch, in the order the triggers fire (counters before throughput):

* the batch's pieces, summed by (line, instant), are stored under the batch
  id, partitioned by day;
* I2: the lots are read again, and the ids whose windows hold an instant of
  the batch or have changed since the last version are counted anew over the
  stored pieces of their days (the range-count operator, equal to batch C3);
  the other ids keep their counts.  Versions of the counts have numbers of their
  own, and each notes the last batch it counts, so that batches, replays and
  refreshes can follow each other in any order;
* I3: the last piece that found each lot is kept as a state (``last_hits``): a
  batch looks up its own pieces and the lots that changed, and throughput is the
  state's elapsed times with the lots' current quantities;
* I4: today's OEE is recomputed from the refreshed lots and stored as a new
  version that notes its day.  After midnight the new day's (empty) rows are
  stored by the next batch or, without any input, by the next tick of ``clock``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linepulse.operators import containment as C
from linepulse.operators import lots as L
from linepulse.plans.plant import Plant
from linepulse.plans.report import today_report
from linepulse.sources.versioned import VersionedTable, path_exists
from linepulse.streaming.last_hits import LastHits

PIECES = ("line_id string, input_time timestamp_ntz, event_id bigint, is_reject bigint, "
          "is_good bigint, is_output bigint, day date, batch_id bigint")


class SensorJob:
    """``keep_versions``: how many versions of the counters, the last hits and
    today's OEE are kept; older ones are deleted after each batch.
    ``with_throughput=False`` leaves I3 out, ``with_oee=False`` I4."""

    def __init__(self, spark: SparkSession, root: str, plant: Plant,
                 as_of: str | None = None, with_oee: bool = True, keep_versions: int = 50,
                 with_throughput: bool = True):
        self.spark = spark
        self.root = root.rstrip("/")
        self.plant = plant
        self.as_of = as_of
        self.with_oee = with_oee
        self.keep_versions = keep_versions
        self.with_throughput = with_throughput
        self.pieces_path = f"{self.root}/pieces"
        self.counts = VersionedTable(spark, f"{self.root}/counts")
        self.hits = LastHits(spark, f"{self.root}/hits")
        self.today = VersionedTable(spark, f"{self.root}/today_oee")

    # ---- reads of the current state -------------------------------------
    def pieces(self) -> DataFrame:
        """All stored pieces: sums of a line's pieces of a batch at an instant,
        with the greatest event id there."""
        if not path_exists(self.spark, self.pieces_path):
            return self.spark.createDataFrame([], PIECES)
        return self.spark.read.schema(PIECES).parquet(self.pieces_path)

    def counters(self) -> DataFrame:
        """Counts per lot id, as of the last batch or ``refresh``."""
        return self.counts.read().select("lot_id", *L.SENSOR_MEASURES).filter(
            F.col("output_count").isNotNull())

    def lots(self) -> DataFrame:
        p = self.plant
        return L.writeback_quality(
            L.apply_sensor_counts(p.fresh("lot"), self.counters(), p.policy), p.policy)

    def throughput(self) -> DataFrame:
        """K10 as of the last batch or ``refresh``."""
        return C.throughput_value(C.matched_quantity(self.hits.read(), self.lots()))

    # ---- per batch --------------------------------------------------------
    def handle(self, batch: DataFrame, batch_id: int) -> None:
        self._store(batch, batch_id)
        self.refresh(batch_id)
        if self.with_oee:                                                     # I4
            self._store_today()
        self.counts.expire(self.keep_versions)
        self.hits.table.expire(self.keep_versions)

    def _day(self) -> dt.date:
        return (dt.date.fromisoformat(self.as_of) if self.as_of
                else self.spark.range(1).select(F.current_date()).first()[0])

    def _store_today(self) -> None:
        self.today.write(self.today_oee(), mark=self._day().toordinal())
        self.today.expire(self.keep_versions)

    def tick(self) -> bool:
        """Store today's rows if the last stored ones are of another day."""
        latest = self.today.latest_version()
        if latest is not None and self.today.mark(latest) == self._day().toordinal():
            return False
        self._store_today()
        return True

    def clock(self, checkpoint: str, every: str = "1 minute") -> StreamingQuery:
        """A query that ticks by processing time, whether pieces come or not."""
        beat = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        return (beat.writeStream.foreachBatch(lambda _, __: self.tick())
                .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())

    def _store(self, batch: DataFrame, batch_id: int) -> None:
        tie = F.col("event_id") if "event_id" in batch.columns else F.lit(None).cast("bigint")
        summed = (batch.withColumn("event_id", tie).groupBy("line_id", "input_time")
                  .agg(F.max("event_id").alias("event_id"),
                       *[F.sum(m).alias(m) for m in ("is_reject", "is_good", "is_output")])
                  .withColumn("day", F.to_date("input_time"))
                  .withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        # batch first: a replay replaces whatever its batch had stored
        (summed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "day").parquet(self.pieces_path))

    def refresh(self, batch_id: int | None = None) -> None:
        """Store the current counts and last hits as the next versions.

        Called for every batch; also to be called when lots have changed
        without new pieces.
        """
        before = self.counts.latest_version()
        seen = -1 if before is None else self.counts.mark(before)
        # A replayed batch counts as new once more, so does one stored before a crash.
        new_from = seen + 1 if batch_id is None else min(seen + 1, batch_id)
        lot = self.plant.fresh("lot")
        one = F.xxhash64("line_id", "start_time", "end_time")
        windows = lot.groupBy("lot_id").agg(F.xxhash64(
            F.bit_xor(one), F.count(F.lit(1)), F.sum(one.cast("decimal(20,0)"))).alias("windows"))
        if before is None:
            counted = self._count(lot)
            old = None
        else:
            # A count holds if the id's windows are the same and no piece has
            # come into them since the version that the count is from.
            same = windows.join(self.counts.read(before), ["lot_id", "windows"])
            old = same.join(self._touched(lot, new_from), "lot_id", "left_anti")
            counted = self._count(lot.join(old.select("lot_id"), "lot_id", "left_anti"))
        fresh = windows.join(counted, "lot_id", "left")
        columns = ["lot_id", "windows", *L.SENSOR_MEASURES]
        if old is not None:
            fresh = fresh.join(old.select("lot_id"), "lot_id", "left_anti").select(*columns) \
                .unionByName(old.select(*columns))
        self.counts.write(fresh.select(*columns), mark=seen if batch_id is None else max(seen, batch_id))
        if self.with_throughput:
            self.hits.advance(lot, self.pieces(), batch_id)

    def _touched(self, lot: DataFrame, new_from: int) -> DataFrame:
        """Ids with a window on a day of the pieces stored by batch ``new_from``
        or later.  The days are a set, not a range: one late piece touches the
        lots of its own day only."""
        days = sorted(r["day"] for r in self.pieces().filter(F.col("batch_id") >= new_from)
                      .select("day").distinct().collect())
        runs: list[list[dt.date]] = []
        for day in days:
            if runs and day - runs[-1][1] <= dt.timedelta(days=1):
                runs[-1][1] = day
            else:
                runs.append([day, day])
        hit = F.lit(False)
        for first, last in runs:
            hit = hit | ((F.to_date("start_time") <= F.lit(last)) & (F.to_date("end_time") >= F.lit(first)))
        return lot.filter(hit).select("lot_id").distinct()

    def _count(self, lot: DataFrame) -> DataFrame:
        """Counts of the given lots over the stored pieces of their days."""
        first, last = lot.agg(F.min("start_time"), F.max("end_time")).first()
        pieces = self.pieces()
        if first is None or last is None:
            pieces = pieces.limit(0)
        else:
            pieces = pieces.filter(F.col("day").between(F.lit(first.date()), F.lit(last.date())))
        return L.sensor_counts(lot, pieces)

    def today_oee(self) -> DataFrame:
        """Today's OEE from the day's intervals and the day's lots refreshed
        from the stored counters (inputs pruned to the day)."""
        p = self.plant

        def from_counters(lots: DataFrame) -> DataFrame:
            counts = self.counters().join(lots.select("lot_id").distinct(), "lot_id",
                                          "left_semi")
            return L.writeback_quality(L.apply_sensor_counts(lots, counts, p.policy), p.policy)

        return today_report(p.with_(lot=p.fresh("lot")), self.as_of, refresh=from_counters)

    def run(self, sensor_stream: DataFrame, checkpoint: str) -> None:
        q = (sensor_stream.writeStream.foreachBatch(self.handle)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
