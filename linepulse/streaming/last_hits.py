"""The last piece that found each lot, kept up to date per batch.

The state is a version of a small table: every lot window, with its lot's last
hit (the greatest (instant, tie)).  Hits only grow while windows stay, so a
batch costs a lookup of its own pieces and a merge of maxima.  A window that is
new, gone or moved may take pieces from the lots that it overlaps, or give them
back; the hits of those lots are dropped and looked up again, over the stored
pieces of the days of their windows and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.operators import containment as C
from linepulse.operators.overlap import overlap_join
from linepulse.sources.versioned import VersionedTable

WINDOW = ["lot_id", "line_id", "start_time", "end_time"]
HIT = ["us", "last_tie", "lot_start_us", "hit_line"]
FAR = "TIMESTAMP_NTZ'9999-12-31 00:00:00'"


def windows_of(lot: DataFrame) -> DataFrame:
    return lot.filter(F.col("lot_id").isNotNull() & F.col("line_id").isNotNull()
                      & F.col("start_time").isNotNull()).select(*WINDOW).distinct()


def changed_windows(before: DataFrame, now: DataFrame) -> DataFrame:
    return now.select(*WINDOW).subtract(before.select(*WINDOW)).unionByName(
        before.select(*WINDOW).subtract(now.select(*WINDOW)))


def touched_lots(before: DataFrame, now: DataFrame) -> DataFrame:
    """Ids with a window, old or new, that meets a changed window of its line
    (ends belong to windows; changed lots are touched themselves)."""
    def span(df: DataFrame, lot_id: str, s: str, e: str) -> DataFrame:
        end = F.least(F.coalesce("end_time", F.expr(FAR)), F.expr(FAR))
        return df.select("line_id", F.col("lot_id").alias(lot_id), F.col("start_time").alias(s),
                         F.timestamp_add("MICROSECOND", F.lit(1), end).alias(e))

    changed = changed_windows(before, now)
    every = before.select(*WINDOW).unionByName(now.select(*WINDOW)).distinct()
    met = overlap_join(span(every, "lot_id", "s", "e"), span(changed, "by", "cs", "ce"), "line_id",
                       ("s", "e"), ("cs", "ce"))
    return met.select("lot_id").unionByName(changed.select("lot_id")).distinct()


def days_of(windows: DataFrame, pieces: DataFrame) -> DataFrame:
    """The days of the windows, up to the last day with a piece."""
    last = pieces.select(F.max("day")).scalar()
    first, end = F.to_date("start_time"), F.least(F.coalesce(F.to_date("end_time"), last), last)
    return (windows.select(first.alias("first"), end.alias("end")).distinct()
            .filter(F.col("first") <= F.col("end"))
            .select(F.explode(F.sequence("first", "end")).alias("day")).distinct())


def on_days(days: list) -> Column:
    """A filter on ``day`` by the runs of the given days (a day each at most,
    whatever the number of lots)."""
    runs: list[list] = []
    for day in sorted(days):
        if runs and (day - runs[-1][1]).days <= 1:
            runs[-1][1] = day
        else:
            runs.append([day, day])
    hit = F.lit(False)
    for first, last in runs:
        hit = hit | F.col("day").between(F.lit(first), F.lit(last))
    return hit


def _hits(pieces: DataFrame, lot: DataFrame) -> DataFrame:
    return C.last_hits(pieces, lot).withColumnRenamed("line_id", "hit_line").select("lot_id", *HIT)


class LastHits:
    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path)

    def read(self) -> DataFrame:
        """``lot_id, us, last_tie, lot_start_us, line_id`` of lots with a hit."""
        return (self.table.read().filter(F.col("us").isNotNull())
                .select("lot_id", *HIT).distinct().withColumnRenamed("hit_line", "line_id"))

    def advance(self, lot: DataFrame, pieces: DataFrame, batch_id: int | None = None) -> None:
        """Store the hits as of the current lots and pieces.  ``batch_id``: the
        batch just stored; a replayed one is looked up once more, which
        changes no maximum."""
        version = self.table.latest_version()
        now = windows_of(lot)
        if version is None:
            seen = -1
            hits = _hits(pieces, now)
        else:
            seen = self.table.mark(version)
            new_from = seen + 1 if batch_id is None else min(seen + 1, batch_id)
            before = self.table.read(version)
            kept = before.filter(F.col("us").isNotNull()).select("lot_id", *HIT).distinct()
            hits = _hits(pieces.filter(F.col("batch_id") >= new_from), now)
            if changed_windows(before, now).isEmpty():
                hits = hits.unionByName(kept)
            else:
                touched = touched_lots(before, now)
                hits = hits.unionByName(kept.join(touched, "lot_id", "left_anti"))
                days = [r["day"] for r in days_of(now.join(touched, "lot_id", "left_semi"), pieces).collect()]
                if days:
                    hits = hits.unionByName(_hits(pieces.filter(on_days(days)), now)
                                            .join(touched, "lot_id", "left_semi"))
        best = hits.groupBy("lot_id").agg(F.max(F.struct(*HIT)).alias("h")).select("lot_id", "h.*")
        self.table.write(now.join(best, "lot_id", "left").select(*WINDOW, *HIT),
                         mark=seen if batch_id is None else max(seen, batch_id))
