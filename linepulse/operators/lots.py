"""Lot quality views, sensor counters and lot table updates.

K2 ``lot_quality``, K3 ``line_quality``, K8 ``lot_summary``,
C3/A9 ``apply_sensor_counts``, A10 ``writeback_quality``,
K11 ``refresh_lots``.

The per-line CASE of the source (``line_id = 'LINE1'`` / ``'LINE2'``) is a
policy mapping line -> 'reject' | 'good', compiled into a CASE expression (no
join): 'reject' lines count rejects and derive good pieces, 'good' lines
count good pieces and derive rejects, other lines keep stored values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.functions import txn_date
from linepulse.operators.window_counts import window_counts
from linepulse.schemas import DEFAULT_POLICY, LOT_COLUMNS

SENSOR_MEASURES = ("reject_count", "good_count", "output_count")


def _lines_with(policy: Mapping[str, str], mode: str) -> list[str]:
    return sorted(line for line, m in policy.items() if m == mode)


def counts_rejects(policy: Mapping[str, str]) -> Column:
    return F.col("line_id").isin(*_lines_with(policy, "reject"))


def counts_goods(policy: Mapping[str, str]) -> Column:
    return F.col("line_id").isin(*_lines_with(policy, "good"))


def _quality_columns(policy: Mapping[str, str]) -> list[Column]:
    qo, qr, qg = F.col("qty_out"), F.col("qty_rej"), F.col("qty_good")
    rej = F.when(counts_goods(policy), F.coalesce(qr, qo - qg)).otherwise(qr)
    good = F.when(counts_rejects(policy), F.coalesce(qg, qo - qr)).otherwise(qg)
    return [F.col("line_id"), F.col("lot_id"), F.col("start_time"), F.col("qty_in"), qo,
            rej.alias("qty_rej"), good.alias("qty_good")]


def lot_quality(lot: DataFrame, policy: Mapping[str, str] = DEFAULT_POLICY) -> DataFrame:
    """K2: distinct lots with the missing quantity derived (stored value wins)."""
    return lot.select(*_quality_columns(policy)).distinct()


def line_quality(lot: DataFrame, policy: Mapping[str, str] = DEFAULT_POLICY) -> DataFrame:
    """K3: per (line_id, txndate) sums over distinct lots; the derived
    quantity always wins over the stored one (no COALESCE)."""
    qo, qr, qg = F.col("qty_out"), F.col("qty_rej"), F.col("qty_good")
    sub = lot.select("line_id", "start_time", txn_date("start_time").alias("txndate"),
                     "qty_in", "qty_out", "qty_rej", "qty_good").distinct()
    rej = F.when(counts_goods(policy), qo - qg).otherwise(qr)
    good = F.when(counts_rejects(policy), qo - qr).otherwise(qg)
    return sub.groupBy("line_id", "txndate").agg(
        F.sum("qty_in").alias("qty_in"), F.sum("qty_out").alias("qty_out"),
        F.sum(rej).alias("qty_rej"), F.sum(good).alias("qty_good"))


def lot_summary(quality: DataFrame, lot_id: str | None = None) -> DataFrame:
    """K8: per lot id, latest start and quantity sums over its lines."""
    if lot_id is not None:
        quality = quality.filter(F.col("lot_id") == lot_id)
    return (quality.groupBy("lot_id")
            .agg(F.max("start_time").alias("start_time"), F.sum("qty_in").alias("qty_in"),
                 F.sum("qty_out").alias("qty_out"), F.sum("qty_rej").alias("qty_rej"))
            .orderBy("lot_id"))


def sensor_counts(lot: DataFrame, sensor_events: DataFrame, match_line: bool = False,
                  strategy: str = "auto") -> DataFrame:
    """Per lot id, events of each sensor inside ``[start_time, end_time)``.

    ``sensor_events``: (line_id, input_time, is_reject, is_good, is_output).
    Faithful default: the line is not compared and windows sharing a lot id
    pool their counts (an event inside two such windows counts twice).
    ``match_line=True`` compares lines and counts per (lot_id, line_id).
    ``strategy``: see ``window_counts`` ('auto', 'broadcast', 'prefix').
    """
    measures = {"reject_count": F.col("is_reject"), "good_count": F.col("is_good"),
                "output_count": F.col("is_output")}
    keys = ["line_id"] if match_line else []
    group = ["lot_id", "line_id"] if match_line else ["lot_id"]
    return window_counts(sensor_events, "input_time", lot, measures, keys=keys,
                         group_by=group, strategy=strategy)


def tag_sensors(ss_reject: DataFrame | None = None, ss_good: DataFrame | None = None,
                ss_output: DataFrame | None = None) -> DataFrame:
    """Union of the three sensor tables with one indicator per sensor; tables
    without ``event_id`` have NULL ones."""
    parts = []
    for df, name in ((ss_reject, "is_reject"), (ss_good, "is_good"), (ss_output, "is_output")):
        if df is None:
            continue
        flags = [F.lit(1 if n == name else 0).cast("bigint").alias(n)
                 for n in ("is_reject", "is_good", "is_output")]
        tie = F.col("event_id") if "event_id" in df.columns else F.lit(None).cast("bigint")
        parts.append(df.select("line_id", "input_time", tie.alias("event_id"), *flags))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def apply_sensor_counts(lot: DataFrame, counts: DataFrame,
                        policy: Mapping[str, str] = DEFAULT_POLICY,
                        match_line: bool = False) -> DataFrame:
    """A9 x3: rejects -> qty_rej of 'reject' lines, goods -> qty_good of
    'good' lines, output -> qty_out of every line.  A lot id without any
    matching event keeps its stored value (never 0)."""
    on = ["lot_id", "line_id"] if match_line else ["lot_id"]
    j = lot.join(counts, on, "left")

    def upd(target: str, measure: str, applies: Column | None) -> Column:
        hit = F.col(measure) > 0
        if applies is not None:
            hit = applies & hit
        return F.when(hit, F.col(measure)).otherwise(F.col(target)).alias(target)

    cols = {c: F.col(c) for c in LOT_COLUMNS}
    cols["qty_rej"] = upd("qty_rej", "reject_count", counts_rejects(policy))
    cols["qty_good"] = upd("qty_good", "good_count", counts_goods(policy))
    cols["qty_out"] = upd("qty_out", "output_count", None)
    return j.select(*[cols[c] for c in LOT_COLUMNS])


def writeback_quality(lot: DataFrame, policy: Mapping[str, str] = DEFAULT_POLICY) -> DataFrame:
    """A10: set qty_good, qty_rej, qty_out from ``lot_quality`` on
    (lot_id, line_id).  Matched NULLs overwrite.  When several view rows share
    a key the host database picks any; we pick the greatest
    (start_time, qty_in, qty_out, qty_rej, qty_good)."""
    v = lot.select(*_quality_columns(policy))     # DISTINCT is moot under max()
    pick = (v.groupBy("lot_id", "line_id")
            .agg(F.max(F.struct("start_time", "qty_in", "qty_out", "qty_rej", "qty_good"))
                 .alias("_v")))
    j = lot.join(pick, ["lot_id", "line_id"], "left")
    hit = F.col("_v").isNotNull()
    cols = {c: F.col(c) for c in LOT_COLUMNS}
    for c in ("qty_out", "qty_rej", "qty_good"):
        cols[c] = F.when(hit, F.col(f"_v.{c}")).otherwise(F.col(c)).alias(c)
    return j.select(*[cols[c] for c in LOT_COLUMNS])


def refresh_lots(lot: DataFrame, sensor_events: DataFrame,
                 policy: Mapping[str, str] = DEFAULT_POLICY,
                 match_line: bool = False) -> DataFrame:
    """The report's lot refresh, counters then write-back.

    The three counter updates read the same (unchanged) lot windows, so all
    three counts come from one pass over the sensor events.
    """
    counts = sensor_counts(lot, sensor_events, match_line)
    return writeback_quality(apply_sensor_counts(lot, counts, policy, match_line), policy)
