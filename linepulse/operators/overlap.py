"""Interval-overlap join with an equality key (C4) and the line timeline (K9).

Of two overlapping intervals one holds the other's start, so the join is two
lookups of points (starts) in intervals, and each pair comes from exactly one of
them.  An interval is cut into the aligned cells of its own size class, one to
three whatever its length; classes grow fourfold from a minute.  A point climbs
the classes that the intervals have, a cell in each, and meets the intervals by
an equi-join on (key, class, cell).  A lot that is open until the year 9999 costs
two rows, and does not coarsen the cells of the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.functions import MICROS_PER_SECOND, epoch_micros
from linepulse.schemas import DEFAULT_LINE_RANGES

CELL_US = 60 * MICROS_PER_SECOND        # of the smallest class


def _cell_us(size_class: Column, cell_us: int) -> Column:
    return F.lit(cell_us).cast("bigint") * F.pow(F.lit(4.0), size_class).cast("bigint")


def _size_class(s: str, e: str, cell_us: int) -> Column:
    cells = (epoch_micros(e) - epoch_micros(s)) / F.lit(float(cell_us))
    return F.ceil(F.log2(F.greatest(cells, F.lit(1.0))) / 2).cast("int")


def _floor(value: Column, width: Column) -> Column:
    return (value - F.pmod(value, width)) / width


def _starts_in(points: DataFrame, at: str, intervals: DataFrame, span: tuple[str, str], key: str,
               cell_us: int) -> DataFrame:
    """Pairs of equal ``key`` whose ``at`` may lie in the span, each once."""
    s, e = span
    intervals = intervals.filter(F.col(s) < F.col(e)).withColumn("_class", _size_class(s, e, cell_us))
    width = _cell_us(F.col("_class"), cell_us)
    first, last = (_floor(epoch_micros(c), width).cast("bigint") for c in (s, e))
    cells = intervals.withColumn("_cell", F.explode(F.sequence(first, last)))
    classes = intervals.select(F.collect_set("_class").alias("classes")).scalar()
    climbed = (points.withColumn("_classes", classes)
               .withColumn("_class", F.explode("_classes")).drop("_classes")
               .withColumn("_cell", _floor(epoch_micros(at), _cell_us(F.col("_class"), cell_us)).cast("bigint")))
    return climbed.join(cells, [key, "_class", "_cell"]).drop("_class", "_cell")


def overlap_join(left: DataFrame, right: DataFrame, key: str,
                 left_span: tuple[str, str], right_span: tuple[str, str],
                 cell_us: int = CELL_US) -> DataFrame:
    """Pairs with equal ``key`` and ``l.start < r.end AND l.end > r.start``.
    Rows with a NULL key or bound match nothing; touching intervals (end ==
    start) do not overlap.  ``cell_us``: width of the smallest cells; results
    never depend on it."""
    (ls, le), (rs, re_) = left_span, right_span
    lb = left.filter(F.col(ls).isNotNull() & F.col(le).isNotNull())
    rb = right.filter(F.col(rs).isNotNull() & F.col(re_).isNotNull())
    overlap = (F.col(ls) < F.col(re_)) & (F.col(le) > F.col(rs))
    later_right = _starts_in(rb, rs, lb, left_span, key, cell_us).filter(overlap & (F.col(rs) >= F.col(ls)))
    later_left = _starts_in(lb, ls, rb, right_span, key, cell_us).filter(overlap & (F.col(rs) < F.col(ls)))
    columns = [key, *[c for c in left.columns if c != key], *[c for c in right.columns if c != key]]
    return later_left.select(*columns).unionByName(later_right.select(*columns))


def line_by_ranges(machine_id: Column, ranges: Sequence[tuple[str, str, str]]
                   = DEFAULT_LINE_RANGES) -> Column:
    """CASE of inclusive string ranges (binary order), no ELSE (NULL)."""
    expr = None
    for lo, hi, line in ranges:
        cond = machine_id.between(lo, hi)
        expr = F.when(cond, line) if expr is None else expr.when(cond, line)
    return expr


def line_state_timeline(machine_state: DataFrame, lot: DataFrame,
                        machine: DataFrame | None = None,
                        ranges: Sequence[tuple[str, str, str]] = DEFAULT_LINE_RANGES,
                        cell_us: int = CELL_US) -> DataFrame:
    """K9: machine state intervals clipped to the lot windows of their line.

    The machine -> line rule is the hard-coded id ranges by default, or the
    ``machine`` dimension when given.  One row per overlapping
    (interval, lot) pair, not merged across machines.
    """
    if machine is None:
        st = machine_state.withColumn("line_id", line_by_ranges(F.col("machine_id"), ranges))
    else:
        st = machine_state.join(machine.select("machine_id", "line_id"), "machine_id")
    st = st.filter(F.col("line_id").isNotNull()).select(
        "line_id", F.col("start_time").alias("m_start"), F.col("end_time").alias("m_end"),
        "state")
    lw = lot.select("line_id", F.col("start_time").alias("l_start"),
                    F.col("end_time").alias("l_end"))
    pairs = overlap_join(st, lw, "line_id", ("m_start", "m_end"), ("l_start", "l_end"),
                         cell_us)
    out = pairs.select("line_id", F.greatest("m_start", "l_start").alias("start_time"),
                       F.least("m_end", "l_end").alias("end_time"), "state")
    return out.filter(F.col("start_time") < F.col("end_time"))
