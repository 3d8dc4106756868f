"""Domain tables derived from the driver's test data.

The reference's tables (machine samples, state intervals, sensor events,
lots, calendar, config) are derived from ``events`` (and, for the large
range-count variant, ``orders`` x ``lineitem``).  Every derived table is a
lazy DataFrame over the parquet scans, so its size grows with the data.

Derivation rules (mirrored by the DuckDB adapter SQL in ``plans.oracle``):

* machine id ``printf('M%05d', user_id)``, line ``'LINE' || (user_id % 4 + 1)``
* sample state from the event type (see ``STATE_OF_EVENT``), tie-break event_id
* state interval: from a sample to the next sample of the machine, capped at
  one hour; empty intervals are dropped
* one lot per event date and line k in 0..3, shared id ``'L' || yyyymmdd``,
  window ``[d + (8 + k) h, d + (14 + k) h)``, qty_in 250
* sensors: output = every event, reject = ``error``, good = ``view``/``purchase``
* calendar: 52 fiscal weeks from 2023-12-31 (half-open), plus a drifting
  variant with gaps and overlaps
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.functions import MICROS_PER_HOUR, from_epoch_micros
from linepulse.operators.sequence import next_time_within
from linepulse.schemas import DEFAULT_CONFIG, DEFAULT_POLICY

# Event type -> machine state of the sample.
STATE_OF_EVENT = {"error": "UDOWN", "click": "IDLE", "signup": "SETUP",
                  "view": "PROD", "purchase": "PROD"}
# Event types read by the reject and good sensors.
REJECT_EVENTS = ("error",)
GOOD_EVENTS = ("view", "purchase")
LINES = 4
LOT_QTY_IN = 250
INTERVAL_CAP_US = MICROS_PER_HOUR
CALENDAR_START = "2023-12-31"
CALENDAR_WEEKS = 52


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def machine_id_of(user_id: Column) -> Column:
    """Padded to five digits, never cut: ids beyond 99,999 stay apart."""
    return F.format_string("M%05d", user_id)


def line_of(user_id: Column) -> Column:
    return F.concat(F.lit("LINE"), (F.pmod(user_id, F.lit(LINES)) + 1).cast("string"))


def state_of(event_type: Column) -> Column:
    expr = None
    for etype, state in STATE_OF_EVENT.items():
        expr = (F.when(event_type == etype, state) if expr is None
                else expr.when(event_type == etype, state))
    return expr.otherwise(F.upper(event_type))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")


def machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine dimension: one row per distinct machine."""
    users = events(spark, sf_dir).select("user_id").distinct()
    uid = F.col("user_id")
    return users.select(machine_id_of(uid).alias("machine_id"),
                        F.concat(F.lit("user "), uid.cast("string")).alias("description"),
                        line_of(uid).alias("line_id"))


def samples_of(ev: DataFrame) -> DataFrame:
    """Events (batch or stream) as state samples."""
    return ev.select(machine_id_of(F.col("user_id")).alias("machine_id"),
                     state_of(F.col("event_type")).alias("state"),
                     F.col("ts").alias("time_input"), "event_id")


def machine_state_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State samples (machine_id, state, time_input, event_id)."""
    return samples_of(events(spark, sf_dir))


def machine_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State intervals: each sample lasts until the machine's next sample,
    at most one hour; ties on a timestamp keep the last sample (event_id)."""
    ev = events(spark, sf_dir).withColumn("state", state_of(F.col("event_type")))
    nxt = next_time_within(ev, ["user_id"], "ts", INTERVAL_CAP_US,
                           aggs=[F.max_by("state", "event_id").alias("state")])
    end_us = F.coalesce("next_us", F.col("us") + F.lit(INTERVAL_CAP_US))
    return nxt.select(machine_id_of(F.col("user_id")).alias("machine_id"),
                      F.col("ts").alias("start_time"),
                      from_epoch_micros(end_us).alias("end_time"),
                      "state")


def _sensor(spark: SparkSession, sf_dir: str, types: tuple[str, ...] | None) -> DataFrame:
    ev = events(spark, sf_dir)
    if types is not None:
        ev = ev.filter(F.col("event_type").isin(*types))
    return ev.select(line_of(F.col("user_id")).alias("line_id"),
                     F.col("ts").alias("input_time"), "event_id")


def ss_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, None)


def ss_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, REJECT_EVENTS)


def ss_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, GOOD_EVENTS)


def lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lot per event date and line; the 4 lines share the lot id."""
    days = events(spark, sf_dir).select(F.to_date("ts").alias("d")).distinct()
    k = F.col("k")
    day_ts = F.col("d").cast("timestamp_ntz")
    return (days.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(LINES - 1))))
            .select(F.concat(F.lit("L"), F.date_format("d", "yyyyMMdd")).alias("lot_id"),
                    F.concat(F.lit("LINE"), (k + 1).cast("string")).alias("line_id"),
                    F.timestamp_add("HOUR", k + 8, day_ts).alias("start_time"),
                    F.timestamp_add("HOUR", k + 14, day_ts).alias("end_time"),
                    F.lit(LOT_QTY_IN).cast("bigint").alias("qty_in"),
                    F.lit(None).cast("bigint").alias("qty_out"),
                    F.lit(None).cast("bigint").alias("qty_rej"),
                    F.lit(None).cast("bigint").alias("qty_good"),
                    F.lit(None).cast("double").alias("throughput")))


def calendar(spark: SparkSession, drift: bool = False) -> DataFrame:
    """Fiscal weeks.  ``drift=False``: 52 gap-free half-open weeks.
    ``drift=True``: even weeks end a day early (a gap day), odd weeks a day
    late (one day in two weeks), as in the reference's later years."""
    wk = F.col("id")
    start = F.date_add(F.lit(CALENDAR_START).cast("date"), (wk * 7).cast("int"))
    length = (F.when(wk % 2 == 0, F.lit(6)).otherwise(F.lit(8)) if drift else F.lit(7))
    return (spark.range(CALENDAR_WEEKS)
            .select(F.lit("2024").alias("year"),
                    (wk + 1).cast("string").alias("ww"),
                    (F.floor(wk / 13) + 1).cast("int").alias("quarter"),
                    (F.floor(wk * 12 / CALENDAR_WEEKS) + 1).cast("int").alias("month"),
                    start.alias("start_date"),
                    F.date_add(start, length).alias("end_date")))


def config(spark: SparkSession, values: tuple[float, float, float] = DEFAULT_CONFIG) -> DataFrame:
    return spark.createDataFrame([values], "total_time double, pm_time double, "
                                           "idea_output_rating double")


def policy() -> dict[str, str]:
    return dict(DEFAULT_POLICY)


# ---- large range-count variant: orders as lot windows, lineitems as events ----
ORDER_WINDOW_DAYS = 3


def order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return o.select(F.col("o_orderkey").alias("lot_id"),
                    F.pmod("o_custkey", F.lit(LINES)).alias("k"),
                    F.col("o_orderdate").alias("start_time"),
                    F.timestamp_add("DAY", F.lit(ORDER_WINDOW_DAYS), F.col("o_orderdate"))
                    .alias("end_time"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_returnflag")
    return li.select(F.pmod("l_suppkey", F.lit(LINES)).alias("k"),
                     F.col("l_shipdate").alias("t"),
                     (F.col("l_returnflag") == "R").alias("is_return"))


def sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three sensor tables in one scan, one indicator column per sensor.

    Equal to ``tag_sensors(ss_reject, ss_good, ss_output)`` (each sensor row
    counted by its own indicator) but reads ``events`` once.
    """
    return sensors_of(events(spark, sf_dir))


def sensors_of(ev: DataFrame) -> DataFrame:
    """Events (batch or stream) as tagged sensor rows."""
    et = F.col("event_type")
    return ev.select(
        line_of(F.col("user_id")).alias("line_id"), F.col("ts").alias("input_time"), "event_id",
        et.isin(*REJECT_EVENTS).cast("bigint").alias("is_reject"),
        et.isin(*GOOD_EVENTS).cast("bigint").alias("is_good"),
        F.lit(1).cast("bigint").alias("is_output"))


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """``readStream`` over the event parquet files of a folder."""
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{pattern}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder).select("event_id", "ts", "user_id", "event_type")


def event_slices(spark: SparkSession, sf_dir: str, slices: int = 2, late: bool = True) -> DataFrame:
    """The events with _part, the number of their time slice; ``late``: every
    twentieth event id comes with the next slice (one more for the last)."""
    ev = events(spark, sf_dir)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = ev.agg(F.min(us), F.max(us)).first()
    part = F.floor((us - F.lit(lo or 0)) / (((hi or 0) - (lo or 0)) // slices + 1))
    if late:
        part = part + F.when(F.pmod("event_id", F.lit(20)) == 0, 1).otherwise(0)
    return ev.withColumn("_part", part)


def replay_events(spark: SparkSession, sf_dir: str, folder: str, batches: int = 2,
                  late: bool = True) -> DataFrame:
    """A stream of the events in at least ``batches`` micro-batches: the files of
    successive time slices (one more for late rows), written one after the other to ``folder``."""
    sliced = event_slices(spark, sf_dir, batches, late)
    ev = sliced.drop("_part")
    for k in range(batches + 1):
        sliced.filter(F.col("_part") == k).drop("_part").write.mode("append").parquet(folder)
    files = len(spark.read.schema(ev.schema).parquet(folder).inputFiles())
    return (spark.readStream.schema(ev.schema)
            .option("maxFilesPerTrigger", max(1, files // (batches + 1))).parquet(folder))
