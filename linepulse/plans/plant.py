"""A bundle of the domain tables one plan reads, and their staging.

In production the domain tables (machines, state intervals, lots, sensor
events, calendar, config) are stored tables.  Over the driver's test data
they are derived by ``sources.adapters``; ``from_testdata`` runs that
derivation once per data folder as Spark jobs and stores the results as
parquet under the shared working folder, so every query plans against plain
table scans (column pruning and filter pushdown reach the files) instead of
re-deriving the tables inside each plan.
"""

from __future__ import annotations

import hashlib
import inspect
import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from linepulse import schemas as S
from linepulse.operators import sequence as _sequence
from linepulse.schemas import DEFAULT_POLICY, DOWN_STATES, PROD_STATES
from linepulse.session import work_path
from linepulse.sources import adapters


TABLES = ("machine", "machine_state", "machine_state_input", "lot", "sensor_events",
          "calendar", "config")


class Plant:
    """Domain tables plus the report parameters.

    Tables are given as DataFrames or as zero-argument callables; a callable
    is opened the first time a plan reads that table.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 policy: Mapping[str, str] | None = None,
                 prod_states: Sequence[str] = PROD_STATES,
                 down_states: Sequence[str] = DOWN_STATES):
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise ValueError(f"unknown tables {sorted(unknown)}")
        self._sources = dict(tables)
        self._opened: dict[str, DataFrame] = {}
        self.policy = dict(DEFAULT_POLICY if policy is None else policy)
        self.prod_states = tuple(prod_states)
        self.down_states = tuple(down_states)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._opened:
            src = self._sources.get(name)
            if src is None:
                raise AttributeError(f"plant has no table {name!r}")
            self._opened[name] = src() if callable(src) else src
        return self._opened[name]

    def fresh(self, name: str) -> DataFrame:
        """The table opened anew: a callable source lists its files again, so
        rows stored since the last read are seen."""
        src = self._sources[name]
        return src() if callable(src) else src

    def with_(self, **kw) -> "Plant":
        tables = {**self._sources, **{k: v for k, v in kw.items() if k in TABLES}}
        params = dict(policy=self.policy, prod_states=self.prod_states,
                      down_states=self.down_states)
        params.update({k: v for k, v in kw.items() if k not in TABLES})
        return Plant(tables, **params)


# table name -> schema of the files a user exports (the sensors are three tables)
FOLDER_TABLES = {
    "machine": S.MACHINE, "machine_state": S.MACHINE_STATE, "lot": S.LOT,
    "calendar": S.CALENDAR, "config": S.CONFIG,
    "ss_reject": S.SENSOR, "ss_good": S.SENSOR, "ss_output": S.SENSOR,
    "machine_state_input": S.MACHINE_STATE_INPUT,
}


def from_folder(spark: SparkSession, folder: str, fmt: str = "parquet",
                policy: Mapping[str, str] | None = None) -> Plant:
    """A plant over exported tables ``<folder>/<table>.<fmt>`` (parquet or
    csv), read with the domain schemas.  The three sensor tables are tagged
    and unioned into ``sensor_events``; ``machine_state_input`` is optional.
    """
    from linepulse.operators.lots import tag_sensors
    from linepulse.sources.tables import read_csv_table, read_table

    def load(name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        if fmt == "csv":
            return read_csv_table(spark, path, FOLDER_TABLES[name])
        return read_table(spark, path, FOLDER_TABLES[name])

    tables: dict[str, DataFrame | Callable[[], DataFrame]] = {
        name: (lambda n=name: load(n))
        for name in ("machine", "machine_state", "lot", "calendar", "config",
                     "machine_state_input")}
    tables["sensor_events"] = lambda: tag_sensors(load("ss_reject"), load("ss_good"),
                                                  load("ss_output"))
    return Plant(tables, policy=policy)


def derive_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The domain tables as lazy derivations from the raw parquet files."""
    return {
        "machine": adapters.machine(spark, sf_dir),
        "machine_state": adapters.machine_state(spark, sf_dir),
        "machine_state_input": adapters.machine_state_input(spark, sf_dir),
        "lot": adapters.lot(spark, sf_dir),
        "sensor_events": adapters.sensor_events(spark, sf_dir),
        "calendar": adapters.calendar(spark, drift=False),
        "calendar_drift": adapters.calendar(spark, drift=True),
        "config": adapters.config(spark),
    }


def _stage_key(spark: SparkSession, sf_dir: str) -> str:
    """Changes with the input's files as Spark lists them (any path Spark can
    read), their sizes and times, and with the derivation rules."""
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    files = (adapters.table(spark, sf_dir, "events")
             .select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
             .distinct().orderBy("file_path"))
    for row in files.agg(F.sort_array(F.collect_list(F.concat_ws(":", *files.columns))), F.count("*")).first():
        h.update(str(row).encode())
    for mod in (adapters, _sequence):
        h.update(inspect.getsource(mod).encode())
    return h.hexdigest()[:16]


_STAGED: set[tuple[str, str]] = set()
_SCHEMAS: dict[str, T.StructType] = {}    # path -> schema: saves inference jobs
_STAGE_LOCK = threading.Lock()


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """Read a stored table; the schema is inferred once per process."""
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def stage_testdata(spark: SparkSession, sf_dir: str, force: bool = False,
                   tables: Sequence[str] | None = None) -> str:
    """Derive and store the domain tables (``tables``: these of them) once;
    returns their folder."""
    key = _stage_key(spark, sf_dir)
    root = work_path(spark, "domain", key)
    _stage(spark, sf_dir, key, root, derive_tables(spark, sf_dir) if tables is None else tables, force)
    return root


def _stage(spark, sf_dir, key, root, names, force=False) -> None:
    app = spark.conf.get("spark.app.id", "")

    def missing() -> list[str]:
        return [n for n in names if force or (app, f"{root}/{n}") not in _STAGED]

    def stored(name: str) -> bool:
        try:
            spark.read.parquet(f"{root}/_complete/{name}")
            return True
        except AnalysisException:
            return False

    if not missing():
        return
    with _STAGE_LOCK:
        wanted = [n for n in missing() if force or not stored(n)]
        tables = derive_tables(spark, sf_dir) if wanted else {}

        def store(name):
            tables[name].write.mode("overwrite").parquet(f"{root}/{name}")
            _SCHEMAS[f"{root}/{name}"] = tables[name].schema
            spark.createDataFrame([(key,)], "key string").write.mode("overwrite").parquet(
                f"{root}/_complete/{name}")

        with ThreadPoolExecutor(max_workers=4) as pool:      # independent jobs
            list(pool.map(store, wanted))
        _STAGED.update((app, f"{root}/{n}") for n in names)


def from_testdata(spark: SparkSession, sf_dir: str, drift_calendar: bool = False,
                  staged: bool = True, tables: Sequence[str] | None = None) -> Plant:
    """Domain tables over the driver's parquet files (see ``adapters``).

    ``tables``: what is stored now, all by default; any other table is stored
    when a plan opens it.

    ``staged=False`` keeps every table a lazy derivation of the raw files.
    Tables are opened on first use.
    """
    cal = "calendar_drift" if drift_calendar else "calendar"
    names = {t: (cal if t == "calendar" else t) for t in TABLES}
    if staged:
        root = stage_testdata(spark, sf_dir, tables=None if tables is None else [names[t] for t in tables])

        def stored(name: str) -> DataFrame:
            _stage(spark, sf_dir, root.rsplit("/", 1)[1], root, [name])
            return read_stored(spark, f"{root}/{name}")

        return Plant({t: (lambda n=n: stored(n)) for t, n in names.items()})
    derived = derive_tables(spark, sf_dir)
    return Plant({t: derived[n] for t, n in names.items()})
