"""Table maintenance without in-place updates.

Every write goes to a folder of its own; a manifest beside the data, in the
folder ``_versions``, names the folders that make up a version.  Rows of the
manifest are only added, after the data they name is complete: a crash leaves a
folder that nothing names, and a replayed write of a version takes its place.
Readers take the manifest's highest version.  A version without rows is a
version like any other: emptying a table leaves an empty table.  A path being
read is never overwritten.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

_MANIFEST = "version long, seq long, schema string, folders array<string>, mark long"


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = tuple(partition_by)

    @property
    def _manifest(self) -> str:
        return f"{self.path}/_versions"

    def _rows(self) -> dict[int, Row]:
        """The last manifest row of each version."""
        if not path_exists(self.spark, self._manifest):
            return {}
        rows = self.spark.read.schema(_MANIFEST).json(f"{self._manifest}/*").collect()
        return {r["version"]: r for r in sorted(rows, key=lambda r: r["seq"])}

    def versions(self) -> dict[int, T.StructType]:
        """Schemas by version; read from the manifest alone."""
        return {v: T.StructType.fromJson(json.loads(r["schema"])) for v, r in self._rows().items()}

    def latest_version(self) -> int | None:
        return max(self._rows(), default=None)

    def latest_before(self, version: int) -> int | None:
        """Highest stored version strictly below ``version``."""
        return max((v for v in self._rows() if v < version), default=None)

    def mark(self, version: int) -> int | None:
        """What the writer noted of this version."""
        return self._rows()[version]["mark"]

    def read(self, version: int | None = None) -> DataFrame:
        found = self._rows()
        if not found:
            raise FileNotFoundError(self.path)
        v = max(found) if version is None else version
        if v not in found:
            raise ValueError(f"{self.path}: no version {v}")
        schema = T.StructType.fromJson(json.loads(found[v]["schema"]))
        parts = [self.spark.read.schema(self._stored(schema)).parquet(f"{self.path}/{folder}")
                 for folder in found[v]["folders"]]
        return reduce(DataFrame.unionByName, parts)

    def write(self, df: DataFrame, version: int | None = None, mark: int | None = None) -> int:
        """Write ``df`` as ``version`` (default: latest + 1) and return it.  A
        version that is there is replaced: a replayed write leaves it once."""
        found = self._rows()
        if version is None:
            version = max(found, default=-1) + 1
        old = found.get(version)
        self._add(df, version, [], (old["seq"] + 1) if old else 0, mark)
        for folder in old["folders"] if old else []:
            delete_path(self.spark, f"{self.path}/{folder}")
        return version

    def append(self, df: DataFrame) -> None:
        """Add rows to the latest version (no dedupe: twice = doubled)."""
        found = self._rows()
        v = max(found, default=0)
        old = found.get(v)
        self._add(df, v, list(old["folders"]) if old else [], (old["seq"] + 1) if old else 0,
                  old["mark"] if old else None)

    def _add(self, df: DataFrame, version: int, folders: list[str], seq: int, mark: int | None) -> None:
        folder = f"data/{uuid.uuid4().hex[:16]}"
        df.write.partitionBy(*self.partition_by).parquet(f"{self.path}/{folder}")
        row = self.spark.createDataFrame(
            [(version, seq, json.dumps(df.schema.jsonValue()), [*folders, folder], mark)], _MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self._manifest}/{version}")

    def expire(self, keep: int = 1) -> list[int]:
        """Delete all but the ``keep`` highest versions; returns those gone."""
        found = self._rows()
        gone = sorted(found)[:-keep] if keep else sorted(found)
        for v in gone:
            delete_path(self.spark, f"{self._manifest}/{v}")
            for folder in found[v]["folders"]:
                delete_path(self.spark, f"{self.path}/{folder}")
        return gone

    def _stored(self, schema: T.StructType) -> T.StructType:
        """Data columns first, then partition columns, as a scan returns them."""
        fields = [f for f in schema.fields if f.name not in self.partition_by]
        return T.StructType([*fields, *[schema[p] for p in self.partition_by]])


def snapshot(table: VersionedTable, view: DataFrame) -> DataFrame:
    """Truncate-and-refill as a new version; returns the stored rows."""
    v = table.write(view)
    return table.read(v)


def keyed_replace(old: DataFrame, new_rows: DataFrame, key: str | list[str]) -> DataFrame:
    """Drop every old row whose key occurs in ``new_rows``, append
    ``new_rows``.  Keys absent from the input keep all their old rows."""
    keys = [key] if isinstance(key, str) else list(key)
    present = new_rows.select(*keys).distinct()
    return old.join(present, keys, "left_anti").unionByName(new_rows.select(*old.columns))
