"""Helpers shared by the operators: table access, staging, Arrow maps, sums of vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.operators.joins import bounded_broadcast
from linepulse.session import work_path

# Rows handled at once inside an Arrow batch, so that a worker holds few texts.
SLICE_ROWS = 256


# Rows of keys that may be broadcast, at most; more are joined by shuffle.
BROADCAST_ROWS = 300_000


def if_small(df: DataFrame) -> DataFrame:
    """``df``, a staged table, as the broadcast side of a join if it is small."""
    return bounded_broadcast(df, BROADCAST_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts the lineage
    where every executor can reach the files."""
    path = work_path(df.sparkSession, "llm", name, unique=True)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns of these names (Spark's names ignore case)."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def numbered(df: DataFrame, column: str) -> tuple[DataFrame, str]:
    """``df`` with columns c0, c1, ..., which clash with no result's name, and
    the new name of ``column``."""
    at = [c.lower() for c in df.columns].index(column.lower())
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]), f"c{at}"


def map_slices(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
               fields: str, keep: bool = True) -> DataFrame:
    """``df`` with new columns computed from slices of Arrow batches.

    ``make`` is called once per task and returns the function from a slice to
    its new arrays, in the order of ``fields`` (a DDL string).  Input columns
    of the same names are replaced.  ``keep=False`` returns the new columns
    only, which may then have any number of rows.
    """
    spark = df.sparkSession
    new = spark.createDataFrame([], fields).schema
    base = without(df, new.names) if keep else df
    names = [*(base.columns if keep else []), *new.names]
    schema = base.schema if keep else type(new)([])
    for f in new.fields:
        schema = type(new)([*schema.fields, f])
    places = [df.columns.index(c) for c in base.columns] if keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                arrays = fn(part)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in places), *arrays],
                                                 names=names)

    return df.mapInArrow(run, schema)


def texts_of(part: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; a null text is empty."""
    at = [n.lower() for n in part.schema.names].index(column.lower())
    return [t or "" for t in part.column(at).to_pylist()]


BLOCK = 8192  # floats in a row of a vector: 64 KB


def vector_rows(name: str, part: int, vec: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
    """The rows (name, part, vec) of one task's vector, cut into blocks."""
    flat = np.ascontiguousarray(vec, dtype=np.float64).ravel()
    for k in range(0, len(flat), BLOCK):
        yield f"{name}:{k // BLOCK}", part, flat[k:k + BLOCK].tobytes()


VECTOR_FIELDS = "name string, part long, vec binary"


def vector_sum(parts: DataFrame, fan_in: int = 512) -> dict[str, np.ndarray]:
    """Sums of the tasks' vectors by name, from rows of ``vector_rows``.

    Two levels: a group of the first holds at most ``fan_in`` blocks of 64 KB,
    one of the second a ``fan_in``-th of the tasks.  Only the sums, whose size
    is fixed by the model, reach the driver.  Blocks are added in the order of
    ``part``, so a repeated run gives the same floats.
    """
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part", kind="stable")
        total = np.zeros(len(pdf["vec"].iloc[0]) // 8)
        for v in pdf["vec"]:
            total += np.frombuffer(v)
        return pd.DataFrame({"name": [pdf["name"].iloc[0]], "part": [int(pdf["part"].iloc[0])],
                             "vec": [total.tobytes()]})

    first = (parts.withColumn("salt", F.floor(F.col("part") / fan_in))
             .groupBy("name", "salt").applyInPandas(add, VECTOR_FIELDS))
    second = first.groupBy("name").applyInPandas(add, VECTOR_FIELDS)
    blocks: dict[str, dict[int, np.ndarray]] = {}
    for r in second.collect():
        name, k = r["name"].rsplit(":", 1)
        blocks.setdefault(name, {})[int(k)] = np.frombuffer(bytes(r["vec"]))
    return {n: np.concatenate([b[k] for k in sorted(b)]) for n, b in blocks.items()}
