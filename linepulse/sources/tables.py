"""Named table scans and literal-row loads."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; with ``schema`` the columns are checked and cast.

    Non-nullable schema columns must exist; a missing nullable column reads
    as NULL (exports made with the older table definitions lack e.g.
    ``qty_good`` and ``throughput``).  Only the named columns are selected,
    so column pruning reaches the scan.
    """
    df = spark.read.parquet(path)
    if schema is None:
        return df.select(*columns) if columns else df
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    required = [f.name for f in schema.fields if f.name in missing and not f.nullable]
    if required:
        raise ValueError(f"{path}: missing columns {required}")
    return df.select(*[
        (F.lit(None) if f.name in missing else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def _csv_text(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    """The file's text by column of ``schema``; NULL where it has no such column."""
    if not header:
        text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
        return spark.read.schema(text).csv(path)
    first = spark.read.option("header", True).option("inferSchema", False).csv(path)
    # Columns are named by the first file; one whose header differs is an error, not read by position.
    raw = spark.read.schema(first.schema).option("header", True).option("enforceSchema", False).csv(path)
    at = {c.strip().lower(): c for c in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in at and not f.nullable]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return raw.select(*[(F.col(f"`{at[f.name.lower()]}`") if f.name.lower() in at
                         else F.lit(None).cast("string")).alias(f.name) for f in schema.fields])


def _parsed(c: Column, kind: T.DataType) -> Column:
    from linepulse.functions.textdates import parse_text_date, parse_text_time

    if isinstance(kind, T.DateType):
        return parse_text_date(c)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return parse_text_time(c).cast(kind)
    return c if isinstance(kind, T.StringType) else F.trim(c).try_cast(kind)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType,
                   header: bool = True) -> DataFrame:
    """CSV export as the columns of ``schema`` (no inference).

    With a header, columns are found by their names, in any order and case;
    further ones are ignored, a missing nullable one reads as NULL and a
    missing other one is an error, and so is a folder whose files differ in
    their headers.  Without, they are taken by position and short rows end in
    NULLs.  Times may be in either load layout
    (``MM/dd/yyyy HH:mm:ss`` or ISO, with or without fractions; dates also
    without the time).  Text that is no value of its column's type gives
    NULL; ``csv_rejects`` counts it.
    """
    raw = _csv_text(spark, path, schema, header)
    return raw.select(*[_parsed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def csv_rejects(spark: SparkSession, path: str, schema: T.StructType,
                header: bool = True) -> DataFrame:
    """(column_name, total_rows, rejected_rows): per column of ``schema`` the
    rows whose text is there but is no value of the type."""
    raw = _csv_text(spark, path, schema, header)
    bad = [F.count_if(F.col(f.name).isNotNull() & _parsed(F.col(f.name), f.dataType).isNull())
           for f in schema.fields]
    counted = raw.agg(F.count(F.lit(1)).alias("total_rows"), F.array(*bad).alias("_bad"))
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    return (counted.select("total_rows", F.explode(F.arrays_zip(names.alias("name"), F.col("_bad")))
                           .alias("r"))
            .select(F.col("r.name").alias("column_name"), "total_rows",
                    F.col("r._bad").alias("rejected_rows")))


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Rows given positionally; missing trailing columns become NULL."""
    width = len(schema.fields)
    padded = []
    for r in rows:
        r = tuple(r)
        if len(r) > width:
            raise ValueError(f"row has {len(r)} values, schema {width}")
        padded.append(r + (None,) * (width - len(r)))
    return spark.createDataFrame(padded, schema=schema)


def text_time_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType,
                   time_columns: Sequence[str]) -> DataFrame:
    """Literal rows whose time columns are text in either load layout."""
    from linepulse.functions import parse_text_time

    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in time_columns else f.dataType, True)
        for f in schema.fields])
    df = literal_rows(spark, rows, text_schema)
    return df.select(*[
        (parse_text_time(F.col(f.name)).cast(f.dataType) if f.name in time_columns
         else F.col(f.name)).alias(f.name)
        for f in schema.fields])
