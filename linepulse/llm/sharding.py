"""A global shuffle into shards by a two-pass external shuffle.

Pass one scatters the records uniformly into memory-sized buckets by a seeded
hash; pass two shuffles each bucket by Fisher-Yates and writes it.  A record's
place in the whole order is its bucket's first place plus its place in the
bucket, and shards are equal runs of places: the numbers of records of two
shards differ by one at most (law ``rows``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.llm.common import table, without
from linepulse.session import work_path

BUCKET_BYTES = 32 << 20
ROW_BYTES = 16               # counted for a record besides its text


def record_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + ROW_BYTES


def write_shards(records: DataFrame, path: str, shards: int = 40, seed: int = 0,
                 text: str = "text", key: Sequence[str] | None = None,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all ``records`` to ``path``, partitioned by shard, with their slot
    (gapless from 0 in each shard), and return the written table.

    The order depends on the seed, the buckets and the values of ``key`` (all
    columns by default) alone, not on how Spark deals out the rows, so a lost
    task is repeated alike.  Records equal in ``key`` share a bucket: name
    columns that tell rows apart where many records are equal.  Nulls are
    values like others; an empty table gives empty shards; columns shard and
    slot of the input are replaced.  The driver holds a count for each bucket,
    one for every ``bucket_bytes`` of the input, and each shard has at least
    one bucket.
    """
    spark = records.sparkSession
    names = [c for c in records.columns if c.lower() not in ("shard", "slot")]
    key = list(key or names)
    columns = [F.col(f"`{c}`") for c in key]
    total = records.agg(F.sum(record_bytes(text))).first()[0] or 0
    buckets = max(shards, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(buckets)).cast("long")
    counts = np.zeros(buckets + 1, dtype=np.int64)
    for r in records.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["b"] + 1] = r["n"]
    first = np.cumsum(counts)
    rows = int(first[-1])
    shared = spark.sparkContext.broadcast(first)
    # Two more hashes give a bucket's records an order before the shuffle.
    scattered = without(records, ["shard", "slot"]).toDF(*[f"c{k}" for k in range(len(names))])
    plain = [F.col(f"c{names.index(c)}") for c in key]
    scattered = (scattered.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), *plain),
                                                       F.lit(buckets)).cast("long"))
                 .withColumn("tie", F.xxhash64(F.lit(seed), F.lit("order"), *plain)))

    def shuffle(bucket_key: tuple, group: pa.Table) -> pa.Table:
        b = bucket_key[0].as_py()
        start = np.argsort(group.column("tie").to_numpy(), kind="stable")
        order = start[np.random.default_rng([seed, b]).permutation(len(start))]  # Fisher-Yates
        place = int(shared.value[b]) + np.arange(len(order), dtype=np.int64)
        shard = place * shards // rows
        out = group.drop_columns(["bucket", "tie"]).take(pa.array(order))
        out = out.append_column("slot", pa.array(place - -(-shard * rows // shards)))
        return out.append_column("shard", pa.array(shard.astype(np.int32)))

    kept = without(scattered, ["bucket", "tie"]).schema
    schema = kept.add("slot", "long").add("shard", "integer")
    # As many tasks as buckets, whatever the session's number of partitions.
    shuffled = scattered.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(shuffle, schema).toDF(
        *names, "slot", "shard")
    shuffled.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return spark.read.schema(shuffled.schema).parquet(path)


def with_row_place(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table with the file and row that each record was read from, which
    tell equal records apart."""
    return table(spark, sf_dir, name).select("*", F.col("_metadata.file_name").alias("_file"),
                                             F.col("_metadata.row_index").alias("_row"))


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, read back from the written shards."""
    docs = with_row_place(spark, sf_dir, "documents").select("doc_id", "text", "_file", "_row")
    path = work_path(spark, "llm", "shards", unique=True)
    written = write_shards(docs, path, shards=40, key=["doc_id", "_file", "_row"])
    return written.select(
        "doc_id", record_bytes("text").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
