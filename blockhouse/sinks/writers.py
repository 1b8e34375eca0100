"""SNK-1..SNK-6, SNK-16: file writers. Output layouts are planned by Spark:
``rebalance`` lets AQE split a hot partition key over several tasks and merge
small ones, so one heavy hour or chunk neither stalls one task nor leaves
thousands of tiny files."""
from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import functions as fn
from ..operators.aggregates import last_per_key
from ..operators.projections import conform
from .tables import drop_partitions, partitions, save_managed

HOUR_KEYS = ["year", "month", "day", "hour"]
DAY_KEYS = ["year", "month", "day"]


def write_conformed(df: DataFrame, path: str, schema: StructType, mode: str = "overwrite") -> None:
    """SNK-1: conform (PRJ-2) then Snappy Parquet."""
    conform(df, schema).write.mode(mode).option("compression", "snappy").parquet(path)


def write_hour_partitions(df: DataFrame, path: str, ts: str = "ts", mode: str = "overwrite",
                          dynamic: bool = True) -> None:
    """SNK-2: KST hour layout year=/month=/day=/hour= (padded text keys).
    Dynamic overwrite: only the hours present in ``df`` are replaced."""
    out = df if all(k in df.columns for k in HOUR_KEYS) else df.select("*", *fn.kst_hour_keys(ts))
    w = out.hint("rebalance", *HOUR_KEYS).write.mode(mode).option("compression", "snappy")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(*HOUR_KEYS).parquet(path)


def write_day_partitions(df: DataFrame, path: str) -> None:
    """SNK-3: day layout with unpadded keys; the whole output is replaced
    (static overwrite)."""
    (df.hint("rebalance", *DAY_KEYS).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*DAY_KEYS).parquet(path))


def with_chunk(df: DataFrame, size: int, block: str = "blockNumber", name: str = "chunk") -> DataFrame:
    """Grid chunk label '%08d_%08d' of the block (chunk k = [k*C, k*C+C-1])."""
    start = F.expr(f"({block} div {size}) * {size}")
    return df.withColumn(name, fn.chunk_label(start, start + size - 1))


def write_block_chunks(df: DataFrame, path: str, size: int, block: str = "blockNumber") -> None:
    """SNK-4: one folder per block-range chunk, rows in block order inside
    each file (AQE may split a very large chunk into several sorted files). Only
    the chunks present in ``df`` are replaced; earlier chunks stay."""
    c = with_chunk(df, size, block)
    (c.hint("rebalance", "chunk").sortWithinPartitions("chunk", block, "transactionIndex")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk").parquet(path))


def manifest(expected: DataFrame, counts: DataFrame, keys: list[str], n: str = "n_rows") -> DataFrame:
    """SNK-5: per expected key the row count and an ``is_empty`` marker (a
    zero-row key is recorded, not silently absent)."""
    j = expected.join(counts.select(*keys, F.col(n).alias("_n")), keys, "left")
    cnt = F.coalesce("_n", F.lit(0)).cast("bigint")
    return j.select(*keys, cnt.alias(n), (cnt == 0).alias("is_empty"))


def write_manifest(spark: SparkSession, m: DataFrame, path: str, keys: list[str]) -> None:
    """Manifest rows are appended with the time of the write; the latest row of a key
    counts (data arriving for a key recorded empty replaces that key's row only).
    Nothing is rewritten, and a failed write adds nothing."""
    m.select(*keys, "n_rows", "is_empty", F.lit(time.time_ns()).alias("written")).coalesce(1).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """keys, n_rows, is_empty: the latest row of each key."""
    return last_per_key(spark.read.parquet(path), keys, "written").select(*keys, "n_rows", "is_empty")


def write_holders_csv(df: DataFrame, path: str, inserted_at: str) -> None:
    """SNK-6: header, no index, plus ``inserted_at`` = run date."""
    (df.withColumn("inserted_at", F.lit(inserted_at).cast("timestamp_ntz"))
     .write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def stage_blocks(df: DataFrame, staging: str, size: int, block: str = "blockNumber") -> None:
    """Per-block rows appended to a managed staging table, partitioned by chunk number."""
    save_managed(df.withColumn("chunk_id", F.expr(f"cast({block} div {size} as string)")), staging, ["chunk_id"])


def compact_chunks(spark: SparkSession, staging: str, complete: DataFrame, path: str, size: int,
                   block: str = "blockNumber") -> int:
    """SNK-16: staged rows of complete chunks only -> gzip JSON-lines, one folder per
    chunk, named end_start (``complete``: chunk_id of complete chunks); AQE may split a
    very large chunk into several files, each in (block, index) order as numbers. The
    packed inputs are dropped from the staging table afterwards: a second call finds
    none, and a crash before the drop packs the same chunks again. Other chunks of an
    earlier call stay. Returns the number of chunks packed."""
    staged = partitions(spark, staging, ["chunk_id"]).join(complete.select(F.col("chunk_id").cast("string").alias("chunk_id")), "chunk_id", "left_semi")
    ids = [r[0] for r in staged.collect()]  # partition keys: one per chunk to pack
    if not ids:
        return 0
    start = F.col("chunk_id").cast("bigint") * size
    c = spark.table(staging).where(F.col("chunk_id").isin(ids)).withColumn("chunk", fn.chunk_label(start + size - 1, start)).drop("chunk_id")
    order = [F.col(k).cast("bigint") for k in (block, "transactionIndex")]
    (c.hint("rebalance", "chunk").sortWithinPartitions("chunk", *order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("chunk").json(path))
    return drop_partitions(spark, staging, spark.createDataFrame([(i,) for i in ids], "chunk_id string"), ["chunk_id"])
