"""STR-1..STR-6 as Structured Streaming jobs.

Landed files are read with the file source and ``trigger(availableNow=True)``:
one run processes everything that arrived since the last run and stops, which
is what the hourly schedule did, with the checkpoint as the resume point.
Writers run in ``foreachBatch`` and replace the partitions (or the folder) of
their micro-batch, so a replayed one rewrites the same rows (exactly once).
"""
from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import functions as fn
from ..operators.projections import tx_project_hourly
from ..sinks.tables import try_read

HOUR_KEYS = ["year", "month", "day", "hour"]
WAREHOUSE_KEYS = ["key_year", "key_month", "key_day", "key_hour"]
# State in RocksDB; a batch commits its changes instead of whole snapshots.
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _run(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def file_stream(spark: SparkSession, landing: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(landing)


def _row_id(key: str, columns: list[str]) -> Column:
    """What tells rows without a key apart: all their columns (null: the key does)."""
    return F.when(F.col(key).isNull(), F.struct(*columns))


def land_rows(df: DataFrame, landing: str, ts: str = "ts") -> None:
    """Landing layout of STR-1: rows are appended below the KST hour they belong
    to, so a late row lands in its own hour whenever it arrives."""
    (df.select("*", *fn.kst_hour_keys(ts)).hint("rebalance", *HOUR_KEYS)
     .write.mode("append").partitionBy(*HOUR_KEYS).parquet(landing))


def _with_hours(schema: StructType) -> StructType:
    return StructType([f for f in schema.fields if f.name not in HOUR_KEYS] + [StructField(k, StringType()) for k in HOUR_KEYS])


def landed_hours(spark: SparkSession, landing: str, schema: StructType, hours: list) -> DataFrame:
    """All landed rows of these hours (rows with the four keys): only their folders
    are listed and opened."""
    folder = lambda h: "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if h[k] is None else h[k]}" for k in HOUR_KEYS)
    return (spark.read.schema(_with_hours(schema)).option("pathGlobFilter", "*.parquet").option("basePath", landing)
            .parquet(*[f"{landing.rstrip('/')}/{folder(h)}" for h in hours]))


def stream_hourly_load(spark: SparkSession, landing: str, schema: StructType, target: str,
                       checkpoint: str, max_files: int | None = None) -> None:
    """STR-1: every run loads the hours that received files; each touched hour is
    rebuilt from all of its landed rows and replaces its partition. The landing is
    partitioned by hour (``land_rows``): the keys of the new files name the hours
    (no content is read for that), and only those hours' folders are read, however
    long the landing has grown. A file landed twice counts once."""

    def load(batch: DataFrame, epoch: int) -> None:
        hours = batch.select(*HOUR_KEYS).distinct().collect()  # partition keys of the batch's files
        if not hours:
            return
        full = (landed_hours(spark, landing, schema, hours).withColumn("_row", _row_id("transactionHash", schema.names))
                .dropDuplicates(["transactionHash", "_row"]))
        (tx_project_hourly(full).hint("rebalance", *WAREHOUSE_KEYS)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*WAREHOUSE_KEYS).parquet(target))

    _run(file_stream(spark, landing, _with_hours(schema), max_files).writeStream.foreachBatch(load), checkpoint)


def _batch_label(checkpoint: str, epoch: int) -> str:
    """Names the output of one micro-batch: a retry of the batch replaces it."""
    return f"{hashlib.sha1(checkpoint.encode()).hexdigest()[:10]}-{epoch}"


def stream_hour_counts(spark: SparkSession, landing: str, schema: StructType, target: str,
                       checkpoint: str, max_files: int | None = None) -> None:
    """STR-2: tumbling one-hour counts. Each micro-batch stores its own counts per
    hour under its batch label (replaced on retry); ``read_hour_counts`` adds them
    up. There is no watermark, so a row that arrives late, in any batch, counts."""

    def write(batch: DataFrame, epoch: int) -> None:
        counts = batch.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n_rows"))
        (counts.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n_rows")
         .withColumn("batch", F.lit(_batch_label(checkpoint, epoch)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target))

    _run(file_stream(spark, landing, schema, max_files).writeStream.foreachBatch(write), checkpoint)


def read_hour_counts(spark: SparkSession, target: str) -> DataFrame:
    """window_start, n_rows over all micro-batches."""
    return spark.read.parquet(target).groupBy("window_start").agg(F.sum("n_rows").alias("n_rows"))


def late_rows_split(df: DataFrame, slot: str = "slot_start", ts: str = "ts") -> DataFrame:
    """STR-3: rows outside their slot [slot, slot + 1h) are flagged (and not
    loaded into that slot); stateless, so it works on batch and stream."""
    s, t = F.col(slot), F.col(ts)
    return df.withColumn("in_slot", (t >= s) & (t < F.timestamp_add("HOUR", F.lit(1), s)))


def _run_clock(spark: SparkSession, target: str, run_time: datetime | None) -> datetime:
    """Logical time of this run, never before an earlier run's (one log row a run)."""
    log = try_read(spark, f"{target}/_runs")
    last = log.agg(F.max("run_time")).first()[0] if log is not None else None
    now = run_time or datetime.now(timezone.utc).replace(tzinfo=None)
    now = now if last is None else max(now, last)
    (spark.createDataFrame([(now,)], "run_time timestamp_ntz").coalesce(1).write.mode("append").parquet(f"{target}/_runs"))
    return now


def stream_dedupe(spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str,
                  key: str = "transactionHash", max_files: int | None = None, run_time: datetime | None = None,
                  retention: str = "30 days", ts: str = "ts") -> None:
    """STR-4: a replayed file must not duplicate rows, and no row is lost.

    Keys live in Spark's state store (RocksDB, checkpointed with the stream), so no
    batch reads the target. A run has a logical time: now, or ``run_time`` when a
    schedule or a backfill names it; it never goes back. The state remembers a key
    for at least ``retention`` after the run that saw it first. A row whose own time
    lies more than ``retention`` before the run could be a repeat of a forgotten
    key; it goes to the output ``late=1`` instead of ``late=0``. So ``late=0`` holds
    each key once (copies of a row carry the same time), nothing is dropped, and
    ``read_deduped`` gives either output or both put together. Rows without a key are
    repeats only when all their columns are equal; rows without a time are never late.

    A batch owns one folder of the target; a retry replaces it as a whole, and the
    state store returns to the batch's start, so the retry writes the same rows."""
    clock = F.lit(_run_clock(spark, target, run_time))
    oldest = clock - F.expr(f"INTERVAL {retention}")
    rows = (file_stream(spark, landing, schema, max_files)
            .select("*", *fn.kst_hour_keys(ts), F.coalesce(F.col(ts) < oldest, F.lit(False)).cast("int").alias("late"),
                    _row_id(key, schema.names).alias("_row"), clock.cast("timestamp").alias("_seen"))
            .withWatermark("_seen", retention).dropDuplicatesWithinWatermark([key, "_row"]).drop("_row", "_seen"))

    def load(batch: DataFrame, epoch: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("late")
         .parquet(f"{target}/batch={_batch_label(checkpoint, epoch)}"))

    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    try:
        for k, v in _STATE_CONF.items():
            spark.conf.set(k, v)
        _run(rows.writeStream.foreachBatch(load), checkpoint)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def read_deduped(spark: SparkSession, target: str, schema: StructType, late: bool | None = False,
                 key: str = "transactionHash") -> DataFrame:
    """Rows of ``stream_dedupe``: on time (False), late (True), or both (None): late
    rows are then added unless the rows on time hold their key."""
    fields = [*_with_hours(schema).fields, StructField("batch", StringType()), StructField("late", StringType())]
    df = spark.read.schema(StructType(fields)).parquet(target)
    if late is not None:
        return df.where(F.col("late") == str(int(late)))
    on_time, rest = df.where("late = '0'"), df.where("late = '1'")
    row = _row_id(key, schema.names).alias("_row")
    once = rest.withColumn("_row", row).dropDuplicates([key, "_row"]).drop("_row")
    keyed = once.where(F.col(key).isNotNull()).join(on_time.select(key), key, "left_anti")
    bare = once.where(F.col(key).isNull()).withColumn("_row", row).join(on_time.where(F.col(key).isNull()).select(row), "_row", "left_anti")
    return on_time.unionByName(keyed).unionByName(bare.drop("_row"))


def stream_append(spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str) -> None:
    """STR-5: incremental append; a rerun with the same checkpoint resumes
    after the last committed file (each file is read once)."""
    s = file_stream(spark, landing, schema).select("*", *fn.kst_hour_keys("ts"))
    _run(s.writeStream.format("parquet").option("path", target), checkpoint)


def first_success(attempts: DataFrame, block: str = "block") -> DataFrame:
    """STR-6: per block the first successful attempt across rounds; blocks
    with none are the ones to report as failed (SNK-15)."""
    return attempts.groupBy(block).agg(
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("first_ok_attempt"))
