"""SNK-7..SNK-15, SNK-17, SNK-18: idempotent load modes on Parquet tables.

Parquet has no DELETE/MERGE, and a path cannot be read and overwritten by one
job. Three mechanisms cover every load mode:

* partition-aligned changes (replace partition, skip existing, purge) touch
  only the partitions involved: dynamic partition overwrite, catalog partitions
  added with their folders or dropped with their data;
* replaced hours and snapshots are written aside and then named by one commit
  (``hourmap.HourTable``, ``load_truncate``);
* row-level replacement (range replace, keyed upsert on an unpartitioned table) writes a new version directory and then appends one row
  to the table's commit log; readers resolve the highest committed version.
  A failed job leaves no commit row, so readers never see a half-written
  version (all-or-nothing, like the warehouse transaction).
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from ..session import scratch_path

HOUR_KEYS = ["year", "month", "day", "hour"]
PARTITIONS_PER_STATEMENT = 500


def try_read(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet"):
    """The table at ``path``, or None when nothing was written there yet."""
    try:
        r = spark.read.format(fmt)
        if schema is not None:
            r = r.schema(schema)
        df = r.load(path)
        df.schema  # noqa: B018  (forces resolution)
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


class VersionedTable:
    """A Parquet table as numbered version folders plus an append-only commit
    log (``_commits``). Only the one-row max(version) reaches the driver."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def current_version(self) -> int | None:
        log = try_read(self.spark, f"{self.base}/_commits")
        if log is None:
            return None
        return log.agg(F.max("version")).first()[0]

    def read(self, schema: StructType | None = None) -> DataFrame | None:
        log = try_read(self.spark, f"{self.base}/_commits")
        last = log.agg(F.max_by("folder", "version")).first()[0] if log is not None else None
        return None if last is None else try_read(self.spark, f"{self.base}/{last}", schema)

    def commit(self, df: DataFrame) -> int:
        """Each attempt writes a folder of its own, which only its commit row
        names; what a crashed attempt left is never read or written again.
        Older versions stay until the table folder is cleaned."""
        v = (self.current_version() or 0) + 1
        folder = f"v={v}-{uuid.uuid4().hex[:12]}"
        df.write.mode("errorifexists").parquet(f"{self.base}/{folder}")
        (self.spark.createDataFrame([(v, folder)], "version bigint, folder string")
         .write.mode("append").parquet(f"{self.base}/_commits"))
        return v


# ----------------------------------------------------------------- SNK-7/8
def load_skip_existing(spark: SparkSession, name: str, df: DataFrame, path: str, keys: list[str] = HOUR_KEYS) -> int:
    """SNK-7: partitions that the catalog already lists are left untouched; only new
    ones are loaded (no row of the target is read to know which). Each load writes a
    folder of its own below ``path`` and then adds its partitions, so what a crashed
    load left is never read and the rerun loads it again. Returns the number added."""
    new = df.join(partitions(spark, name, keys), keys, "left_anti")
    folder = f"{path.rstrip('/')}/load-{uuid.uuid4().hex[:12]}"
    new.hint("rebalance", *keys).write.mode("errorifexists").partitionBy(*keys).parquet(folder)
    return add_partitions(spark, name, written_partitions(spark, folder, df.schema, keys), keys)


def written_partitions(spark: SparkSession, folder: str, schema: StructType, keys: list[str]) -> DataFrame:
    """keys, folder of every partition below ``folder`` (from its file listing)."""
    place = F.concat(F.lit(folder), *[F.concat(F.lit(f"/{k}="), F.coalesce(F.col(k), F.lit("__HIVE_DEFAULT_PARTITION__"))) for k in keys])
    return (spark.read.schema(_with_text_keys(schema, keys)).parquet(folder).select(*keys).distinct().withColumn("folder", place))


def _with_text_keys(schema: StructType, keys: list[str]) -> StructType:
    return StructType([f for f in schema.fields if f.name not in keys] + [StructField(k, StringType()) for k in keys])


def load_replace_partition(df: DataFrame, path: str, keys: list[str]) -> None:
    """SNK-8: every partition present in ``df`` is replaced, all others kept
    (dynamic partition overwrite; only the touched folders change)."""
    (df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


# ----------------------------------------------------------------- SNK-9/10
def load_replace_range(table: VersionedTable, incoming: DataFrame, ts: str, start, end) -> int:
    """SNK-9: delete [start, end) then insert the incoming rows of exactly that
    range (D10), as one new committed version."""
    in_range = (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end))
    new = incoming.where(in_range)
    cur = table.read()
    out = new if cur is None else cur.where(~in_range | F.col(ts).isNull()).unionByName(new)
    return table.commit(out)


def load_upsert_key(table: VersionedTable, incoming: DataFrame, keys: list[str]) -> int:
    """SNK-10: rows whose key is in ``incoming`` are replaced, others kept."""
    cur = table.read()
    out = incoming if cur is None else cur.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming)
    return table.commit(out)


# --------------------------------------------------------------- SNK-11/18
def create_table_if_absent(spark: SparkSession, name: str, ddl: str, path: str) -> None:
    """SNK-18: ``CREATE TABLE IF NOT EXISTS ... USING parquet``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{path}'")


def load_truncate(spark: SparkSession, name: str, snapshot: DataFrame) -> None:
    """SNK-11 + FLT-9: the table is replaced by the snapshot. The snapshot is written
    into a folder of its own, and the table is then pointed at it, in one catalog
    change: whichever step fails, and when the snapshot holds no row, the table still
    shows the old snapshot. Older folders stay until the shared folder is cleaned."""
    folder = scratch_path(spark, f"snapshot-{name}")
    want = spark.table(name).schema
    snapshot.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in want.fields]).write.parquet(folder)
    if spark.read.schema(want).parquet(folder).isEmpty():
        raise ValueError(f"snapshot for {name} is empty; table left unchanged")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


# ----------------------------------------------------------------- SNK-12
def absent_rows(src: DataFrame, target: DataFrame, key: str, days: list[str]) -> DataFrame:
    """JOIN-2: source rows whose key the target does not hold on the source's days.
    The days come from the source itself (its whole range, D8) and prune the target's
    day partitions at run time, before the anti join reads their keys."""
    held = target.join(src.select(*days).distinct(), days, "left_semi").select(key)
    return src.join(held, key, "left_anti")


def load_insert_absent(spark: SparkSession, src: DataFrame, path: str, key: str, days: list[str] | None = None) -> None:
    """SNK-12 (+ JOIN-2, D8): append only source rows whose key is not in the target.
    With ``days`` the target is partitioned by these text keys, and only the source's
    days are read of it; without, the whole key column is."""
    if days is None:
        tgt = try_read(spark, path)
        new = src if tgt is None else src.join(tgt.select(key), key, "left_anti")
        new.write.mode("append").parquet(path)
        return
    tgt = try_read(spark, path, _with_text_keys(src.schema, days))
    new = src if tgt is None else absent_rows(src, tgt, key, days)
    new.hint("rebalance", *days).write.mode("append").partitionBy(*days).parquet(path)


# ----------------------------------------------------------------- SNK-13/17
def register_table(spark: SparkSession, name: str, ddl: str, path: str, keys: list[str], hours: DataFrame | None = None) -> None:
    """SNK-17: external partitioned table (keys stay text, '01' is kept); the given
    partitions (keys) are added with their locations below ``path``. Storage is not
    listed; registering again adds nothing."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
              f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'")
    if hours is not None:
        place = F.concat(F.lit(path.rstrip("/")), *[F.concat(F.lit(f"/{k}="), F.col(k)) for k in keys])
        add_partitions(spark, name, hours.select(*keys).distinct().withColumn("folder", place), keys)


def add_partitions(spark: SparkSession, name: str, hours: DataFrame, keys: list[str]) -> int:
    """Partitions (key columns and ``folder``) added to a catalog table where absent;
    only the given ones are touched, storage is not listed. Returns their number."""
    rows = hours.select(*keys, "folder").collect()  # partition keys
    for i in range(0, len(rows), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION ({_spec(r, keys)}) LOCATION '{r['folder']}'" for r in rows[i:i + PARTITIONS_PER_STATEMENT]))
    return len(rows)


def partitions(spark: SparkSession, name: str, keys: list[str]) -> DataFrame:
    """Catalog partitions of a table as key columns."""
    p = spark.sql(f"SHOW PARTITIONS {name}")
    parts = F.split(F.col("partition"), "/")
    return p.select(*[F.regexp_extract(parts[i], r"^[^=]+=(.*)$", 1).alias(k) for i, k in enumerate(keys)])


def save_managed(df: DataFrame, name: str, keys: list[str]) -> None:
    """Rows appended to a managed table partitioned by ``keys`` (created when absent);
    dropping a partition of it removes its files."""
    df.hint("rebalance", *keys).write.mode("append").format("parquet").partitionBy(*keys).saveAsTable(name)


def drop_partitions(spark: SparkSession, name: str, doomed: DataFrame, keys: list[str]) -> int:
    """Partitions (key columns) dropped, several hundred a statement; absent ones are ignored."""
    specs = [_spec(r, keys) for r in doomed.select(*keys).collect()]  # partition keys
    for i in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs[i:i + PARTITIONS_PER_STATEMENT]))
    return len(specs)


def purge_hour_range(spark: SparkSession, tables: dict[str, list[str]], start, end) -> int:
    """SNK-13: every hour in [start, end] (KST hour starts, both inclusive) is removed
    from all tables, given with their hour keys (lake: year...; warehouse: key_year...).
    The tables are managed (``save_managed``), so files, catalog partitions and rows
    go together, and nothing is left to register again; absent hours are ignored.
    Returns the number of partitions dropped."""
    n = 0
    for name, keys in tables.items():
        hour = F.make_timestamp_ntz(*[F.col(k).cast("int") for k in keys], F.lit(0), F.lit(0))
        doomed = partitions(spark, name, keys).where((hour >= F.lit(start).cast("timestamp_ntz")) & (hour <= F.lit(end).cast("timestamp_ntz")))
        n += drop_partitions(spark, name, doomed, keys)
    return n


# ----------------------------------------------------------------- SNK-14/15
def append_state(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """SNK-14: the ingest state is an append-only table; nothing is rewritten."""
    rows.write.mode("append").parquet(path)


def read_state(spark: SparkSession, path: str, initial: int) -> DataFrame:
    """The next block to fetch: the latest committed value, or ``initial``
    when the state is empty or unreadable."""
    try:
        st = try_read(spark, path)
        if st is not None:
            st.select("seq", "next_fetch_block").schema  # noqa: B018
    except AnalysisException:  # no such columns or no Parquet: resets; a storage fault is raised
        st = None
    if st is None:
        return spark.range(1).select(F.lit(initial).cast("bigint").alias("next_fetch_block"))
    last = st.agg(F.max_by("next_fetch_block", "seq").alias("v"))
    return last.select(F.coalesce("v", F.lit(initial)).cast("bigint").alias("next_fetch_block"))


def append_failed_blocks(path: str, failed: DataFrame, strict: bool = False) -> None:
    """SNK-15: blocks still missing after the recovery rounds are appended to
    the log; in strict mode the job then fails (after the log is written)."""
    failed.write.mode("append").parquet(path)
    if strict and not failed.isEmpty():
        raise RuntimeError(f"blocks still missing after recovery; see {path}")


def _spec(row, keys: list[str]) -> str:
    return ", ".join(f"{k}='{row[k]}'" for k in keys)
