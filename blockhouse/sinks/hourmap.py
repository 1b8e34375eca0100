"""Hour-partitioned tables with atomic commits (SNK-8, SNK-9, SNK-17).

The data of a commit lies in a folder of its own, partitioned by the hour keys.
The commit itself is one file: a row per touched hour that names the hour's new
folder, or none for an hour left empty.  Readers take the latest row of each
hour, so they see all hours of a commit or none, whatever step a writer failed
at; untouched hours keep the folders of earlier commits.  One writer at a time.

The map has one row per hour and commit; a read collects the folders of the hours
it wants (as a partition listing would) and opens nothing else.  Folders that no
row names any more stay until the table folder is cleaned.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import functions as fn
from .tables import add_partitions, try_read, written_partitions

HOUR_KEYS = ["year", "month", "day", "hour"]
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a null key


class HourTable:
    def __init__(self, spark: SparkSession, base: str, schema: StructType, keys: list[str] = HOUR_KEYS):
        self.spark, self.base, self.keys = spark, base.rstrip("/"), keys
        self.schema = StructType([f for f in schema.fields if f.name not in keys])

    def _log(self) -> DataFrame | None:
        fields = "version bigint, " + ", ".join(f"{k} string" for k in self.keys) + ", folder string"
        if try_read(self.spark, f"{self.base}/_hours") is None:
            return None
        return self.spark.read.schema(fields).parquet(f"{self.base}/_hours")

    def version(self) -> int:
        log = self._log()
        return 0 if log is None else log.agg(F.max("version")).first()[0] or 0

    def live(self) -> DataFrame:
        """The hours that hold rows: keys, folder."""
        log = self._log()
        if log is None:
            return self.spark.createDataFrame([], ", ".join(f"{k} string" for k in [*self.keys, "folder"]))
        return log.groupBy(*self.keys).agg(F.max_by("folder", "version").alias("folder")).where("folder IS NOT NULL")

    def read(self, where: Column | None = None) -> DataFrame:
        """Rows of all hours, or of those whose keys pass ``where``; keys are text."""
        live = self.live() if where is None else self.live().where(where)
        folders = [r["folder"] for r in live.select("folder").collect()]
        if not folders:
            return self.spark.createDataFrame([], StructType([*self.schema.fields, *(StructField(k, StringType()) for k in self.keys)]))
        df = self.spark.read.schema(self.schema).option("pathGlobFilter", "*.parquet").parquet(*folders)
        key = lambda k: F.nullif(F.regexp_extract("_metadata.file_path", f"/{k}=([^/]+)/", 1), F.lit(_NO_VALUE)).alias(k)
        return df.select(*[F.col(f"`{f.name}`") for f in self.schema.fields], *[key(k) for k in self.keys])

    def _folder(self, root: str) -> Column:
        return F.concat(F.lit(root), *[F.concat(F.lit(f"/{k}="), F.coalesce(F.col(k), F.lit(_NO_VALUE))) for k in self.keys])

    def _commit(self, hours: DataFrame, version: int) -> None:
        hours.select(F.lit(version).cast("bigint").alias("version"), *self.keys, "folder").coalesce(1).write.mode("append").parquet(f"{self.base}/_hours")

    def replace(self, rows: DataFrame, touched: DataFrame | None = None) -> int:
        """Every hour of ``rows`` and of ``touched`` (its keys) holds exactly ``rows``
        afterwards; other hours stay. Returns the version."""
        version = self.version() + 1
        root = f"{self.base}/v={version}-{uuid.uuid4().hex[:12]}"
        rows = rows.select(*[F.col(f"`{f.name}`") for f in self.schema.fields], *self.keys)
        rows.hint("rebalance", *self.keys).write.mode("errorifexists").option("compression", "zstd").partitionBy(*self.keys).parquet(root)
        written = written_partitions(self.spark, root, self.schema, self.keys)
        if touched is not None:
            gone = touched.select(*self.keys, F.lit(None).cast("string").alias("folder"))
            written = written.unionByName(gone).groupBy(*self.keys).agg(F.max("folder").alias("folder"))
        self._commit(written, version)
        return version

    def adopt(self, path: str, hours: DataFrame) -> int:
        """Hours that lie below ``path`` in the hour layout join the table as they are."""
        version = self.version() + 1
        self._commit(hours.select(*self.keys).distinct().withColumn("folder", self._folder(path.rstrip("/"))), version)
        return version

    def register(self, name: str, where: Column | None = None) -> None:
        """SNK-17: the live hours as partitions of a catalog table, with their folders."""
        live = self.live() if where is None else self.live().where(where)
        add_partitions(self.spark, name, live, self.keys)


def range_hours(spark: SparkSession, start, end, keys: list[str] = HOUR_KEYS) -> DataFrame:
    """Hour keys that overlap the UTC range [start, end); bounded by the range."""
    first = F.date_trunc("hour", F.lit(start).cast("timestamp_ntz")).cast("timestamp_ntz")
    hours = F.sequence(first, F.lit(end).cast("timestamp_ntz"), F.expr("INTERVAL 1 HOUR"))
    h = spark.range(1).select(F.explode(hours).alias("h")).where(F.col("h") < F.lit(end).cast("timestamp_ntz"))
    return h.select(*[c.alias(k) for c, k in zip(fn.kst_hour_keys("h"), keys)])


def load_replace_hour_range(table: HourTable, incoming: DataFrame, ts: Column, start, end) -> int:
    """SNK-9: [start, end) (UTC wall time, compared with ``ts``) holds exactly the
    incoming rows of that range (D10) afterwards. Only the hours that the ends of the
    range cut are read, for their rows outside it; all touched hours are committed at
    once, the emptied ones too. A replay gives the same table."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    hour = fn.hour_key_ts(*table.keys)
    cut = ((hour < lo) & (hour + F.expr("INTERVAL 1 HOUR") > lo)) | ((hour < hi) & (hour + F.expr("INTERVAL 1 HOUR") > hi))
    inside = F.coalesce((ts >= lo) & (ts < hi), F.lit(False))
    kept = table.read(cut).where(~inside)
    keys = [c.alias(k) for c, k in zip(fn.kst_hour_keys(ts), table.keys)]
    new = incoming.where(inside).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in table.schema.fields], *keys)
    return table.replace(kept.unionByName(new), range_hours(table.spark, start, end, table.keys))
