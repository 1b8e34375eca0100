"""SRC-1..SRC-5, SRC-9: file scans with declared schemas."""
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import functions as fn
from ..schemas import HOLDERS, JSONL_TX, RAW_23

HOUR_KEYS = ["year", "month", "day", "hour"]
DAY_KEYS = ["year", "month", "day"]
BAD = "_bad_line"


def _with_keys(schema: StructType, keys) -> StructType:
    have = set(schema.fieldNames())
    return StructType(schema.fields + [StructField(k, StringType()) for k in keys if k not in have])


def scan_nested_tx(spark: SparkSession, path: str, schema: StructType = RAW_23) -> DataFrame:
    """SRC-1: every Parquet file under a prefix, read with the declared nested
    schema. Marker files (``.empty``) share the folders, so only ``*.parquet``
    files are listed."""
    return (spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").parquet(path))


def scan_partitioned(spark: SparkSession, path: str, schema: StructType, keys) -> DataFrame:
    """Partitioned table read with text partition keys (D6: never inferred)."""
    return (spark.read.schema(_with_keys(schema, keys)).option("pathGlobFilter", "*.parquet")
            .option("basePath", path).parquet(path))


def scan_hour_partition(spark: SparkSession, path: str, schema: StructType,
                        year: str, month: str, day: str, hour: str) -> DataFrame:
    """SRC-2 + FLT-2: one year/month/day/hour partition (pruned at listing)."""
    df = scan_partitioned(spark, path, schema, HOUR_KEYS)
    return df.where((F.col("year") == year) & (F.col("month") == month)
                    & (F.col("day") == day) & (F.col("hour") == hour))


def day_range_predicate(start: date, end: date, year="year", month="month", day="day"):
    """FLT-3: every (year, month, day) of the inclusive range, as one
    expression over the unpadded text keys. It references partition columns
    only, so Catalyst evaluates it against partition values (PartitionFilters)
    and no file of another day is opened; its size does not grow with the
    range, unlike a literal OR of days."""
    d = fn.day_key_date(year, month, day)
    return (d >= F.lit(start)) & (d <= F.lit(end))


def scan_day_range(spark: SparkSession, path: str, schema: StructType, start: date, end: date) -> DataFrame:
    """SRC-3: all days in [start, end] of the day-partitioned table."""
    return scan_partitioned(spark, path, schema, DAY_KEYS).where(day_range_predicate(start, end))


def scan_holders_csv(spark: SparkSession, path: str, schema: StructType = HOLDERS) -> DataFrame:
    """SRC-4: header skipped, comma-delimited, typed; a malformed row fails."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def _json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(file, line, j): every line that is not blank, parsed; the field BAD of j holds
    a line that does not parse."""
    lines = (spark.read.option("recursiveFileLookup", "true").text(path).where(F.trim("value") != "")
             .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")))
    with_bad = StructType([*schema.fields, StructField(BAD, StringType())])
    return lines.withColumn("j", F.from_json("line", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))


def scan_jsonl_gz(spark: SparkSession, path: str, schema: StructType = JSONL_TX, strict: bool = False) -> DataFrame:
    """SRC-5: gzip JSON-lines chunks, one transaction per line (codec taken from the
    file suffix). A line that does not parse gives no row: ``bad_json_lines`` returns
    it. With ``strict`` such a line fails the scan."""
    if strict:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").option("mode", "FAILFAST").json(path)
    return _json_lines(spark, path, schema).where(_good()).select(*[F.col(f"j.{f.name}").alias(f.name) for f in schema.fields])


def bad_json_lines(spark: SparkSession, path: str, schema: StructType = JSONL_TX) -> DataFrame:
    """(file, line) of the lines that ``scan_jsonl_gz`` leaves out."""
    return _json_lines(spark, path, schema).where(~_good()).select("file", "line")


def _good():
    return F.col("j").isNotNull() & F.col(f"j.{BAD}").isNull()


def stage_semistructured(df: DataFrame, nested: list[str] | None = None, form: str = "json") -> DataFrame:
    """SRC-9: staging form; nested columns as JSON text or, with ``form="variant"``, as
    VARIANT values, whose fields are read by path without parsing text (``variant_get``)."""
    nested = nested if nested is not None else [
        f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]
    staged = {"json": fn.to_json_text, "variant": lambda c: F.to_variant_object(F.col(c))}[form]
    return df.select(*[staged(c).alias(c) if c in nested else F.col(c) for c in df.columns])
