"""PRJ-*, FLT-1: projections, conformance, casts and filters."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import functions as fn
from ..schemas import DECODED_LOG, OPTIONAL_CASTS, RAW_26, TYPED_CASTS


def tx_project_hourly(df: DataFrame) -> DataFrame:
    """PRJ-1: the 11 loaded columns of the hourly warehouse table."""
    return df.select(
        F.col("transactionHash").alias("transactionhash"),
        F.col("blockNumber").cast("bigint").alias("blocknumber"),
        F.col("from").alias("transaction_from"), F.col("to").alias("transaction_to"),
        F.col("value").try_cast("decimal(38,0)").alias("value"),
        F.col("status").alias("transaction_status"),
        F.col("year").alias("key_year"), F.col("month").alias("key_month"),
        F.col("day").alias("key_day"), F.col("hour").alias("key_hour"),
        fn.text_to_ts("timestamp").alias("transaction_timestamp"),
    )


def tx_project_historical(df: DataFrame) -> DataFrame:
    """PRJ-1b: 10 columns, no key_hour; ``timestamp`` is already typed."""
    return df.select(
        F.col("transactionHash").alias("transactionhash"),
        F.col("blockNumber").cast("bigint").alias("blocknumber"),
        F.col("from").alias("transaction_from"), F.col("to").alias("transaction_to"),
        F.col("value").try_cast("decimal(38,0)").alias("value"),
        F.col("status").alias("transaction_status"),
        F.col("year").alias("key_year"), F.col("month").alias("key_month"),
        F.col("day").alias("key_day"),
        F.col("timestamp").cast("timestamp_ntz").alias("transaction_timestamp"),
    )


def tx_project_realtime(staging: DataFrame) -> DataFrame:
    """PRJ-1c: epoch-ns -> timestamp, value, from, to, blockNumber, status flag."""
    return staging.select(
        fn.epoch_ns_to_ts("timestamp").alias("timestamp"),
        F.col("value").try_cast("decimal(38,0)").alias("value"),
        F.col("from"), F.col("to"), F.col("blockNumber").cast("bigint").alias("blockNumber"),
        fn.status_flag("status").alias("status"),
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """PRJ-2: declared-but-absent columns as typed nulls, undeclared columns
    dropped, declared order, every column cast to its declared type."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def as_raw_26(df: DataFrame) -> DataFrame:
    """PRJ-2 across versions (D19): rows of the 23- or the 26-column form, or any file
    version of them, in the 26-column form. The form is read off the columns: a log
    without ``decodedLog`` gets a null one, a text block number becomes a bigint."""
    logs = dict(df.dtypes).get("logs", "")
    if logs.startswith("array<struct<") and "decodedLog" not in logs:
        df = df.withColumn("logs", F.transform("logs", lambda l: l.withField("decodedLog", F.lit(None).cast(DECODED_LOG))))
    if dict(df.dtypes).get("blockNumber") == "string":
        df = df.withColumn("blockNumber", F.col("blockNumber").try_cast("bigint"))
    return conform(df, RAW_26)


def fill_text(df: DataFrame) -> DataFrame:
    """PRJ-3: missing text -> '' (string columns only; nested stay null)."""
    return df.fillna("")


def tx_typed(df: DataFrame) -> DataFrame:
    """PRJ-4 + FN-7: typed casts; '' or bad text -> null, never an error."""
    out = df
    for c, t in TYPED_CASTS.items():
        if c in df.columns:
            out = out.withColumn(c, F.col(c).try_cast(t))
    return out.withColumn("timestamp", fn.text_to_ts("timestamp"))


def tx_typed_optional(df: DataFrame) -> DataFrame:
    """PRJ-5: cast version-dependent columns only where this input has them
    (decided from the schema at plan time)."""
    out = df
    for c, t in OPTIONAL_CASTS.items():
        if c in df.columns:
            out = out.withColumn(c, F.col(c).try_cast(t))
    return out


def nested_defaults(df: DataFrame) -> DataFrame:
    """PRJ-8: log ``removed`` -> false, ``topics`` -> [], ``accessList`` -> []."""
    out = df
    if "logs" in df.columns:
        out = out.withColumn("logs", F.transform("logs", lambda l: l.withField(
            "removed", F.coalesce(l["removed"], F.lit(False))).withField(
            "topics", F.coalesce(l["topics"], F.array().cast("array<string>")))))
    if "accessList" in df.columns:
        out = out.withColumn("accessList", F.coalesce(
            "accessList", F.array().cast(df.schema["accessList"].dataType)))
    return out


def filter_time_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """FLT-1: half-open [start, end); a null time is dropped."""
    t = F.col(ts)
    return df.where((t >= F.lit(start)) & (t < F.lit(end)))
