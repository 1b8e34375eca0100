"""SURVEY §3 flows composed from the operators. Each flow is one Spark plan
per step (no driver-side loops over rows); exchanges happen only at the
dedupe/join keys and at the partitioned writes."""
from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import functions as fn
from ..operators import joins as jn
from ..operators import ordering as srt
from ..operators import projections as prj
from ..operators.aggregates import count_per_key, last_per_key
from ..schemas import HOLDERS, RAW_23, RAW_26, REALTIME, WAREHOUSE
from ..sinks import tables as tb
from ..sinks import writers as wr
from ..sinks.hourmap import HourTable, load_replace_hour_range, range_hours
from ..sources import files as src
from ..sources import html as hsrc
from ..sources import landed as lsrc
from ..sources.status import source_status

HOUR_KEYS = ["year", "month", "day", "hour"]
WAREHOUSE_KEYS = ["key_year", "key_month", "key_day", "key_hour"]


def lake_table(spark: SparkSession, path: str) -> HourTable:
    """The hourly lake: the 26 raw columns by KST hour."""
    return HourTable(spark, path, RAW_26)


def warehouse_table(spark: SparkSession, path: str) -> HourTable:
    """The hourly warehouse table (PRJ-1) by KST hour."""
    return HourTable(spark, path, WAREHOUSE, WAREHOUSE_KEYS)


def kst_text_to_utc(c: str) -> Column:
    """UTC wall time of a row's KST text."""
    return F.convert_timezone(F.lit(fn.KST), F.lit("UTC"), fn.text_to_ts(c))


def hourly_batch(spark: SparkSession, pages: DataFrame, start: datetime, end: datetime,
                 lake: str, warehouse: str, manifest: str | None = None) -> DataFrame:
    """§3.1: landed pages -> 26-column rows stamped with block time (SRC-6, PRJ-9),
    of which a hash retried in several pages counts once (AGG-5, D13), rows without a
    hash all -> half-open range (FLT-1) -> KST hours of the lake (SNK-2) and, by the
    warehouse projection (PRJ-1), of the warehouse (SNK-8). Exactly [start, end) is
    replaced: rows that the first and last hour hold outside it stay, an hour left
    without rows is emptied, and all hours of a table change in one commit. With
    ``manifest`` every hour of the range is recorded with its row count, the empty
    ones too (SNK-5). Works for any range in one plan; returns the hours loaded."""
    items = lsrc.flatten_tx_pages(pages)
    inside = prj.filter_time_range(items.withColumn("_ts", fn.from_epoch_seconds("block_ts")), "_ts", start, end)
    # of the copies of a hash: one with logs (later pages leave them out), then the latest
    order = [F.col("logs").isNotNull().alias("l"), F.col("decodedInput").isNotNull().alias("d"), *[c for c in ("block_ts", "block", "page") if c in inside.columns]]
    keyed = last_per_key(inside.where(F.col("transactionHash").isNotNull()).withColumn("_o", F.struct(*order)), ["transactionHash"], "_o")
    rows = prj.as_raw_26(keyed.unionByName(inside.where(F.col("transactionHash").isNull()), allowMissingColumns=True))
    raw, loaded = lake_table(spark, lake), warehouse_table(spark, warehouse)
    load_replace_hour_range(raw, rows, kst_text_to_utc("timestamp"), start, end)
    hour = fn.hour_key_ts(*HOUR_KEYS)
    touched = (hour >= F.date_trunc("hour", F.lit(start)).cast("timestamp_ntz")) & (hour < F.lit(end).cast("timestamp_ntz"))
    now = raw.read(touched)
    hours = range_hours(spark, start, end)
    loaded.replace(prj.tx_project_hourly(now), hours.toDF(*WAREHOUSE_KEYS))
    if manifest is not None:
        wr.write_manifest(spark, wr.manifest(hours, count_per_key(now, HOUR_KEYS), HOUR_KEYS), manifest, HOUR_KEYS)
    return raw.live().where(touched).select(*HOUR_KEYS)


def historical_backfill(spark: SparkSession, blocks: DataFrame, receipts: DataFrame, chunk_size: int,
                        chunk_dir: str, day_dir: str, target: str, days: tuple[date, date]) -> DataFrame:
    """§3.2: RPC blocks x receipts (SRC-7, SRC-8, JOIN-1) -> block chunk files
    (SNK-4) -> nested scan (SRC-1) -> typed casts and day keys (PRJ-4/5/7) ->
    day partitions (SNK-3) -> historical projection (PRJ-1b) inserted where
    absent (SNK-12). Returns the blocks to retry (JOIN-6 input)."""
    merged, failed = jn.merge_block_responses(blocks, receipts)
    conformed = prj.conform(merged, RAW_23).withColumn("blockNumber", F.col("blockNumber").cast("bigint"))
    conformed = conformed.withColumn("transactionIndex", F.col("transactionIndex").cast("bigint"))
    wr.write_block_chunks(conformed, chunk_dir, chunk_size)
    lake = src.scan_nested_tx(spark, chunk_dir, _with_chunk_types(RAW_23))
    typed = prj.tx_typed_optional(prj.tx_typed(lake))
    wr.write_day_partitions(typed.select("*", *fn.day_keys("timestamp")), day_dir)
    typed_schema = typed.schema
    source = src.scan_day_range(spark, day_dir, typed_schema, *days)
    tb.load_insert_absent(spark, prj.tx_project_historical(source), target, "transactionhash", ["key_year", "key_month", "key_day"])
    return failed


def _with_chunk_types(schema: StructType) -> StructType:
    from pyspark.sql.types import LongType, StructField
    return StructType([StructField(f.name, LongType()) if f.name in ("blockNumber", "transactionIndex") else f
                       for f in schema.fields])


def realtime_table(spark: SparkSession, path: str) -> HourTable:
    """The realtime transactions (PRJ-1c) by KST hour of their time."""
    return HourTable(spark, path, REALTIME)


def realtime_replace(spark: SparkSession, staging: DataFrame, table: HourTable,
                     start: datetime, end: datetime, expected: DataFrame | None = None,
                     manifest: DataFrame | None = None) -> int | None:
    """§3.3: availability check (SRC-12) -> staging (SRC-9) -> realtime
    projection (PRJ-1c) -> replace exactly [start, end) (SNK-9), all its hours in one
    commit. A source recorded empty is skipped; a missing one raises."""
    if expected is not None and manifest is not None:
        st = source_status(expected, manifest, strict=True)
        if st.where(F.col("status") == "ready").isEmpty():
            return None
    proj = prj.tx_project_realtime(src.stage_semistructured(staging))
    return load_replace_hour_range(table, proj, F.col("timestamp"), start, end)


def daily_prices(prices: DataFrame, rates: DataFrame, table: tb.VersionedTable) -> int:
    """§3.4 price: price and FX responses (SRC-10) -> price x FX (JOIN-5, FN-11) ->
    keyed upsert by date (SNK-10), for a whole date range at once."""
    joined = jn.join_price_fx(lsrc.scan_price(prices), lsrc.scan_fx(rates))
    return tb.load_upsert_key(table, jn.daily_price(joined), ["price_date"])


def holders_snapshot(spark: SparkSession, pages: DataFrame, csv_dir: str, table: str,
                     inserted_at: str, top_n: int = 10_000) -> DataFrame:
    """§3.4 holders: pages -> cells (SRC-11) -> top-N then filters (SRT-2) ->
    CSV (SNK-6) -> typed CSV scan (SRC-4) -> truncate and load (SNK-11,
    SNK-18, FLT-9)."""
    cells = hsrc.parse_holder_cells(hsrc.holder_cells(pages), filtered=False)
    wr.write_holders_csv(srt.top_holders(cells, top_n), csv_dir, inserted_at)
    snap = src.scan_holders_csv(spark, csv_dir, HOLDERS)
    tb.create_table_if_absent(spark, table, "address string, eth_balance string, percentage string, "
                              "inserted_at timestamp_ntz", f"{csv_dir}_table")
    tb.load_truncate(spark, table, snap)
    return spark.table(table)


def purge(spark: SparkSession, tables: dict[str, list[str]], start: datetime, end: datetime) -> int:
    """§3.4 purge: every KST hour in [start, end] removed from lake and warehouse (SNK-13)."""
    return tb.purge_hour_range(spark, tables, start, end)
