"""One registered query per SURVEY §2 key: ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through the ledger views of
``fixtures`` (whole tables, no subsets), runs the operator as a Spark plan and
returns scalar columns named exactly as in the oracle SQL. Sinks write to a
fresh folder under the shared ``spark.checkpoint.dir`` and return the table
read back. Wide decimals are returned as text (compared by value).
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import schemas
from ..operators import aggregates as agg
from ..operators import joins as jn
from ..operators import ordering as srt
from ..operators import projections as prj
from ..operators import setops as st
from ..session import configure, scratch_path
from ..sinks import tables as tb
from ..sinks import writers as wr
from ..sources import files as src
from ..sources import html as hsrc
from ..sources import landed as lsrc
from ..sources.status import source_status
from ..streaming import hourly as stream
from . import fixtures as fx
from . import flows

# Fixed query parameters (named here once; oracles use the same values).
PICK_HOUR = ("2024", "01", "15", "09")                 # KST partition read by SRC-2
DAY_RANGE = (date(1996, 1, 1), date(1997, 12, 31))     # SRC-3 / FLT-3
INSERT_RANGE = (date(1996, 7, 1), date(1997, 6, 30))   # SNK-12 source days
TIME_RANGE = (datetime(1996, 1, 1), datetime(1997, 1, 1))  # FLT-1, KST wall time
REPLACE_RANGE = (datetime(2024, 1, 10), datetime(2024, 1, 12))  # SNK-9, UTC
PURGE_RANGE = (datetime(2024, 1, 5, 9), datetime(2024, 1, 7, 8))  # SNK-13 hour starts, KST
RUN_DATE = "2025-07-01 00:00:00"
RUN_TIME = datetime(2024, 1, 31)                       # STR-4: logical time of the run
NEXT_RUN_DATE = "2025-07-02 00:00:00"
FILE_CHUNK = 100      # blocks per chunk file (SNK-4, AGG-1, SRT-1)
GRID_A, GRID_B = 7, 10  # manifest chunk sizes (partial edges on purpose)
TOP_N = 1000
START_BLOCK = 1       # first block of the collected range (a setting; block 0 lies before it)
LANES = 4
LANDED_FILE_ROWS = 1_000_000  # most rows that a stream's landed file holds, about

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return f(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = f.__doc__
        Q[name] = run
        return f
    return deco


def _block_bounds(spark: SparkSession, sf: str) -> tuple[int, int]:
    """[START_BLOCK, max block]: the operators take the range as arguments; the
    queries ask for it from START_BLOCK on, like the oracles."""
    hi = fx.tx(spark, sf).agg(F.max("blockNumber")).first()[0]
    return START_BLOCK, int(hi)


def _present_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return fx.block_manifest(spark, sf).select("block")


def _typed_tx(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.tx_raw(spark, sf).drop("o_orderkey")
    t = prj.tx_typed(raw)
    return t.select("*", *fn.day_keys("timestamp"))


def _staging(spark: SparkSession, sf: str) -> DataFrame:
    return fx.realtime_staging(spark, sf)


def _hour_range(spark: SparkSession, sf: str) -> DataFrame:
    """Every UTC hour start between the first and the last event (FN-10)."""
    return fx.hour_targets(spark, sf).select(F.col("target_ts").alias("hour_ts"))


# ============================================================== 2.1 sources
@query("scan_nested_tx")
def scan_nested_tx(spark, sf):
    """SRC-1: landed nested files scanned with the declared 23-column schema."""
    df = src.scan_nested_tx(spark, fx.lake_nested.path(spark, sf))
    return df.select("transactionHash", "blockNumber", "value", "status",
                     F.size("logs").cast("bigint").alias("n_logs"),
                     F.aggregate("logs", F.lit(0).cast("bigint"), lambda a, l: a + l["logIndex"]).alias("sum_log_index"),
                     F.col("accessList").isNotNull().alias("has_access_list"))


def _write_hourly(spark, sf, name="hourly"):
    path = scratch_path(spark, name)
    wr.write_hour_partitions(fx.hourly(spark, sf), path)
    return path


_HOURLY_SCHEMA = ("transactionHash string, blockNumber bigint, transactionIndex bigint, `from` string, "
                  "`to` string, value decimal(38,0), status string, ts timestamp_ntz, timestamp string")


def _hourly_schema():
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(_HOURLY_SCHEMA)


@query("scan_hour_partition")
def scan_hour_partition(spark, sf):
    """SRC-2 + FLT-2: one KST hour partition of the hourly table."""
    path = fx.lake_hours.path(spark, sf)
    df = src.scan_hour_partition(spark, path, _hourly_schema(), *PICK_HOUR)
    return df.select("transactionHash", "from", "status", "timestamp", "year", "month", "day", "hour")


def _write_days(spark, sf):
    path = scratch_path(spark, "days")
    wr.write_day_partitions(_typed_tx(spark, sf), path)
    return path


@query("scan_day_range")
def scan_day_range(spark, sf):
    """SRC-3 + FLT-3: days in [1996-01-01, 1997-12-31] of the day table."""
    path = fx.lake_days.path(spark, sf)
    schema = _typed_tx(spark, sf).drop("year", "month", "day").schema
    df = src.scan_day_range(spark, path, schema, *DAY_RANGE)
    return df.select("transactionHash", "blockNumber", "year", "month", "day")


@query("scan_holders_csv")
def scan_holders_csv(spark, sf):
    """SRC-4: holder CSV with header read back with its typed schema."""
    path = scratch_path(spark, "holders-csv")
    rows = fx.holder_rows(spark, sf).select("address", "eth_balance", "percentage")
    wr.write_holders_csv(rows, path, RUN_DATE)
    return src.scan_holders_csv(spark, path)


def _jsonl_rows(df: DataFrame) -> DataFrame:
    return df.select("transactionHash", "blockNumber", "transactionIndex", "from", "to", "value", "status",
                     "timestamp")


@query("scan_jsonl_gz")
def scan_jsonl_gz(spark, sf):
    """SRC-5: gzip JSON-lines chunks read back with a declared schema; lines that do
    not parse come from the side table."""
    path, side = fx.lake_jsonl.path(spark, sf), scratch_path(spark, "bad-lines")
    src.bad_json_lines(spark, path).write.parquet(side)
    bad = spark.read.parquet(side).select(F.col("line").alias("bad_line"))
    return src.scan_jsonl_gz(spark, path).unionByName(bad, allowMissingColumns=True)


def _joined(c: str, part) -> Column:
    """A nested array as text: its elements' fields, null arrays null."""
    return F.array_join(F.transform(c, part), ";").alias(c)


def _raw_26_out(df: DataFrame) -> DataFrame:
    """The 26 raw columns, nested ones as text of all their fields, after the others."""
    text = lambda c: c.cast("string")
    log = lambda l: F.concat_ws(
        ":", l["contractAddress"], l["transactionHash"], text(l["transactionIndex"]), l["blockHash"], text(l["blockNumber"]), l["data"],
        text(l["logIndex"]), text(l["removed"]), F.array_join(l["topics"], ","), l["decodedLog"]["name"], l["decodedLog"]["eventFragment"],
        l["decodedLog"]["signature"], l["decodedLog"]["eventHash"],
        F.array_join(F.transform(l["decodedLog"]["args"], lambda a: F.concat_ws("/", a["name"], a["type"], a["value"])), ","))
    nested = {
        "accessList": _joined("accessList", lambda a: F.concat_ws(":", a["address"], F.array_join(a["storageKeys"], ","))),
        "authorizationList": _joined("authorizationList", lambda a: F.concat_ws(":", *[a[f] for f in ("chainId", "nonce", "address", "yParity", "r", "s")])),
        "logs": _joined("logs", log),
    }
    return df.select(*[c for c in df.columns if c not in schemas.COLUMNS_26], *[nested.get(c, F.col(f"`{c}`")) for c in schemas.COLUMNS_26])


@query("flatten_tx_pages")
def flatten_tx_pages(spark, sf):
    """SRC-6 + PRJ-9: paged responses -> 26-column rows stamped with page block time."""
    return _raw_26_out(lsrc.flatten_tx_pages(fx.tx_pages(spark, sf)).drop("count", "nextCursor"))


def _rpc_txs(spark, sf, stamp=False):
    return lsrc.flatten_rpc_blocks(fx.rpc_block(spark, sf), stamp=stamp)


@query("flatten_rpc_blocks")
def flatten_rpc_blocks(spark, sf):
    """SRC-7 + FLT-7: block responses -> decoded tx rows (bare strings dropped)."""
    t = _rpc_txs(spark, sf)
    return t.select(F.col("hash").alias("transactionHash"),
                    fn.hex_to_long("blockNumber").alias("blockNumber"),
                    fn.hex_to_long("transactionIndex").alias("transactionIndex"),
                    fn.hex_to_long("nonce").alias("nonce"), fn.hex_to_long("gas").alias("gas"),
                    fn.hex_to_decimal("value").cast("string").alias("value"))


def _receipts(spark, sf):
    return lsrc.flatten_rpc_receipts(fx.rpc_receipt(spark, sf))


@query("flatten_rpc_receipts")
def flatten_rpc_receipts(spark, sf):
    """SRC-8: receipt responses -> receipt rows with their position."""
    r = _receipts(spark, sf)
    return r.select("blockNumber", F.col("ord").cast("bigint").alias("ord"), "transactionHash",
                    fn.hex_to_long("gasUsed").alias("gasUsed"), "status")


@query("stage_semistructured")
def stage_semistructured(spark, sf):
    """SRC-9: nested columns staged as VARIANT, written, typed fields read back by path."""
    path = scratch_path(spark, "staging")
    src.stage_semistructured(fx.tx_nested(spark, sf).drop("o_orderkey"), form="variant").write.option("compression", "zstd").parquet(path)
    staged = spark.read.parquet(path)
    return staged.select(
        "transactionHash",
        F.size(F.variant_get("logs", "$", "array<variant>")).cast("bigint").alias("n_logs"),
        F.variant_get("logs", "$[0].logIndex", "bigint").alias("first_log_index"),
        F.variant_get("logs", "$[0].contractAddress", "string").alias("first_log_address"),
        F.variant_get("logs", "$[0].topics[1]", "string").alias("first_log_topic"),
        F.variant_get("logs", "$[0].removed", "boolean").alias("first_log_removed"),
        F.variant_get("accessList", "$[0].storageKeys[0]", "string").alias("first_slot"),
        F.col("accessList").isNull().alias("access_list_missing"))


def _price_fx(spark, sf):
    return jn.join_price_fx(lsrc.scan_price(fx.price_responses(spark, sf)), lsrc.scan_fx(fx.fx_responses(spark, sf)))


@query("scan_price_fx")
def scan_price_fx(spark, sf):
    """SRC-10: $.ETH.USD and $.rates.KRW of the landed responses."""
    p = _price_fx(spark, sf)
    return p.select(F.col("price_date").cast("string").alias("price_date"), "price_usd_raw", "fx_rate")


def _all_pages(spark, sf):
    """Holder pages plus the raw web pages table (pages without a table give
    no rows)."""
    raw = fx.table(spark, sf, "pages").select(F.col("page_id").alias("page_no"), "html")
    return fx.holder_pages(spark, sf).unionByName(raw)


@query("extract_holder_rows")
def extract_holder_rows(spark, sf):
    """SRC-11 + FLT-4/5/6 + FN-18: filtered holder rows from HTML pages."""
    return hsrc.extract_holder_rows(_all_pages(spark, sf)).select("address", "eth_balance", "percentage")


def _hour_manifest(spark, sf):
    """Hours of ``hourly``; KST hour 03 recorded empty, 04 never recorded."""
    counts = agg.count_per_key(fx.hourly(spark, sf), ["year", "month", "day", "hour"])
    counts = counts.where(F.col("hour") != "04")
    return counts.withColumn("n_rows", F.when(F.col("hour") == "03", F.lit(0).cast("bigint")).otherwise(F.col("n_rows")))


def _expected_hours(spark, sf):
    return _hour_range(spark, sf).select(*fn.kst_hour_keys("hour_ts"))


@query("source_status")
def source_status_q(spark, sf):
    """SRC-12: expected hours x manifest -> empty / ready / missing."""
    return source_status(_expected_hours(spark, sf), _hour_manifest(spark, sf))


# ================================================================ 2.2 sinks
def _raw_variants_conformed(spark, sf):
    a, b = fx.tx_raw_variants(spark, sf)
    return prj.conform(a, schemas.RAW_23).unionByName(prj.conform(b, schemas.RAW_23))


@query("write_conformed")
def write_conformed(spark, sf):
    """SNK-1: two file versions conformed to one schema, written, read back."""
    path = scratch_path(spark, "conformed")
    a, b = fx.tx_raw_variants(spark, sf)
    wr.write_conformed(a, f"{path}/a", schemas.RAW_23)
    wr.write_conformed(b, f"{path}/b", schemas.RAW_23)
    df = src.scan_nested_tx(spark, path)
    return df.select("transactionHash", "maxFeePerGas", "gas", "timestamp")


@query("write_hour_partitions")
def write_hour_partitions(spark, sf):
    """SNK-2: KST hour layout, read back with text keys."""
    path = _write_hourly(spark, sf)
    df = src.scan_partitioned(spark, path, _hourly_schema(), src.HOUR_KEYS)
    return df.select("transactionHash", "status", "year", "month", "day", "hour")


@query("write_day_partitions")
def write_day_partitions(spark, sf):
    """SNK-3: unpadded day layout, static overwrite, read back."""
    path = _write_days(spark, sf)
    schema = _typed_tx(spark, sf).drop("year", "month", "day").schema
    df = src.scan_partitioned(spark, path, schema, src.DAY_KEYS)
    return df.select("transactionHash", "year", "month", "day")


@query("write_block_chunks")
def write_block_chunks(spark, sf):
    """SNK-4: one folder per '%08d_%08d' block chunk."""
    path = scratch_path(spark, "chunks")
    wr.write_block_chunks(fx.tx(spark, sf).select("transactionHash", "blockNumber", "transactionIndex"),
                          path, FILE_CHUNK)
    df = spark.read.schema("transactionHash string, blockNumber bigint, transactionIndex bigint, chunk string").parquet(path)
    return df.select("transactionHash", "chunk")


@query("manifest_empty")
def manifest_empty(spark, sf):
    """SNK-5: per expected hour n_rows and is_empty (KST hour 03 has none)."""
    path = scratch_path(spark, "manifest")
    keys = ["year", "month", "day", "hour"]
    counts = agg.count_per_key(fx.hourly(spark, sf).where(F.col("hour") != "03"), keys)
    m = wr.manifest(_expected_hours(spark, sf), counts, keys)
    wr.write_manifest(spark, m, path, keys)
    wr.write_manifest(spark, m, path, keys)  # a later row replaces the key's row
    return wr.read_manifest(spark, path, keys)


def _holder_snapshot(spark, sf):
    return hsrc.extract_holder_rows(_all_pages(spark, sf)).select("address", "eth_balance", "percentage")


@query("write_holders_csv")
def write_holders_csv(spark, sf):
    """SNK-6: extracted holder rows + inserted_at as CSV with header."""
    path = scratch_path(spark, "holders")
    wr.write_holders_csv(_holder_snapshot(spark, sf), path, RUN_DATE)
    return src.scan_holders_csv(spark, path)


def _table_name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex[:8]}"


_HOURLY_DDL = _HOURLY_SCHEMA + ", year string, month string, day string, hour string"


@query("load_skip_existing")
def load_skip_existing(spark, sf):
    """SNK-7: hours already loaded (KST days 1..15) are not touched."""
    path, name = scratch_path(spark, "skip"), _table_name("skip_tx")
    tb.register_table(spark, name, _HOURLY_DDL, path, src.HOUR_KEYS)
    h = fx.hourly(spark, sf)
    tb.load_skip_existing(spark, name, h.where(F.col("day") <= "15"), path)
    again = h.withColumn("status", F.upper("status"))
    for _ in range(2):  # the second adds nothing
        tb.load_skip_existing(spark, name, again, path)
    return spark.table(name).select("transactionHash", "status", "year", "month", "day", "hour")


_WAREHOUSE_KEYS = ["key_year", "key_month", "key_day", "key_hour"]


def _warehouse_text(df: DataFrame) -> DataFrame:
    return df.select("transactionhash", "transaction_status", *_WAREHOUSE_KEYS)


@query("load_replace_partition")
def load_replace_partition(spark, sf):
    """SNK-8: hours of KST days 10..12 replaced; every other hour kept."""
    path = scratch_path(spark, "replace-part")
    h = fx.hourly(spark, sf)
    tb.load_replace_partition(prj.tx_project_hourly(h), path, _WAREHOUSE_KEYS)
    fresh = h.where(F.col("day").between("10", "12")).withColumn("status", F.upper("status"))
    tb.load_replace_partition(prj.tx_project_hourly(fresh), path, _WAREHOUSE_KEYS)
    tb.load_replace_partition(prj.tx_project_hourly(fresh), path, _WAREHOUSE_KEYS)  # replay
    return _warehouse_text(spark.read.option("basePath", path).parquet(path))


def _realtime_out(df: DataFrame) -> DataFrame:
    return df.select("timestamp", F.col("value").cast("string").alias("value"), "from", "to", "blockNumber", "status")


@query("load_replace_range")
def load_replace_range(spark, sf):
    """SNK-9: [2024-01-10, 2024-01-12) replaced in one commit; only the hours of
    that range are rebuilt (replayed once)."""
    table = flows.realtime_table(spark, scratch_path(spark, "realtime"))
    # the earlier load is a landed table: its hours are taken over as they are
    table.adopt(fx.lake_realtime.path(spark, sf), fx.lake_realtime(spark, sf).select(*src.HOUR_KEYS))
    for _ in range(2):
        flows.realtime_replace(spark, _staging(spark, sf), table, *REPLACE_RANGE)
    return _realtime_out(table.read())


@query("hourly_batch")
def hourly_batch(spark, sf):
    """§3.1 (SRC-6, PRJ-2, D12, D13, SNK-2, SNK-8, SNK-5): all landed hours through
    the 26-column hourly flow; the lake's rows with their hour keys and the row count
    that the manifest records for the hour."""
    lake, warehouse, manifest = (scratch_path(spark, n) for n in ("lake", "warehouse", "hours"))
    span = fx.hour_targets(spark, sf).agg(F.min("target_ts"), F.max("target_ts") + F.expr("INTERVAL 1 HOUR")).first()
    flows.hourly_batch(spark, fx.hour_pages(spark, sf), span[0], span[1], lake, warehouse, manifest)
    rows = _raw_26_out(flows.lake_table(spark, lake).read())
    recorded = wr.read_manifest(spark, manifest, src.HOUR_KEYS).select(*src.HOUR_KEYS, F.col("n_rows").alias("hour_rows"))
    loaded = agg.count_per_key(flows.warehouse_table(spark, warehouse).read(), _WAREHOUSE_KEYS, "loaded_rows").toDF(*src.HOUR_KEYS, "loaded_rows")
    return rows.join(F.broadcast(recorded), src.HOUR_KEYS).join(F.broadcast(loaded), src.HOUR_KEYS)  # one row an hour: the lake's rows stay where they are


def _daily_price(spark, sf):
    return jn.daily_price(_price_fx(spark, sf))


@query("load_upsert_key")
def load_upsert_key(spark, sf):
    """SNK-10: price rows of days 10..20 replaced by key; others kept."""
    t = tb.VersionedTable(spark, scratch_path(spark, "prices"))
    p = _daily_price(spark, sf)
    t.commit(p.withColumn("price_krw", F.lit(None).cast("double")))
    fresh = p.where(F.dayofmonth(F.to_date("price_date")).between(10, 20))
    tb.load_upsert_key(t, fresh, ["price_date"])
    tb.load_upsert_key(t, fresh, ["price_date"])
    return t.read().select("price_date", "price_usd", "price_krw")


@query("load_truncate")
def load_truncate(spark, sf):
    """SNK-11 + SNK-18 + FLT-9: holders table replaced by today's snapshot."""
    path = scratch_path(spark, "holders-table")
    name = _table_name("top_holders")
    tb.create_table_if_absent(spark, name, "address string, eth_balance string, percentage string, "
                              "inserted_at timestamp_ntz", path)
    tb.create_table_if_absent(spark, name, "address string, eth_balance string, percentage string, "
                              "inserted_at timestamp_ntz", path)
    old = fx.snapshot_old(spark, sf).withColumn("inserted_at", F.lit(RUN_DATE).cast("timestamp_ntz"))
    tb.load_truncate(spark, name, old)
    new = _holder_snapshot(spark, sf).withColumn("inserted_at", F.lit(NEXT_RUN_DATE).cast("timestamp_ntz"))
    tb.load_truncate(spark, name, new)
    return spark.table(name).select("address", "eth_balance", "percentage", "inserted_at")


def _historical_out(df: DataFrame) -> DataFrame:
    return df.select("transactionhash", "blocknumber", "transaction_from", "transaction_to",
                     F.col("value").cast("string").alias("value"), "transaction_status",
                     "key_year", "key_month", "key_day", "transaction_timestamp")


@query("load_insert_absent")
def load_insert_absent(spark, sf):
    """SNK-12 + JOIN-2 + FLT-3: 1996 preloaded; days 1996-07-01..1997-06-30
    inserted where the hash is absent; a rerun inserts nothing. The target is
    partitioned by month here: the driver tables have few rows a day."""
    days, keys = fx.lake_days.path(spark, sf), ["key_year", "key_month"]
    schema = _typed_tx(spark, sf).drop("year", "month", "day").schema
    target = scratch_path(spark, "historical")
    pre = src.scan_partitioned(spark, days, schema, src.DAY_KEYS).where(F.col("year") == "1996")
    tb.load_insert_absent(spark, prj.tx_project_historical(pre), target, "transactionhash", keys)
    source = prj.tx_project_historical(src.scan_day_range(spark, days, schema, *INSERT_RANGE))
    for _ in range(2):
        tb.load_insert_absent(spark, source, target, "transactionhash", keys)
    return _historical_out(spark.read.parquet(target))


def _managed_hours(spark, sf):
    """The hourly lake and its warehouse projection as managed tables."""
    lake, warehouse = _table_name("batch_tx"), _table_name("warehouse_tx")
    h = fx.lake_hours(spark, sf)
    tb.save_managed(h.select(*_hourly_schema().fieldNames(), *src.HOUR_KEYS), lake, src.HOUR_KEYS)
    tb.save_managed(prj.tx_project_hourly(h), warehouse, _WAREHOUSE_KEYS)
    return lake, warehouse


@query("purge_hour_range")
def purge_hour_range(spark, sf):
    """SNK-13: KST hours 2024-01-05 09:00 .. 2024-01-07 08:00 removed from lake and
    warehouse; a rerun and a new registration bring nothing back."""
    lake, warehouse = _managed_hours(spark, sf)
    tables = {lake: src.HOUR_KEYS, warehouse: _WAREHOUSE_KEYS}
    for _ in range(2):
        flows.purge(spark, tables, *PURGE_RANGE)
    for name in tables:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    out = spark.table(lake).select(F.lit("lake").alias("side"), "transactionHash", *src.HOUR_KEYS)
    return out.union(spark.table(warehouse).select(F.lit("warehouse"), "transactionhash", *_WAREHOUSE_KEYS))


@query("register_partitions")
def register_partitions(spark, sf):
    """SNK-17: the collected hours registered with their locations; rows per partition."""
    name, hours = _table_name("batch_tx"), fx.hourly(spark, sf).select(*src.HOUR_KEYS)
    for _ in range(2):  # repeatable
        tb.register_table(spark, name, _HOURLY_DDL, fx.lake_hours.path(spark, sf), src.HOUR_KEYS, hours)
    parts = tb.partitions(spark, name, src.HOUR_KEYS)
    counts = agg.count_per_key(spark.table(name), src.HOUR_KEYS)
    return parts.join(counts, src.HOUR_KEYS, "left").select(*src.HOUR_KEYS, "n_rows")


@query("ingest_state")
def ingest_state(spark, sf):
    """SNK-14: state appended per completed chunk; next block read back."""
    lo, hi = _block_bounds(spark, sf)
    path = scratch_path(spark, "state")
    c = agg.chunk_completeness(spark, _present_blocks(spark, sf), lo, hi, GRID_B)
    # the contiguous prefix of complete chunks advances the state, in order;
    # the first incomplete chunk id is one scalar of a one-row aggregate
    gap = c.where(~F.col("is_complete")).agg(F.min("chunk_id")).first()[0]
    done = c if gap is None else c.where(F.col("chunk_id") < F.lit(gap))
    rows = done.select(F.col("chunk_id").alias("seq"), (F.col("chunk_end") + 1).cast("bigint").alias("next_fetch_block"))
    tb.append_state(spark, path, rows)
    return tb.read_state(spark, path, lo)


def _first_success(spark, sf):
    return stream.first_success(fx.attempts(spark, sf))


@query("failed_blocks")
def failed_blocks(spark, sf):
    """SNK-15: blocks never successful in 5 rounds appended to the log."""
    path = scratch_path(spark, "failed")
    failed = _first_success(spark, sf).where(F.col("first_ok_attempt").isNull()).select("block")
    tb.append_failed_blocks(path, failed)
    return spark.read.parquet(path).select("block")


def _complete_chunks(spark, sf, size):
    lo, hi = _block_bounds(spark, sf)
    c = agg.chunk_completeness(spark, _present_blocks(spark, sf), lo, hi, size)
    return c.where("is_complete").select("chunk_id"), lo, hi


@query("compact_chunks")
def compact_chunks(spark, sf):
    """SNK-16: staged per-block rows of complete chunks -> one gzip JSONL per chunk;
    what stays staged are the incomplete chunks."""
    complete, lo, hi = _complete_chunks(spark, sf, GRID_B)
    path, staging = scratch_path(spark, "compact"), _table_name("staged_blocks")
    rows = _jsonl_rows(fx.tx_raw(spark, sf)).withColumn("blockNumber", F.col("blockNumber").cast("bigint")) \
        .where(F.col("blockNumber").between(lo, hi))
    wr.stage_blocks(rows, staging, GRID_B)
    for _ in range(2):  # the second call finds no inputs
        wr.compact_chunks(spark, staging, complete, path, GRID_B)
    packed = spark.read.schema("transactionHash string, chunk string").json(path).select("transactionHash", "chunk")
    return packed.union(spark.table(staging).select("transactionHash", F.lit("staged")))


# ========================================================== 2.3 projections
@query("tx_project_hourly")
def tx_project_hourly(spark, sf):
    """PRJ-1: 11 warehouse columns of the hourly rows."""
    p = prj.tx_project_hourly(fx.hourly(spark, sf))
    return p.select(*[c if c != "value" else F.col("value").cast("string").alias("value") for c in p.columns])


@query("tx_project_historical")
def tx_project_historical(spark, sf):
    """PRJ-1b: 10 columns of the typed, day-keyed rows."""
    return _historical_out(prj.tx_project_historical(_typed_tx(spark, sf)))


@query("tx_project_realtime")
def tx_project_realtime(spark, sf):
    """PRJ-1c: realtime projection of the staging rows."""
    return _realtime_out(prj.tx_project_realtime(_staging(spark, sf)))


@query("tx_conform")
def tx_conform(spark, sf):
    """PRJ-2: both 23-column file versions and the 26-column page items in one form."""
    a, b = fx.tx_raw_variants(spark, sf)
    new = lsrc.flatten_tx_pages(fx.hour_pages(spark, sf)).where(F.col("page") == 0)
    parts = [(prj.conform(a, schemas.RAW_23), "23"), (prj.conform(b, schemas.RAW_23), "23"), (new, "26")]
    rows = [prj.as_raw_26(df).withColumn("form", F.lit(form)) for df, form in parts]
    return _raw_26_out(rows[0].unionByName(rows[1]).unionByName(rows[2]))


@query("tx_fill_text")
def tx_fill_text(spark, sf):
    """PRJ-3: missing text -> ''."""
    df = prj.fill_text(_raw_variants_conformed(spark, sf))
    return df.select("transactionHash", "maxFeePerGas", "gas", "contractAddress", "timestamp")


@query("tx_typed")
def tx_typed(spark, sf):
    """PRJ-4 + FN-7: typed casts, '' -> null."""
    t = prj.tx_typed(fx.tx_raw(spark, sf).drop("o_orderkey"))
    return t.select("transactionHash", "transactionIndex", "blockNumber", "nonce", "gas", "gasPrice", "timestamp")


@query("tx_typed_optional")
def tx_typed_optional(spark, sf):
    """PRJ-5: version-dependent casts applied per file version."""
    a, b = fx.tx_raw_variants(spark, sf)
    out = prj.tx_typed_optional(a).unionByName(prj.tx_typed_optional(b), allowMissingColumns=True)
    return out.select("transactionHash", "maxFeePerGas", "maxPriorityFeePerGas", "effectGasPrice")


@query("kst_hour_keys")
def kst_hour_keys(spark, sf):
    """PRJ-6: padded KST hour keys."""
    return fx.hourly(spark, sf).select("transactionHash", "year", "month", "day", "hour")


@query("day_keys")
def day_keys(spark, sf):
    """PRJ-7: unpadded day keys of the typed (KST) timestamp."""
    return _typed_tx(spark, sf).select("transactionHash", "year", "month", "day")


def _wire_logs(spark, sf, more=None):
    """(transactionHash, logs) and the columns of ``more``, joined by hash: both joins
    carry line items as numbers, the wire text is made and parsed after them."""
    t = fx.tx(spark, sf).select("o_orderkey", "transactionHash")
    t = t if more is None else t.join(more, "transactionHash")
    j = t.join(fx.order_items(spark, sf), "o_orderkey")
    return j.select(F.from_json(fx.order_logs_text(), fn.LOG_WIRE_DDL).alias("logs"), *[c for c in t.columns if c != "o_orderkey"])


@query("nested_defaults")
def nested_defaults(spark, sf):
    """PRJ-8: removed -> false, topics -> [] per log; accessList -> [] per transaction."""
    access = fx.tx_nested(spark, sf).select("transactionHash", "accessList")
    d = prj.nested_defaults(_wire_logs(spark, sf, access))
    e = d.select("transactionHash", F.size("accessList").cast("bigint").alias("n_access"), F.posexplode_outer("logs").alias("pos", "l"))
    return e.select("transactionHash", "n_access", F.col("pos").cast("bigint").alias("pos"),
                    F.col("l.removed").alias("removed"),
                    F.when(F.col("l").isNotNull(), F.size("l.topics")).cast("bigint").alias("n_topics"))


@query("stamp_block_time")
def stamp_block_time(spark, sf):
    """PRJ-9: every tx of a block gets the block's time (carried at explode)."""
    t = _rpc_txs(spark, sf, stamp=True)
    return t.select(F.col("hash").alias("transactionHash"), fn.hex_to_long("blockNumber").alias("blockNumber"),
                    "timestamp")


@query("filter_time_range")
def filter_time_range(spark, sf):
    """FLT-1: half-open [1996-01-01, 1997-01-01) on the typed time; null dropped."""
    t = prj.tx_typed(fx.tx_raw(spark, sf).drop("o_orderkey"))
    return prj.filter_time_range(t, "timestamp", *TIME_RANGE).select("transactionHash", "timestamp")


# ================================================================ 2.4 joins
def _merge(spark, sf):
    return jn.merge_block_responses(fx.rpc_block(spark, sf), fx.rpc_receipt(spark, sf))


@query("merge_tx_receipts")
def merge_tx_receipts(spark, sf):
    """JOIN-1: tx x last receipt per hash; blocks with an unmatched tx excluded."""
    m, _ = _merge(spark, sf)
    return m.select("transactionHash", "blockNumber", "value", "gas", "gasUsed", "status",
                    F.size("logs").cast("bigint").alias("n_logs"), "timestamp")


@query("blocks_with_unmatched_tx")
def blocks_with_unmatched_tx(spark, sf):
    """JOIN-1 failure side: blocks to retry and their unmatched tx count."""
    _, failed = _merge(spark, sf)
    return failed.select("blockNumber", "n_unmatched")


@query("asof_block_before")
def asof_block_before(spark, sf):
    """JOIN-3: latest block at or before each hour start."""
    return jn.asof_block(fx.blocks_time(spark, sf), fx.hour_targets(spark, sf), "before")


@query("asof_block_after")
def asof_block_after(spark, sf):
    """JOIN-3: earliest block at or after each hour start."""
    return jn.asof_block(fx.blocks_time(spark, sf), fx.hour_targets(spark, sf), "after")


@query("join_block_header")
def join_block_header(spark, sf):
    """JOIN-4: block header time joined onto the block's transactions."""
    blocks = fx.rpc_block(spark, sf)
    headers = lsrc.rpc_block_headers(blocks).select("blockNumber", fn.hex_ts_to_kst("block_ts_hex").alias("timestamp"))
    t = lsrc.flatten_rpc_blocks(blocks, stamp=False).select(
        F.col("hash").alias("transactionHash"), fn.hex_to_long("blockNumber").alias("blockNumber"))
    return jn.join_block_header(t, headers).select("transactionHash", "blockNumber", "timestamp")


@query("daily_price")
def daily_price(spark, sf):
    """JOIN-5 + FN-11: price x FX per date, rounded after multiplying."""
    return _daily_price(spark, sf)


def _missing(spark, sf):
    lo, hi = _block_bounds(spark, sf)
    return jn.missing_blocks(jn.block_range(spark, lo, hi), _present_blocks(spark, sf))


@query("missing_blocks")
def missing_blocks(spark, sf):
    """JOIN-6: expected [1, max block] minus recorded blocks."""
    return _missing(spark, sf)


@query("retry_subset")
def retry_subset(spark, sf):
    """JOIN-7: only the transactions of the retry list."""
    return jn.retry_subset(fx.tx(spark, sf), _missing(spark, sf)).select("transactionHash", "blockNumber")


def _profile(spark, sf):
    return agg.address_profile(fx.tx(spark, sf))


def _profile_out(df):
    return df.select("address", "first_seen_block", "first_seen_timestamp", "total_tx_count",
                     F.col("total_value").cast("string").alias("total_value"))


@query("new_holders")
def new_holders(spark, sf):
    """JOIN-8: active addresses missing from the holder snapshot."""
    return _profile_out(jn.new_holders(_profile(spark, sf), fx.snapshot_old(spark, sf)))


# ========================================================= 2.5 aggregations
@query("count_per_hour")
def count_per_hour(spark, sf):
    """AGG-1: rows per KST hour."""
    return agg.count_per_key(fx.hourly(spark, sf), ["year", "month", "day", "hour"])


@query("count_per_chunk")
def count_per_chunk(spark, sf):
    """AGG-1: rows per block chunk."""
    return agg.count_per_key(wr.with_chunk(fx.tx(spark, sf), FILE_CHUNK), ["chunk"])


@query("next_block_asc")
def next_block_asc(spark, sf):
    """AGG-2 ascending (contiguous, grid of 7)."""
    lo, hi = _block_bounds(spark, sf)
    return agg.next_block_asc(spark, _present_blocks(spark, sf), lo, hi, GRID_A)


@query("next_block_desc")
def next_block_desc(spark, sf):
    """AGG-2 descending: contiguous form and the reference's min - 1 form."""
    lo, hi = _block_bounds(spark, sf)
    return agg.next_block_desc(spark, _present_blocks(spark, sf), lo, hi)


@query("chunk_completeness")
def chunk_completeness(spark, sf):
    """AGG-3: completeness on the absolute grids of 7 and 10 blocks."""
    lo, hi = _block_bounds(spark, sf)
    p = _present_blocks(spark, sf)
    return agg.chunk_completeness(spark, p, lo, hi, GRID_A).unionByName(
        agg.chunk_completeness(spark, p, lo, hi, GRID_B))


@query("page_reconcile")
def page_reconcile(spark, sf):
    """AGG-4: reported count vs rows and pages received per block."""
    return agg.page_reconcile(lsrc.flatten_tx_pages(fx.tx_pages(spark, sf), keep_empty=True), fx.TX_PAGE_SIZE)


@query("last_per_key")
def last_per_key(spark, sf):
    """AGG-5: last receipt per (block, hash) by response position."""
    r = agg.last_per_key(_receipts(spark, sf).select("blockNumber", "transactionHash", "ord", "gasUsed", "status"),
                         ["blockNumber", "transactionHash"], "ord")
    return r.select("blockNumber", "transactionHash", F.col("ord").cast("bigint").alias("ord"),
                    fn.hex_to_long("gasUsed").alias("gasUsed"), "status")


@query("address_profile")
def address_profile(spark, sf):
    """AGG-6: per sender first block/time, count, total wei."""
    return _profile_out(_profile(spark, sf))


@query("chunk_throughput")
def chunk_throughput(spark, sf):
    """AGG-7: tx per second per chunk of 10 blocks."""
    return agg.chunk_throughput(fx.block_manifest(spark, sf), GRID_B)


# ================================================================ 2.7 sorts
@query("sort_block_tx")
def sort_block_tx(spark, sf):
    """SRT-1: position of each tx inside its chunk file."""
    c = wr.with_chunk(fx.tx(spark, sf), FILE_CHUNK)
    return srt.position_in_chunk(c).select("chunk", "pos", "transactionHash")


@query("top_holders")
def top_holders(spark, sf):
    """SRT-2: top 1000 rows by balance, then filtered."""
    cells = hsrc.parse_holder_cells(hsrc.holder_cells(_all_pages(spark, sf)), filtered=False)
    return srt.top_holders(cells, TOP_N)


@query("chunk_plan_asc")
def chunk_plan_asc(spark, sf):
    """SRT-3 ascending plan over [1, max block], grid of 7."""
    lo, hi = _block_bounds(spark, sf)
    return srt.chunk_plan_asc(spark, lo, hi, GRID_A)


@query("chunk_plan_desc")
def chunk_plan_desc(spark, sf):
    """SRT-3 descending plan from max block down to 1, size 10."""
    lo, hi = _block_bounds(spark, sf)
    return srt.chunk_plan_desc(spark, hi, lo, GRID_B)


# ================================================================= 2.8 sets
@query("union_retry")
def union_retry(spark, sf):
    """SET-1: first-pass rows plus rows of blocks recovered by retries."""
    fs = _first_success(spark, sf)
    t = fx.tx(spark, sf).select("transactionHash", "blockNumber")
    first = t.join(fs.where(F.col("first_ok_attempt") == 0).select(F.col("block").alias("blockNumber")),
                   "blockNumber", "left_semi").withColumn("attempt", F.lit(0).cast("bigint"))
    later = fs.where(F.col("first_ok_attempt") > 0).select(F.col("block").alias("blockNumber"),
                                                          F.col("first_ok_attempt").alias("attempt"))
    retried = t.join(later, "blockNumber")
    return st.union_retry(first, retried).select("transactionHash", "blockNumber", "attempt")


@query("recovered_blocks")
def recovered_blocks(spark, sf):
    """SET-2: missing after round 0 minus missing after all rounds."""
    a = fx.attempts(spark, sf)
    before = a.where((F.col("attempt") == 0) & ~F.col("ok")).select("block")
    after = _first_success(spark, sf).where(F.col("first_ok_attempt").isNull()).select("block")
    return st.recovered_blocks(before, after)


@query("repeated_cursors")
def repeated_cursors(spark, sf):
    """SET-3: cursors seen more than once per block."""
    pages = fx.tx_pages(spark, sf)
    c = pages.select("block", "page", F.get_json_object("body", "$.nextCursor").alias("nextCursor"))
    return st.repeated_cursors(c).select("block", "nextCursor", "n_seen")


@query("holder_registry")
def holder_registry(spark, sf):
    """SET-4: snapshot rows plus new holders, tagged by origin."""
    new = jn.new_holders(_profile(spark, sf), fx.snapshot_old(spark, sf))
    reg = st.holder_registry(fx.snapshot_old(spark, sf), new, RUN_DATE)
    return reg.select("address", "note", "detected_at", "first_seen_block", "total_tx_count")


# ======================================================= 2.9 scalar fns
def _rpc_decoded(spark, sf):
    return _rpc_txs(spark, sf).select(F.col("hash").alias("transactionHash"), "*")


@query("hex_to_decimal")
def hex_to_decimal(spark, sf):
    """FN-1: wide hex wei values -> decimal(38,0) (as text)."""
    t = _rpc_decoded(spark, sf)
    return t.select("transactionHash", fn.hex_to_decimal("value").cast("string").alias("value"),
                    fn.hex_to_decimal_text("gasPrice").alias("gasPrice"))


@query("hex_to_long")
def hex_to_long(spark, sf):
    """FN-2: hex -> bigint, bad text -> null."""
    t = _rpc_decoded(spark, sf)
    return t.select("transactionHash", fn.hex_to_long("nonce").alias("nonce"), fn.hex_to_long("gas").alias("gas"),
                    fn.hex_to_long("gasPrice").alias("gasPrice"))


@query("long_to_hex")
def long_to_hex(spark, sf):
    """FN-3: block number -> '0x' hex."""
    b = fx.tx(spark, sf).select("blockNumber").distinct()
    return b.select("blockNumber", fn.long_to_hex("blockNumber").alias("block_hex"))


@query("hex_ts_to_kst")
def hex_ts_to_kst(spark, sf):
    """FN-4: block hex epoch -> KST text ('0x0' when missing)."""
    h = lsrc.rpc_block_headers(fx.rpc_block(spark, sf))
    return h.select("blockNumber", fn.hex_ts_to_kst("block_ts_hex").alias("timestamp"))


@query("epoch_to_kst")
def epoch_to_kst(spark, sf):
    """FN-5: epoch seconds -> KST text."""
    t = fx.tx(spark, sf)
    return t.select("transactionHash", fn.epoch_to_kst(fn.epoch_seconds("ts")).alias("timestamp"))


@query("epoch_ns_to_ts")
def epoch_ns_to_ts(spark, sf):
    """FN-6: epoch ns -> timestamp (seconds)."""
    s = _staging(spark, sf)
    return s.select("transactionHash", fn.epoch_ns_to_ts("timestamp").alias("timestamp"))


@query("pad_block_label")
def pad_block_label(spark, sf):
    """FN-8: 8-digit block label and zero-stripped month/day keys."""
    t = fx.tx(spark, sf).select("transactionHash", "blockNumber", *fn.kst_hour_keys("ts"))
    return t.select("transactionHash", fn.pad_block_label("blockNumber").alias("label"),
                    fn.strip_leading_zero("month").alias("month"), fn.strip_leading_zero("day").alias("day"))


@query("align_hour")
def align_hour(spark, sf):
    """FN-9: hour floor minus one hour, and the half-open slot end."""
    h = fx.hourly(spark, sf)
    a = fn.align_hour("ts")
    return h.select("transactionHash", a.alias("from_ts"), F.timestamp_add("HOUR", F.lit(1), a).alias("to_ts"))


@query("hour_series")
def hour_series(spark, sf):
    """FN-10: every hour between the first and last event."""
    return _hour_range(spark, sf)


@query("day_series")
def day_series(spark, sf):
    """FN-10: every day between the first and last order date."""
    o = fx.table(spark, sf, "orders")
    b = o.agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return b.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))


@query("decoded_to_json")
def decoded_to_json(spark, sf):
    """FN-12: decoded input serialised to JSON (non-ASCII kept), read back."""
    t = fx.tx(spark, sf)
    decoded = F.struct(
        F.lit("transfer").alias("method"),
        F.concat(F.lit("전송 "), F.col("transactionIndex").cast("string")).alias("note"),
        F.array(F.struct(F.lit("to").alias("name"), F.lit("address").alias("type"), F.col("to").alias("value")),
                F.struct(F.lit("value").alias("name"), F.lit("uint256").alias("type"),
                         F.col("value").cast("string").alias("value"))).alias("args"))
    j = t.select("transactionHash", fn.to_json_text(decoded).alias("decodedInput"))
    return j.select("transactionHash", F.get_json_object("decodedInput", "$.note").alias("note"),
                    F.json_array_length(F.get_json_object("decodedInput", "$.args")).cast("bigint").alias("n_args"),
                    F.get_json_object("decodedInput", "$.args[1].value").alias("value"))


@query("status_flag")
def status_flag(spark, sf):
    """FN-13: '0x1'/'1' -> '1', else '0'."""
    return fx.tx(spark, sf).select("transactionHash", fn.status_flag("status").alias("status"))


@query("convert_logs")
def convert_logs(spark, sf):
    """FN-14: wire logs -> typed logs (rename, decode, defaults)."""
    d = _wire_logs(spark, sf).select("transactionHash", fn.convert_logs("logs").alias("logs"))
    e = d.select("transactionHash", F.posexplode("logs").alias("pos", "l"))
    return e.select("transactionHash", F.col("pos").cast("bigint").alias("pos"),
                    F.col("l.contractAddress").alias("contractAddress"), F.col("l.blockNumber").alias("blockNumber"),
                    F.col("l.logIndex").alias("logIndex"), F.col("l.removed").alias("removed"),
                    F.size("l.topics").cast("bigint").alias("n_topics"))


@query("empty_array_to_null")
def empty_array_to_null(spark, sf):
    """FN-15: empty log arrays -> null."""
    d = _wire_logs(spark, sf).select("transactionHash", fn.empty_array_to_null(fn.convert_logs("logs")).alias("logs"))
    return d.select("transactionHash", F.col("logs").isNull().alias("logs_is_null"))


@query("shard_blocks")
def shard_blocks(spark, sf):
    """FN-17: fetch lane per block = (block + attempt) mod 4, attempt 1."""
    b = fx.tx(spark, sf).select(F.col("blockNumber").alias("block")).distinct()
    return b.select("block", fn.shard_lane("block", F.lit(1), LANES).cast("bigint").alias("lane"))


# ============================================================= 2.10 streams
def _landing_rows(spark, sf):
    return fx.hourly(spark, sf).select(*[c for c in _hourly_schema().fieldNames()])


def _files_a_batch(spark, sf):
    """Files that share a micro-batch of the landed rows, one below a million rows: no
    task writes or reads more than a bounded part of a batch."""
    return fx.table(spark, sf, "events").count() // LANDED_FILE_ROWS + 1


@query("stream_hourly_load")
def stream_hourly_load(spark, sf):
    """STR-1: two arrivals (even, then odd events); each run rebuilds the
    touched hours completely."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "stream-target", "stream-ckpt"))
    rows = _landing_rows(spark, sf)
    sch = _hourly_schema()
    ev = F.conv(F.substring("transactionHash", 3, 1), 16, 10).cast("int") % 2  # stable split of the rows
    stream.land_rows(rows.where(ev == 0), landing)
    stream.stream_hourly_load(spark, landing, sch, target, ckpt)
    stream.land_rows(rows, landing)  # the first rows land again
    stream.stream_hourly_load(spark, landing, sch, target, ckpt)
    out = spark.read.option("basePath", target).parquet(target)
    return out.select("transactionhash", "blocknumber", "transaction_from", "transaction_to",
                      F.col("value").cast("string").alias("value"), "transaction_status",
                      *_WAREHOUSE_KEYS, "transaction_timestamp")


@query("stream_hour_counts")
def stream_hour_counts(spark, sf):
    """STR-2: rows per tumbling UTC hour from the stream."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "counts", "counts-ckpt"))
    files = _files_a_batch(spark, sf)
    _landing_rows(spark, sf).repartition(3 * files).write.parquet(landing)  # unordered files, three micro-batches
    stream.stream_hour_counts(spark, landing, _hourly_schema(), target, ckpt, max_files=files)
    return stream.read_hour_counts(spark, target)


@query("late_rows_split")
def late_rows_split(spark, sf):
    """STR-3: landed slot = hour of (ts + 10 min); rows outside it are late."""
    h = fx.hourly(spark, sf)
    slotted = h.withColumn("slot_start", F.date_trunc("hour", F.timestamp_add("MINUTE", F.lit(10), "ts"))
                           .cast("timestamp_ntz"))
    return stream.late_rows_split(slotted).select("transactionHash", "slot_start", "in_slot")


@query("stream_dedupe")
def stream_dedupe(spark, sf):
    """STR-4: every file landed twice; the stream keeps one copy per hash."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "dedupe", "dedupe-ckpt"))
    rows, files = _landing_rows(spark, sf), _files_a_batch(spark, sf)
    rows.repartition(2 * files).write.mode("append").parquet(landing)
    rows.repartition(2 * files).write.mode("append").parquet(landing)  # replay
    stream.stream_dedupe(spark, landing, _hourly_schema(), target, ckpt, max_files=files, run_time=RUN_TIME)
    return stream.read_deduped(spark, target, _hourly_schema()).select("transactionHash", "ts")


@query("stream_resume")
def stream_resume(spark, sf):
    """STR-5: second run resumes from the checkpoint; rows loaded once."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "resume", "resume-ckpt"))
    rows = _landing_rows(spark, sf)
    first = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    rows.where(first).write.mode("append").parquet(landing)
    stream.stream_append(spark, landing, _hourly_schema(), target, ckpt)
    stream.stream_append(spark, landing, _hourly_schema(), target, ckpt)  # nothing new
    rows.where(~first).write.mode("append").parquet(landing)
    stream.stream_append(spark, landing, _hourly_schema(), target, ckpt)
    return spark.read.parquet(target).select("transactionHash", "year", "month", "day", "hour")


@query("recover_rounds")
def recover_rounds(spark, sf):
    """STR-6: first successful attempt per recovered block."""
    return _first_success(spark, sf).where(F.col("first_ok_attempt").isNotNull())
