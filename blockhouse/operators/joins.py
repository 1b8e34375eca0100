"""JOIN-1..JOIN-8."""
from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as fn
from .aggregates import last_per_key


def merge_tx_receipts(txs: DataFrame, receipts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JOIN-1: block transactions x receipts on (blockNumber, hash).

    Receipts are deduplicated last-wins per hash (AGG-5, reduced map-side),
    then left-joined on (block, hash), which spreads even a huge block over
    many tasks. A block in which any transaction has no receipt fails as a
    whole: the failed blocks (block, n_unmatched) come from a partial
    aggregate over the join, and the merged rows are the join minus those
    blocks (an anti join that AQE can split when one block is hot). Both
    passes read the same two shuffles (exchange reuse). ``type`` stays as
    sent; numbers are decoded to text (FN-1).
    """
    t = txs.withColumn("blockNumber", fn.hex_to_long("blockNumber"))
    r = last_per_key(receipts, ["blockNumber", "transactionHash"], "ord")
    r = r.select("blockNumber", F.col("transactionHash").alias("hash"), F.lit(True).alias("_matched"),
                 *[F.col(c).alias(f"r_{c}") for c in (
                     "gasUsed", "cumulativeGasUsed", "effectiveGasPrice", "contractAddress",
                     "status", "logsBloom", "logs")])
    j = t.join(r, ["blockNumber", "hash"], "left")
    failed = (j.groupBy("blockNumber")
              .agg(F.sum(F.col("_matched").isNull().cast("bigint")).alias("n_unmatched"))
              .where(F.col("n_unmatched") > 0))
    ok = j.join(failed.select("blockNumber"), "blockNumber", "left_anti")
    dec = fn.hex_to_decimal_text
    merged = ok.select(
        F.col("hash").alias("transactionHash"), dec("transactionIndex").alias("transactionIndex"),
        "blockHash", F.col("blockNumber").cast("string").alias("blockNumber"), "from", "to",
        dec("value").alias("value"), "input", dec("nonce").alias("nonce"), dec("gas").alias("gas"),
        dec("gasPrice").alias("gasPrice"), dec("maxFeePerGas").alias("maxFeePerGas"),
        dec("maxPriorityFeePerGas").alias("maxPriorityFeePerGas"), "type", "timestamp",
        fn.default_array("accessList", "struct<address:string,storageKeys:array<string>>").alias("accessList"),
        dec("r_gasUsed").alias("gasUsed"), dec("r_cumulativeGasUsed").alias("cumulativeGasUsed"),
        dec("r_effectiveGasPrice").alias("effectGasPrice"), F.col("r_contractAddress").alias("contractAddress"),
        dec("r_status").alias("status"), F.col("r_logsBloom").alias("logsBloom"),
        fn.convert_logs(F.coalesce("r_logs", F.array().cast(fn.LOG_WIRE_DDL))).alias("logs"),
    )
    return merged, failed


MAX_BUCKETS = 4_096          # base buckets of an as-of join
_SUB = 1 << 20               # sub-buckets a base bucket can have
_GROUP = 64                  # base buckets in a group of the carry


def _div(a, b):
    """Whole quotient of non-negative bigints, exact beyond a double's digits."""
    whole = (a - a % b).cast("decimal(20,0)") / (F.lit(b) if isinstance(b, int) else b).cast("decimal(20,0)")
    return whole.cast("bigint")


def _buckets(u: DataFrame, rows_per_bucket: int) -> DataFrame:
    """``u`` with ``_bid``, a bucket number that grows with ``_t`` and depends on its
    value alone: equal spans of time, those with many rows cut into finer ones."""
    r = u.agg(F.min("_t").alias("lo"), F.max("_t").alias("hi"), F.count("_t").alias("n")).first()
    if r["lo"] is None:
        return u.withColumn("_bid", F.lit(None).cast("bigint"))
    parts = int(u.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = (r["hi"] - r["lo"]) // timedelta(microseconds=1) + 1
    width = span // min(MAX_BUCKETS, max(parts, r["n"] // rows_per_bucket + 1)) + 1
    at = F.timestamp_diff("MICROSECOND", F.lit(r["lo"]).cast("timestamp_ntz"), F.col("_t"))
    u = u.withColumn("_base", _div(at, width))
    dense = u.groupBy("_base").count().where(F.col("count") > 2 * rows_per_bucket).collect()  # MAX_BUCKETS rows at most
    fine = F.lit(width)
    if dense:
        sizes = [(x["_base"], max(1, width // min(_SUB, x["count"] // rows_per_bucket + 1))) for x in dense if x["_base"] is not None]
        u = u.join(F.broadcast(u.sparkSession.createDataFrame(sizes, "_base bigint, _fine bigint")), "_base", "left")
        fine = F.coalesce(F.col("_fine"), F.lit(width))
    sub = F.least(_div(at % width, fine), F.lit(_SUB - 1))
    return u.withColumn("_bid", F.col("_base") * _SUB + sub).drop("_base", "_fine")


def asof_block(blocks: DataFrame, targets: DataFrame, closest: str = "before",
               block: str = "block", ts: str = "ts", target: str = "target_ts",
               rows_per_bucket: int = 1 << 20) -> DataFrame:
    """JOIN-3: for each target time the block nearest to it on one side.
    ``before``: latest block with ts <= target (ties -> higher block);
    ``after``: earliest block with ts >= target (ties -> lower block).

    No inequality join: targets and blocks are unioned and dealt into time buckets
    that depend on the values alone (dense spans are cut finer; blocks of one time
    are first reduced to the one that wins), and a running ``last(ignorenulls)``
    inside each bucket finds the nearest block. Targets before the first block of
    their bucket take the last block of the buckets before it: from their group of
    buckets, else from the groups before. Targets are shuffled once, by bucket;
    blocks also by time, after map-side reduction, so that a time that very many
    blocks share is one row; the carry holds one row per bucket. A target without a
    time has no block."""
    before = closest == "before"
    pick = F.max if before else F.min
    b = (blocks.where(F.col(ts).isNotNull()).groupBy(F.col(ts).cast("timestamp_ntz").alias("_t")).agg(pick(block).alias("_b")))
    t = targets.select(F.col(target).cast("timestamp_ntz").alias("_t"), F.lit(None).cast(b.schema["_b"].dataType).alias("_b"))
    u = _buckets(b.withColumn("_is_block", F.lit(True)).unionByName(t.withColumn("_is_block", F.lit(False))), rows_per_bucket)

    def order(*cols):  # at equal times a block comes before the target
        return [*[F.col(c).asc() if before else F.col(c).desc() for c in cols]]

    w = Window.partitionBy("_bid").orderBy(*order("_t"), F.col("_is_block").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = (u.withColumn("_near", F.last("_b", ignorenulls=True).over(w)).where(~F.col("_is_block"))
           .select(F.col("_t").alias(target), "_bid", "_near"))
    far = F.max_by if before else F.min_by
    edge = u.where("_bid IS NOT NULL").groupBy("_bid").agg(far("_b", F.when(F.col("_is_block"), F.col("_t"))).alias("_edge"))
    edge = edge.withColumn("_group", _div(F.col("_bid"), _SUB * _GROUP))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inner = F.last("_edge", ignorenulls=True).over(earlier(Window.partitionBy("_group").orderBy(*order("_bid"))))
    groups = edge.groupBy("_group").agg(far("_edge", F.when(F.col("_edge").isNotNull(), F.col("_bid"))).alias("_last"))
    outer = F.last("_last", ignorenulls=True).over(earlier(Window.orderBy(*order("_group"))))  # MAX_BUCKETS / _GROUP rows
    groups = groups.select("_group", outer.alias("_outer"))
    carry = edge.withColumn("_inner", inner).join(groups, "_group").select("_bid", F.coalesce("_inner", "_outer").alias("_carry"))
    return hit.join(carry, "_bid", "left").select(target, F.coalesce("_near", "_carry").alias(block))


def join_block_header(txs: DataFrame, headers: DataFrame, key: str = "blockNumber") -> DataFrame:
    """JOIN-4: header time onto its transactions (equi join). Always a merge join:
    Spark plans with an exploded side as small as the responses it came from, and
    would broadcast all transactions through the driver."""
    return txs.join(headers.hint("merge"), key, "inner")


def join_price_fx(prices: DataFrame, rates: DataFrame) -> DataFrame:
    """JOIN-5: the FX rate of the date onto its price; a price without a rate stays."""
    return prices.join(rates, "price_date", "left")


def daily_price(prices: DataFrame, digits: int = 4) -> DataFrame:
    """FN-11: price and FX rate of a date -> one record (KRW null without a rate)."""
    return prices.select(
        F.col("price_date").cast("string").alias("price_date"),
        fn.price_usd("price_usd_raw", digits).alias("price_usd"),
        fn.price_krw("price_usd_raw", "fx_rate", digits).alias("price_krw"))


def block_range(spark: SparkSession, low: int, high: int, name: str = "block") -> DataFrame:
    """Expected blocks [low, high] as a distributed range (no driver list)."""
    n = max(1, min(spark.sparkContext.defaultParallelism * 4, (high - low) // 100_000 + 1))
    return spark.range(low, high + 1, 1, n).withColumnRenamed("id", name)


def missing_blocks(expected: DataFrame, present: DataFrame, key: str = "block") -> DataFrame:
    """JOIN-6: expected minus present (an empty block counts as present)."""
    return expected.join(present.select(key), key, "left_anti")


def retry_subset(df: DataFrame, retry: DataFrame, key: str = "block", df_key: str = "blockNumber") -> DataFrame:
    """JOIN-7: only the rows of listed blocks."""
    return df.join(retry.select(F.col(key).alias(df_key)), df_key, "left_semi")


def new_holders(profile: DataFrame, snapshot: DataFrame, key: str = "address") -> DataFrame:
    """JOIN-8: active addresses absent from the holder snapshot."""
    return profile.join(snapshot.select(key), key, "left_anti")


def _block_side(blocks: DataFrame, body: str, key: Column | None) -> DataFrame:
    """Parsed blocks by ``key``, without one by the number in the body."""
    from ..sources.landed import RPC_BLOCK_DDL, RPC_TX_DDL
    named = [] if key is None else [key.alias("_block")]
    parsed = blocks.select(*named, F.from_json(F.col(body), RPC_BLOCK_DDL)["result"].alias("_r"))  # parsed once
    p = F.col("_r")
    objects = F.filter(p["transactions"], lambda e: F.ltrim(e).startswith("{"))          # FLT-7
    return parsed.select(
        "_block" if named else fn.hex_to_long(p["number"]).alias("_block"),
        F.coalesce(p["timestamp"], F.lit("0x0")).alias("block_ts_hex"),
        F.transform(objects, lambda e: F.from_json(e, RPC_TX_DDL)).alias("_txs"))


def _receipt_side(receipts: DataFrame, body: str, key: str) -> DataFrame:
    from ..sources.landed import RPC_RECEIPT_DDL
    arr = F.from_json(F.col(body), RPC_RECEIPT_DDL)["result"]
    tagged = F.transform(arr, lambda r, i: F.struct(r["transactionHash"].alias("h"), i.alias("pos"), r.alias("r")))
    # the sorted array is a column of its own: a lambda that referenced the
    # expression would re-evaluate it per element
    tagged = F.filter(tagged, lambda x: x["h"].isNotNull())  # a receipt without a hash matches nothing
    s = receipts.select(F.col(key).alias("_block"), F.array_sort(tagged).alias("_s"))
    c = F.col("_s")
    last = F.filter(c, lambda x, i: (i == F.size(c) - 1) | (F.element_at(c, i + 2)["h"] != x["h"]))
    return s.select("_block", F.map_from_entries(F.transform(last, lambda x: F.struct(x["h"], x["r"]))).alias("_rmap"))


def latest_landing(responses: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the latest landed response per block (by ``order``, e.g. the
    landing time); a partial aggregate, so repeats reduce map-side."""
    return last_per_key(responses, [key], order)


def merge_block_responses(blocks: DataFrame, receipts: DataFrame, body: str = "body",
                          receipt_key: str = "blockNumber",
                          landing_order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """JOIN-1 on landed per-block responses (one block response and one
    receipts response per block).

    The two responses of a block are joined on the block number -- one row
    per block on each side, so no key can be hot -- and the rest happens
    inside the joined row with higher-order functions: receipts sorted by
    (hash, position) keep the last per hash (the dict build), a hash ->
    receipt map matches every transaction, and the block fails as a whole
    when any transaction has no receipt (or the receipts response is
    missing, or the block response itself has no result). No
    per-transaction shuffle; extra receipts are ignored. Same output as
    ``merge_tx_receipts``. Both sides are keyed by the landing key column
    (``receipt_key``, the requested block) where present. With
    ``landing_order`` a block landed several times keeps its latest response
    on each side; without it one response per block and side is assumed."""
    if landing_order:
        blocks = latest_landing(blocks, receipt_key, landing_order)
        receipts = latest_landing(receipts, receipt_key, landing_order)
    r = _receipt_side(receipts, body, receipt_key)
    sides = [_block_side(blocks, body, None)]
    if receipt_key in blocks.columns:
        # the key as it stands: blocks that were dealt by it are not shuffled again as
        # parsed texts, as a key that may come from the body would need
        key = F.col(receipt_key).cast("bigint")
        sides = [_block_side(blocks.where(key.isNotNull()), body, key), _block_side(blocks.where(key.isNull()), body, None)]
    j = reduce(DataFrame.unionByName, [side.join(r, "_block", "left") for side in sides])
    j = j.select("_block", "block_ts_hex", F.transform("_txs", lambda t: F.struct(
        t.alias("t"), F.try_element_at(F.col("_rmap"), t["hash"]).alias("r"))).alias("_m"))
    j = j.withColumn("_unmatched", F.size(F.filter("_m", lambda x: x["r"].isNull())).cast("bigint"))
    # a block response without a result (failed fetch) fails the block too
    # (n_unmatched is null: its transactions are unknown)
    failed = j.where((F.col("_unmatched") > 0) | F.col("_m").isNull()).select(
        F.col("_block").alias("blockNumber"), F.when(F.col("_m").isNotNull(), F.col("_unmatched")).alias("n_unmatched"))
    rows = j.where(F.col("_unmatched") == 0).select("block_ts_hex", F.explode("_m").alias("x"))
    t, r = F.col("x.t"), F.col("x.r")
    dec = fn.hex_to_decimal_text
    merged = rows.select(
        t["hash"].alias("transactionHash"), dec(t["transactionIndex"]).alias("transactionIndex"),
        t["blockHash"].alias("blockHash"), fn.hex_to_long(t["blockNumber"]).cast("string").alias("blockNumber"),
        t["from"].alias("from"), t["to"].alias("to"), dec(t["value"]).alias("value"), t["input"].alias("input"),
        dec(t["nonce"]).alias("nonce"), dec(t["gas"]).alias("gas"), dec(t["gasPrice"]).alias("gasPrice"),
        dec(t["maxFeePerGas"]).alias("maxFeePerGas"), dec(t["maxPriorityFeePerGas"]).alias("maxPriorityFeePerGas"),
        t["type"].alias("type"), fn.hex_ts_to_kst("block_ts_hex").alias("timestamp"),
        fn.default_array(t["accessList"], "struct<address:string,storageKeys:array<string>>").alias("accessList"),
        dec(r["gasUsed"]).alias("gasUsed"), dec(r["cumulativeGasUsed"]).alias("cumulativeGasUsed"),
        dec(r["effectiveGasPrice"]).alias("effectGasPrice"), r["contractAddress"].alias("contractAddress"),
        dec(r["status"]).alias("status"), r["logsBloom"].alias("logsBloom"),
        fn.convert_logs(F.coalesce(r["logs"], F.array().cast(fn.LOG_WIRE_DDL))).alias("logs"),
    )
    return merged, failed
