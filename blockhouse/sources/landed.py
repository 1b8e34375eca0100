"""SRC-6, SRC-7, SRC-8, SRC-10: landed provider responses -> rows.

Responses are landed as one JSON text per request; each function is a
``from_json`` + ``explode`` plan, so parsing runs in the executors next to the
data and the driver never sees a record.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..schemas import PAGE, PAGE_ITEM

RPC_TX_DDL = ("struct<hash:string,transactionIndex:string,blockHash:string,blockNumber:string,"
              "from:string,to:string,value:string,input:string,nonce:string,gas:string,"
              "gasPrice:string,maxFeePerGas:string,maxPriorityFeePerGas:string,type:string,"
              "accessList:array<struct<address:string,storageKeys:array<string>>>>")
RPC_BLOCK_DDL = "struct<result:struct<number:string,timestamp:string,transactions:array<string>>>"

RPC_RECEIPT_DDL = (
    "struct<result:array<struct<transactionHash:string,gasUsed:string,cumulativeGasUsed:string,"
    "effectiveGasPrice:string,contractAddress:string,status:string,logsBloom:string,"
    f"logs:{fn.LOG_WIRE_DDL}>>>"
)


def flatten_tx_pages(pages: DataFrame, body: str = "body", keep_empty: bool = False) -> DataFrame:
    """SRC-6 + PRJ-9: one row per item with the 26 raw columns. The block time of a
    page is its first item's ``timestamp``, carried beside the explode and stamped on
    every item as KST text. ``decodedInput`` is the JSON text of what was sent, null
    when missing, null or empty (D12). Keeps the landing keys (``block``, ``page``)
    and the page's ``count`` / cursors for reconciliation. With ``keep_empty`` a page
    without items gives one row without a transaction. Columns that a caller does not
    select are pruned from the parse."""
    keys = [c for c in pages.columns if c != body]
    p = pages.select(*keys, F.from_json(F.col(body), PAGE).alias("_p"))
    rows = p.select(
        *keys, F.col("_p.count").alias("count"), F.coalesce(F.col("_p.nextCursor"), F.col("_p.cursor")).alias("nextCursor"),
        F.try_element_at(F.col("_p.items"), F.lit(1))["timestamp"].alias("block_ts"),
        (F.explode_outer if keep_empty else F.explode)("_p.items").alias("it"))
    decoded = F.col("it.decodedInput")
    item = {"timestamp": fn.epoch_to_kst("block_ts"), "decodedInput": F.when(~F.trim(decoded).isin("", "null", '""'), decoded)}
    return rows.select(*keys, "count", "nextCursor", "block_ts",
                       *[item.get(f.name, F.col(f"it.{f.name}")).alias(f.name) for f in PAGE_ITEM.fields])


def rpc_block_headers(blocks: DataFrame, body: str = "body") -> DataFrame:
    """(blockNumber, block_ts_hex) per landed block; a missing ``timestamp``
    defaults to '0x0'."""
    p = F.from_json(F.col(body), RPC_BLOCK_DDL)
    return blocks.select(
        fn.hex_to_long(p["result"]["number"]).alias("blockNumber"),
        F.coalesce(p["result"]["timestamp"], F.lit("0x0")).alias("block_ts_hex"))


def flatten_rpc_blocks(blocks: DataFrame, body: str = "body", stamp: bool = True) -> DataFrame:
    """SRC-7 + FLT-7 (+ PRJ-9 when ``stamp``): tx objects of each block; array
    elements that are not objects are dropped; a block without transactions
    gives no row. Body and elements are parsed once. Numbers stay wire text here
    (decode with FN-1/FN-2)."""
    parsed = blocks.select(F.from_json(F.col(body), RPC_BLOCK_DDL)["result"].alias("_r"))
    objects = F.filter(F.col("_r.transactions"), lambda e: F.ltrim(e).startswith("{"))           # FLT-7
    rows = parsed.select(F.coalesce(F.col("_r.timestamp"), F.lit("0x0")).alias("block_ts_hex"),
                         F.explode(F.transform(objects, lambda e: F.from_json(e, RPC_TX_DDL))).alias("t"))
    out = rows.select("t.*", "block_ts_hex")
    if stamp:
        out = out.withColumn("timestamp", fn.hex_ts_to_kst("block_ts_hex"))
    return out


def flatten_rpc_receipts(receipts: DataFrame, body: str = "body") -> DataFrame:
    """SRC-8: one row per receipt with its position in the response (``ord``),
    which the last-wins dedupe (AGG-5) orders by."""
    p = receipts.select(*[c for c in receipts.columns if c != body],
                        F.from_json(F.col(body), RPC_RECEIPT_DDL).alias("_p"))
    keep = [c for c in receipts.columns if c != body]
    r = p.select(*keep, F.posexplode("_p.result").alias("ord", "r"))
    return r.select(*keep, "ord", *[F.col(f"r.{c}").alias(c) for c in (
        "transactionHash", "gasUsed", "cumulativeGasUsed", "effectiveGasPrice", "contractAddress",
        "status", "logsBloom", "logs")])


def scan_price(responses: DataFrame, body: str = "body") -> DataFrame:
    """SRC-10 + FN-19: $.ETH.USD of the landed price responses."""
    return responses.select("price_date", fn.json_path(body, "$.ETH.USD").cast("double").alias("price_usd_raw"))


def scan_fx(responses: DataFrame, body: str = "body") -> DataFrame:
    """SRC-10 + FN-19: $.rates.KRW of the landed FX responses."""
    return responses.select("price_date", fn.json_path(body, "$.rates.KRW").cast("double").alias("fx_rate"))
