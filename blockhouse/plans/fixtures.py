"""Ledger views over the driver tables (FIXTURES.md §3).

Each view is a lazy DataFrame derived from a driver table, so every query built
on it reads the whole table and its work grows with the scale factor. Grouping
happens only on keys whose groups are bounded by construction: a block holds at
most 50 transactions, a page 20 items, a holder page 100 rows, and the logs of a
transaction are the line items of one order.
"""
from __future__ import annotations

import functools
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .. import functions as fn
from ..schemas import LOG_26
from ..session import shared_root

# Fixed binding parameters (FIXTURES.md §3).
TX_PER_BLOCK = 50
TX_PAGE_SIZE = 20
EVENTS_PER_BLOCK = 5
HOLDER_PAGE_ROWS = 100
ADDRESS_SPACE = 1500
ATTEMPTS = 5


LANDING_VERSION = "9"
LANDED_FROM = ("orders", "lineitem", "events", "customer", "pages")


def input_identity(spark: SparkSession, sf_dir: str) -> str:
    """Changes when any file of the tables that landings derive from is added,
    removed or rewritten: one sum over (path, size, modification time). Only the
    listing is read, no content."""
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in LANDED_FROM]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    r = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{r[0]}|{r[1]}"


def landed(name: str, partition_by: list[str] | None = None, fmt: str = "parquet", view: bool = False, dealt: bool = False, **options: str):
    """Land a derived table once per state of the driver tables (their files' names,
    sizes and modification times are part of the key, so a table that grew is
    landed anew): written as Parquet
    under the shared ``spark.checkpoint.dir`` (a marker is committed after the
    data, so a half-written landing is never read) and read back by every
    later query. This is the landing step of the provider responses and of
    the lake tables that scans and loads start from; queries then time their
    own operators, not the synthesis of their input. ``.path(spark, sf)``
    returns the data folder (partitioned by ``partition_by``). With ``view`` callers
    read the rows as they are built, and only ``.path`` writes them: long response
    texts then take neither a shuffle nor a file. Files hold what the last stage of
    the build gives a task, in Zstandard (the texts are mostly hex); partitions are
    dealt here unless the build has ``dealt`` and sorted its rows by them."""
    if fmt == "parquet":
        options.setdefault("compression", "zstd")

    def deco(build):
        def path(spark: SparkSession, sf_dir: str) -> str:
            import uuid
            from ..sinks.tables import try_read
            key = hashlib.sha1(f"{LANDING_VERSION}|{sf_dir.rstrip('/')}|{input_identity(spark, sf_dir)}".encode()).hexdigest()[:16]
            base = f"{shared_root(spark)}/blockhouse/landed/{key}/{name}"
            marker = try_read(spark, f"{base}/_done")
            if marker is not None:
                return marker.first()["data"]
            # each writer lands into its own folder and then publishes it, so
            # concurrent or interrupted landings never mix files
            data = f"{base}/data-{uuid.uuid4().hex[:12]}"
            df = build(spark, sf_dir)
            df = df.hint("rebalance", *partition_by) if partition_by and not dealt else df
            w = df.write.partitionBy(*partition_by) if partition_by else df.write
            w.mode("errorifexists").options(**options).format(fmt).save(data)
            spark.createDataFrame([(data,)], "data string").coalesce(1).write.mode("overwrite").parquet(f"{base}/_done")
            return data

        @functools.wraps(build)
        def get(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(spark, sf_dir) if view else spark.read.format(fmt).load(path(spark, sf_dir))
        get.build = build
        get.path = path
        return get
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ROWS_A_TASK = 250_000  # narrow rows that one task turns into response texts


def tasks(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """How many tasks share the rows of these tables when they become long texts. The
    number grows with the tables: by the size of the narrow rows that were shuffled,
    AQE would give a task more text than its memory holds."""
    rows = sum(table(spark, sf_dir, n).count() for n in names)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // ROWS_A_TASK + 1)


def orders_by_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` dealt by block: what a block's texts need is shuffled before they are built."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return o.withColumn("blockNumber", F.expr(f"o_orderkey div {TX_PER_BLOCK}")).repartition(tasks(spark, sf_dir, "orders", "lineitem"), "blockNumber")


def address(c) -> Column:
    """20-byte address text from an integer id."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(c.cast("bigint"))), 40, "0"))


def hash_of(c, prefix: str = "") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string") if not prefix else F.concat(F.lit(prefix), c.cast("string"))
    return F.concat(F.lit("0x"), F.sha2(text, 256))


# --------------------------------------------------------------------------- tx
def tx(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One transaction per order (typed). ``orders``: its rows as a caller joined or
    dealt them, whose columns ``keep`` stay; a ``blockNumber`` it holds is used."""
    o = table(spark, sf_dir, "orders") if orders is None else orders
    block = F.col("blockNumber") if "blockNumber" in o.columns else F.expr(f"o_orderkey div {TX_PER_BLOCK}")
    gas_price = F.round(F.col("o_totalprice")).cast("bigint") * F.lit(1_000_000_000)
    return o.select(
        hash_of("o_orderkey").alias("transactionHash"),
        F.expr(f"o_orderkey % {TX_PER_BLOCK}").alias("transactionIndex"),
        hash_of(block, "block-").alias("blockHash"),
        block.alias("blockNumber"),
        address("o_custkey").alias("from"),
        address(F.expr(f"(o_custkey * 7 + 1) % {ADDRESS_SPACE}")).alias("to"),
        (F.round(F.col("o_totalprice") * 100).cast("decimal(20,0)")
         * F.lit(10 ** 18).cast("decimal(19,0)")).cast("decimal(38,0)").alias("value"),
        F.lit("0x").alias("input"),
        F.expr("o_orderkey % 1000").alias("nonce"),
        F.expr("21000 + o_orderkey % 1000").alias("gas"),
        gas_price.alias("gasPrice"),
        (gas_price + F.lit(2_000_000_000)).alias("maxFeePerGas"),
        F.expr("1000000000 + (o_orderkey % 7) * 100000000").alias("maxPriorityFeePerGas"),
        F.lit("0x2").alias("type"),
        F.when(F.col("o_orderstatus") == "F", "0x1").otherwise("0x0").alias("status"),
        F.timestamp_add("SECOND", F.expr("o_orderkey % 86400"), F.col("o_orderdate").cast("timestamp_ntz")).alias("ts"),
        F.col("o_orderkey"),
        F.col("o_custkey"),
        *[c for c in keep if c != "o_custkey"],
    )


def tx_raw(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``tx`` as the all-text 23-column raw schema (FIXTURES 1.2), plus the
    order key for the variant split. gas is '' for o_orderkey % 9 = 0 and the
    KST timestamp text is '' for o_orderkey % 10 = 0."""
    t = tx(spark, sf_dir, orders, keep)
    s = lambda c: F.col(c).cast("string")
    return t.select(
        "transactionHash", s("transactionIndex").alias("transactionIndex"), "blockHash",
        s("blockNumber").alias("blockNumber"), "from", "to", s("value").alias("value"), "input",
        s("nonce").alias("nonce"),
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("")).otherwise(s("gas")).alias("gas"),
        s("gasPrice").alias("gasPrice"), s("maxFeePerGas").alias("maxFeePerGas"),
        s("maxPriorityFeePerGas").alias("maxPriorityFeePerGas"),
        F.expr("cast(21000 + o_orderkey % 500 as string)").alias("gasUsed"),
        F.expr("cast(o_orderkey * 21000 as string)").alias("cumulativeGasUsed"),
        s("gasPrice").alias("effectGasPrice"),
        F.lit(None).cast("string").alias("contractAddress"),
        "type", "status", F.lit("0x00").alias("logsBloom"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("")).otherwise(fn.kst_text("ts")).alias("timestamp"),
        "o_orderkey",
        *keep,
    )


def tx_raw_variants(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two file versions of the raw rows: even orders keep ``maxFeePerGas``,
    odd orders come from an older writer without it and with one extra,
    undeclared column."""
    r = tx_raw(spark, sf_dir)
    with_fee = r.where(F.col("o_orderkey") % 2 == 0).drop("o_orderkey")
    without_fee = (r.where(F.col("o_orderkey") % 2 == 1).drop("o_orderkey", "maxFeePerGas")
                   .withColumn("legacyField", F.lit("x")))
    return with_fee, without_fee


# ------------------------------------------------------------------------- logs
RECEIPT_ORDINAL = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def line_fields(*more: str) -> Column:
    """A line item as the few numbers that its log and its receipt derive from."""
    return F.struct(*RECEIPT_ORDINAL, "l_returnflag", *more)


def logs_text(key: Column, block: Column, items: Column) -> Column:
    """An order's line items (``line_fields``) as a wire-format log array ordered by the
    receipt ordinal; ``removed`` is absent for line 2 and ``topics`` for line 3; '[]'
    without line items, null for null."""
    hexs = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    log = lambda i: F.struct(
        address(i["l_suppkey"]).alias("address"),
        hash_of(key).alias("transactionHash"),
        hexs(key % TX_PER_BLOCK).alias("transactionIndex"),
        hash_of(block, "block-").alias("blockHash"),
        hexs(block).alias("blockNumber"),
        hexs(F.round(i["l_extendedprice"] * 100).cast("bigint")).alias("data"),
        hexs(i["l_linenumber"].cast("bigint")).alias("logIndex"),
        F.when(i["l_linenumber"] != 2, i["l_returnflag"] == "R").alias("removed"),
        F.when(i["l_linenumber"] != 3, F.array(hash_of(i["l_partkey"]), hash_of(i["l_suppkey"]))).alias("topics"),
    )
    ordered = F.sort_array(F.transform(items, lambda i: F.struct(*[i[c].alias(c) for c in RECEIPT_ORDINAL], log(i).alias("log"))))
    return F.when(items.isNotNull(), F.coalesce(F.to_json(F.transform(ordered, lambda x: x["log"])), F.lit("[]")))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, items): the line items of an order, as ``line_fields``. The joins that
    need an order's logs shuffle these, and the texts (``order_logs_text``) come after,
    in as many tasks (merge joins: a broadcast would leave all texts to the tasks that
    scan orders)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", line_fields().alias("item"))
    per_order = (li.repartition(tasks(spark, sf_dir, "orders", "lineitem"), "l_orderkey").groupBy("l_orderkey")
                 .agg(F.collect_list("item").alias("items")).withColumnRenamed("l_orderkey", "o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    none = F.array().cast(per_order.schema["items"].dataType)
    joined = orders.join(per_order.hint("merge"), "o_orderkey", "left")
    return joined.select("o_orderkey", F.coalesce("items", none).alias("items")).hint("merge")


def order_logs_text(items: str = "items") -> Column:
    return logs_text(F.col("o_orderkey"), F.expr(f"o_orderkey div {TX_PER_BLOCK}"), F.col(items))


@landed("logs_wire", view=True)
def logs_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, logs_json): the wire-format logs of every order (``logs_text``)."""
    return order_items(spark, sf_dir).select("o_orderkey", order_logs_text().alias("logs_json"))


def tx_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw 23-column rows with typed nested ``logs`` and ``accessList``
    (accessList null for o_orderkey % 4 = 0, else one entry)."""
    joined = table(spark, sf_dir, "orders").join(order_items(spark, sf_dir), "o_orderkey", "left")
    access = F.when(F.col("o_orderkey") % 4 != 0, F.array(F.struct(
        F.col("to").alias("address"), F.array(hash_of("o_orderkey", "slot-")).alias("storageKeys"))))
    return (tx_raw(spark, sf_dir, joined, ("items",))
            .withColumn("accessList", access)
            .withColumn("logs", fn.convert_logs(F.from_json(order_logs_text(), fn.LOG_WIRE_DDL)))
            .drop("items"))


# -------------------------------------------------------------- RPC envelopes
def _json_array(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


@landed("rpc_block", view=True)
def rpc_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(blockNumber, body): one eth_getBlockByNumber response per block. All
    numbers hex; ``gas`` is the bad text '0xzz' for o_orderkey % 9 = 0;
    ``accessList`` absent for o_orderkey % 4 = 0; block ``timestamp`` (the
    earliest tx time of the block) absent when block % 23 = 0; blocks with
    block % 19 = 0 also list one bare hash string (not an object)."""
    t = tx(spark, sf_dir, orders_by_block(spark, sf_dir))
    hexs = fn.long_to_hex
    tx_obj = F.to_json(F.struct(
        F.col("transactionHash").alias("hash"), hexs("transactionIndex").alias("transactionIndex"),
        "blockHash", hexs("blockNumber").alias("blockNumber"), "from", "to",
        fn.decimal_to_hex("value").alias("value"), "input", hexs("nonce").alias("nonce"),
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("0xzz")).otherwise(hexs("gas")).alias("gas"),
        hexs("gasPrice").alias("gasPrice"), hexs("maxFeePerGas").alias("maxFeePerGas"),
        hexs("maxPriorityFeePerGas").alias("maxPriorityFeePerGas"), "type",
        F.when(F.col("o_orderkey") % 4 != 0, F.array(F.struct(
            F.col("to").alias("address"),
            F.array(hash_of("o_orderkey", "slot-")).alias("storageKeys")))).alias("accessList"),
    ))
    blocks = t.groupBy("blockNumber").agg(
        F.min("ts").alias("block_ts"),
        F.sort_array(F.collect_list(F.struct("transactionIndex", tx_obj.alias("j")))).alias("txs"))
    items = F.transform("txs", lambda x: x["j"])
    extra = F.concat(F.lit('"'), hash_of("blockNumber", "orphan-"), F.lit('"'))
    items = F.when(F.col("blockNumber") % 19 == 0, F.concat(items, F.array(extra))).otherwise(items)
    ts_part = F.when(F.col("blockNumber") % 23 != 0, F.concat(
        F.lit('"timestamp":"'), hexs(fn.epoch_seconds("block_ts")), F.lit('",'))).otherwise(F.lit(""))
    body = F.concat(
        F.lit('{"jsonrpc":"2.0","id":1,"result":{"number":"'), hexs("blockNumber"), F.lit('",'),
        ts_part, F.lit('"transactions":'), _json_array(items), F.lit("}}"))
    return blocks.select("blockNumber", body.alias("body"))


@landed("rpc_receipt", view=True)
def rpc_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(blockNumber, body): one eth_getBlockReceipts response per block, one
    receipt per line item (so an order has duplicate receipts; the last by the
    ordinal wins). Only the last duplicate carries the order's logs, earlier
    ones carry '[]'; orders without line items have no receipt. Line items and order
    keys are dealt by block once, as numbers; the texts are built after that."""
    block = f"{{}} div {TX_PER_BLOCK} AS blockNumber"
    li = table(spark, sf_dir, "lineitem").select(F.expr(block.format("l_orderkey")), "l_orderkey", line_fields("l_quantity", "l_discount").alias("item"))
    keys = table(spark, sf_dir, "orders").select(F.expr(block.format("o_orderkey")), F.col("o_orderkey").alias("l_orderkey"))
    ordinal = lambda i: [i[c].alias(c) for c in RECEIPT_ORDINAL]
    rows = li.unionByName(keys, allowMissingColumns=True).repartition(tasks(spark, sf_dir, "orders", "lineitem"), "blockNumber")
    orders = rows.groupBy("blockNumber", "l_orderkey").agg(
        F.collect_list("item").alias("items"), F.max(F.when(F.col("item").isNotNull(), F.struct(*ordinal(F.col("item"))))).alias("last"),
        F.count(F.when(F.col("item").isNull() & F.col("l_orderkey").isNotNull(), 1)).alias("n_orders"))
    blocks = (orders.where(F.size("items") > 0).groupBy("blockNumber")
              .agg(F.collect_list(F.struct("l_orderkey", "items", "last", "n_orders")).alias("orders")))
    hexs = fn.long_to_hex

    def receipt(o: Column, i: Column) -> Column:
        logs = F.when(F.struct(*ordinal(i)) != o["last"], F.lit("[]")).when(o["n_orders"] > 0, logs_text(o["l_orderkey"], F.col("blockNumber"), o["items"]))
        j = F.concat(
            F.lit('{"transactionHash":"'), hash_of(o["l_orderkey"]),
            F.lit('","gasUsed":"'), hexs(F.round(i["l_extendedprice"]).cast("bigint")),
            F.lit('","cumulativeGasUsed":"'), hexs(F.round(i["l_extendedprice"] * i["l_quantity"]).cast("bigint")),
            F.lit('","effectiveGasPrice":"'), hexs(F.round(i["l_extendedprice"] * (1 - i["l_discount"])).cast("bigint")),
            F.lit('","contractAddress":null,"status":"'),
            F.when(i["l_linenumber"] % 2 == 1, F.lit("0x1")).otherwise(F.lit("0x0")),
            F.lit('","logsBloom":"0x00","logs":'), logs, F.lit("}"),
        )
        return F.struct((o["l_orderkey"] % TX_PER_BLOCK).alias("txi"), *ordinal(i), j.alias("j"))

    # an order key that comes several times in orders gives its receipts as often
    rs = F.flatten(F.transform("orders", lambda o: F.flatten(F.array_repeat(
        F.transform(o["items"], lambda i: receipt(o, i)), F.greatest(o["n_orders"], F.lit(1)).cast("int")))))
    body = F.concat(F.lit('{"jsonrpc":"2.0","id":1,"result":'),
                    _json_array(F.transform(F.sort_array(rs), lambda x: x["j"])), F.lit("}"))
    return blocks.select("blockNumber", body.alias("body"))


def page_item(k: Column, page: Column) -> Column:
    """JSON text of a page item with the 26 raw columns. What the row does not hold
    derives from its number ``k``: no functionSelector unless k % 3 = 0, no
    maxFeePerGas and accessList when k % 4 = 0, an authorizationList when k % 5 = 0,
    k % 3 logs (every odd one decoded), which pages after the first leave out, and
    decodedInput an object (k % 3 = 0), "" (k % 6 = 2), null (k % 6 = 5) or missing."""
    text = lambda c: c.cast("string")
    gas_price = (k % 50 + 1) * F.lit(1_000_000_000)
    block_hash = hash_of("blockNumber", "block-")
    log = lambda i: F.struct(
        address(k + i).alias("contractAddress"), F.col("transactionHash"), F.col("transactionIndex").cast("bigint").alias("transactionIndex"),
        block_hash.alias("blockHash"), F.col("blockNumber"), F.concat(F.lit("0x"), F.lower(F.hex(k * i))).alias("data"), i.alias("logIndex"),
        (i % 2 == 0).alias("removed"), F.array(hash_of(k + i, "topic-")).alias("topics"),
        F.when(i % 2 == 1, F.struct(
            F.lit("Transfer").alias("name"), F.lit("event Transfer(address,uint256)").alias("eventFragment"),
            F.lit("Transfer(address,uint256)").alias("signature"), hash_of(k, "event-").alias("eventHash"),
            F.array(F.struct(F.lit("to").alias("name"), F.lit("address").alias("type"), F.col("to").alias("value")),
                    F.struct(F.lit("value").alias("name"), F.lit("uint256").alias("type"), text(k * i).alias("value"))).alias("args"))).alias("decodedLog"))
    logs = F.when(k % 3 == 0, F.array().cast(ArrayType(LOG_26))).otherwise(F.transform(F.sequence(F.lit(1).cast("bigint"), k % 3), log))
    j = F.to_json(F.struct(
        "transactionHash", "transactionIndex", block_hash.alias("blockHash"), "blockNumber", "from", "to", text(F.col("value")).alias("value"),
        F.lit("0x").alias("input"), F.when(k % 3 == 0, F.lit("0xa9059cbb")).alias("functionSelector"), text(k % 1000).alias("nonce"),
        text(k % 1000 + 21000).alias("gas"), text(gas_price).alias("gasPrice"),
        F.when(k % 4 != 0, text(gas_price + 2_000_000_000)).alias("maxFeePerGas"), F.lit("1000000000").alias("maxPriorityFeePerGas"),
        text(k % 500 + 21000).alias("gasUsed"), text(k * 21000).alias("cumulativeGasUsed"), text(gas_price).alias("effectGasPrice"),
        F.lit("2").alias("type"), F.when(k % 7 == 0, F.lit("0")).otherwise(F.lit("1")).alias("status"), F.lit("0x00").alias("logsBloom"),
        fn.epoch_seconds("ts").alias("timestamp"),
        F.when(k % 4 != 0, F.array(F.struct(F.col("to").alias("address"), F.array(hash_of(k, "slot-")).alias("storageKeys")))).alias("accessList"),
        F.when(k % 5 == 0, F.array(F.struct(F.lit("0x1").alias("chainId"), text(k % 1000).alias("nonce"), F.col("from").alias("address"),
                                            F.lit("0x0").alias("yParity"), hash_of(k, "r-").alias("r"), hash_of(k, "s-").alias("s")))).alias("authorizationList"),
        F.when(page == 0, logs).alias("logs")))
    sent = F.concat(F.lit('{"method":"transfer","note":"전송 '), text(k), F.lit('","args":[{"name":"to","value":"'), F.col("to"), F.lit('"}]}'))
    decoded = F.when(k % 3 == 0, sent).when(k % 6 == 2, F.lit('""')).when(k % 6 == 5, F.lit("null"))
    return F.when(decoded.isNull(), j).otherwise(F.concat(F.left(j, F.length(j) - 1), F.lit(',"decodedInput":'), decoded, F.lit("}")))


@landed("hour_pages", view=True)
def hour_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(block, page, body): one page of 26-column items per block of ``hourly``; blocks
    with block % 7 = 0 were fetched again (page 1, the same items without logs)."""
    k = F.expr(f"blockNumber * {EVENTS_PER_BLOCK} + transactionIndex")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    e = e.withColumn("blockNumber", F.expr(f"event_id div {EVENTS_PER_BLOCK}")).repartition(tasks(spark, sf_dir, "events"), "blockNumber")
    h = hourly(spark, sf_dir, e).withColumn("page", F.explode(F.when(F.col("blockNumber") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    pages = h.groupBy("blockNumber", "page").agg(F.sort_array(F.collect_list(F.struct("transactionIndex", page_item(k, F.col("page")).alias("j")))).alias("its"))
    body = F.concat(F.lit('{"items":'), _json_array(F.transform("its", lambda x: x["j"])), F.lit(',"count":'), F.size("its").cast("string"), F.lit("}"))
    return pages.select(F.col("blockNumber").alias("block"), F.col("page").cast("bigint").alias("page"), body.alias("body"))


@landed("tx_pages", view=True)
def tx_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(block, page, body): paged getTransactionsInBlock responses, 20 items
    (``page_item``) a page; ``count`` = txs in the block; ``nextCursor`` on every page but the
    last (it repeats inside blocks with block % 4 = 0); pages with
    (block + page) % 17 = 0 were never landed."""
    n = F.count(F.lit(1)).over(Window.partitionBy("blockNumber"))
    t = tx(spark, sf_dir, orders_by_block(spark, sf_dir).withColumn("n", n), ("n",)).withColumn("page", F.expr(f"transactionIndex div {TX_PAGE_SIZE}"))
    item = page_item(F.col("o_orderkey"), F.col("page"))
    pages = t.groupBy("blockNumber", "page", "n").agg(
        F.sort_array(F.collect_list(F.struct("transactionIndex", item.alias("j")))).alias("its"))
    last_page = F.expr(f"(n - 1) div {TX_PAGE_SIZE}")
    cursor = F.concat(F.lit("c"), F.col("blockNumber").cast("string"), F.lit("_"),
                      F.when(F.col("blockNumber") % 4 == 0, F.lit(1)).otherwise(F.col("page") + 1).cast("string"))
    cursor_part = F.when(F.col("page") < last_page, F.concat(F.lit(',"nextCursor":"'), cursor, F.lit('"'))).otherwise(F.lit(""))
    body = F.concat(F.lit('{"items":'), _json_array(F.transform("its", lambda x: x["j"])),
                    F.lit(',"count":'), F.col("n").cast("string"), cursor_part, F.lit("}"))
    return (pages.where((F.col("blockNumber") + F.col("page")) % 17 != 0)
            .select(F.col("blockNumber").alias("block"), "page", body.alias("body")))


# ------------------------------------------------------- manifests / attempts
def block_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(block, n_tx, seconds, is_empty): blocks of ``tx`` minus block % 13 = 0;
    blocks with block % 11 = 0 were recorded empty."""
    t = tx(spark, sf_dir)
    m = t.groupBy("blockNumber").agg(F.count(F.lit(1)).alias("n"))
    empty = F.col("blockNumber") % 11 == 0
    return m.where(F.col("blockNumber") % 13 != 0).select(
        F.col("blockNumber").alias("block"),
        F.when(empty, F.lit(0).cast("bigint")).otherwise(F.col("n")).alias("n_tx"),
        (F.lit(1) + F.col("blockNumber") % 7).cast("bigint").alias("seconds"),
        empty.alias("is_empty"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(block, attempt, ok) for every block of ``tx`` and attempts 0..4;
    ok = (block + attempt) % 3 <> 0, except blocks with block % 29 = 0, which
    never succeed."""
    blocks = tx(spark, sf_dir).select(F.col("blockNumber").alias("block")).distinct()
    a = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(ATTEMPTS - 1))).alias("attempt"))
    return a.select("block", F.col("attempt").cast("bigint").alias("attempt"),
                    (((F.col("block") + F.col("attempt")) % 3 != 0) & (F.col("block") % 29 != 0)).alias("ok"))


# ----------------------------------------------------------------- hourly
def hourly(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """One landed transaction per event, keyed by KST hour (PRJ-6); ``events``: its
    rows as a caller dealt them, with their ``blockNumber``."""
    e = table(spark, sf_dir, "events") if events is None else events
    block = F.col("blockNumber") if "blockNumber" in e.columns else F.expr(f"event_id div {EVENTS_PER_BLOCK}")
    ts = F.col("ts").cast("timestamp_ntz")
    return e.select(
        hash_of("event_id").alias("transactionHash"),
        block.alias("blockNumber"),
        F.expr(f"event_id % {EVENTS_PER_BLOCK}").alias("transactionIndex"),
        address("user_id").alias("from"),
        address(F.expr(f"(user_id * 7 + 1) % {ADDRESS_SPACE}")).alias("to"),
        (F.round(F.col("value") * 100).cast("decimal(20,0)")
         * F.lit(10 ** 16).cast("decimal(17,0)")).cast("decimal(38,0)").alias("value"),
        F.col("event_type").alias("status"),
        ts.alias("ts"),
        fn.kst_text(ts).alias("timestamp"),
        *fn.kst_hour_keys(ts),
    )


def blocks_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(block, ts): block = event_id div 5, time = earliest event of the block."""
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.expr(f"event_id div {EVENTS_PER_BLOCK}").alias("block"))
            .agg(F.min(F.col("ts").cast("timestamp_ntz")).alias("ts")))


def hour_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(target_ts): every hour start between the first and last event hour."""
    e = table(spark, sf_dir, "events")
    b = e.agg(F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz").alias("a"),
              F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz").alias("b"))
    return b.select(F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("target_ts"))


def _daily_mean(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """(price_date, v): mean value of the events of a type per UTC day, through decimal
    sums so that it does not depend on summation order."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == event_type)
    return e.groupBy(F.to_date(F.col("ts").cast("timestamp_ntz")).alias("price_date")).agg(
        (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("v"))


def price_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(price_date, body): the landed price response {ETH:{USD}} of a day (mean purchase value)."""
    return _daily_mean(spark, sf_dir, "purchase").select("price_date", F.to_json(F.struct(F.struct(F.col("v").alias("USD")).alias("ETH"))).alias("body"))


def fx_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(price_date, body): the landed FX response {rates:{KRW}} of a day (1000 + mean view value)."""
    return _daily_mean(spark, sf_dir, "view").select(
        "price_date", F.to_json(F.struct(F.struct((F.lit(1000.0) + F.col("v")).alias("KRW")).alias("rates"))).alias("body"))


# ---------------------------------------------------------------- holders
def holder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account list behind the holder pages, one row per customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", "c_name",
        address("c_custkey").alias("address"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("eth_balance"),
        F.concat((F.col("c_acctbal") / 10000).cast("decimal(12,6)").cast("string"), F.lit("%")).alias("percentage"),
    )


@landed("holder_pages")
def holder_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_no, html): 100 rows per page in custkey order. Row rules: image in
    the name cell when c_custkey % 5 = 0, a name tag when % 7 = 0, only four
    cells when % 11 = 0, no address span when % 13 = 0."""
    h = holder_rows(spark, sf_dir)
    k = F.col("c_custkey")
    addr_cell = F.when(k % 13 == 0, F.concat(F.lit('<a href="/address/'), F.col("address"), F.lit('">'),
                                             F.col("address"), F.lit("</a>"))) \
        .otherwise(F.concat(F.lit('<span data-highlight-target="'), F.col("address"), F.lit('">'),
                            F.col("address"), F.lit("</span>")))
    name_cell = F.when(k % 5 == 0, F.lit('<img src="/images/exchange.svg" alt="x"/>')) \
        .when(k % 7 == 0, F.concat(F.lit('<span class="tag">'), F.col("c_name"), F.lit("</span>"))) \
        .otherwise(F.lit(" "))
    td = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    cells = F.concat(td((k + 1).cast("string")), td(addr_cell), td(name_cell), td(F.col("eth_balance")),
                     F.when(k % 11 == 0, F.lit("")).otherwise(td(F.col("percentage"))))
    rows = h.select(F.expr(f"c_custkey div {HOLDER_PAGE_ROWS}").alias("page_no"), "c_custkey",
                    F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("tr"))
    pages = rows.groupBy("page_no").agg(F.sort_array(F.collect_list(F.struct("c_custkey", "tr"))).alias("trs"))
    header = "<tr><th>Rank</th><th>Address</th><th>Name Tag</th><th>Balance</th><th>Percentage</th></tr>"
    html = F.concat(F.lit('<html><body><div><table class="table"><thead>' + header + "</thead><tbody>"),
                    F.array_join(F.transform("trs", lambda x: x["tr"]), ""),
                    F.lit("</tbody></table></div></body></html>"))
    return pages.select("page_no", html.alias("html"))


def snapshot_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous holder snapshot: customers with c_custkey % 3 <> 0."""
    return holder_rows(spark, sf_dir).where(F.col("c_custkey") % 3 != 0).select(
        "address", "eth_balance", "percentage")


# ------------------------------------------------------------- lake tables
@landed("lake_hours", ["year", "month", "day", "hour"])
def lake_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hour-partitioned batch table (SNK-2 layout) over ``hourly``."""
    return hourly(spark, sf_dir)


@landed("lake_days", ["year", "month", "day"], dealt=True)
def lake_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day-partitioned historical table (SNK-3 layout): raw rows typed by
    PRJ-4, unpadded keys of the KST time (PRJ-7)."""
    from ..operators.projections import tx_typed
    columns, days = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"), ("year", "month", "day")
    # dealt and sorted by day as the few columns of orders; the wide rows go straight to the files
    dated = tx_typed(tx_raw(spark, sf_dir, keep=columns[1:])).select(*columns, *fn.day_keys("timestamp"))
    dealt = dated.hint("rebalance", *days).sortWithinPartitions(*days)
    return tx_typed(tx_raw(spark, sf_dir, dealt, days).drop("o_orderkey"))


@landed("lake_nested")
def lake_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw files conformed to the 23-column schema (SNK-1)."""
    from ..operators.projections import conform
    from ..schemas import RAW_23
    return conform(tx_nested(spark, sf_dir), RAW_23)


def realtime_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Realtime staging rows from ``hourly``: epoch-ns time, hex status
    ('0x1' for purchases)."""
    h = hourly(spark, sf_dir)
    ns = (fn.epoch_seconds("ts") * F.lit(1_000_000_000)
          + (F.unix_micros(F.col("ts").cast("timestamp")) % 1_000_000) * 1000)
    return h.select("transactionHash", ns.alias("timestamp"), F.col("value").cast("string").alias("value"),
                    "from", "to", "blockNumber",
                    F.when(F.col("status") == "purchase", "0x1").otherwise("0x0").alias("status"))


@landed("lake_realtime", ["year", "month", "day", "hour"])
def lake_realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier (stale: every status '0') load of the realtime table,
    hour-partitioned by the KST keys of its time."""
    from ..operators.projections import tx_project_realtime
    p = tx_project_realtime(realtime_staging(spark, sf_dir)).withColumn("status", F.lit("0"))
    return p.select("*", *fn.kst_hour_keys("timestamp"))


@landed("lake_jsonl", ["chunk"], fmt="text", compression="gzip")
def lake_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip JSON-lines chunks of flat text rows (one tx per line), one folder
    per 100-block chunk, as the descending collector lands them; lines of
    o_orderkey % 97 = 0 were cut off after 40 characters."""
    r = tx_raw(spark, sf_dir)
    start = F.expr(f"(cast(blockNumber as bigint) div 100) * 100")
    line = F.to_json(F.struct("transactionHash", "blockNumber", "transactionIndex", "from", "to", "value", "status", "timestamp"))
    return r.select(F.when(F.col("o_orderkey") % 97 == 0, F.substring(line, 1, 40)).otherwise(line).alias("value"),
                    fn.chunk_label(start, start + 99).alias("chunk"))
