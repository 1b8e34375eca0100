"""What keeps shuffles, files and tasks in step with the tables."""
import glob
import json
import re

import pyarrow.parquet as pq
import pytest

from blockhouse.operators import joins as jn
from blockhouse.plans import fixtures as fx
from blockhouse.plans import queries as q
from blockhouse.plans.queries import Q
from blockhouse.session import scratch_path
from blockhouse.sinks.hourmap import HourTable
from blockhouse.sources import landed as lsrc

from .conftest import SF_SMALL
from .test_plans import plan


def codec(folder):
    files = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    return {pq.read_metadata(f).row_group(0).column(0).compression for f in files}


@pytest.mark.parametrize("key", ["flatten_rpc_receipts", "last_per_key", "blocks_with_unmatched_tx", "convert_logs", "empty_array_to_null",
                                 "nested_defaults", "hex_to_long", "repeated_cursors", "tx_conform"])
def test_response_texts_are_neither_shuffled_nor_landed(spark, capsys, key):
    p = plan(Q[key](spark, SF_SMALL), capsys)
    assert not re.search(r"ReadSchema: struct<[^>]*(body|logs_json):string", p)
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", p)
    assert shuffled and not any(re.search(r"\b(body|logs_json|logs|its)#", x) for x in shuffled)


def test_landing_is_not_shuffled_again_for_its_files(spark):
    assert codec(fx.lake_nested.path(spark, SF_SMALL)) == codec(fx.lake_days.path(spark, SF_SMALL)) == {"ZSTD"}
    folder = fx.lake_nested.path(spark, SF_SMALL)
    # an order's row lies where its line items were dealt: by key, not in rotation
    files = spark.read.parquet(folder).selectExpr("transactionHash", "_metadata.file_name AS f").where("substring(transactionHash, 3, 1) = '0'")
    assert files.select("f").distinct().count() > 1


def test_tasks_follow_the_tables(spark, monkeypatch):
    few = fx.tasks(spark, SF_SMALL, "orders", "lineitem")
    monkeypatch.setattr(fx, "ROWS_A_TASK", 100)
    rows = sum(fx.table(spark, SF_SMALL, t).count() for t in ("orders", "lineitem"))
    assert fx.tasks(spark, SF_SMALL, "orders", "lineitem") == rows // 100 + 1 > few


@pytest.mark.parametrize("key, batches", [("stream_hour_counts", 3), ("stream_dedupe", 4)])
def test_landed_stream_files_follow_the_rows(spark, monkeypatch, key, batches):
    """More rows land as more files, not larger ones, in as many micro-batches."""
    before = sorted(map(str, Q[key](spark, SF_SMALL).collect()))
    paths = {}
    monkeypatch.setattr(q, "scratch_path", lambda s, n: paths.setdefault(n, scratch_path(s, n)))
    monkeypatch.setattr(q, "LANDED_FILE_ROWS", 300)  # 1,000 events: four files a batch
    assert sorted(map(str, Q[key](spark, SF_SMALL).collect())) == before
    assert len(glob.glob(f"{paths['landing']}/*.parquet")) == 4 * batches
    checkpoint = next(v for k, v in paths.items() if k.endswith("ckpt"))
    assert len(glob.glob(f"{checkpoint}/commits/[0-9]*")) == batches


def test_hour_table_files_are_zstandard_and_hours_join_by_broadcast(spark, capsys):
    t = HourTable(spark, scratch_path(spark, "t-hours"), fx.realtime_staging(spark, SF_SMALL).schema)
    t.replace(fx.realtime_staging(spark, SF_SMALL).selectExpr("*", "'2024' AS year", "'01' AS month", "'01' AS day", "'00' AS hour"))
    assert codec(f"{t.base}/v=1-*") == {"ZSTD"}


def test_page_items_are_cut_without_a_regex(spark, capsys):
    assert "regexp_replace" not in plan(fx.hour_pages.build(spark, SF_SMALL), capsys)


@pytest.mark.parametrize("key", ["merge_tx_receipts", "blocks_with_unmatched_tx"])
def test_parsed_blocks_are_not_shuffled_for_their_receipts(spark, capsys, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q[key](spark, SF_SMALL)
        df.collect()
        capsys.readouterr()
        df.explain()
        final = capsys.readouterr().out.split("== Initial Plan ==")[0]  # without the join of blocks that have no key
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "REPARTITION_BY_NUM" in final and "hashpartitioning(_block#" not in final


def test_transactions_are_not_broadcast_to_meet_their_headers(spark, capsys):
    tx = lambda n, i: {"hash": f"{n}-{i}", "blockNumber": n}
    block = lambda n, ts, txs: (json.dumps({"result": {"number": n, "timestamp": ts, "transactions": txs}}),)
    blocks = spark.createDataFrame([
        block("0x1", "0x64", [tx("0x1", i) for i in range(3)]), block("0x2", "0x65", [tx("0x2", 0), "a hash"]),
        block("0x2", "0x66", []), block("0x3", "0x67", [tx("0x9", 0), tx(None, 0)]), block(None, "0x68", [tx("0x1", 3)]),
    ], "body string")
    t = lsrc.flatten_rpc_blocks(blocks, stamp=False).select("hash", jn.fn.hex_to_long("blockNumber").alias("blockNumber"))
    df = jn.join_block_header(t, lsrc.rpc_block_headers(blocks))
    got = sorted((r["hash"], r["blockNumber"], r["block_ts_hex"]) for r in df.collect())
    assert got == [*[(f"0x1-{i}", 1, "0x64") for i in range(4)], ("0x2-0", 2, "0x65"), ("0x2-0", 2, "0x66")]
    for p in (plan(df, capsys), plan(Q["join_block_header"](spark, SF_SMALL), capsys)):
        assert "SortMergeJoin" in p and "Broadcast" not in p
