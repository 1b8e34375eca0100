"""Physical-plan properties the operators rely on at scale."""
import re

from blockhouse.plans import fixtures as fx
from blockhouse.plans.queries import Q

from .conftest import SF_SMALL


def plan(df, capsys):
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_partition_reads_are_pruned(spark, capsys):
    p = plan(Q["scan_hour_partition"](spark, SF_SMALL), capsys)
    assert re.search(r"PartitionFilters: \[.*\(hour#\d+ = 09\)", p)
    assert "ReadSchema: struct<transactionHash:string,from:string,status:string,timestamp:string>" in p
    d = plan(Q["scan_day_range"](spark, SF_SMALL), capsys)
    assert re.search(r"PartitionFilters: \[.*make_date", d)          # FLT-3 prunes, no OR list


def test_envelope_merge_shuffles_only_by_block(spark, capsys):
    from blockhouse.operators.joins import merge_block_responses
    blocks = spark.read.parquet(fx.rpc_block.path(spark, SF_SMALL))
    recs = spark.read.parquet(fx.rpc_receipt.path(spark, SF_SMALL))
    merged, _ = merge_block_responses(blocks, recs)
    p = plan(merged, capsys)
    parts = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", p)
    # either a join exchange on the block alone, or (small inputs) a broadcast:
    # never an exchange keyed by transaction
    assert all(x.split("#")[0] == "_block" for x in parts), parts
    assert parts or "BroadcastHashJoin" in p


def test_asof_is_dealt_by_time_bucket_and_top_n_is_bounded(spark, capsys):
    p = plan(Q["asof_block_before"](spark, SF_SMALL), capsys)
    assert "hashpartitioning(_bid" in p and "SPARK_PARTITION_ID" not in p
    assert "CartesianProduct" not in p and "NestedLoop" not in p
    t = plan(Q["top_holders"](spark, SF_SMALL), capsys)
    assert "TakeOrderedAndProject" in t


def test_no_python_udfs_in_any_registered_plan(spark, capsys):
    for key in ("merge_tx_receipts", "extract_holder_rows", "hex_to_decimal", "convert_logs", "address_profile",
                "flatten_tx_pages", "page_reconcile", "daily_price"):
        p = plan(Q[key](spark, SF_SMALL), capsys)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, key
