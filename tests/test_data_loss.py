"""Cases in which rows or digits could get lost."""
import os
import random
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from blockhouse import functions as fn
from blockhouse.operators import aggregates as agg
from blockhouse.operators import joins as jn
from blockhouse.plans import fixtures as fx
from blockhouse.session import scratch_path
from blockhouse.sinks import tables as tb
from blockhouse.sinks import writers as wr
from blockhouse.sources import files as src
from blockhouse.sources import html as hsrc
from blockhouse.sources import landed as lsrc
from blockhouse.streaming import hourly as stream
from tests.conftest import SF_SMALL

def test_landing_follows_its_tables(spark, tmp_path):
    """A table that grows after its landing is landed again."""
    sf = str(tmp_path / "sf")
    os.mkdir(sf)
    for name in os.listdir(SF_SMALL):  # contents only: the test data is read-only
        shutil.copyfile(f"{SF_SMALL}/{name}", f"{sf}/{name}")
    before = fx.lake_nested(spark, sf).count()
    assert fx.lake_nested.path(spark, sf) == fx.lake_nested.path(spark, sf)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    more = orders.withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000)
    (tmp_path / "sf" / "orders.parquet").unlink()
    orders.union(more).write.parquet(f"{sf}/orders.parquet")
    assert fx.lake_nested(spark, sf).count() == 2 * before


def test_labels_above_eight_digits(spark):
    df = spark.createDataFrame([(5,), (123456780,), (123456789,)], "b bigint")
    assert [r[0] for r in df.select(fn.pad_block_label("b")).collect()] == ["00000005", "123456780", "123456789"]
    rows = wr.with_chunk(spark.createDataFrame([(10 ** 9,), (10 ** 9 + 10,)], "blockNumber bigint"), 10).select("chunk").collect()
    assert [r[0] for r in rows] == ["1000000000_1000000009", "1000000010_1000000019"]


def test_chunk_writer_keeps_earlier_chunks(spark):
    path = scratch_path(spark, "t-chunks")
    rows = lambda b: spark.createDataFrame([("a", b, "10"), ("b", b, "9"), ("c", b, "2")], "transactionHash string, blockNumber bigint, transactionIndex string")
    for b in (5, 105, 5):
        wr.write_block_chunks(rows(b), path, 100)
    assert spark.read.parquet(path).groupBy("blockNumber").count().orderBy("blockNumber").collect() == [(5, 3), (105, 3)]


def test_wide_hex_text(spark):
    rng = random.Random(3)
    words = [f"0x{rng.getrandbits(bits):x}" for bits in (8, 100, 126, 129, 200, 256, 300) for _ in range(5)] + ["0x1" + "0" * 50]
    df = spark.createDataFrame([(w,) for w in words], "h string")
    assert all(r[1] == str(int(r[0], 16)) for r in df.select("h", fn.hex_to_decimal_text("h")).collect())
    flags = spark.createDataFrame([("0x1" + "0" * 50,), ("0x1f",), ("0xg",), ("",), (None,)], "h string").select(fn.hex_quality("h"))
    assert [r[0] for r in flags.collect()] == ["wide", "ok", "bad", "missing", "missing"]


def test_json_keeps_nulls(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', CAST(null AS int)) AS s")
    assert df.select(fn.to_json_text("s")).first()[0] == '{"a":1,"b":null}'
    assert src.stage_semistructured(df).first()[0] == '{"a":1,"b":null}'


def _files(spark, path):
    rows = [(f"h{i}", f"2024-01-{1 + i % 9:02d} {i % 24:02d}:10:00", i) for i in range(90)]
    rng = random.Random(1)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "transactionHash string, t string, v bigint").select("transactionHash", F.col("t").cast("timestamp_ntz").alias("ts"), "v")
    df.repartition(3).write.parquet(path)
    return df


def test_broken_json_lines_go_to_a_side_table(spark):
    path = scratch_path(spark, "t-lines")
    lines = ['{"transactionHash":"a","value":"1"}', '{"transactionHash":"b","va', "", '{"transactionHash":"c"}', "not json"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.option("compression", "gzip").text(f"{path}/chunk=1")
    assert [(r["transactionHash"], r["value"]) for r in src.scan_jsonl_gz(spark, path).collect()] == [("a", "1"), ("c", None)]
    bad = src.bad_json_lines(spark, path).collect()
    assert [r["line"] for r in bad] == [lines[1], lines[4]] and all("chunk=1" in r["file"] for r in bad)
    with pytest.raises(Exception):
        src.scan_jsonl_gz(spark, path, strict=True).collect()


def test_variant_staging_reads_typed_fields(spark):
    df = spark.sql("SELECT array(named_struct('a', 1, 'b', array('x', null))) AS n, map('k', 2.5D) AS m, 7 AS plain")
    row = src.stage_semistructured(df, form="variant").selectExpr(
        "variant_get(n, '$[0].a', 'int') AS a", "variant_get(n, '$[0].b[0]', 'string') AS b", "variant_get(n, '$[3].a', 'int') AS gone",
        "variant_get(m, '$.k', 'double') AS k", "plain").first()
    assert tuple(row) == (1, "x", None, 2.5, 7)


def test_streams_keep_late_rows_over_batches(spark):
    landing, counts, dedupe = (scratch_path(spark, n) for n in ("t-land", "t-counts", "t-dedupe"))
    df = _files(spark, landing)
    schema = df.schema
    stream.stream_hour_counts(spark, landing, schema, counts, scratch_path(spark, "t-ck1"), max_files=1)
    got = stream.read_hour_counts(spark, counts)
    want = df.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start")).agg(F.count("*").alias("n_rows"))
    assert got.exceptAll(want).isEmpty() and got.agg(F.sum("n_rows")).first()[0] == 90
    df.write.mode("append").parquet(landing)  # everything lands again
    stream.stream_dedupe(spark, landing, schema, dedupe, scratch_path(spark, "t-ck2"), max_files=1, run_time=datetime(2024, 1, 11))
    out = stream.read_deduped(spark, dedupe, schema)
    assert out.count() == 90 and out.select("transactionHash").distinct().count() == 90


def test_streams_keep_rows_without_a_hash(spark):
    landing, loaded, dedupe = (scratch_path(spark, n) for n in ("t-land", "t-load", "t-dedupe"))
    rows = spark.createDataFrame([("h1" if i < 1 else None, i, "a", "b", "1", "1", "2024-01-01 10:10:00") for i in range(5)],
                                 "transactionHash string, blockNumber bigint, `from` string, `to` string, value string, status string, timestamp string")
    rows = rows.withColumn("ts", F.col("timestamp").cast("timestamp_ntz"))
    for _ in range(2):  # the second file repeats the first
        rows.coalesce(1).write.mode("append").parquet(landing)
        stream.land_rows(rows, f"{landing}-hours")
    stream.stream_hourly_load(spark, f"{landing}-hours", rows.schema, loaded, scratch_path(spark, "t-ck1"), max_files=1)
    stream.stream_dedupe(spark, landing, rows.schema, dedupe, scratch_path(spark, "t-ck2"), max_files=1)
    assert spark.read.parquet(loaded).count() == 5
    # run at today's time: rows of 2024 are older than the state remembers
    assert [stream.read_deduped(spark, dedupe, rows.schema, late).count() for late in (False, True, None)] == [0, 5, 5]


def test_dedupe_survives_a_failed_batch(spark, monkeypatch):
    """The second batch fails after it has been written: the retry gives the same rows."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("t-land", "t-dedupe", "t-ck"))
    schema = _files(spark, landing).schema
    run = lambda: stream.stream_dedupe(spark, landing, schema, target, ckpt, max_files=1, run_time=datetime(2024, 1, 11), retention="5 days")
    calls, original = [], stream._batch_label

    def label(checkpoint, epoch):
        calls.append(epoch)
        if calls.count(1) == 1 and epoch == 1:
            spark.read.parquet(landing).limit(3).write.mode("overwrite").parquet(f"{target}/batch={original(checkpoint, epoch)}/late=0")
            raise RuntimeError("lost")
        return original(checkpoint, epoch)

    monkeypatch.setattr(stream, "_batch_label", label)
    with pytest.raises(Exception):
        run()
    run()
    assert calls.count(1) == 2
    out = stream.read_deduped(spark, target, schema, None)
    assert out.count() == 90 and out.select("transactionHash").distinct().count() == 90
    assert 0 < stream.read_deduped(spark, target, schema, True).count() < 90


def test_dedupe_over_runs_and_late_rows(spark):
    """Replays in a later run are caught; rows older than the state go to the late output."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("t-land", "t-dedupe", "t-ck"))
    row = lambda h, t: (h, datetime.fromisoformat(t))
    schema = spark.createDataFrame([], "transactionHash string, ts timestamp_ntz").schema

    def run(rows, at):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream.stream_dedupe(spark, landing, schema, target, ckpt, run_time=datetime.fromisoformat(at), retention="2 days")

    run([row("a", "2024-01-10 01:00:00"), row("b", "2024-01-10 02:00:00"), (None, None)], "2024-01-10 03:00:00")
    run([row("a", "2024-01-10 01:00:00"), row("c", "2024-01-08 00:00:00")], "2024-01-11 03:00:00")   # replay; c is late
    run([row("a", "2024-01-10 01:00:00"), (None, None)], "2024-01-12 00:30:00")                       # replay within the retention
    run([row("d", "2024-01-20 00:00:00")], "2024-01-20 01:00:00")
    run([row("a", "2024-01-10 01:00:00"), row("e", "2024-01-20 00:30:00")], "2024-01-19 00:00:00")   # a run's time never goes back
    run([row("d", "2024-01-20 00:00:00"), row("c", "2024-01-08 00:00:00"), row("f", "2024-01-09 00:00:00")], "2024-01-20 02:00:00")
    read = lambda late: sorted(str(r["transactionHash"]) for r in stream.read_deduped(spark, target, schema, late).collect())
    assert read(False) == ["None", "a", "b", "d", "e"]
    assert set(read(True)) == {"a", "c", "f"} or set(read(True)) == {"c", "f"}
    assert read(None) == ["None", "a", "b", "c", "d", "e", "f"]


def test_hourly_load_opens_only_new_hours(spark):
    """A run over one new hour reads that hour's files, late rows of it included."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("t-land", "t-load", "t-ck"))
    ddl = "transactionHash string, blockNumber bigint, `from` string, `to` string, value string, status string, timestamp string, ts timestamp_ntz"
    row = lambda h, t: (h, 1, "a", "b", "1", "1", t, datetime.fromisoformat(t))
    rows = lambda *r: spark.createDataFrame([row(*x) for x in r], ddl)
    schema = rows(("x", "2024-01-01 00:00:00")).schema
    stream.land_rows(rows(*[(f"h{i}", f"2024-01-01 {i % 20:02d}:10:00") for i in range(60)]), landing)
    stream.stream_hourly_load(spark, landing, schema, target, ckpt)
    seen, original = [], stream.landed_hours

    def spy(*a):
        df = original(*a)
        seen.append(df.inputFiles())
        return df

    stream.landed_hours = spy
    try:
        stream.land_rows(rows(("late", "2024-01-01 03:50:00"), ("h3", "2024-01-01 03:10:00")), landing)  # 12 h in Seoul
        stream.stream_hourly_load(spark, landing, schema, target, ckpt)
    finally:
        stream.landed_hours = original
    assert len(seen) == 1 and all("day=01/hour=12/" in f for f in seen[0]) and len(seen[0]) >= 2
    out = spark.read.option("basePath", target).parquet(target)
    assert out.count() == 61 and out.where("key_hour = '12' AND key_day = '01'").count() == 4


def test_version_commit_after_a_crash(spark):
    table = tb.VersionedTable(spark, scratch_path(spark, "t-versions"))
    table.commit(spark.range(3))
    spark.range(9).write.parquet(f"{table.base}/v=2")  # data without a commit row
    assert table.commit(spark.range(5)) == 2 and table.read().count() == 5


def test_holder_cells_with_other_white_space(spark):
    row = lambda tag, attr, bal: f"<tr><td>1</td><td><span data-highlight-target={attr}>x</span></td><td>{tag}</td><td>{bal}</td><td>2%</td></tr>"
    page = "<table><tr><th>h</th></tr>" + row("\n  ", '"0xa"', "1 ETH\n") + row(" &nbsp; ", "'0xb'", "\t2 ETH") + row("Name", "0xc", "3") + "</table>"
    got = hsrc.extract_holder_rows(spark.createDataFrame([(page,)], "html string")).select("address", "eth_balance").collect()
    assert [tuple(r) for r in got] == [("0xa", "1 ETH"), ("0xb", "2 ETH")]


def test_reconcile_empty_pages_repeats_and_lost_blocks(spark):
    page = lambda b, p, items, n: (b, p, f'{{"items":[{",".join(items)}],"count":{n}}}')
    item = lambda h: f'{{"transactionHash":"{h}","timestamp":1700000000}}'
    rows = [page(1, 1, [], 50), page(2, 1, [item("a"), item("a")], 2), page(3, 1, [item("b"), item("c")], 2)]
    items = lsrc.flatten_tx_pages(spark.createDataFrame(rows, "block bigint, page bigint, body string"), keep_empty=True)
    got = agg.page_reconcile(items, 20, spark.range(1, 5).select(F.col("id").alias("block")))
    assert {r["block"]: (r["received"], r["mismatch"]) for r in got.collect()} == {1: (0, True), 2: (1, True), 3: (2, False), 4: (0, True)}


def test_receipt_without_a_hash_fails_its_block_only(spark):
    block = lambda n, h: (n, f'{{"result":{{"number":"0x{n:x}","timestamp":"0x10","transactions":[{{"hash":"{h}"}}]}}}}')
    blocks = spark.createDataFrame([block(1, "a"), block(2, "b")], "blockNumber bigint, body string")
    receipts = spark.createDataFrame([(1, '{"result":[{"transactionHash":"a","status":"0x1"}]}'), (2, '{"result":[{"status":"0x1"}]}')], "blockNumber bigint, body string")
    merged, failed = jn.merge_block_responses(blocks, receipts)
    assert [r["transactionHash"] for r in merged.collect()] == ["a"] and [r["blockNumber"] for r in failed.collect()] == [2]
