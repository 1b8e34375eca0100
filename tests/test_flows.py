"""§3 flows end to end on the smallest driver tables."""
import datetime as dt

from pyspark.sql import functions as F

from blockhouse.operators import joins as jn
from blockhouse.plans import fixtures as fx
from blockhouse.plans import flows
from blockhouse.session import scratch_path
from blockhouse.sinks import tables as tb
from blockhouse.sinks import writers as wr
from blockhouse.sources import landed as lsrc

from .conftest import SF_SMALL


def test_hourly_batch_loads_exactly_the_range_and_replays(spark):
    pages = fx.tx_pages(spark, SF_SMALL)
    lake, wh = scratch_path(spark, "f-lake"), scratch_path(spark, "f-wh")
    start, end = dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1)
    for _ in range(2):                                   # replay-safe
        flows.hourly_batch(spark, pages, start, end, lake, wh)
    items = lsrc.flatten_tx_pages(pages).withColumn("t", F.col("block_ts"))
    lo, hi = int(start.replace(tzinfo=dt.timezone.utc).timestamp()), int(end.replace(tzinfo=dt.timezone.utc).timestamp())
    expected = items.where((F.col("t") >= lo) & (F.col("t") < hi)).select("transactionHash")
    got = flows.warehouse_table(spark, wh).read().select(F.col("transactionhash").alias("transactionHash"))
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0
    assert flows.lake_table(spark, lake).version() == 2


def _page(block, time):
    at = int(dt.datetime.fromisoformat(time).replace(tzinfo=dt.timezone.utc).timestamp())
    return (block, 0, f'{{"items":[{{"transactionHash":"0x{block}","blockNumber":{block},"transactionIndex":0,"from":"a","to":"b",'
                      f'"value":"1","timestamp":{at}}}],"count":1}}')


def test_hourly_batch_replaces_exactly_an_unaligned_range(spark):
    pages = lambda *p: spark.createDataFrame(p, "block bigint, page bigint, body string")
    lake, wh = scratch_path(spark, "f-lake"), scratch_path(spark, "f-wh")
    at = lambda h, m=0: dt.datetime(2024, 3, 1, h, m)
    stored = lambda: (sorted(r[0] for r in flows.lake_table(spark, lake).read().select("transactionHash").collect()),
                      sorted(r[0] for r in flows.warehouse_table(spark, wh).read().select("transactionhash").collect()))
    flows.hourly_batch(spark, pages(_page(1, "2024-03-01T00:10"), _page(2, "2024-03-01T00:40"), _page(3, "2024-03-01T01:20"),
                                    _page(4, "2024-03-01T02:10"), _page(5, "2024-03-01T02:50"), _page(6, "2024-03-01T03:10")),
                       at(0), at(4), lake, wh)
    for _ in range(2):  # 00:40, 01:20 and 02:10 replaced by 00:50 and 02:20
        hours = flows.hourly_batch(spark, pages(_page(7, "2024-03-01T00:50"), _page(8, "2024-03-01T02:20"), _page(9, "2024-03-01T02:35")),
                                   at(0, 30), at(2, 30), lake, wh)
        assert stored() == (["0x1", "0x5", "0x6", "0x7", "0x8"],) * 2
        assert sorted(r["hour"] for r in hours.collect()) == ["09", "11"]  # KST
    flows.hourly_batch(spark, pages(_page(3, "2024-03-01T01:20")), at(0), at(4), lake, wh)
    assert stored() == (["0x3"],) * 2


def test_hourly_batch_26_columns_dedupe_manifest(spark):
    """Status and decoded input are real, a retried page counts once, rows without a
    hash stay, hours without rows are recorded empty."""
    at = int(dt.datetime(2024, 3, 1, 0, 10, tzinfo=dt.timezone.utc).timestamp())
    item = lambda h, extra: f'{{"transactionHash":{h},"blockNumber":5,"transactionIndex":"3","status":"1","timestamp":{at}{extra}}}'
    body = lambda *items: f'{{"items":[{",".join(items)}],"count":9}}'
    log = ',"logs":[{"logIndex":1,"decodedLog":{"name":"T","args":[{"name":"a","type":"t","value":"v"}]}}]'
    pages = [(5, 0, body(item('"a"', ',"decodedInput":{"m":"é","n":[1, 2]}' + log), item('"b"', ',"decodedInput":""'), item("null", ""))),
             (5, 1, body(item('"a"', ""), item('"c"', ',"decodedInput":null'), item("null", "")))]
    lake, wh, man = (scratch_path(spark, n) for n in ("f-lake", "f-wh", "f-man"))
    for _ in range(2):
        hours = flows.hourly_batch(spark, spark.createDataFrame(pages, "block bigint, page bigint, body string"),
                                   dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 1, 2), lake, wh, man)
    rows = {r["transactionHash"]: r for r in flows.lake_table(spark, lake).read().collect()}
    assert [r["hour"] for r in hours.collect()] == ["09"] and set(rows) == {"a", "b", "c", None}
    assert rows["a"]["decodedInput"] == '{"m":"é","n":[1,2]}' and rows["b"]["decodedInput"] is rows["c"]["decodedInput"] is None
    assert rows["a"]["logs"][0]["decodedLog"]["args"][0]["value"] == "v" and rows["c"]["logs"] is None  # the copy with logs counts
    out = flows.warehouse_table(spark, wh).read()
    assert out.count() == 5 and {r["transaction_status"] for r in out.collect()} == {"1"}
    got = sorted((r["hour"], r["n_rows"], r["is_empty"]) for r in wr.read_manifest(spark, man, ["year", "month", "day", "hour"]).collect())
    assert got == [("09", 5, False), ("10", 0, True)]


def test_range_replace_is_one_commit(spark, monkeypatch):
    """A failure after part of the work leaves the old range readable."""
    table = flows.realtime_table(spark, scratch_path(spark, "f-rt"))
    at = lambda h, m=0: dt.datetime(2025, 7, 1, h, m)
    rows = lambda s, *ts: spark.createDataFrame([(int(t.replace(tzinfo=dt.timezone.utc).timestamp()) * 10 ** 9, "1", "a", "b", i, s) for i, t in enumerate(ts)],
                                                "timestamp bigint, value string, `from` string, `to` string, blockNumber bigint, status string")
    state = lambda: sorted((r["timestamp"], r["status"], r["hour"]) for r in table.read().collect())
    flows.realtime_replace(spark, rows("0x0", at(0, 10), at(0, 50), at(1, 5), at(2, 30), at(3, 30)), table, at(0), at(5))
    before = state()
    assert len(before) == 5
    with monkeypatch.context() as m:
        m.setattr(type(table), "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            flows.realtime_replace(spark, rows("0x1", at(1, 5)), table, at(0, 30), at(3))
        except RuntimeError:
            pass
    assert state() == before
    for _ in range(2):  # 00:50, 01:05 and 02:30 are replaced by 01:05; hour 2 becomes empty
        flows.realtime_replace(spark, rows("0x1", at(1, 5), at(3, 10)), table, at(0, 30), at(3))
        assert state() == [(at(0, 10), "0", "09"), (at(1, 5), "1", "10"), (at(3, 30), "0", "12")]
    import uuid
    name = f"rt_{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE TABLE {name} (`timestamp` timestamp_ntz, value decimal(38,0), `from` string, `to` string, blockNumber bigint, status string, "
              f"year string, month string, day string, hour string) USING parquet PARTITIONED BY (year, month, day, hour) LOCATION '{table.base}/catalog'")
    table.register(name)
    assert spark.table(name).where("hour = '10'").count() == 1 and spark.table(name).count() == 3


def test_historical_backfill_matches_merge(spark):
    blocks, receipts = fx.rpc_block(spark, SF_SMALL), fx.rpc_receipt(spark, SF_SMALL)
    target = scratch_path(spark, "f-hist")
    days = (dt.date(1990, 1, 1), dt.date(2030, 12, 31))
    failed = flows.historical_backfill(spark, blocks, receipts, 100, scratch_path(spark, "f-chunks"),
                                       scratch_path(spark, "f-days"), target, days)
    merged, failed2 = jn.merge_tx_receipts(lsrc.flatten_rpc_blocks(blocks), lsrc.flatten_rpc_receipts(receipts))
    assert failed.count() == failed2.count() > 0
    want = merged.where(F.col("timestamp") >= "1990").select("transactionHash")  # 0x0 time -> 1970
    got = spark.read.parquet(target).select(F.col("transactionhash").alias("transactionHash"))
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    flows.historical_backfill(spark, blocks, receipts, 100, scratch_path(spark, "f-chunks"),
                              scratch_path(spark, "f-days"), target, days)
    assert spark.read.parquet(target).count() == want.count()   # insert-if-absent: no duplicates


def test_price_and_holders_flows(spark):
    t = tb.VersionedTable(spark, scratch_path(spark, "f-price"))
    flows.daily_prices(fx.price_responses(spark, SF_SMALL), fx.fx_responses(spark, SF_SMALL), t)
    flows.daily_prices(fx.price_responses(spark, SF_SMALL), fx.fx_responses(spark, SF_SMALL), t)
    assert t.read().count() == fx.price_responses(spark, SF_SMALL).count()
    import uuid
    snap = flows.holders_snapshot(spark, fx.holder_pages(spark, SF_SMALL), scratch_path(spark, "f-csv"),
                                  f"holders_{uuid.uuid4().hex[:6]}", "2025-07-01 00:00:00", top_n=50)
    n = snap.count()
    assert 0 < n < 50
