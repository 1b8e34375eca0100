"""Sinks: write -> read back, run-twice idempotence, replace semantics."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from blockhouse import functions as fn
from blockhouse.plans import flows
from blockhouse.session import scratch_path
from blockhouse.sinks import tables as tb
from blockhouse.sinks import writers as wr
from blockhouse.sources import files as src


def hourly_rows(spark):
    t = dt.datetime
    return spark.createDataFrame([
        ("a", t(2025, 7, 1, 0, 30), "ok"), ("b", t(2025, 7, 1, 0, 45), "ok"),
        ("c", t(2025, 7, 1, 1, 5), "ok"), ("d", t(2025, 7, 1, 15, 0), "ok"),
    ], "transactionHash string, ts timestamp_ntz, status string")


SCHEMA = "transactionHash string, ts timestamp_ntz, status string"


def read_hourly(spark, path):
    from pyspark.sql.types import _parse_datatype_string
    return src.scan_partitioned(spark, path, _parse_datatype_string(SCHEMA), src.HOUR_KEYS)


def test_hour_partition_layout_is_kst_and_padded(spark):
    path = scratch_path(spark, "t-hours")
    wr.write_hour_partitions(hourly_rows(spark), path)
    keys = sorted(tuple(r) for r in read_hourly(spark, path).select("year", "month", "day", "hour").distinct().collect())
    assert keys == [("2025", "07", "01", "09"), ("2025", "07", "01", "10"), ("2025", "07", "02", "00")]


def test_replace_partition_touches_only_given_hours_and_is_idempotent(spark):
    path = scratch_path(spark, "t-replace")
    wr.write_hour_partitions(hourly_rows(spark), path)
    fresh = hourly_rows(spark).where(F.col("transactionHash") == "a").withColumn("status", F.lit("new"))
    for _ in range(2):
        wr.write_hour_partitions(fresh, path)
    got = {r["transactionHash"]: r["status"] for r in read_hourly(spark, path).collect()}
    assert got == {"a": "new", "c": "ok", "d": "ok"}        # b's hour replaced by the incoming hour


HOURS_DDL = SCHEMA + ", year string, month string, day string, hour string"


def _name(kind):
    import uuid
    return f"{kind}_{uuid.uuid4().hex[:6]}"


def test_skip_existing_and_insert_absent_never_lose_rows(spark, monkeypatch):
    path, name = scratch_path(spark, "t-skip"), _name("skip")
    rows = hourly_rows(spark).select("*", *fn.kst_hour_keys("ts"))
    tb.register_table(spark, name, HOURS_DDL, path, src.HOUR_KEYS)
    assert tb.load_skip_existing(spark, name, rows.where("transactionHash = 'a'"), path) == 1
    with monkeypatch.context() as m:  # a load that dies before its partitions are added leaves nothing behind
        m.setattr(tb, "add_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            tb.load_skip_existing(spark, name, rows.withColumn("status", F.lit("x")), path)
    added = [tb.load_skip_existing(spark, name, rows.withColumn("status", F.lit("x")), path) for _ in range(2)]
    got = {r["transactionHash"]: r["status"] for r in spark.table(name).collect()}
    assert got == {"a": "ok", "c": "x", "d": "x"} and added == [2, 0]

    target = scratch_path(spark, "t-absent")
    counts = []
    for part in ("a", "a,b", "a,b,c"):
        tb.load_insert_absent(spark, hourly_rows(spark).where(F.col("transactionHash").isin(part.split(","))),
                              target, "transactionHash")
        counts.append(spark.read.parquet(target).count())
    assert counts == [1, 2, 3]


def test_insert_absent_reads_only_the_days_of_the_source(spark):
    """The source's days prune the target before the anti join (D8: every day of the range)."""
    target, days = scratch_path(spark, "t-days"), ["year", "month", "day"]
    rows = spark.range(600).selectExpr("concat('h', id) AS h", "'2024' AS year", "'1' AS month", "cast(1 + id % 30 AS string) AS day")
    tb.load_insert_absent(spark, rows.where("cast(substring(h, 2) AS int) % 2 = 0"), target, "h", days)
    source = scratch_path(spark, "t-src")
    rows.write.partitionBy(*days).parquet(source)
    part = spark.read.schema("h string, year string, month string, day string").parquet(source).where("cast(day AS int) BETWEEN 3 AND 4")
    new = tb.absent_rows(part, spark.read.schema("h string, year string, month string, day string").parquet(target), "h", days)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    for _ in range(2):
        tb.load_insert_absent(spark, part, target, "h", days)
    out = spark.read.parquet(target)
    assert out.count() == 300 + part.where("cast(substring(h, 2) AS int) % 2 = 1").count() == out.select("h").distinct().count()


def test_purge_removes_files_partitions_and_rows(spark):
    lake, wh = _name("lake"), _name("wh")
    rows = hourly_rows(spark).select("*", *fn.kst_hour_keys("ts"))
    keys = ["key_year", "key_month", "key_day", "key_hour"]
    tb.save_managed(rows, lake, src.HOUR_KEYS)
    tb.save_managed(rows.toDF("transactionHash", "ts", "status", *keys), wh, keys)
    place = spark.sql(f"DESCRIBE FORMATTED {lake}").where("col_name = 'Location'").first()["data_type"]
    files = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(place).count()
    assert files() == 3
    # KST: a, b lie in hour 09, c in hour 10, d in hour 00 of the next day
    assert [flows.purge(spark, {lake: src.HOUR_KEYS, wh: keys}, dt.datetime(2025, 7, 1, 10), dt.datetime(2025, 7, 2, 0)) for _ in range(2)] == [4, 0]
    for name in (lake, wh):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
        assert sorted(r["transactionHash"] for r in spark.table(name).collect()) == ["a", "b"]
    assert files() == 1


def test_compaction_drops_its_inputs(spark):
    staging, path = _name("staged"), scratch_path(spark, "t-compact")
    rows = lambda *b: spark.createDataFrame([(f"h{x}-{i}", x, str(i)) for x in b for i in (10, 9, 2)], "transactionHash string, blockNumber bigint, transactionIndex string")
    chunks = lambda *c: spark.createDataFrame([(x,) for x in c], "chunk_id bigint")
    wr.stage_blocks(rows(0, 1, 10, 25), staging, 10)
    assert [wr.compact_chunks(spark, staging, chunks(0, 1, 7), path, 10) for _ in range(2)] == [2, 0]
    assert spark.table(staging).count() == 3
    wr.stage_blocks(rows(31), staging, 10)
    assert wr.compact_chunks(spark, staging, chunks(0, 1, 3), path, 10) == 1
    out = spark.read.json(path)
    assert sorted((r["chunk"], r["count"]) for r in out.groupBy("chunk").count().collect()) == [("00000009_00000000", 6), ("00000019_00000010", 3), ("00000039_00000030", 3)]
    assert [r["transactionIndex"] for r in spark.read.json(f"{path}/chunk=00000009_00000000").collect()] == ["2", "9", "10"] * 2


def test_versioned_range_replace_regression_d10(spark):
    t = tb.VersionedTable(spark, scratch_path(spark, "t-range"))
    rows = hourly_rows(spark)
    t.commit(rows)
    incoming = rows.withColumn("status", F.lit("new"))
    for _ in range(2):
        tb.load_replace_range(t, incoming, "ts", dt.datetime(2025, 7, 1, 0), dt.datetime(2025, 7, 1, 1))
    got = {r["transactionHash"]: r["status"] for r in t.read().collect()}
    assert got == {"a": "new", "b": "new", "c": "ok", "d": "ok"}  # exactly [00:00, 01:00)
    assert t.current_version() == 3


def test_upsert_key(spark):
    t = tb.VersionedTable(spark, scratch_path(spark, "t-upsert"))
    t.commit(spark.createDataFrame([("2025-07-01", 1.0), ("2025-07-02", 2.0)], "price_date string, price_usd double"))
    new = spark.createDataFrame([("2025-07-02", 3.0), ("2025-07-03", 4.0)], "price_date string, price_usd double")
    tb.load_upsert_key(t, new, ["price_date"])
    tb.load_upsert_key(t, new, ["price_date"])
    assert sorted(tuple(r) for r in t.read().collect()) == [("2025-07-01", 1.0), ("2025-07-02", 3.0), ("2025-07-03", 4.0)]


def test_truncate_swaps_whole_snapshots(spark):
    """An empty snapshot or a failing last step leaves the old one."""
    name = _name("h")
    tb.create_table_if_absent(spark, name, "address string, n int", scratch_path(spark, "t-trunc"))
    snap = lambda *r: spark.createDataFrame(r, "n int, address string")
    tb.load_truncate(spark, name, snap((1, "x")))
    with pytest.raises(ValueError):
        tb.load_truncate(spark, name, snap())
    with pytest.raises(Exception):
        tb.load_truncate(spark, name, snap((1, "y")).selectExpr("n", "assert_true(n > 1) IS NULL AS address"))
    assert [tuple(r) for r in spark.table(name).collect()] == [("x", 1)]
    tb.load_truncate(spark, name, snap((2, "y"), (3, "z")))
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("y", 2), ("z", 3)]


def test_state_defaults_when_empty(spark):
    path = scratch_path(spark, "t-state")
    assert tb.read_state(spark, path, 42).first()[0] == 42
    tb.append_state(spark, path, spark.createDataFrame([(0, 100), (1, 200)], "seq long, next_fetch_block long"))
    tb.append_state(spark, path, spark.createDataFrame([(2, 300)], "seq long, next_fetch_block long"))
    assert tb.read_state(spark, path, 42).first()[0] == 300


def test_manifest_rewrite_replaces_only_rewritten_keys(spark):
    path = scratch_path(spark, "t-manifest")
    exp = spark.createDataFrame([("01",), ("02",), ("03",)], "hour string")
    wr.write_manifest(spark, wr.manifest(exp, spark.createDataFrame([("01", 5)], "hour string, n_rows long"), ["hour"]),
                      path, ["hour"])
    later = wr.manifest(spark.createDataFrame([("02",)], "hour string"),
                        spark.createDataFrame([("02", 7)], "hour string, n_rows long"), ["hour"])
    wr.write_manifest(spark, later, path, ["hour"])
    got = sorted(tuple(r) for r in wr.read_manifest(spark, path, ["hour"]).collect())
    assert got == [("01", 5, False), ("02", 7, False), ("03", 0, True)]


def test_state_resets_when_unreadable_and_failed_blocks_strict(spark):
    path = scratch_path(spark, "t-bad-state")
    spark.createDataFrame([("garbage",)], "x string").write.parquet(path)
    assert tb.read_state(spark, path, 7).first()[0] == 7
    with pytest.raises(RuntimeError):
        tb.append_failed_blocks(scratch_path(spark, "t-failed"), spark.createDataFrame([(13,)], "block long"), strict=True)


def test_source_status_strict_raises_on_missing_hour(spark):
    from blockhouse.sources.status import source_status
    exp = spark.createDataFrame([("2025", "07", "01", "09"), ("2025", "07", "01", "10")], "year string, month string, day string, hour string")
    man = spark.createDataFrame([("2025", "07", "01", "09", 0)], "year string, month string, day string, hour string, n_rows long")
    got = {r["hour"]: r["status"] for r in source_status(exp, man).collect()}
    assert got == {"09": "empty", "10": "missing"}
    with pytest.raises(Exception):
        source_status(exp, man, strict=True).collect()
