from decimal import Decimal

from pyspark.sql import functions as F

from blockhouse import functions as fn


def one(spark, expr_col, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr_col.alias("r")).first()["r"]


def test_hex_to_decimal_edges(spark):
    cases = {
        None: None, "": None, "0x": None, "0xzz": None, "0x1f": Decimal(31), "0x0": Decimal(0),
        "0xde0b6b3a7640000": Decimal(10**18), "0x152d02c7e14af6800000": Decimal(10**23),
        "0x" + "f" * 31: Decimal(16**31 - 1), "0x" + "f" * 32: None,
        "0x000000000000000000000000001f": Decimal(31),
    }
    for v, want in cases.items():
        assert one(spark, fn.hex_to_decimal(F.col("v")), v) == want, v


def test_hex_to_decimal_text_raw(spark):
    assert one(spark, fn.hex_to_decimal_text(F.col("v")), None) == ""
    assert one(spark, fn.hex_to_decimal_text(F.col("v")), " ") == ""
    assert one(spark, fn.hex_to_decimal_text(F.col("v")), "0x10") == "16"


def test_hex_to_long(spark):
    for v, want in {"0x1f": 31, "0x": None, "0xzz": None, None: None, "0x7fffffffffffffff": 2**63 - 1,
                    "0xffffffffffffffff": None, "0x00000000000000000001": 1}.items():
        assert one(spark, fn.hex_to_long(F.col("v")), v) == want, v


def test_hex_round_trip(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 * 104729).alias("n"))
    bad = df.where(fn.hex_to_long(fn.long_to_hex("n")) != F.col("n")).count()
    assert bad == 0
    wide = spark.range(1, 2000).select((F.col("id").cast("decimal(38,0)") * F.lit(10**18).cast("decimal(38,0)") * 997).cast("decimal(38,0)").alias("w"))
    assert wide.where(fn.hex_to_decimal(fn.decimal_to_hex("w")) != F.col("w")).count() == 0


def test_epoch_kst(spark):
    assert one(spark, fn.epoch_to_kst(F.col("v")), 1751328000, "v bigint") == "2025-07-01 09:00:00"
    assert one(spark, fn.epoch_to_kst(F.col("v")), 1751382000, "v bigint") == "2025-07-02 00:00:00"
    assert one(spark, fn.epoch_to_kst(F.col("v")), None, "v bigint") == ""
    assert one(spark, fn.hex_ts_to_kst(F.col("v")), hex(1751328000)) == "2025-07-01 09:00:00"
    assert one(spark, fn.hex_ts_to_kst(F.col("v")), "") == ""
    assert one(spark, fn.hex_ts_to_kst(F.col("v"), blank_as_empty=False), "0xzz") is None


def test_keys(spark):
    df = spark.createDataFrame([(1751328000,)], "s bigint").select(fn.from_epoch_seconds("s").alias("t"))
    r = df.select(*fn.kst_hour_keys("t")).first()
    assert tuple(r) == ("2025", "07", "01", "09")
    r2 = df.select(*fn.day_keys(fn.utc_to_kst("t"))).first()
    assert tuple(r2) == ("2025", "7", "1")


def test_casts_and_status(spark):
    assert one(spark, F.col("v").try_cast("bigint"), "") is None
    assert one(spark, F.col("v").cast("decimal(38,0)"), "1" * 30) == Decimal("1" * 30)
    for v, want in {"0x1": "1", "1": "1", "0x0": "0", None: "0"}.items():
        assert one(spark, fn.status_flag(F.col("v")), v) == want
    assert one(spark, F.round(F.col("v"), 4), 2.00005, "v double") == 2.0001


def test_epoch_ns(spark):
    r = one(spark, fn.epoch_ns_to_ts(F.col("v")), 1751328000_999_999_999, "v bigint")
    assert str(r) == "2025-07-01 00:00:00"


def test_convert_logs_defaults(spark):
    df = spark.createDataFrame(
        [('[{"address":"0xa","logIndex":"0x2","blockNumber":"0x10"},{"address":"0xb","removed":true,"topics":["t"]}]',)],
        "j string").select(fn.convert_logs(F.from_json("j", fn.LOG_WIRE_DDL)).alias("l"))
    logs = df.first()["l"]
    assert logs[0]["contractAddress"] == "0xa" and logs[0]["removed"] is False and logs[0]["topics"] == []
    assert logs[0]["logIndex"] == 2 and logs[0]["blockNumber"] == 16
    assert logs[1]["removed"] is True and logs[1]["topics"] == ["t"]


def test_logs_quality_flag(spark):
    df = spark.createDataFrame([(None,), ([],), (["x"],)], "l array<string>")
    assert [r[0] for r in df.select(fn.logs_quality("l")).collect()] == ["missing", "empty", "present"]
