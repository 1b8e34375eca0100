"""FN-4..FN-7, FN-9, FN-10, PRJ-6, PRJ-7: epoch, KST text and calendar keys.

Calendar keys are KST (UTC+9, no daylight saving); the clock of every input is
UTC. Values are TIMESTAMP_NTZ holding UTC wall time, so no step depends on the
session time zone.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hexcodec import hex_to_long

KST = "Asia/Seoul"
TEXT_FMT = "yyyy-MM-dd HH:mm:ss"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c) -> Column:
    return _col(c).cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    """UTC wall time -> whole epoch seconds (bigint)."""
    return F.timestamp_diff("SECOND", _epoch(), to_ntz(ts))


def from_epoch_seconds(sec) -> Column:
    """epoch seconds -> UTC wall time (TIMESTAMP_NTZ)."""
    return F.timestamp_add("SECOND", _col(sec).cast("bigint"), _epoch())


def utc_to_kst(ts) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(KST), to_ntz(ts))


def kst_text(ts) -> Column:
    return F.date_format(utc_to_kst(ts), TEXT_FMT)


def epoch_to_kst(sec, bad_as_empty: bool = True) -> Column:
    """FN-5: epoch seconds -> 'yyyy-MM-dd HH:mm:ss' KST; bad input -> ''."""
    txt = kst_text(from_epoch_seconds(_col(sec).try_cast("bigint")))
    return F.coalesce(txt, F.lit("")) if bad_as_empty else txt


def hex_ts_to_kst(hex_ts, blank_as_empty: bool = True) -> Column:
    """FN-4: '0x..' epoch -> KST text; blank -> '' (raw) and bad -> null."""
    txt = kst_text(from_epoch_seconds(hex_to_long(hex_ts)))
    if blank_as_empty:
        blank = _col(hex_ts).isNull() | (F.trim(_col(hex_ts)) == "")
        return F.when(blank, F.lit("")).otherwise(txt)
    return txt


def epoch_ns_to_ts(ns) -> Column:
    """FN-6: epoch nanoseconds -> timestamp, fraction dropped (integer divide)."""
    n = _col(ns).cast("bigint")
    billion = F.lit(1_000_000_000).cast("bigint")
    # n - n % 1e9 is an exact multiple (remainder keeps the dividend's sign),
    # so the division truncates toward zero without any rounding step.
    whole = ((n - n % billion).cast("decimal(20,0)") / billion.cast("decimal(20,0)"))
    return from_epoch_seconds(whole.cast("bigint"))


def text_to_ts(c, fmt: str = TEXT_FMT) -> Column:
    """FN-7: text -> TIMESTAMP_NTZ; '' or bad text -> null (ANSI-safe)."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def align_hour(ts, shift_hours: int = 1) -> Column:
    """FN-9: floor to the hour, minus ``shift_hours``."""
    return F.timestamp_add("HOUR", F.lit(-shift_hours), F.date_trunc("hour", to_ntz(ts)).cast("timestamp_ntz"))


def kst_hour_keys(ts) -> list[Column]:
    """PRJ-6: zero-padded KST 'yyyy','MM','dd','HH' text keys from UTC time."""
    k = utc_to_kst(ts)
    return [
        F.date_format(k, "yyyy").alias("year"),
        F.date_format(k, "MM").alias("month"),
        F.date_format(k, "dd").alias("day"),
        F.date_format(k, "HH").alias("hour"),
    ]


def day_keys(ts) -> list[Column]:
    """PRJ-7: unpadded year/month/day text keys of an already-local timestamp."""
    t = _col(ts)
    return [
        F.year(t).cast("string").alias("year"),
        F.month(t).cast("string").alias("month"),
        F.dayofmonth(t).cast("string").alias("day"),
    ]


def hour_key_ts(year, month, day, hour) -> Column:
    """Inverse of PRJ-6 on partition values: KST keys -> UTC hour start (NTZ)."""
    kst = F.make_timestamp_ntz(
        _col(year).cast("int"), _col(month).cast("int"), _col(day).cast("int"),
        _col(hour).cast("int"), F.lit(0), F.lit(0),
    )
    return F.convert_timezone(F.lit(KST), F.lit("UTC"), kst)


def day_key_date(year, month, day) -> Column:
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), _col(day).cast("int"))
