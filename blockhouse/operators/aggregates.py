"""AGG-1..AGG-7: counts, high-water marks, completeness, reconciliation."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, keys: list[str], name: str = "n_rows") -> DataFrame:
    """AGG-1: rows per hour / chunk (partial counts are combined map-side, so a
    hot key costs one partial row per input partition)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """AGG-5: keep the last row per key by ``order`` (a dict build keeps the
    last value). An aggregate, not a window: duplicates are reduced map-side
    before the exchange."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_last"))
    return picked.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others])


def address_profile(tx: DataFrame, address: str = "from") -> DataFrame:
    """AGG-6: per address first block, first time, tx count and total wei
    (``try_sum``: an overflow gives null instead of failing the job)."""
    return tx.groupBy(F.col(address).alias("address")).agg(
        F.min("blockNumber").alias("first_seen_block"),
        F.min("ts").alias("first_seen_timestamp"),
        F.count(F.lit(1)).alias("total_tx_count"),
        F.try_sum("value").alias("total_value"))


def next_block_asc(spark: SparkSession, present: DataFrame, low: int, high: int, size: int,
                   key: str = "block") -> DataFrame:
    """AGG-2 ascending, contiguous form (D16): the start of the grid chunk
    that holds the first missing block at or after ``low`` (so the state never
    skips a gap); ``high + 1`` when nothing is missing. Grid: chunk ends are
    multiples of ``size`` (D15)."""
    from .joins import block_range, missing_blocks
    miss = missing_blocks(block_range(spark, low, high, key), present, key)
    m = miss.agg(F.min(key).alias("m"))
    chunk_start = (F.ceil(F.col("m") / F.lit(size)).cast("bigint") - 1) * size + 1
    return m.select(F.when(F.col("m").isNull(), F.lit(high + 1))
                    .otherwise(F.greatest(F.lit(low), chunk_start)).cast("bigint").alias("next_block"))


def next_block_desc(spark: SparkSession, present: DataFrame, low: int, high: int,
                    key: str = "block") -> DataFrame:
    """AGG-2 descending: contiguous form = highest missing block <= ``high``
    (``low - 1`` when none); the reference's form min(successful) - 1 is kept
    beside it (it skips failed blocks above the minimum, D16)."""
    from .joins import block_range
    flags = present.select(key).distinct().withColumn("_p", F.lit(True))
    e = block_range(spark, low, high, key).join(flags, key, "left")
    g = e.agg(F.max(F.when(F.col("_p").isNull(), F.col(key))).alias("m"),
              F.min(F.when(F.col("_p"), F.col(key))).alias("p"))
    return g.select(
        F.coalesce(F.col("m"), F.lit(low - 1)).cast("bigint").alias("next_block"),
        F.coalesce(F.col("p") - 1, F.lit(high)).cast("bigint").alias("next_block_reference"))


def chunk_completeness(spark: SparkSession, present: DataFrame, low: int, high: int, size: int,
                       key: str = "block") -> DataFrame:
    """AGG-3: absolute grid chunk = block div size, clamped to [low, high];
    complete when every block of the clamped chunk is present. Chunks with no
    present block at all are listed too (expected chunks left join counts)."""
    first, last = low // size, high // size
    chunks = spark.range(first, last + 1).select(F.col("id").alias("chunk_id"))
    counts = (present.where((F.col(key) >= low) & (F.col(key) <= high))
              .groupBy(F.expr(f"{key} div {size}").alias("chunk_id"))
              .agg(F.count_distinct(key).alias("n_present")))
    c = chunks.join(counts, "chunk_id", "left")
    start = F.greatest(F.col("chunk_id") * size, F.lit(low))
    end = F.least(F.col("chunk_id") * size + size - 1, F.lit(high))
    return c.select(
        F.lit(size).cast("bigint").alias("chunk_size"), F.col("chunk_id").cast("bigint").alias("chunk_id"),
        start.cast("bigint").alias("chunk_start"), end.cast("bigint").alias("chunk_end"),
        F.coalesce("n_present", F.lit(0)).cast("bigint").alias("n_present"),
        (F.coalesce("n_present", F.lit(0)) == end - start + 1).alias("is_complete"))


def page_reconcile(items: DataFrame, page_size: int, expected: DataFrame | None = None) -> DataFrame:
    """AGG-4: provider total vs distinct transactions received per block; pages =
    ceil(count / rpp); a mismatch flags a silently truncated block (D13). Pages
    without items count as received pages, and a transaction that came twice
    counts once. With ``expected`` (column ``block``) a block of which nothing
    arrived is reported too (nothing received, total unknown)."""
    g = items.groupBy("block").agg(
        F.max("count").alias("reported"), F.count_distinct("transactionHash").alias("received"),
        F.count_distinct("page").alias("pages_received"))
    if expected is not None:
        g = expected.select("block").distinct().join(g, "block", "left").fillna(0, ["received", "pages_received"])
    return g.select(
        F.col("block").cast("bigint").alias("block"), F.col("reported").cast("bigint").alias("reported"),
        F.col("received").cast("bigint").alias("received"),
        F.ceil(F.col("reported") / F.lit(page_size)).cast("bigint").alias("pages_expected"),
        F.col("pages_received").cast("bigint").alias("pages_received"),
        F.coalesce(F.col("received") != F.col("reported"), F.lit(True)).alias("mismatch"))


def chunk_throughput(manifest: DataFrame, size: int, key: str = "block") -> DataFrame:
    """AGG-7: rows / seconds per chunk from the manifest."""
    g = manifest.groupBy(F.expr(f"{key} div {size}").alias("chunk_id")).agg(
        F.sum("n_tx").alias("n_rows"), F.sum("seconds").alias("seconds"))
    return g.select(F.col("chunk_id").cast("bigint").alias("chunk_id"),
                    F.col("n_rows").cast("bigint").alias("n_rows"),
                    F.col("seconds").cast("bigint").alias("seconds"),
                    F.round(F.col("n_rows") / F.nullif(F.col("seconds"), F.lit(0)), 4).alias("tx_per_sec"))
