"""SET-1..SET-4."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_retry(first: DataFrame, retried: DataFrame) -> DataFrame:
    """SET-1: concatenation of first-pass and retry results, duplicates kept."""
    return first.unionByName(retried, allowMissingColumns=True)


def recovered_blocks(missing_before: DataFrame, missing_after: DataFrame) -> DataFrame:
    """SET-2: blocks missing before the retries but not after (distinct)."""
    return missing_before.subtract(missing_after)


def repeated_cursors(items_or_pages: DataFrame, block: str = "block", cursor: str = "nextCursor") -> DataFrame:
    """SET-3: a cursor seen more than once for a block means a paging loop."""
    return (items_or_pages.where(F.col(cursor).isNotNull()).groupBy(block, cursor)
            .agg(F.count(F.lit(1)).alias("n_seen")).where(F.col("n_seen") > 1))


def holder_registry(snapshot: DataFrame, new: DataFrame, detected_at: str) -> DataFrame:
    """SET-4: the top-holder snapshot plus newly detected holders, each row
    tagged with where it came from; new rows carry their detection time."""
    return (snapshot.withColumn("note", F.lit("top_holder_snapshot"))
            .withColumn("detected_at", F.lit(None).cast("timestamp_ntz"))
            .unionByName(new.withColumn("note", F.lit("new_holder_detected"))
                         .withColumn("detected_at", F.lit(detected_at).cast("timestamp_ntz")),
                         allowMissingColumns=True))
