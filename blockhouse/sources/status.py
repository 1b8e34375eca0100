"""SRC-12: per expected hour, is the source empty, ready or missing?"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["year", "month", "day", "hour"]


def source_status(expected: DataFrame, manifest: DataFrame, strict: bool = False) -> DataFrame:
    """``expected``: hour keys; ``manifest``: hour keys + n_rows. Marker
    (n_rows = 0) -> 'empty' (skip), data -> 'ready' (load), neither ->
    'missing'; in strict mode a missing hour raises when the plan runs."""
    m = manifest.select(*KEYS, F.col("n_rows").alias("_n"))
    j = expected.join(m, KEYS, "left")
    status = (F.when(F.col("_n").isNull(), F.lit("missing"))
              .when(F.col("_n") == 0, F.lit("empty")).otherwise(F.lit("ready")))
    if strict:
        status = F.when(status == "missing", F.raise_error(F.concat(
            F.lit("source missing for hour "), F.concat_ws("-", *[F.col(k) for k in KEYS])))).otherwise(status)
    return j.select(*KEYS, status.alias("status"))
