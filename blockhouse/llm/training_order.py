"""Training-order materialisation: fixed-stride shards in a keyed random order.

1. Each input split is tokenised into one stream (id 0 ends a document) and cut
   into sequences of ``stride`` ids; only a split's last one is padded with id 0.
   The sequences are written once, compressed, with their place in the split.
2. Splits are numbered through (a running sum over one row per split), which
   gives every sequence a dense index below N.
3. A keyed Feistel network over the smallest even-bit domain above N permutes
   the index; values at or above N walk the cycle until they fall below it.
   The result is a bijection: slot = place in the training order.
4. Slots are range partitioned into shards of equal slot counts (bounds are
   arithmetic, nothing is sampled), sorted, and written one file a shard.  Row r
   of shard s is slot s * shard_slots + r and holds exactly 2 * stride bytes, so
   a reader resumes at any slot by shard and row.

A lost executor repeats only its split or shard.  Defined results: a null text
is an empty document (one id); repeated rows are repeated documents; null ids
stay null in ``doc_ids``; an empty table writes no shard.
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from blockhouse.session import scratch_path

from .common import mix, stored, text_bytes
from .packing import END
from .tokens import default_vocabulary, encoder

MAX_BROADCAST_SPLITS = 1_000_000
_U = np.uint64
SEQUENCES = "split int, place bigint, n_ids int, doc_ids array<bigint>, ids binary"


def feistel(index: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """Keyed bijection of [0, n) onto itself, by cycle walking in a 4**k domain."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = _U((1 << half) - 1), _U(half)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(key & (1 << 64) - 1))

    def once(x):
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << shift) | right

    x = once(index.astype(np.uint64))
    while (out := np.flatnonzero(x >= _U(n))).size:
        x[out] = once(x[out])
    return x.astype(np.int64)


def _sequences(vocabulary: str, stride: int):
    def run(batches):
        import zstandard

        enc, pack = encoder(vocabulary), zstandard.ZstdCompressor(level=1)
        if enc.top >= 1 << 16:
            raise ValueError(f"{vocabulary} has ids above 65,535: they do not fit the rows' two bytes")
        split, place = TaskContext.get().partitionId(), 0
        buf, held = bytearray(), []  # the open stream and its (doc, bytes left in the stream)
        size = 4 * stride

        def take(n):
            nonlocal place
            row = np.zeros(stride, dtype="<u2")
            row[:n // 4] = np.frombuffer(buf[:n], dtype="<u4").astype("<u2")
            docs, room = [], n
            while room > 0:
                doc, left = held[0]
                docs.append(doc)
                if left > room:
                    held[0] = (doc, left - room)
                    break
                room -= left
                held.pop(0)
            del buf[:n]
            place += 1
            return split, place - 1, n // 4, docs, pack.compress(row.tobytes())

        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.ids(t.decode("utf-8", "replace")) + END
                buf += ids
                held.append((i, len(ids)))
                while len(buf) >= size:
                    rows.append(take(size))
                if len(rows) >= 512:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)
        if buf:
            yield _rows([take(len(buf))])
    return run


def _rows(rows):
    c = list(zip(*rows))
    return pa.record_batch([pa.array(c[0], pa.int32()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()),
                            pa.array(c[3], pa.list_(pa.int64())), pa.array(c[4], pa.binary())],
                           names=["split", "place", "n_ids", "doc_ids", "ids"])


def _slots(n: int, key: int):
    def run(batches):
        for b in batches:
            slot = feistel(b.column("index").to_numpy(), n, key)
            yield b.set_column(b.schema.get_field_index("index"), "slot", pa.array(slot))
    return run


def _raw(batches):
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        at = b.schema.get_field_index("ids")
        for i in range(0, b.num_rows, 1024):
            part = b.slice(i, 1024)
            yield part.set_column(at, "ids", pa.array([unpack.decompress(x) for x in part.column(at).to_pylist()], pa.binary()))


def materialise(docs: DataFrame, path: str, stride: int = 2048, shard_slots: int = 4096, key: int = 20_011,
                vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Write the shards under ``path``; returns the number of sequences."""
    spark = docs.sparkSession
    seqs = stored(text_bytes(docs, id_col=id_col, text_col=text_col)
                  .mapInArrow(_sequences(vocabulary or default_vocabulary(), stride), SEQUENCES), "order-sequences")
    counts = stored(seqs.groupBy("split").agg(F.count("*").alias("n")), "order-splits")
    before = F.sum("n").over(W.orderBy("split").rowsBetween(W.unboundedPreceding, -1))
    starts = stored(counts.select("split", F.coalesce(before, F.lit(0)).alias("first")), "order-starts")
    n = int(counts.agg(F.sum("n")).first()[0] or 0)
    if counts.limit(MAX_BROADCAST_SPLITS + 1).count() <= MAX_BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    placed = (seqs.join(starts, "split").select((F.col("first") + F.col("place")).alias("index"), "n_ids", "doc_ids", "ids")
              .mapInArrow(_slots(n, key), "slot bigint, n_ids int, doc_ids array<bigint>, ids binary"))
    shards = max(1, math.ceil(n / shard_slots))
    sharded = placed.select(F.floor(F.col("slot") / shard_slots).cast("int").alias("shard"), "*")
    (sharded.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")
     .mapInArrow(_raw, "shard int, slot bigint, n_ids int, doc_ids array<bigint>, ids binary")
     .write.option("compression", "zstd").partitionBy("shard").parquet(path))
    return n


def read_order(spark: SparkSession, path: str, from_slot: int = 0, shard_slots: int = 4096) -> DataFrame:
    """The sequences from a slot on; earlier shards are pruned by their folder."""
    s = spark.read.schema("slot bigint, n_ids int, doc_ids array<bigint>, ids binary, shard int").parquet(path)
    return s.where((F.col("shard") >= from_slot // shard_slots) & (F.col("slot") >= from_slot))


def _checksums(batches):
    for b in batches:
        at = b.schema.get_field_index("ids")
        raw = b.column(at).to_pylist()
        b = b.set_column(at, "ids_crc32", pa.array([zlib.crc32(x) for x in raw], pa.int64()))
        yield b.append_column("n_bytes", pa.array([len(x) for x in raw], pa.int32()))


def training_order(docs: DataFrame, shard_slots: int = 4096, **options) -> DataFrame:
    """slot, shard, row, n_ids, n_bytes, ids_crc32, doc_ids: read back from the shards written."""
    spark = docs.sparkSession
    path = scratch_path(spark, "training-order")
    if not materialise(docs, path, shard_slots=shard_slots, **options):
        spark.createDataFrame([], "slot bigint, n_ids int, doc_ids array<bigint>, ids binary, shard int").write.mode("ignore").parquet(path)
    return (read_order(spark, path, 0, shard_slots)
            .mapInArrow(_checksums, "slot bigint, n_ids int, doc_ids array<bigint>, ids_crc32 bigint, shard int, n_bytes int")
            .select("slot", "shard", (F.col("slot") - F.col("shard").cast("long") * shard_slots).alias("row"), "n_ids", "n_bytes", "ids_crc32", "doc_ids"))
