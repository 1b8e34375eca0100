"""Helpers shared by the training-data operators.

Words are runs of bytes other than space and ``\\x09``-``\\x0D``.  Word and
n-gram identities are 64-bit fingerprints computed over whole Arrow batches
with numpy; a batch is cut into chunks of a few MB, so memory follows the chunk
and the longest single text, never the table.
"""
from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from blockhouse.session import scratch_path

CHUNK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20  # of an Arrow batch between the JVM and Python, about
_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd: powers are invertible modulo 2**64
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, *cols: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text as binary (null: empty) and nothing else: other columns can't clash.

    Every Arrow map of a text operator starts here, so the session's batches are bounded
    here too: by bytes, as 10,000 texts (Spark's default) are held several times over, on
    both sides, and a Python worker keeps what it once took."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"), *cols)


def give_back() -> None:
    """Freed memory returns to the system: Arrow's pool, then the C library's (where it can)."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable) -> Callable:
    """``run``, an Arrow map or cogroup function, that gives back what it freed when it
    ends. Spark keeps idle Python workers for the next tasks, one for each step that
    ever ran side by side, and each would hold the most that any step took."""
    if inspect.isgeneratorfunction(run):
        def mapped(batches):
            try:
                yield from run(batches)
            finally:
                give_back()
        return mapped

    def grouped(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            give_back()
    return grouped


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (xor-shift and multiply rounds), in a new array."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[[32, 9, 10, 11, 12, 13]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((int(_MULT), pow(int(_MULT), -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def hash_words(buf: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit fingerprint of every word of ``buf``.

    A buffer above the chunk size is handled in slices cut at separators.
    """
    if len(buf) > 2 * CHUNK_BYTES:
        out, at = [], 0
        while at < len(buf):
            end = min(len(buf), at + CHUNK_BYTES)
            while end < len(buf) and not _IS_SEP[buf[end]]:
                end += 1
            s, e, h = hash_words(buf[at:end], lower) if end - at <= 2 * CHUNK_BYTES else _hash_slice(buf[at:end], lower)
            out.append((s + at, e + at, h))
            at = end
        return tuple(np.concatenate(x) for x in zip(*out))
    return _hash_slice(buf, lower)


def _hash_slice(buf: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = np.frombuffer(buf, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~_IS_SEP[b]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    pw, inv = _power_tables(len(b) + 1)
    acc = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[b] * pw[:len(b)], out=acc[1:])
    return start, end, mix((acc[end] - acc[start]) * inv[start] + (end - start).astype(np.uint64))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Fingerprint of each k consecutive words (empty when there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        acc *= _MULT
        acc += words[j:j + n]
    return mix(acc)


def doc_chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list]]:
    """(doc ids, texts) of about ``limit`` bytes; a longer text comes alone. Only
    these are copied out of the Arrow batch, not all of its texts."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        at, size = 0, 0
        for i, n in enumerate(pc.binary_length(texts).to_pylist()):
            if size and size + n > limit:
                yield ids.slice(at, i - at).to_pylist(), texts.slice(at, i - at).to_pylist()
                at, size = i, 0
            size += n + 1
        if at < batch.num_rows:
            yield ids.slice(at).to_pylist(), texts.slice(at).to_pylist()


def chunk_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Words of several texts at once: per-text offsets into the word arrays,
    then starts, ends, fingerprints and the joined buffer."""
    buf = b" ".join(texts)
    start, end, h = hash_words(buf, lower)
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return np.searchsorted(start, bounds), start, end, h, buf


def packed(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Components of undirected ``edges(a, b)`` -> (node, component = smallest node).

    Alternating large-star and small-star steps over distinct edges; each round
    is written to the shared folder, and the loop ends when the edges are stars.
    Rounds grow with the logarithm of the longest chain.  A hub with very many
    edges is reduced by map-side minima and split by the skew join.
    """
    cur = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "cc")
    while not _are_stars(cur):
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(cur.select(F.col("b"), F.col("a")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: neighbours above u move to the minimum around u
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        # small star: u and its smaller neighbours move to the smallest of them
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
                 .union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct())
        cur = stored(small, "cc")
    return (cur.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
            .union(cur.select("a", "a").distinct()))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of distinct ``edges(a < b)`` is either a centre (only
    ``a``) or the end of one edge: then the centres name the components."""
    ends = (edges.select(F.col("a").alias("node"), F.lit(0).alias("end"), F.lit(1).alias("centre"))
            .union(edges.select("b", F.lit(1), F.lit(0))))
    roles = ends.groupBy("node").agg(F.sum("end").alias("ends"), F.max("centre").alias("centre"))
    return roles.where("ends + centre > 1").isEmpty()


def text_volume(texts: DataFrame) -> int:
    """Bytes of all texts (one aggregate; only sizes work units, never a result)."""
    return int(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def split_sorted(keys: np.ndarray, *rest: np.ndarray) -> Iterator[tuple]:
    """Runs of equal values of ``keys``: (value, slice of each array), by value."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    cut = np.flatnonzero(k[1:] != k[:-1]) + 1
    parts = [np.split(a[order], cut) for a in rest]
    for i, at in enumerate(np.concatenate([[0], cut]) if len(k) else []):
        yield k[at].item(), *(p[i] for p in parts)
