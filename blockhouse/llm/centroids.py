"""Centroid clustering with subvector dictionaries.

Components become integers, floor(scale * x).  Vectors are held in chunks; each
block of ``width`` dimensions of a chunk is dictionary-encoded without loss: its
distinct subvectors, and a code per vector.  A round computes the exact squared
distance of every distinct subvector to every centroid's part once and sums
these partial distances by code, and sums members by counting codes.  All of it
is integer arithmetic: 64-bit where the values allow, Python's integers
otherwise, so results are exact and do not depend on how rows are dealt.

Encoded chunks are written to the shared folder once; rounds read them.  A task
returns at most one row of sums per centroid, and these are added up in two
levels, so the driver gets one row per centroid and memory stays with the chunk.

Defined results: vectors that are null, of another number of components, or that
hold null or non-finite components are left out; repeated ids are separate
vectors; a null id stays, its hash sorts last; with fewer vectors than centroids
every vector starts one; a distance or inertia beyond a long is null; an empty
table gives an empty result.
"""
from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_parts, stored

WIDTH = 2
LONG = (1 << 63) - 1
CHUNK = "n int, ids binary, no_id binary, sizes binary, entries binary, wide_entries array<string>, codes binary"
SUMS = "cluster int, members string, inertia string, sums array<string>"


def _is_wide(top, dims: int) -> bool:
    """Whether squared distances of components up to ``top`` could pass 64 bits."""
    return dims * (2 * int(top) + 2) ** 2 > LONG


def _integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly (the scale is a power of two): 64-bit integers or,
    for wide values, Python's."""
    top = np.abs(x).max(initial=0)
    if top < LONG / scale and not _is_wide(top * scale, x.shape[-1]):
        return np.floor(scale * x).astype(np.int64)
    return np.array([math.floor(Fraction(v) * scale) for v in x.ravel()], dtype=object).reshape(x.shape)


def _encode(dims: int, scale: int, width: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            v = _integers(batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims), scale)
            wide, sizes, entries, codes = v.dtype == object, [], [], []
            for at in range(0, dims, width):
                distinct, code = _distinct(v[:, at:at + width])
                sizes.append(len(distinct))
                entries += distinct.ravel().tolist()
                codes.append(code)
            yield pa.record_batch([
                pa.array([len(v)], pa.int32()),
                pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()), pa.array([np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes()], pa.binary()),
                pa.array([np.array(sizes, "<i4").tobytes()], pa.binary()), pa.array([None if wide else np.array(entries, "<i8").tobytes()], pa.binary()),
                pa.array([[str(e) for e in entries] if wide else None], pa.list_(pa.string())),
                pa.array([np.stack(codes).astype("<u4" if len(v) > 1 << 16 else "<u2").tobytes()], pa.binary())],
                names=["n", "ids", "no_id", "sizes", "entries", "wide_entries", "codes"])
    return run


def _distinct(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a block and the number of each row's among them."""
    key = np.zeros(len(block), np.int64)
    for j in range(block.shape[1]):
        values, code = np.unique(block[:, j], return_inverse=True)
        _, key = np.unique(key * len(values) + code, return_inverse=True)
    first = np.zeros(key.max() + 1, np.int64)
    first[key[::-1]] = np.arange(len(key))[::-1]
    return block[first], key


class _Chunk:
    """Dictionaries (distinct subvectors per block) and codes of one row of ``CHUNK``."""

    def __init__(self, row: dict, dims: int, width: int, wide: bool):
        self.n = row["n"]
        self.codes = np.frombuffer(row["codes"], "<u4" if self.n > 1 << 16 else "<u2").reshape(-1, self.n)
        entries = np.frombuffer(row["entries"], "<i8") if row["entries"] is not None else np.array([int(e) for e in row["wide_entries"]], dtype=object)
        entries = entries.astype(object) if wide else entries
        self.blocks, at = [], 0
        for size, d in zip(np.frombuffer(row["sizes"], "<i4").tolist(), range(0, dims, width)):
            w = min(width, dims - d)
            self.blocks.append((d, w, entries[at:at + size * w].reshape(size, w)))
            at += size * w

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (ties: the smaller number) and squared distance of every vector."""
        total = 0
        for (d, w, entry), code in zip(self.blocks, self.codes):
            gap = entry[:, None, :] - centroids[None, :, d:d + w]
            total = total + (gap * gap).sum(2)[code]
        near = total.argmin(1)
        return near, total[np.arange(self.n), near]

    def sums(self, near: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of every cluster's members, from counts of codes."""
        out = []
        for (_, _, entry), code in zip(self.blocks, self.codes):
            held = np.bincount(near * len(entry) + code, minlength=k * len(entry)).reshape(k, -1)
            out.append(held.astype(entry.dtype) @ entry)
        return np.concatenate(out, axis=1)


def _chunks(batches, centroids: list, dims: int, width: int):
    wide = _is_wide(max((abs(v) for c in centroids for v in c), default=0), dims)
    c = np.array(centroids, dtype=object if wide else np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            chunk = _Chunk(row, dims, width, wide)
            yield row, chunk, *chunk.assign(c)


def _partial(centroids: list, dims: int, width: int):
    k = len(centroids)

    def run(batches):
        members, inertia, sums = [0] * k, [0] * k, [[0] * dims for _ in range(k)]
        for _, chunk, near, distance in _chunks(batches, centroids, dims, width):
            part = chunk.sums(near, k).tolist()
            for j, n in enumerate(np.bincount(near, minlength=k).tolist()):
                if n:
                    members[j] += n
                    inertia[j] += sum(distance[near == j].tolist())
                    sums[j] = [a + b for a, b in zip(sums[j], part[j])]
        yield _as_rows(members, inertia, sums)
    return run


def _as_rows(members: list, inertia: list, sums: list) -> pa.RecordBatch:
    live = [j for j, n in enumerate(members) if n]
    return pa.record_batch([pa.array(live, pa.int32()), pa.array([str(members[j]) for j in live], pa.string()), pa.array([str(inertia[j]) for j in live], pa.string()),
                            pa.array([[str(x) for x in sums[j]] for j in live], pa.list_(pa.string()))], names=["cluster", "members", "inertia", "sums"])


def _add(k: int, dims: int):
    """Partial rows of a partition added up, one at a time."""
    def run(batches):
        members, inertia, sums = [0] * k, [0] * k, [[0] * dims for _ in range(k)]
        for batch in batches:
            for r in batch.to_pylist():
                j = r["cluster"]
                members[j] += int(r["members"])
                inertia[j] += int(r["inertia"])
                sums[j] = [a + int(b) for a, b in zip(sums[j], r["sums"])]
        yield _as_rows(members, inertia, sums)
    return run


def _totals(chunks: DataFrame, centroids: list, dims: int, width: int) -> dict[int, tuple]:
    """cluster -> (members, inertia, sums): tasks, then groups of tasks, then one."""
    k = len(centroids)
    part = chunks.mapInArrow(_partial(centroids, dims, width), SUMS)
    part = part.repartition(math.isqrt(shuffle_parts(chunks.sparkSession))).mapInArrow(_add(k, dims), SUMS)
    rows = part.repartition(1).mapInArrow(_add(k, dims), SUMS).collect()  # one row per centroid at most
    return {r["cluster"]: (int(r["members"]), int(r["inertia"]), [int(x) for x in r["sums"]]) for r in rows}


def _final(centroids: list, dims: int, width: int, totals: dict[int, tuple]):
    whole = _long(sum(t[1] for t in totals.values()))
    inertia = {j: _long(t[1]) for j, t in totals.items()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def run(batches):
        for row, chunk, near, distance in _chunks(batches, centroids, dims, width):
            ids = pa.array(np.frombuffer(row["ids"], "<i8"), mask=np.unpackbits(np.frombuffer(row["no_id"], np.uint8), count=chunk.n).astype(bool))
            yield pa.record_batch([
                ids, pa.array(near.astype(np.int32)), pa.array([_long(x) for x in distance.tolist()], pa.int64()),
                pa.array([inertia[j] for j in near.tolist()], pa.int64()), pa.array([whole] * chunk.n, pa.int64()),
                pa.array([digest[j] for j in near.tolist()], pa.string())],
                names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])
    return run


def _long(x: int) -> int | None:
    return x if x <= LONG else None


def first_centroids(vectors: DataFrame, k: int, scale: int, seed: int) -> list:
    """The k vectors with the smallest sha256 of ``seed:id`` (ties: by components)."""
    rows = vectors.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "embedding").limit(k).collect()
    return [_integers(np.array(r["embedding"], dtype=np.float64), scale).tolist() for r in rows]


def cluster_vectors(embeddings: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
                    width: int = WIDTH, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list]:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per vector; final centroids)."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    vectors = embeddings.where((F.size(v) == dims) & finite).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("embedding"))
    centroids = first_centroids(vectors, k, scale, seed)
    chunks = stored(vectors.mapInArrow(_encode(dims, scale, width), CHUNK), "subvectors")
    for _ in range(rounds if centroids else 0):
        for j, (n, _, sums) in _totals(chunks, centroids, dims, width).items():
            centroids[j] = [x // n for x in sums]
    totals = _totals(chunks, centroids, dims, width) if centroids else {}
    out = chunks.mapInArrow(_final(centroids, dims, width, totals), "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return out, centroids
