"""Embedding near-duplicates by product quantisation.

Coarse lists and residual subspace codebooks are fitted on a bounded sample
(``SAMPLE`` distinct vectors with the smallest hashes); every vector is indexed.

* Probes: for unit vectors cosine >= t means a distance of at most
  r = sqrt(2 - 2t).  x lies (|x-c'|^2 - |x-c|^2) / (2 |c-c'|) away from the cell
  of c' when c is its nearest centroid, so no list further than r can matter.
  Real pairs need much less than r: ``QUERIES`` vectors are compared with all
  vectors, and the largest distance that any of their links needs, times
  ``SPARE``, is the margin within which every vector probes every list.  Half of
  the queries must find ``RECALL`` of its links with the margin of the other
  half, otherwise (or where the queries have no links) the margin is r itself.
  A table of at most ``QUERIES`` distinct vectors loses no link, and
  ``exact=True`` sets the margin to r and loses none at any size.
* Asymmetric distances: |x - code(y)| is summed from one table per subspace (the
  code of y is its list's centroid plus its codewords).  The coding error e of
  every vector is stored, and |x - y| >= |x - code(y)| - e, so pairs with
  |x - code(y)| > r + e are dropped.
* The rest is reranked with exact cosines in double precision.

The margin is the only approximate step; two vectors meet when each probes the
list of the other.  Only the probed lists are scanned.  The number of lists grows
with the vectors, up to ``MAX_LISTS``.  Each dimension that occurs has an index of
its own, so the number of different dimensions should be small.

Equal vectors are one node with a count.  Neighbouring lists share a block of
``BLOCK`` rows at most, and a longer list is cut into several.  A task meets two
blocks, each with only those of its vectors that probe a list of the other, so a
list that holds a third of all vectors is spread out.  A task returns per vector
the number of links and a spanning forest of the links found, never the pairs.

Defined results: vectors that are null, zero, or that hold null or non-finite
components link with nothing; vectors of different dimensions never link; repeated
ids are separate vectors; rows with a null id are left out; an empty table is empty.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import connected, stored

SAMPLE = 16_384
QUERIES = 4_096  # vectors compared with all others to set the probes
SPARE = 1.25
RECALL = 0.99
MARGINS = 64     # steps in which needed margins are counted
BATCH = 2_048
BLOCK = 8_192
BLOCK_VALUES = 1 << 21
MIN_BLOCKS = 8
MIN_BLOCK = 256
CODES = 256
LIST_ROWS = 64
MAX_LISTS = 2_048
EPS = 1e-6
TABLE_EPS = 1e-5  # rounding of the tables' single precision
LINKS = "node bigint, links bigint, root bigint"


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _sq_dist(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def _kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([_sq_dist(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def _in_order(c: np.ndarray) -> list[int]:
    """Centroids in an order that keeps neighbours together: halved along the widest direction."""
    def halves(i):
        if len(i) < 3:
            return i.tolist()
        x = c[i] - c[i].mean(0)
        i = i[np.argsort(x @ np.linalg.eigh(x.T @ x)[1][:, -1], kind="stable")]
        return halves(i[:len(i) // 2]) + halves(i[len(i) // 2:])
    return halves(np.arange(len(c)))


def _blocks(coarse: np.ndarray, size: dict, rows: int) -> dict:
    """Blocks of ``rows`` rows at most: the parts of each list (``slots``), their lists and blocks."""
    parts, first, slot_list, slot_block, block, held = np.ones(len(coarse), np.int64), np.zeros(len(coarse), np.int64), [], [], 0, 0
    for at in _in_order(coarse):
        n = size.get(at, 0)
        parts[at], first[at] = max(1, -(-n // rows)), len(slot_list)
        for _ in range(parts[at]):
            share = -(-n // int(parts[at]))
            if held and held + share > rows:
                block, held = block + 1, 0
            held += share
            slot_list.append(at)
            slot_block.append(block)
    slot_block = np.array(slot_block)
    return {"parts": parts, "first": first, "slot_list": np.array(slot_list), "slot_block": slot_block,
            "starts": np.flatnonzero(np.diff(slot_block, prepend=-1))}


def fit(sample: np.ndarray, lists: int, parts: int = 8) -> dict:
    """Coarse centroids, one residual codebook for each run of dimensions."""
    rng = np.random.default_rng(11)
    x = _unit(sample.astype(np.float64))
    coarse = _kmeans(x, lists, 8, rng)
    rest = x - coarse[_sq_dist(x, coarse).argmin(1)]
    cuts = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
    books = [_kmeans(rest[:, a:b], CODES, 6, rng) for a, b in zip(cuts[:-1], cuts[1:])]
    return {"coarse": coarse, "cuts": cuts, "books": books}


def _matrix(column, dim: int) -> np.ndarray:
    return np.array(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(),
                    dtype=np.float64).reshape(-1, dim)


def _away(x: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How far each x lies from the cell of centroid ``other`` (0: the same cell), row by row."""
    gap = np.sqrt(((own - other) ** 2).sum(1))
    away = ((x - other) ** 2).sum(1) - ((x - own) ** 2).sum(1)
    return np.where(gap > 0, away / np.maximum(2 * gap, 1e-300), 0)


def _needed(model, queries, cosine: float, radius: float):
    """Index rows -> (half, step, links): margins that the links of the queries need."""
    def run(batches):
        coarse = model.value["coarse"]
        q_node, q = queries.value
        q_own = coarse[_nearest(q, coarse)]
        q32 = q.astype(np.float32)
        found = np.zeros((2, MARGINS + 1), dtype=np.int64)
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                node, x = part.column(0).to_numpy(), _unit(_matrix(part.column(2), coarse.shape[1]))
                i, j = np.nonzero(x.astype(np.float32) @ q32.T >= cosine - TABLE_EPS)
                i, j = i[node[i] != q_node[j]], j[node[i] != q_node[j]]
                own = coarse[part.column(3).to_numpy()]
                for k in range(0, len(i), 1 << 16):
                    u, v = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                    need = np.maximum(_away(x[u], own[u], q_own[v]), _away(q[v], q_own[v], own[u]))
                    step = np.clip(np.ceil(need / radius * MARGINS), 0, MARGINS).astype(np.int64)
                    np.add.at(found, (v % 2, step), 1)
        half, step = np.nonzero(found)
        yield pa.record_batch([pa.array(half, pa.int32()), pa.array(step, pa.int32()), pa.array(found[half, step], pa.int64())],
                              names=["half", "step", "links"])
    return run


def _nearest(x: np.ndarray, coarse: np.ndarray) -> np.ndarray:
    return np.concatenate([_sq_dist(x[i:i + BATCH], coarse).argmin(1) for i in range(0, len(x), BATCH)])


def fitted_margin(counts: list[tuple[int, int, int]], radius: float) -> tuple[float, float | None]:
    """(margin, recall of the second half of the queries with the first half's margin)
    from (half, step, links); the recall is None where a half has no link."""
    halves = [{s: n for h, s, n in counts if h == half} for half in (0, 1)]
    if not halves[0] or not halves[1]:
        return radius, None
    reach = SPARE * max(halves[0])
    recall = sum(n for s, n in halves[1].items() if s <= reach) / sum(halves[1].values())
    most = max(1, *halves[0], *halves[1])
    return (radius if recall < RECALL else min(radius, SPARE * most / MARGINS * radius)), recall


def _assign(model):
    """node, copies, vec -> + list, codes, error."""
    def run(batches):
        m = model.value
        coarse, cuts, books = m["coarse"], m["cuts"], m["books"]
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                x = _unit(_matrix(part.column(2), coarse.shape[1]))
                own = _sq_dist(x, coarse).argmin(1)
                rest = x - coarse[own]
                codes = np.empty((len(x), len(books)), dtype=np.uint8)
                err = np.zeros(len(x))
                for j, (book, lo, hi) in enumerate(zip(books, cuts[:-1], cuts[1:])):
                    dist = _sq_dist(rest[:, lo:hi], book)
                    codes[:, j] = dist.argmin(1)
                    err += ((rest[:, lo:hi] - book[codes[:, j]]) ** 2).sum(1)
                yield pa.record_batch([
                    part.column(0), part.column(1), part.column(2), pa.array(own, pa.int32()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(np.sqrt(err))],
                    names=["node", "copies", "vec", "list", "codes", "err"])
    return run


def _probes(x: np.ndarray, own: np.ndarray, coarse: np.ndarray, lists: np.ndarray, margin: float) -> np.ndarray:
    """Which of ``lists`` each x probes."""
    mine, others = coarse[own], coarse[lists]
    away = _sq_dist(x, others) - ((x - mine) ** 2).sum(1)[:, None]
    return away <= 2 * np.sqrt(_sq_dist(mine, others)) * (margin + EPS) + EPS


def _deal(model, blocks, margin: float):
    """Index rows -> + block of the vector, blocks that hold a probed list."""
    def run(batches):
        k, coarse = blocks.value, model.value["coarse"]
        every = np.arange(len(coarse))
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                node, own = part.column(0).to_numpy(), part.column(3).to_numpy()
                possible = _probes(_unit(_matrix(part.column(2), coarse.shape[1])), own, coarse, every, margin)
                block = k["slot_block"][k["first"][own] + (node.view(np.uint64) % k["parts"][own].astype(np.uint64)).astype(np.int64)]
                met = np.logical_or.reduceat(possible[:, k["slot_list"]], k["starts"], axis=1)
                yield pa.record_batch([*part.columns[:6], pa.array(block, pa.int32()),
                                       pa.array([np.flatnonzero(v).astype(np.int32) for v in met], pa.list_(pa.int32()))],
                                      names=["node", "copies", "vec", "list", "codes", "err", "block", "met"])
    return run


def _join(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest row reached when the links u-v are added, with pointer jumping."""
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _unit_links(model, cosine: float, radius: float, margin: float):
    """Two blocks (or one with itself) -> links per vector, forest of links."""
    def run(t: pa.Table) -> pa.Table:
        m = model.value
        coarse, cuts, books = m["coarse"], m["cuts"], m["books"]
        t = t.combine_chunks()
        node, copies = t.column("node").to_numpy(), t.column("copies").to_numpy()
        block, one, two = t.column("block").to_numpy(), t.column("a")[0].as_py(), t.column("b")[0].as_py()
        x = _matrix(t.column("vec"), coarse.shape[1])
        unit = _unit(x)
        own = t.column("list").to_numpy()
        by_list = np.argsort(own, kind="stable")
        qi, yi = by_list[block[by_list] == one], by_list[block[by_list] == two]
        links, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
        codes = np.frombuffer(b"".join(t.column("codes").take(pa.array(yi)).to_pylist()), dtype=np.uint8).reshape(len(yi), len(books))
        limit = (radius + EPS + t.column("err").to_numpy()[yi]) ** 2 + EPS + TABLE_EPS
        held, first, nth = np.unique(own[yi], return_index=True, return_inverse=True)
        last = np.append(first[1:], len(yi))
        decoded = coarse[held][nth] + np.concatenate([book[codes[:, j]] for j, book in enumerate(books)], axis=1)
        # |x - code|^2 <= limit, as x . centroid + sum of x . codeword >= need
        need = ((1 + np.einsum("ij,ij->i", decoded, decoded) - limit) / 2).astype(np.float32)
        for at in range(0, len(qi) if len(yi) else 0, 256):
            q = qi[at:at + 256]
            probed = _probes(unit[q], own[q], coarse, held, margin)
            centre = (unit[q] @ coarse[held].T).astype(np.float32)
            tables = [(unit[q, lo:hi] @ book.T).astype(np.float32) for book, lo, hi in zip(books, cuts[:-1], cuts[1:])]
            hits = []
            for i in np.flatnonzero(probed.any(0)):  # the lists that any of the queries probes
                who, rows = np.flatnonzero(probed[:, i]), slice(first[i], last[i])
                dot = np.repeat(centre[who, i][:, None], last[i] - first[i], axis=1)
                for j, near in enumerate(tables):
                    dot += np.take(near[who], codes[rows, j], axis=1)
                a, c = np.nonzero(dot >= need[rows][None])
                hits.append((q[who[a]], yi[rows][c]))
            if not hits:
                continue
            a, c = (np.concatenate(side) for side in zip(*hits))
            if one == two:
                a, c = a[a < c], c[a < c]
            for k in range(0, len(a), 1 << 16):
                u, v = a[k:k + (1 << 16)], c[k:k + (1 << 16)]
                s = x[u] / np.abs(x[u]).max(1, keepdims=True)
                w = x[v] / np.abs(x[v]).max(1, keepdims=True)
                cos = np.einsum("ij,ij->i", s, w) / np.sqrt(np.einsum("ij,ij->i", s, s) * np.einsum("ij,ij->i", w, w))
                u, v = u[cos >= cosine], v[cos >= cosine]
                both = _away(unit[v], coarse[own[v]], coarse[own[u]]) <= margin + EPS  # whichever of the two asks
                u, v = u[both], v[both]
                np.add.at(links, u, copies[v])
                np.add.at(links, v, copies[u])
                new = root[u] != root[v]
                root = _join(root, u[new], v[new])
        keep = np.flatnonzero((links > 0) | (root != np.arange(len(node))))
        return pa.table({"node": node[keep], "links": links[keep], "root": node[root[keep]]})
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding",
                 lists: int | None = None, exact: bool = False) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable), kept."""
    spark = vectors.sparkSession
    given = vectors.schema[vec_col].dataType
    kind = "array<float>" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "array<double>"  # as given: half the shuffle
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(kind).alias("vec")).where("vec_id IS NOT NULL")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("vec").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    named = stored(v.select("vec_id", F.when(usable, F.col("vec")).alias("vec"))
                   .withColumn("node", F.when(F.col("vec").isNotNull(), F.xxhash64("vec"))), "pq-vectors")
    nodes = stored(named.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.first("vec").alias("vec")), "pq-nodes")
    sizes = nodes.groupBy(F.size("vec").alias("dim")).count().orderBy("dim").collect()  # one row a dimension
    found = spark.createDataFrame([], LINKS)
    for dim, n in sizes:
        if n > 1:
            found = found.union(_dimension_links(nodes.where(F.size("vec") == dim), dim, n, kind, cosine, lists, exact))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected(spark, found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_node = stored(nodes.select("node", "copies").join(links, "node", "left").join(groups, "node", "left")
                      .select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                              F.coalesce("component", "node").alias("group")), "pq-groups")
    marked = named.where("node IS NOT NULL").select("vec_id", "node").join(per_node, "node")
    first = marked.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    out = marked.join(first, "group").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return out.union(_plain(named.where("node IS NULL")))


def _by_hash(nodes: DataFrame, n: int, seed: int):
    return nodes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(n).select("node", "vec").collect()


def _dimension_links(nodes: DataFrame, dim: int, n: int, kind: str, cosine: float, lists: int | None, exact: bool) -> DataFrame:
    """Links per node and a forest of links among the ``n`` distinct vectors of one dimension."""
    context, radius = nodes.sparkSession.sparkContext, math.sqrt(2 - 2 * cosine)
    sample = np.array([r[1] for r in _by_hash(nodes, SAMPLE, 0)], dtype=np.float64)
    model = context.broadcast(fit(sample, lists or min(MAX_LISTS, max(1, n // LIST_ROWS))))  # <= 2,048 centroids
    index = f"node bigint, copies bigint, vec {kind}, list int, codes binary, err double"
    rows = stored(nodes.select("node", "copies", "vec").mapInArrow(_assign(model), index), "pq-index")
    margin = radius
    if not exact:
        asked = _by_hash(nodes, QUERIES, 1)
        queries = context.broadcast((np.array([r[0] for r in asked]), _unit(np.array([r[1] for r in asked], dtype=np.float64))))
        counts = (rows.mapInArrow(_needed(model, queries, cosine, radius), "half int, step int, links bigint")
                  .groupBy("half", "step").agg(F.sum("links")).collect())  # <= 2 * (MARGINS + 1) rows
        margin, _ = fitted_margin([tuple(r) for r in counts], radius)

    # rows per list: at most MAX_LISTS rows on the driver
    size = {r[0]: r[1] for r in rows.groupBy("list").count().collect()}
    most = min(BLOCK, max(MIN_BLOCK, BLOCK_VALUES // dim), max(MIN_BLOCK, -(-n // MIN_BLOCKS)))
    blocks = context.broadcast(_blocks(model.value["coarse"], size, most))
    carried = ["node", "copies", "vec", "list", "codes", "err", "block"]
    return stored(rows.mapInArrow(_deal(model, blocks, margin), f"{index}, block int, met array<int>")
                  .select(*carried, F.explode("met").alias("other"))
                  .select(*carried, F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
                  .groupBy("a", "b").applyInArrow(_unit_links(model, cosine, radius, margin), LINKS), "pq-links")


def _plain(v: DataFrame) -> DataFrame:
    return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
