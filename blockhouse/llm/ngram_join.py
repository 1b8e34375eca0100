"""Near-duplicate documents: exact Jaccard join on word shingles with
token-combination prefixes.

A document's set holds its distinct k-word shingles (64-bit fingerprints of
lower-cased words).  Documents with equal sets are one *node*; links are sought
between nodes only.

Order and classes.  One pass counts shingles in a fixed table of hashed slots.
Slots far above the mean load are *frequent*, graded by powers of two.  The
global order puts rare tokens first (by hash), then frequent ones by grade.

Prefixes.  Two sets with Jaccard >= t leave at most d = n - ceil(t n) of their n
tokens unmatched, so their first d + m tokens share at least m.  Rare tokens are
indexed singly.  Frequent tokens are dealt into sub-classes, and pairs of tokens
of one sub-class are indexed.  A prefix may match one token in each sub-class
without a common pair, so it is extended by one token per sub-class present;
then a shared rare token or a shared pair is certain.  The number of sub-classes
grows with the set size (per fourfold size level), which keeps the pairs linear
in the set size; a set indexes its own level and, if a partner could be on it,
the next.  A prefix that would pass the end of its set stops there and indexes
every frequent token singly too.

Verification.  In every index key all nodes are compared to one hub: a parity
sketch drops pairs that provably differ too much, the rest are intersected
exactly.  Links are merged into components, and
only keys that still hold several components go on: three hub rounds, then all
pairs of nodes of *different* components that still share a key, compared by
their sketches in units of bounded size that return only pairs to verify.  Thus a group
of thousands of copies costs rows in proportion to the group, and no link is
lost: components equal those of all pairs with Jaccard >= t.

Fingerprints stand for shingles; with 10**10 distinct shingles about three
pairs collide, which would have to meet inside one verified pair to matter.

Defined results: a null, empty or blank text has an empty set and links with
nothing; fewer than k words make one shingle; repeated rows give repeated
results; rows with a null id are left out (the id names the component).
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (_MULT, chunk_words, connected, doc_chunks, lean, mix, packed, shuffle_parts, stored, text_bytes,
                     window_hashes)

SLOT_BITS = 22              # fixed size of the count table: 2**22 counters
SLICES = 64                 # the table travels in 64 slices
BUCKET_ROWS = 1 << 19       # rare index entries per bucket, about
BROADCAST_IDS = 1_000_000   # ids are broadcast only up to this count
FLUSH_BYTES = 16 << 20
UNIT = 1024                 # nodes of a key that are compared in one unit
_U = np.uint64


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Sorted distinct fingerprints of each text (empty array: no words)."""
    offs, _, _, words, _ = chunk_words(texts, lower=True)
    every = window_hashes(words, k)
    for a, b in zip(offs[:-1], offs[1:]):
        if b - a >= k:
            yield np.unique(every[a:b - k + 1])
        elif b > a:
            yield window_hashes(words[a:b], b - a) ^ _U(b - a)
        else:
            yield every[:0]


def node_of(s: np.ndarray) -> int:
    """64-bit name of a set, equal for equal sets."""
    h = mix(np.array([mix(s * _MULT).sum(dtype=np.uint64) + _U(len(s))], dtype=np.uint64))
    return int(h.view(np.int64)[0])


def _slots(s: np.ndarray) -> np.ndarray:
    return (s >> _U(64 - SLOT_BITS)).astype(np.int64)


def count_slots(texts: DataFrame, k: int) -> DataFrame:
    """Documents per hashed shingle slot, summed over all documents: a fixed
    table in slices (slice, counts, total), added up in streaming tasks (two levels)."""
    per = (1 << SLOT_BITS) // SLICES

    def tally(batches):
        counts = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        some, salt = False, 0
        for ids, chunk in doc_chunks(batches):
            sets = [s for s in shingle_sets(chunk, k) if len(s)]
            if sets:
                some, salt = True, (salt + int(sets[0][0] >> _U(7))) % 16
                np.add.at(counts, _slots(np.concatenate(sets)), 1)
        if some:
            yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array([salt] * SLICES, pa.int32()),
                                   pa.array([packed(c.astype(np.int64)) for c in counts.reshape(SLICES, per)], pa.binary())],
                                  names=["slice", "salt", "counts"])

    def add(batches):
        total: dict = {}
        for b in batches:
            for key, salt, c in zip(*(b.column(i).to_pylist() for i in range(3))):
                at = total.setdefault((key, salt), np.zeros(per, dtype=np.int64))
                at += np.frombuffer(c, dtype=np.int64)
        if total:
            yield pa.record_batch([pa.array([x[0] for x in total], pa.int32()), pa.array([x[1] for x in total], pa.int32()),
                                   pa.array([packed(c) for c in total.values()], pa.binary())], names=["slice", "salt", "counts"])

    schema = "slice int, salt int, counts binary"
    parts = shuffle_parts(texts.sparkSession)
    level1 = texts.mapInArrow(lean(tally), schema).repartition(parts, "slice", "salt").mapInArrow(lean(add), schema)
    total = lambda batches: (b.append_column("total", pa.array([int(np.frombuffer(c, dtype=np.int64).sum()) for c in b.column(2).to_pylist()], pa.int64()))
                             for b in add(batches))
    return stored(level1.withColumn("salt", F.lit(0)).repartition(min(parts, SLICES), "slice")
                  .mapInArrow(total, schema + ", total bigint"), "ngram-slots")


def frequency_grades(counts: np.ndarray, least: float) -> np.ndarray:
    """0: rare; g: frequent, g grows with the count's power of two (one byte a slot)."""
    out = np.zeros(len(counts), dtype=np.uint8)
    often = np.flatnonzero(counts >= least)
    out[often] = (1 + np.floor(np.log2(counts[often] / least))).clip(1, 60)
    return out


def grade_table(slots: DataFrame, shingles: int) -> np.ndarray:
    """Grades of all slots: frequent ones lie five deviations above the mean load."""
    mean = shingles / (1 << SLOT_BITS)
    least, grade = max(32.0, mean + 5 * math.sqrt(mean)), frequency_grades

    def run(batches):
        for b in batches:
            grades = [packed(grade(np.frombuffer(c, dtype=np.int64), least)) for c in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(grades, pa.binary())], names=["slice", "grades"])

    table = np.zeros((SLICES, (1 << SLOT_BITS) // SLICES), dtype=np.uint8)
    for i, g in slots.select("slice", "counts").mapInArrow(run, "slice int, grades binary").collect():  # 4 MB at any size
        table[i] = np.frombuffer(g, dtype=np.uint8)
    return table.ravel()


def size_level(n: int) -> int:
    """Fourfold size level of a set: 1 for 4..15 tokens, 2 for 16..63, ..."""
    return (max(n, 4).bit_length() - 1) // 2


def subclasses(level: int) -> int:
    return max(2, 4 ** level // 8)


def index_keys(s: np.ndarray, grades: np.ndarray, pct: int) -> tuple[np.ndarray, np.ndarray]:
    """(rare single-token keys, frequent-pair keys) of a sorted set."""
    n, none = len(s), s[:0]
    d = n - -(-pct * n // 100)     # tokens that a partner may lack
    largest = n * 100 // pct       # size of the largest partner
    if d == 0 and largest == n:    # only an equal set could link
        return none, none
    g = grades[_slots(s)]
    rare = s[g == 0]
    if len(rare) > d:
        return rare[:d + 1], none
    often = s[g > 0]
    often = often[np.lexsort((often, g[g > 0]))]
    keys = []
    for level in {size_level(n), size_level(largest)}:
        sub = (mix(often ^ _MULT) % _U(subclasses(level))).astype(np.int64)
        fresh = np.zeros(len(often), dtype=np.int64)  # 1 where a sub-class occurs first
        fresh[np.unique(sub, return_index=True)[1]] = 1
        size = len(rare) + 1 + np.arange(len(often))
        enough = np.flatnonzero(size >= d + 1 + np.cumsum(fresh))
        m = enough[0] + 1 if len(enough) else len(often)
        order = np.argsort(sub[:m], kind="stable")
        t, c = often[:m][order], sub[:m][order]
        for apart in range(1, m):
            same = c[apart:] == c[:-apart]
            if not same.any():
                break
            a, b = t[:-apart][same], t[apart:][same]
            keys.append(mix(np.minimum(a, b) * _MULT + mix(np.maximum(a, b)) + _U(level)))
        if not len(enough):  # the set ends first: single frequent tokens complete the guarantee
            keys.append(mix(often + _U(level)))
    return rare, np.unique(np.concatenate(keys)) if keys else none


def _index(buckets: int, grades, k: int, pct: int):
    """Arrow map: documents -> packed rows, each for one of ``buckets`` partitions.

    kind 0: doc ids with their nodes, sizes and sketches; 1: rare entries;
    2: frequent-pair entries.  Nodes are numbered within a flush, so an entry
    takes a key and a small number; equal entries of one flush are sent once.
    """
    edges = np.arange(1, buckets, dtype=np.uint64) * _U((1 << 64) // buckets)

    def run(batches):
        table, turn = grades.value, 0
        held = {1: ([], []), 2: ([], [])}
        size, names = 0, []

        def flush():
            rows, all_names = [], np.array(names, dtype=np.int64)
            for kind, (ks, vs) in held.items():
                if not ks:
                    continue
                keys = np.concatenate(ks)
                local = np.repeat(np.array([v for v, _ in vs], dtype=np.int64), [c for _, c in vs])
                bucket = np.searchsorted(edges, keys, side="right")
                order = np.lexsort((local, bucket))
                keys, local = keys[order], local[order]
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for i in np.flatnonzero(np.diff(cut)):
                    kk, vv = keys[cut[i]:cut[i + 1]], local[cut[i]:cut[i + 1]]
                    used, vv = np.unique(vv, return_inverse=True)
                    rows.append((kind, int(i), packed(kk), packed(all_names[used]), packed(vv.astype(np.uint32)), None, None))
                ks.clear()
                vs.clear()
            names.clear()
            return rows

        for ids, texts in doc_chunks(batches):
            nodes, sizes, sketches, seen = [], [], [], {}
            for s in shingle_sets(texts, k):
                v = node_of(s)
                nodes.append(v)
                sizes.append(len(s))
                sketches.append(packed(parity_sketch(s)) if len(s) else b"")
                if len(s) and v not in seen:
                    seen[v] = True
                    for kind, keys in zip((1, 2), index_keys(s, table, pct)):
                        if len(keys):
                            held[kind][0].append(keys)
                            held[kind][1].append((len(names), len(keys)))
                            size += 16 * len(keys)
                    names.append(v)
            turn = (turn + 1 + abs(nodes[0])) % buckets
            rows = [(0, turn, packed(np.array(sizes, dtype=np.int64)), packed(np.array(nodes, dtype=np.int64)), None, ids, sketches)]
            if size > FLUSH_BYTES:
                rows += flush()
                size = 0
            yield _rows(rows)
        if rows := flush():
            yield _rows(rows)
    return run


_INDEX_SCHEMA = "kind int, bucket int, keys binary, nodes binary, which binary, ids array<bigint>, sketches array<binary>"
_ENTRY_SCHEMA = "kind int, key bigint, node bigint, n bigint, doc_id bigint, sketch binary"


def _rows(rows):
    c = list(zip(*rows))
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
    return pa.record_batch([pa.array(x, t) for x, t in zip(c, kinds)], names=["kind", "bucket", "keys", "nodes", "which", "ids", "sketches"])


def _entries(kind: int, keys=None, nodes=None, sizes=None, ids=None, sketches=None):
    n = len(nodes)
    none = lambda t: pa.nulls(n, t)
    return pa.record_batch([pa.array([kind] * n, pa.int32()), none(pa.int64()) if keys is None else pa.array(keys.view(np.int64)),
                            pa.array(nodes), none(pa.int64()) if sizes is None else pa.array(sizes),
                            none(pa.int64()) if ids is None else pa.array(ids, pa.int64()),
                            none(pa.binary()) if sketches is None else pa.array(sketches, pa.binary())],
                           names=["kind", "key", "node", "n", "doc_id", "sketch"])


def _settle(batches):
    """One bucket: documents and pair entries pass, of the rare entries those whose
    key is held by two nodes or more.  A rare key has few nodes by its slot count,
    so a bucket stays near its planned size."""
    ks, vs = [], []
    for b in batches:
        for kind, _, keys, nodes, which, ids, sketches in zip(*(b.column(i).to_pylist() for i in range(7))):
            nodes = np.frombuffer(nodes, dtype=np.int64)
            if kind == 0:
                yield _entries(0, None, nodes, np.frombuffer(keys, dtype=np.int64), ids, sketches)
                continue
            keys, nodes = np.frombuffer(keys, dtype=np.uint64), nodes[np.frombuffer(which, dtype=np.uint32)]
            if kind == 2:
                yield _entries(2, keys, nodes)
            else:
                ks.append(keys)
                vs.append(nodes)
    if not ks:
        return
    ks, vs = np.concatenate(ks), np.concatenate(vs)
    order = np.lexsort((vs, ks))
    ks, vs = ks[order], vs[order]
    new = np.ones(len(ks), dtype=bool)
    new[1:] = (ks[1:] != ks[:-1]) | (vs[1:] != vs[:-1])
    ks, vs = ks[new], vs[new]
    again = ks[1:] == ks[:-1]
    keep = np.zeros(len(ks), dtype=bool)
    keep[1:] |= again
    keep[:-1] |= again
    yield _entries(1, ks[keep], vs[keep])


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the tokens that fall on each of B bits, B the power of two >= 4 n.

    Tokens that two sets share cancel in the xor, so its bit count never exceeds
    the size of the symmetric difference; a longer sketch folds onto a shorter
    one by xor of its halves."""
    bits = max(256, 4 << (len(s) - 1).bit_length())
    odd = np.bincount((mix(s) % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _fold(x: np.ndarray, words: int) -> np.ndarray:
    """Sketches (in the last axis) folded onto ``words`` 64-bit words."""
    while x.shape[-1] > words:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def _possible(x: np.ndarray, y: np.ndarray, n, m, pct: int):
    """Whether sketches of equal length leave room for a link: |x ^ y| is at least
    their bit count, |x ^ y| = n + m - 2 both, and a link has (100 + pct) both >=
    pct (n + m)."""
    return (100 + pct) * np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64) <= (100 - pct) * (n + m)


def _may_link(pct: int):
    """Drops pairs whose sketches prove a Jaccard similarity below the threshold."""
    def run(batches):
        for b in batches:
            n, m, sa, sc = (b.column(i).to_pylist() for i in range(2, 6))
            keep = []
            for i in range(len(n)):
                x, y = np.frombuffer(sa[i], dtype=np.uint64), np.frombuffer(sc[i], dtype=np.uint64)
                words = min(len(x), len(y))
                if _possible(_fold(x, words), _fold(y, words), n[i], m[i], pct):
                    keep.append(i)
            yield pa.record_batch([b.column(0).take(pa.array(keep, pa.int64())), b.column(1).take(pa.array(keep, pa.int64()))], names=["a", "b"])
    return run


def _unit_pairs(block, node, component, n, sketches, pct: int) -> Iterator[tuple]:
    """Pairs of one unit whose components differ and whose sketches leave room for
    a link; in a unit of two blocks only pairs across the blocks."""
    across = block.min() != block.max()
    words = np.array([len(s) // 8 for s in sketches])
    for size in np.unique(words):
        i = np.flatnonzero(words == size)
        x = np.frombuffer(b"".join(sketches[k] for k in i), dtype=np.uint64).reshape(len(i), size)
        for other in (size, 2 * size):  # partners differ by a quarter at most: equal or twice the length
            j = i if other == size else np.flatnonzero(words == other)
            if not len(j):
                continue
            y = x if other == size else _fold(np.frombuffer(b"".join(sketches[k] for k in j), dtype=np.uint64).reshape(len(j), other), size)
            short_x, short_y = _fold(x, max(1, int(size) // 4)), _fold(y, max(1, int(size) // 4))
            step = max(1, (1 << 20) // len(j))
            for at in range(0, len(i), step):
                k = i[at:at + step]
                u, v = np.nonzero((component[k][:, None] != component[j][None])
                                  & (100 * np.minimum(n[k][:, None], n[j][None]) >= pct * np.maximum(n[k][:, None], n[j][None])))
                # most pairs go by sketches folded to a quarter, the rest by whole ones
                for left, right in ((short_x, short_y), (x, y)):
                    part = max(1, (1 << 20) // left.shape[1])
                    ok = [_possible(left[at + u[q:q + part]], right[v[q:q + part]], n[k[u[q:q + part]]], n[j[v[q:q + part]]], pct)
                          for q in range(0, len(u), part)]
                    ok = np.concatenate(ok) if ok else np.zeros(0, bool)
                    u, v = u[ok], v[ok]
                u, v = k[u], j[v]
                if across:
                    differ = block[u] != block[v]
                    u, v = u[differ], v[differ]
                yield from zip(np.minimum(node[u], node[v]).tolist(), np.maximum(node[u], node[v]).tolist())


def _meet(pct: int):
    """Entries sorted by unit -> pairs to verify. One unit is held at a time; a pair
    that several keys of a task yield is sent once."""
    def run(batches):
        held, seen, last = [], set(), None

        def finish():
            t = pa.concat_batches(held)
            held.clear()
            c = [t.column(i).to_numpy() for i in range(3, 7)]
            new = [p for p in _unit_pairs(*c, t.column(7).to_pylist(), pct) if p not in seen and not seen.add(p)]
            a, b = zip(*new) if new else ((), ())
            if len(seen) > 1 << 17:
                seen.clear()
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for b in batches:
            unit = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            cut = np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(unit)]):
                if lo == hi:
                    continue
                if held and tuple(unit[lo]) != last:
                    yield finish()
                last = tuple(unit[lo])
                held.append(b.slice(lo, hi - lo))
        if held:
            yield finish()
    return run


def _verify(pct: int):
    def run(batches):
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(4)]
            a, c = [], []
            for u, v, su, sv in zip(*cols):
                x, y = np.frombuffer(su, dtype=np.uint64), np.frombuffer(sv, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= pct * (len(x) + len(y) - both):
                    a.append(u)
                    c.append(v)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])
    return run


def _sets(k: int):
    def run(batches):
        for ids, texts in doc_chunks(batches):
            sets = list(shingle_sets(texts, k))
            yield pa.record_batch([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([packed(s) for s in sets], pa.binary())],
                                  names=["node", "tokens"])
    return run


def _remaining(entries: DataFrame, known: DataFrame, pct: int) -> DataFrame:
    """All pairs of nodes of different components that share a key, as far as their
    sketches leave room for a link.

    Keys with the same nodes (equal counts and 128-bit sums of node hashes) are one.
    A key with more than ``UNIT`` nodes is dealt into blocks, and a unit is a pair of
    blocks; comparisons stay inside a unit and only pairs to verify leave it."""
    wide = lambda seed: F.sum(F.xxhash64("node", F.lit(seed)).cast("decimal(38,0)"))
    alike = entries.groupBy("key").agg(F.count("*").alias("c"), wide(1).alias("s"), wide(2).alias("t"))
    keys = alike.groupBy("c", "s", "t").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("c") / UNIT).cast("int").alias("blocks"))
    e = (entries.join(keys, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
         .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
         .select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "component", "n"))
    e = e.join(known.select("node", "sketch"), "node")
    cols = ["key", "i", "j", "block", "node", "component", "n", "sketch"]
    parts = shuffle_parts(entries.sparkSession)
    return (e.select(*cols).repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(lean(_meet(pct)), "a bigint, b bigint").distinct())


def similar_groups(docs: DataFrame, k: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    return _grouped(docs, k, pct, id_col, text_col).drop("node")


def _grouped(docs: DataFrame, k: int, pct: int, id_col: str, text_col: str) -> DataFrame:
    """similar_groups with the node (fingerprint of the shingle set) of each row."""
    spark = docs.sparkSession
    texts = text_bytes(docs, id_col=id_col, text_col=text_col).where("doc_id IS NOT NULL")
    slots = count_slots(texts, k)
    shingles = int(slots.agg(F.sum("total")).first()[0] or 0)
    grades = spark.sparkContext.broadcast(grade_table(slots, shingles))  # 4 MB
    buckets = max(shuffle_parts(spark), math.ceil(shingles * (100 - pct) / 100 / BUCKET_ROWS))
    index = stored(texts.mapInArrow(lean(_index(buckets, grades, k, pct)), _INDEX_SCHEMA)
                   .repartitionById(buckets, F.col("bucket")).mapInArrow(lean(_settle), _ENTRY_SCHEMA), "ngram-index")
    nodes = index.where("kind = 0").select("doc_id", "n", "node", "sketch")
    pairs = index.where("kind = 2").select("key", "node")
    span = pairs.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    entries = index.where("kind = 1").select("key", "node").union(pairs.join(span, "key").distinct())

    sizes = nodes.groupBy("node").agg(F.min("n").alias("n"))
    sized = stored(entries.join(sizes, "node").select("key", "node", "n"), "ngram-sized")
    # size and sketch of each node, and one document that has its text
    known = nodes.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    known = stored(known.join(sized.select("node").distinct(), "node"), "ngram-nodes")

    side = lambda of, name, what: of.select(F.col("node").alias(name), *[F.col(c).alias(c + name) for c in what])
    labels = None
    for hub_round in range(4):
        open_ = sized
        if labels is not None:
            marked = sized.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
            keys = marked.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
            sized = open_ = stored(marked.join(keys, "key").select("key", "node", "n", "component"), "ngram-open")
            if open_.isEmpty():
                break
        if hub_round < 3:
            # the first round's hub is the same node for all keys of a group (few
            # pairs); later rounds draw one per key, for nodes still outside the
            # hub's component, so an outlier meets as many hubs as it has keys
            turn = F.xxhash64("node", F.lit(hub_round), *([F.col("key")] if hub_round else []))
            extra = ["component"] if labels is not None else []
            hubs = open_.groupBy("key").agg(F.min_by(F.struct("node", "n", *extra), turn).alias("h"))
            cand = open_.join(hubs, "key").where("node <> h.node")
            if labels is not None:
                cand = cand.where("component <> h.component")
            cand = cand.select("node", "n", F.col("h.node").alias("other"), F.col("h.n").alias("m"))
            near = (F.least("n", "m") * 100 >= F.greatest("n", "m") * pct)
            cand = cand.where(near).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
            cand = (cand.join(side(known, "a", ["n", "sketch"]), "a").join(side(known, "b", ["n", "sketch"]), "b")
                    .select("a", "b", "na", "nb", "sketcha", "sketchb").mapInArrow(lean(_may_link(pct)), "a bigint, b bigint"))
        else:
            cand = _remaining(open_, known, pct)
        cand = stored(cand, "ngram-candidates")
        wanted = stored(cand.select(F.col("a").alias("node")).union(cand.select("b")).distinct()
                        .join(known.select("node", "doc_id"), "node").select("doc_id"), "ngram-wanted")
        few = wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        sets = stored(texts.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
                      .mapInArrow(lean(_sets(k)), "node bigint, tokens binary"), "ngram-sets")
        found = (cand.join(side(sets, "a", ["tokens"]), "a").join(side(sets, "b", ["tokens"]), "b")
                 .select("a", "b", "tokensa", "tokensb").mapInArrow(lean(_verify(pct)), "a bigint, b bigint"))
        found = stored(found, "ngram-links")
        # components so far: stars of the last round plus the new links
        if labels is not None:
            found = found.union(labels.where("node <> component").select(F.col("component"), F.col("node")))
        labels = stored(connected(spark, found), "ngram-labels")
        if "component" in sized.columns:
            sized = sized.drop("component")

    named = nodes.join(labels, "node", "left").withColumn("group", F.coalesce("component", "node"))
    linked = named.where("n > 0")
    least = linked.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    out = linked.join(least, "group").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "node")
    return out.union(named.where("n = 0").select("doc_id", F.col("n"), F.col("doc_id"), "node"))


def _nodes(k: int):
    def run(batches):
        for ids, texts in doc_chunks(batches):
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([node_of(s) for s in shingle_sets(texts, k)], pa.int64()),
                                   pa.array(texts, pa.binary())], names=["doc_id", "node", "text"])
    return run


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", k: int = 5, pct: int = 80, text_col: str = "text") -> DataFrame:
    """The documents, of each linked group only the one with the smallest id.

    Rows with a null id are kept (they can't be named as copies).  Of rows that
    share an id but not the text, only those whose text is a copy go.
    """
    few = lambda g: F.broadcast(g) if g.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else g
    groups = stored(_grouped(docs, k, pct, id_col, text_col).select("doc_id", "node", (F.col("doc_id") != F.col("component_id")).alias("copy")), "ngram-groups")
    copies = stored(groups.where("copy").select("doc_id", "node").distinct(), "ngram-copies")
    ids = few(copies.select("doc_id").distinct())
    both = stored(groups.where("NOT copy").join(ids, "doc_id", "left_semi").select("doc_id").distinct(), "ngram-both")
    gone = few(copies.join(both, "doc_id", "left_anti").select(F.col("doc_id").alias("_copy_id")).distinct())
    out = docs.join(gone, docs[id_col] == gone["_copy_id"], "left_anti")
    if both.isEmpty():
        return out
    texts = text_bytes(docs, id_col=id_col, text_col=text_col).join(both, "doc_id", "left_semi")
    named = texts.mapInArrow(lean(_nodes(k)), "doc_id bigint, node bigint, text binary").join(copies, ["doc_id", "node"], "left_semi")
    named = stored(named.select(F.col("doc_id").alias("_copy_id"), F.col("text").alias("_copy_text")).distinct(), "ngram-copy-texts")
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    return out.join(named, (docs[id_col] == named["_copy_id"]) & (text == named["_copy_text"]), "left_anti")
