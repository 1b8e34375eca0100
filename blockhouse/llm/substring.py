"""Repeated passages: every word inside a window of ``length`` words whose word
sequence also starts earlier (smaller id, or same document, earlier) goes.

Difference-cover anchors.  D = {0, 1, 3, 9} covers every difference modulo 13:
for any two places i, j some shift below 13 puts i + shift and j + shift on
cover places of their documents at once.  Two equal windows of 20 words thus
hold equal 8-word anchors at cover places, the same shift into the window, and
only 4 of 13 places are hashed and shuffled.

1. Anchors are grouped by fingerprint in hashed buckets.  Repeats inside one
   flush are settled on the spot and one leader of each key is sent on, so a
   passage shared by a third of all documents reaches a bucket once per flush.
2. Each repeated anchor is extended to all windows around it; only these windows
   are fingerprinted, and for each the earliest place is found in the same way
   (leaders per flush, then buckets).  No pair of places is ever built.
3. Documents meet the windows to remove.  A window is removed from a document
   only if the document holds that fingerprint at that place.

Documents are dealt into blocks by their id modulo a prime; texts are shuffled once
(both later steps read the same exchange) and a block is a few MB of text.

Defined results: null, empty and short texts lose nothing; rows repeating an id
and text at one place are not earlier than each other and are both kept whole;
rows with a null id are left out; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F, types as T

from .common import chunk_words, doc_chunks, lean, packed, shuffle_parts, split_sorted, text_bytes, text_volume, window_hashes

PERIOD, COVER = 13, (0, 1, 3, 9)
FLUSH = 1 << 20          # entries collected before leaders are sent
BLOCK_BYTES = 8 << 20
BUCKET_ENTRIES = 1 << 19
_U = np.uint64
_PACKED = "bucket int, keys binary, ids binary, places binary"


def _block(ids: np.ndarray, blocks: int) -> np.ndarray:
    return np.mod(ids, blocks)  # as pmod(doc_id, blocks); a prime count also deals out ids with a common step


def _prime(n: int) -> int:
    while any(n % f == 0 for f in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _U(20)) % _U(buckets)).astype(np.int64)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    c = list(zip(*rows)) or [[], [], [], []]
    return pa.record_batch([pa.array(c[0], pa.int32())] + [pa.array(x, pa.binary()) for x in c[1:]],
                           names=["bucket", "keys", "ids", "places"])


def _rows(group: np.ndarray, keys, ids, places) -> list[tuple]:
    """One packed row per group; ``keys`` may be left out (empty)."""
    if not len(keys):
        return [(g, b"", packed(i), packed(p)) for g, i, p in split_sorted(group, ids, places)]
    return [(g, packed(k), packed(i), packed(p)) for g, k, i, p in split_sorted(group, keys, ids, places)]


class _Leaders:
    """Collects (key, id, place) entries; a flush sorts them, yields one leader of
    each key for the key's bucket, and settled entries for their document's block
    (coded as -1 - block)."""

    def __init__(self, buckets: int, blocks: int, whole_groups: bool):
        self.buckets, self.blocks, self.whole = buckets, blocks, whole_groups
        self.parts, self.size = [], 0

    def add(self, keys, ids, places):
        if len(keys):
            self.parts.append((keys, ids, places))
            self.size += len(keys)

    def flush(self) -> list[tuple]:
        if not self.parts:
            return []
        keys, ids, places = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        first, settled = _first_and_settled(keys, ids, places, self.whole)
        by_doc = np.lexsort((first[2], first[1]))  # runs of one id compress well
        first = tuple(x[by_doc] for x in first)
        if self.whole:
            settled = (settled[0][:0], *settled[1:])  # places of anchors are all that is needed
        out = _rows(_bucket(first[0], self.buckets), *first)
        return out + _rows(-1 - _block(settled[1], self.blocks), *settled)


def _first_and_settled(keys, ids, places, whole: bool):
    """The earliest entry of each key, and entries known to repeat: the later ones
    (those at the first place itself aside), or with ``whole`` all of the key."""
    order = np.lexsort((places, ids, keys))
    keys, ids, places = keys[order], ids[order], places[order]
    lead = np.ones(len(keys), dtype=bool)
    lead[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(lead)[np.cumsum(lead) - 1]
    later = (ids != ids[at]) | (places != places[at])
    if whole:
        many = np.bitwise_or.reduceat(later, np.flatnonzero(lead)) if len(later) else later
        later = np.repeat(many, np.diff(np.append(np.flatnonzero(lead), len(keys))))
    return (keys[lead], ids[lead], places[lead]), (keys[later], ids[later], places[later])


def _arrays(t: pa.Table):
    return (np.concatenate([np.frombuffer(x, dtype=d) for x in t.column(c).to_pylist()] or [np.empty(0, d)])
            for c, d in (("keys", np.uint64), ("ids", np.int64), ("places", np.int32)))


def _settle(blocks: int, whole: bool):
    """The partition of one bucket: leaders of all flushes -> settled entries by
    document block.  Entries settled before pass through."""
    def run(batches):
        parts = []
        for b in batches:
            t = pa.Table.from_batches([b])
            before = pa.compute.less(t.column("bucket"), 0)
            done = t.filter(before)
            if len(done):
                block = pa.compute.subtract(pa.scalar(-1, pa.int32()), done.column("bucket"))
                yield from done.set_column(0, "bucket", block).to_batches()
            parts.append(t.filter(pa.compute.invert(before)))
        if parts and any(len(t) for t in parts):
            _, (keys, ids, places) = _first_and_settled(*_arrays(pa.concat_tables(parts)), whole)
            yield _batch(_rows(_block(ids, blocks), keys[:0] if whole else keys, ids, places))
    return run


def _anchors(buckets: int, blocks: int, length: int):
    width = length - PERIOD + 1
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True

    def run(batches):
        sink = _Leaders(buckets, blocks, True)
        for ids, texts in doc_chunks(batches):
            offs, _, _, words, _ = chunk_words(texts)
            every = window_hashes(words, width)
            size = np.diff(offs)
            place = np.arange(len(words)) - np.repeat(offs[:-1], size)
            room = np.repeat(size, size)
            use = np.flatnonzero(cover[place % PERIOD] & (place + width <= room) & (room >= length))
            sink.add(every[use], np.repeat(np.array(ids, dtype=np.int64), size)[use], place[use].astype(np.int32))
            if sink.size >= FLUSH:
                yield _batch(sink.flush())
        yield _batch(sink.flush())
    return run


def _chosen(found: pa.Table):
    """Entries of a block by document: id -> (places, keys)."""
    keys, ids, places = _arrays(found)
    keys = keys if len(keys) else np.zeros(len(ids), np.uint64)
    return {i: (p, k) for i, p, k in split_sorted(ids, places, keys)}


def _windows(buckets: int, blocks: int, length: int):
    """A block's texts and its repeated anchors -> fingerprints of the windows around them."""
    width = length - PERIOD + 1

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        by_doc, sink, rows = _chosen(found), _Leaders(buckets, blocks, False), []
        if by_doc:
            for ids, texts in doc_chunks(docs.select(["doc_id", "text"]).to_batches()):
                pick = [j for j, i in enumerate(ids) if i in by_doc]
                if not pick:
                    continue
                offs, _, _, words, _ = chunk_words([texts[j] for j in pick])
                every = window_hashes(words, length)
                for n, j in enumerate(pick):
                    last = offs[n + 1] - offs[n] - length
                    if last < 0:
                        continue
                    edge = np.zeros(last + 2, dtype=np.int32)  # window starts that reach over an anchor
                    p = by_doc[ids[j]][0]
                    p = p[p - (length - width) <= last]
                    np.add.at(edge, np.maximum(p - (length - width), 0), 1)
                    np.add.at(edge, np.minimum(p, last) + 1, -1)
                    at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                    sink.add(every[offs[n] + at], np.full(len(at), ids[j], dtype=np.int64), at.astype(np.int32))
                if sink.size >= FLUSH:
                    rows += sink.flush()
        return pa.Table.from_batches([_batch(rows + sink.flush())])
    return run


def _cut(length: int, want_text: bool):
    """A block's documents and the windows to remove -> what is left of each."""
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        by_doc, n_words, n_removed, left = _chosen(found), [], [], []
        for i, text in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()):
            words, gone = text.split(), None
            if i in by_doc:
                places, keys = by_doc[i]
                _, start, end, h, _ = chunk_words([text])
                every = window_hashes(h, length)
                fits = places < len(every)
                p = places[fits][every[places[fits]] == keys[fits]]
                edge = np.zeros(len(words) + 1, dtype=np.int32)
                np.add.at(edge, p, 1)
                np.add.at(edge, p + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
            n_words.append(len(words))
            n_removed.append(0 if gone is None else int(gone.sum()))
            if not n_removed[-1]:
                left.append(text if want_text else hashlib.sha256(b" ".join(words)).hexdigest())
                continue
            flip = np.flatnonzero(np.diff(np.concatenate([[1], gone.astype(np.int8), [1]])))
            runs = list(zip(flip[::2], flip[1::2]))
            if want_text:
                left.append(b" ".join(text[start[a]:end[b - 1]] for a, b in runs))
            else:
                left.append(hashlib.sha256(b" ".join(w for a, b in runs for w in words[a:b])).hexdigest())
        out = pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                        "kept": pa.array(left, pa.binary() if want_text else pa.string())})
        return out.append_column("row", docs.column("row")) if "row" in docs.column_names else out
    return run


def _marked(texts: DataFrame, length: int):
    """(blocked documents, windows to remove packed by block)."""
    spark = texts.sparkSession
    volume = text_volume(texts)
    parts = shuffle_parts(spark)
    blocks = _prime(max(parts, math.ceil(volume / BLOCK_BYTES)))
    buckets = max(parts, math.ceil(volume / 16 / BUCKET_ENTRIES))

    def settled(packed_rows: DataFrame, whole: bool) -> DataFrame:
        return packed_rows.repartitionById(buckets, F.pmod("bucket", F.lit(buckets))).mapInArrow(lean(_settle(blocks, whole)), _PACKED)

    anchors = settled(texts.select("doc_id", "text").mapInArrow(lean(_anchors(buckets, blocks, length)), _PACKED), True)
    docs = texts.withColumn("block", F.pmod("doc_id", F.lit(blocks)).cast("int"))
    around = docs.groupBy("block").cogroup(anchors.groupBy("bucket")).applyInArrow(lean(_windows(buckets, blocks, length)), _PACKED)
    return docs, settled(around, False)


def repeated_passages(docs: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space)."""
    texts = text_bytes(docs, id_col=id_col, text_col=text_col).where("doc_id IS NOT NULL")
    blocked, gone = _marked(texts, length)
    return (blocked.groupBy("block").cogroup(gone.groupBy("bucket"))
            .applyInArrow(lean(_cut(length, False)), "doc_id bigint, n_words bigint, n_removed bigint, kept string")
            .withColumnRenamed("kept", "kept_sha256"))


def without_repeats(docs: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated passages cut out of their texts; kept stretches
    keep their own white space and are joined by one space.  All other columns,
    untouched texts and rows with a null id stay as they are."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    texts = text_bytes(docs, row.alias("row"), id_col=id_col, text_col=text_col)
    blocked, gone = _marked(texts.where("doc_id IS NOT NULL").withColumn("row", F.col("row").dropFields(text_col)), length)
    kind = T.StructType.fromDDL("doc_id bigint, n_words bigint, n_removed bigint, kept binary").add("row", blocked.schema["row"].dataType)
    out = (blocked.groupBy("block").cogroup(gone.groupBy("bucket"))
           .applyInArrow(lean(_cut(length, True)), kind))
    named = out.select(*[F.col("kept").cast("string").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
    return named.union(docs.where(F.col(id_col).isNull()))
