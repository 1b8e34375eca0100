"""Vector best-fit packing of token sequences.

Every document is tokenised and ended with id 0; only documents above the
capacity are cut, into full pieces behind a shorter first one.  A piece asks
for three resources: tokens, one document, and attention cost (length squared).
Pieces are dealt by hash into groups of bounded size; a group is packed in
decreasing size, each piece into the open sequence that stays feasible in all
three resources and is best by the weighted residual norm (tightest) or by the
weighted dot product of demand and residual.  Weights follow scarcity: total
demand over capacity.  Only lengths and checksums are shuffled, never ids.

Groups are large against a sequence, so what they lose is a partly filled
sequence or two each.  Defined results: null text is an empty text (one id);
ties go to the lower id, then piece; rows may repeat, each copy is packed; a
null id stays null; an empty table gives an empty result.
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import doc_chunks, lean, stored, text_bytes
from .tokens import default_vocabulary, encoder

GROUP_PIECES = 8_192
END = b"\0\0\0\0"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(vocabulary: str, limit: int):
    def run(batches):
        enc = encoder(vocabulary)
        for ids, texts in doc_chunks(batches):
            rows = []
            for i, t in zip(ids, texts):
                buf = enc.ids(t.decode("utf-8", "replace")) + END
                n = len(buf) // 4
                cuts = [0, *range(n % limit or limit, n, limit), n]
                rows += [(i, k, a, b - a, zlib.crc32(buf[4 * a:4 * b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
            c = list(zip(*rows))
            yield pa.record_batch([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), *(pa.array(x, pa.int64()) for x in c[2:])],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of at most ``capacity`` tokens."""
    return text_bytes(docs, id_col=id_col, text_col=text_col).mapInArrow(lean(_pieces(vocabulary or default_vocabulary(), capacity)), PIECES)


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_attention: int, score: str) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, pieces given in placing order."""
    caps = np.array([capacity, max_docs, max_attention], dtype=np.float64)
    ask = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1).astype(np.float64)
    weight = ask.sum(0) / caps
    weight /= weight.sum() or 1
    left = np.empty((len(lengths), 3))
    name = np.empty(len(lengths), dtype=np.int64)   # bin number of each open row
    live = used = 0
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    smallest = np.minimum.accumulate(lengths[::-1])[::-1]  # least length still to come
    for i, q in enumerate(ask):
        open_ = left[:live]
        fits = np.flatnonzero((open_ >= q).all(axis=1))
        if len(fits):
            if score == "dot":
                gain = -(open_[fits] / caps * (q / caps)) @ weight
            else:
                gain = (((open_[fits] - q) / caps) ** 2) @ weight
            at = fits[gain.argmin()]
        else:
            at, live = live, live + 1
            left[at], name[at] = caps, used
            used += 1
        bins[i], offsets[i] = name[at], capacity - int(left[at, 0])
        left[at] -= q
        if left[at, 0] < (smallest[i + 1] if i + 1 < len(lengths) else 0) or left[at, 1] < 1:
            live -= 1  # full: the last open row takes its place
            left[at], name[at] = left[live], name[live]
    return bins, offsets


def _pack_group(capacity: int, max_docs: int, max_attention: int, score: str):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        ids = t.column("doc_id").fill_null(-1 << 63).to_numpy()
        length = t.column("length").to_numpy()
        order = np.lexsort((t.column("piece").to_numpy(), ids, -length))
        bins, offsets = best_fit(length[order], capacity, max_docs, max_attention, score)
        out = t.drop_columns(["_group"]).take(pa.array(order))
        return out.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins)).append_column("offset", pa.array(offsets))
    return run


def pack(docs: DataFrame, capacity: int = 2048, max_docs: int | None = None, max_attention: int | None = None,
         score: str = "norm", vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``max_docs`` and ``max_attention`` default to bounds that tokens alone reach
    (one document per token; a full sequence's square), so sequences are fewest.
    """
    max_docs, max_attention = max_docs or capacity, max_attention or capacity * capacity
    cut = min(capacity, math.isqrt(max_attention))
    p = stored(pieces(docs, cut, vocabulary, id_col, text_col), "pack-pieces")
    groups = max(1, math.ceil(p.count() / GROUP_PIECES))
    dealt = p.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(_pack_group(capacity, max_docs, max_attention, score),
                                                PIECES + ", sequence_id bigint, offset bigint")
