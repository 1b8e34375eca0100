"""Cross-tokenizer alignment: where the tokens of two tokenizers end together.

A text, with one space before it, is encoded by a byte-level BPE (A) and by a
sentencepiece BPE (B).  Every token covers a run of the text's bytes; the end
offsets of A and of B are two increasing lists.  ``common_ends`` intersects them
by galloping: the shorter list drives, each of its offsets is looked for in the
longer one from where the last was found, in steps of doubling width and then by
halving.  The common offsets cut both lists into groups; the differences of
their ranks say which A and which B tokens cover the same bytes.  Thousands of
lanes gallop in lockstep, so the search runs in numpy.

Neither tokenizer lets a token cross from a non-space character into a following
space (checked in B's vocabulary), so a text is the concatenation of its pieces
between such places; a bounded cache holds the tokens of pieces seen before.

A link is a pair of tokens whose byte ranges end together, one for each group.
How often an id pair is linked is counted over the whole corpus.  The most
frequent pairs, ``HEAD`` of them at most, go to every task; occurrences of the
others are joined by pair, where no pair is frequent.

Defined results: texts that are null, empty, not UTF-8, or whose joined token
bytes differ from the text (a text that holds U+2581) have no tokens; rows
repeat, each counted for itself; a null id stays null; other columns are not
read; an empty table is empty.  A text is held whole, texts together in chunks.
"""
from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import doc_chunks, stored, text_bytes
from .tokens import _CUT, _NO_CUT, _byte_letters, default_vocabulary, encoder

CACHE_PIECES = 300_000
CACHE_TOKENS = 4_000_000
CHUNK_TOKENS = 400_000
HEAD = 1 << 20
SPACE = "▁"
ALIGNED = "row bigint, doc_id bigint, n_a bigint, n_b bigint, a_ids binary, a_last binary, b_ids binary, b_last binary"
DIGEST = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
GROUPS = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and in ``b`` of the values that both increasing lists hold."""
    if len(a) > len(b):
        return common_ends(b, a)[::-1]
    n = len(a)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lanes = min(n, 4 * math.isqrt(n))
    steps = -(-n // lanes)
    needles = np.concatenate([a, np.full(lanes * steps - n, a[-1])]).reshape(lanes, steps)
    hay = np.concatenate([b, [np.iinfo(np.int64).max]])  # a last value that no offset reaches
    found = np.empty((lanes, steps), np.int64)
    at = np.searchsorted(b, needles[:, 0])               # where each lane starts
    for j in range(steps):
        x, low, high, width = needles[:, j], at.copy(), at.copy(), 1
        live = np.flatnonzero(hay[high] < x)
        while len(live):                                 # exponential: hay[low - 1] < x
            low[live] = high[live] + 1
            high[live] = np.minimum(low[live] + width, len(b))
            live = live[hay[high[live]] < x[live]]
            width *= 2
        live = np.flatnonzero(low < high)
        while len(live):                                 # binary: hay[high] >= x
            mid = (low[live] + high[live]) >> 1
            less = hay[mid] < x[live]
            low[live[less]] = mid[less] + 1
            high[live[~less]] = mid[~less]
            live = live[low[live] < high[live]]
        found[:, j] = at = low
    found = found.ravel()[:n]
    hit = np.flatnonzero(hay[found] == a)
    return hit, found[hit]


def _ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (count[i] of them) for every i, joined."""
    out = np.repeat(start - (np.cumsum(count) - count), count)
    return out + np.arange(len(out))


class Pieces:
    """Ids and byte lengths of both tokenizers for text pieces, cached per worker."""

    def __init__(self, vocabulary: str, model: str):
        import sentencepiece

        self._a = encoder(vocabulary)._encode
        self._b = sentencepiece.SentencePieceProcessor(model_file=model)
        letters = _byte_letters()
        with open(vocabulary, encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in entries.items() if all(c in letters for c in t)}
        names = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b_bytes = [bytes([int(t[3:-1], 16)]) if self._b.is_byte(i) else t.replace(SPACE, " ").encode() for i, t in enumerate(names)]
        if any(SPACE in t.lstrip(SPACE) for t in names):
            raise ValueError("a token of the sentencepiece model crosses from a character into a space")
        self.widths = ["<u2" if max(ids, default=0) < 1 << 16 else "<u4" for ids in (self.a_bytes, range(len(names)))]
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ok = np.empty(0, bool)
        self.ids = [np.empty(0, np.uint32), np.empty(0, np.uint32)]
        self.size = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.first, self.count = ([np.empty(0, np.int64), np.empty(0, np.int64)] for _ in range(2))

    def rows(self, pieces: list[str]) -> np.ndarray:
        """The cache row of every piece; unknown pieces are encoded."""
        distinct = dict.fromkeys(pieces)
        new = [p for p in distinct if p not in self.at]
        if len(self.at) + len(new) > CACHE_PIECES or max(map(len, self.ids)) > CACHE_TOKENS:
            self._clear()
            new = list(distinct)
        if new:
            self._learn(new)
        return np.fromiter(map(self.at.__getitem__, pieces), np.int64, len(pieces))

    def _learn(self, new: list[str]) -> None:
        coded = [[self._a(" " + p) for p in new], self._b.encode(new, num_threads=1)]
        if "" in new:  # a last space; alone, sentencepiece would drop it
            coded[1][new.index("")] = [self._b.piece_to_id(SPACE)]
        ok = np.ones(len(new), bool)
        want = [b" " + p.encode() for p in new]
        for side, (ids, entry) in enumerate(zip(coded, (self.a_bytes, self.b_bytes))):
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = [entry[i] for row in ids for i in row]
            size = np.fromiter(map(len, flat), np.int64, len(flat))
            end = np.cumsum(count).tolist()
            ok &= np.fromiter((b"".join(flat[e - n:e]) == w for e, n, w in zip(end, count.tolist(), want)), bool, len(new))
            first = len(self.ids[side]) + np.cumsum(count) - count
            for held, more in ((self.first, first), (self.count, count), (self.size, size),
                               (self.ids, np.fromiter((i for row in ids for i in row), np.uint32, len(flat)))):
                held[side] = np.concatenate([held[side], more])
        self.at.update(zip(new, range(len(self.ok), len(self.ok) + len(new))))
        self.ok = np.concatenate([self.ok, ok])


def split_pieces(text: str) -> list[str]:
    """The pieces of " " + text, each without the space it begins with."""
    if text[:1] != " " and not _NO_CUT.search(text):
        return text.split(" ")
    return [p[1:] for p in _CUT.split(" " + text)]


_workers: dict[tuple[str, str], Pieces] = {}


def _pieces(vocabulary: str, model: str) -> Pieces:
    """One cache per worker process and pair of vocabularies."""
    if (vocabulary, model) not in _workers:
        _workers[vocabulary, model] = Pieces(vocabulary, model)
    return _workers[vocabulary, model]


def _align(vocabulary: str, model: str):
    def run(batches):
        cache = _pieces(vocabulary, model)
        row = TaskContext.get().partitionId() << 33
        for ids, texts in doc_chunks(batches):
            pieces, bounds = [], [0]
            for t in texts:
                try:
                    text = t.decode()
                except UnicodeDecodeError:
                    text = ""
                pieces += split_pieces(text) if text else []
                bounds.append(len(pieces))
            rows, bounds = cache.rows(pieces), np.array(bounds)
            bad = np.concatenate([[0], np.cumsum(~cache.ok[rows])])[bounds]
            whole, held = bad[1:] == bad[:-1], np.diff(bounds)
            rows = rows[np.repeat(whole, held)]
            bounds = np.concatenate([[0], np.cumsum(np.where(whole, held, 0))])
            token_ids, ends, cuts = [], [], []
            for side in (0, 1):
                count = cache.count[side][rows]
                at = _ragged(cache.first[side][rows], count)
                token_ids.append(cache.ids[side][at].astype(cache.widths[side]))
                ends.append(np.cumsum(cache.size[side][at]))
                cuts.append(np.concatenate([[0], np.cumsum(count)])[bounds])
            columns = [pa.array(range(row, row + len(ids)), pa.int64()), pa.array(ids, pa.int64()), *(pa.array(np.diff(c)) for c in cuts)]
            row += len(ids)
            for tokens, cut, common in zip(token_ids, cuts, common_ends(*ends)):
                last = np.zeros(len(tokens), bool)
                last[common] = True
                spans = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
                columns += [pa.array([tokens[s:e].tobytes() for s, e in spans], pa.binary()),
                            pa.array([np.packbits(last[s:e]).tobytes() for s, e in spans], pa.binary())]
            yield pa.record_batch(columns, names=["row", "doc_id", "n_a", "n_b", "a_ids", "a_last", "b_ids", "b_last"])
    return run


def alignments(docs: DataFrame, vocabulary: str | None = None, model: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: token ids of A and B (little-endian) and one bit per
    token that says whether its group ends there, most significant bit first."""
    return text_bytes(docs, id_col=id_col, text_col=text_col).mapInArrow(
        _align(vocabulary or default_vocabulary(), model or default_model()), ALIGNED)


def _chunks(batches):
    """Batches cut at about CHUNK_TOKENS tokens: (rows, ids, ends of groups and bounds of documents for A and B).  The worker's cache of pieces, no longer needed, is freed."""
    _workers.clear()
    for batch in batches:
        total = np.cumsum(batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy())
        part = total // CHUNK_TOKENS
        for at in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
            if not len(at):
                continue
            rows, sides = batch.slice(int(at[0]), len(at)), []
            for side in "ab":
                n = rows.column(f"n_{side}").to_numpy()
                raw = rows.column(f"{side}_ids").to_pylist()
                width = max((len(x) // m for x, m in zip(raw, n.tolist()) if m), default=2)
                ids = np.frombuffer(b"".join(raw), f"<u{width}").astype(np.int64)
                bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=m) for x, m in zip(rows.column(f"{side}_last").to_pylist(), n.tolist())]
                sides.append((ids, np.flatnonzero(np.concatenate(bits)), np.concatenate([[0], np.cumsum(n)])))
            yield rows, *sides


def _links(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Key of every link (A id above B id) and the documents' bounds among the links."""
    (a_ids, a_end, a_cut), (b_ids, b_end, _) = a, b
    return (a_ids[a_end] << 32) | b_ids[b_end], np.searchsorted(a_end, a_cut)


def _sum_by_key(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)


def _count(batches):
    keys, counts, held = [], [], 0
    for _, a, b in _chunks(batches):
        key, n = np.unique(_links(a, b)[0], return_counts=True)
        keys.append(key)
        counts.append(n)
        held += len(key)
        if held > HEAD:
            key, n = _sum_by_key(keys, counts)
            keys, counts, held = [key], [n], len(key)
            if held > HEAD // 2:
                yield pa.record_batch([pa.array(key), pa.array(n)], names=["key", "n"])
                keys, counts, held = [], [], 0
    if held:
        yield pa.record_batch([pa.array(x) for x in _sum_by_key(keys, counts)], names=["key", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """key (A id * 2**32 + B id), count over the corpus, best (1: its B id's highest)."""
    pairs = stored(aligned.select("n_a", "n_b", "a_ids", "a_last", "b_ids", "b_last").mapInArrow(_count, "key bigint, n bigint")
                   .groupBy("key").agg(F.sum("n").alias("count")), "align-pairs")
    b = F.col("key").bitwiseAND(F.lit((1 << 32) - 1))
    top = pairs.groupBy(b.alias("b")).agg(F.max("count").alias("top"))
    return pairs.withColumn("b", b).join(top, "b").select("key", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))


def _head(pairs: DataFrame, limit: int) -> tuple[int, bool]:
    """(least count of the pairs that every task gets, whether these are all):
    the greatest power of two below which fewer than ``limit`` pairs stay."""
    level = F.floor(F.log2("count")).cast("int")
    sizes = {r[0]: r[1] for r in pairs.groupBy(level.alias("level")).count().collect()}  # one row per power of two
    held, least = 0, max(sizes, default=0) + 1
    for k in sorted(sizes, reverse=True):
        if held + sizes[k] > limit:
            return 1 << least, False
        held, least = held + sizes[k], k
    return 1 << least, True


_digits: list[np.ndarray] = []


def _decimal(top: int) -> np.ndarray:
    """ASCII digits of 0 .. top, padded with zero bytes."""
    if not _digits or len(_digits[0]) <= top:
        text = np.array([str(i) for i in range(max(top + 1, 1 << 16))], dtype="S")
        _digits[:] = [text.view(np.uint8).reshape(len(text), -1)]
    return _digits[0]


def _group_text(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;...;`` over the documents of a chunk and their bounds."""
    (a_ids, a_end, a_cut), (b_ids, b_end, b_cut) = a, b
    place = []
    for ids, end, other, shift in ((a_ids, a_end, b_end, 0), (b_ids, b_end, a_end, 1)):
        group = np.searchsorted(end, np.arange(len(ids)))      # the group that each token is in
        place.append(np.arange(len(ids)) + np.concatenate([[0], other + 1])[group + shift])
    table = _decimal(int(max(a_ids.max(initial=0), b_ids.max(initial=0))))
    cells = np.zeros((len(a_ids) + len(b_ids), table.shape[1] + 1), np.uint8)
    for ids, end, at, close in ((a_ids, a_end, place[0], b"|"), (b_ids, b_end, place[1], b";")):
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[end] = ord(close)
        cells[at, :-1] = table[ids]
        cells[at, -1] = mark
    used = cells != 0
    return cells[used], np.concatenate([[0], np.cumsum(used.sum(1))])[a_cut + b_cut]


def _digest(head):
    def run(batches):
        keys, count, best = head.value
        for rows, a, b in _chunks(batches):
            link, cut = _links(a, b)
            at = np.minimum(np.searchsorted(keys, link), max(len(keys) - 1, 0))
            known = keys[at] == link if len(keys) else np.zeros(len(link), bool)
            sums = [np.concatenate([[0], np.cumsum(np.where(known, x[at], 0) if len(keys) else np.zeros(len(link), np.int64))])[cut] for x in (best, count)]
            text, bounds = _group_text(a, b)
            sha = [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            n = pa.array(np.diff(cut))
            yield pa.record_batch([*rows.columns[:4], n, n, *(pa.array(np.diff(x).astype(np.int64)) for x in sums), pa.array(sha, pa.string())],
                                  names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def _rest(head):
    """(row, key, n) of the links that the head doesn't hold."""
    def run(batches):
        keys = head.value[0]
        for rows, a, b in _chunks(batches):
            link, cut = _links(a, b)
            row = np.repeat(rows.column("row").to_numpy(), np.diff(cut))
            out = ~np.isin(link, keys)
            yield pa.record_batch([pa.array(row[out]), pa.array(link[out])], names=["row", "key"])
    return run


def alignment_digests(docs: DataFrame, vocabulary: str | None = None, model: str | None = None, head_pairs: int = HEAD,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document."""
    aligned = stored(alignments(docs, vocabulary, model, id_col, text_col), "align")
    pairs = stored(pair_counts(aligned), "align-counts")
    least, whole = _head(pairs, head_pairs)
    top = pairs.where(F.col("count") >= least).orderBy("key").toArrow()  # at most head_pairs rows
    head = docs.sparkSession.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("key", "count", "best")))
    out = aligned.mapInArrow(_digest(head), DIGEST)
    if not whole:
        rest = (aligned.mapInArrow(_rest(head), "row bigint, key bigint").groupBy("row", "key").agg(F.count(F.lit(1)).alias("n"))
                .join(pairs, "key").groupBy("row").agg(F.sum(F.col("n") * F.col("best")).alias("_best"), F.sum(F.col("n") * F.col("count")).alias("_sum")))
        out = (out.join(rest, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("_best", F.lit(0)))
               .withColumn("count_sum", F.col("count_sum") + F.coalesce("_sum", F.lit(0))).drop("_best", "_sum"))
    return out.drop("row")


def _listed(batches):
    for rows, a, b in _chunks(batches):
        columns = [rows.column("doc_id")]
        cut = np.searchsorted(a[1], a[2])
        for ids, _, bounds in (a, b):
            columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())))
        for _, end, _ in (a, b):
            columns.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(np.diff(end, prepend=-1), pa.int32())))
        yield pa.record_batch(columns, names=["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])


def aligned_groups(docs: DataFrame, vocabulary: str | None = None, model: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, ids of both tokenizers and how many A and B tokens each group holds."""
    return alignments(docs, vocabulary, model, id_col, text_col).mapInArrow(_listed, GROUPS)
