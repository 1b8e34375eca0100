"""Language identification with language-bitmask n-gram filters.

Every byte 4-gram (ASCII lower-cased, each white-space byte a blank) has two hashed
places, one in each of two tables.  A table entry is a bitmask of languages, so
one look-up per table and an AND return all languages that hold the n-gram (a
Bloom filter per language, sliced by bit).  Bits come from counts over all
learning documents: a language holds a place if at least one in 1 / ``MEMBER`` of
its n-grams falls there, whatever other languages do; below that are misspelt
and foreign words, of which a large corpus holds every one.  N-grams that all
languages hold add the same to each score.

A text's score for a language is its hits over its n-grams, corrected for false
positives with the language's fill of the tables: (hits/n - f) / (1 - f).

Defined results: null texts and texts without a letter are ``und`` with score 0;
without any hit the most frequent learned language is returned; without learning
rows all texts are ``und``; a null id is not held out and not learned from;
repeated rows give repeated results.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import doc_chunks, packed, shuffle_parts, stored

BITS = 18                 # places per table
SLICES = 16
MEMBER = 1e-5            # least share of a language's n-grams that makes one its own
N = 4
_LETTER = re.compile(rb"[A-Za-z]")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def fold(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) modulo ``parts``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def _places(texts: list[bytes]):
    """Two hashed places per 4-gram, and each text's range of 4-grams."""
    buf = b"".join(b"  " + t + b"  " for t in texts)
    b = _FOLD[np.frombuffer(buf, dtype=np.uint8)]
    size = np.array([len(t) + 4 for t in texts], dtype=np.int64)
    end = np.cumsum(size)
    g = np.zeros(max(len(b) - N + 1, 0), dtype=np.uint32)
    for j in range(N):
        g |= b[j:j + len(g)] << np.uint32(8 * j)
    first = (g * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    second = ((g ^ (g >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)
    return first, second, end - size, end - N + 1


def _tally(batches):
    """(lang, text) rows -> counts per language, table and slice, once per task."""
    counts: dict = {}
    for langs, texts in doc_chunks(batches):
        first, second, lo, hi = _places(texts)
        for lang in set(langs):
            pick = np.concatenate([np.arange(a, b) for a, b, x in zip(lo, hi, langs) if x == lang])
            at = counts.setdefault(lang, np.zeros((2, 1 << BITS), dtype=np.int64))
            for table, where in enumerate((first, second)):
                at[table] += np.bincount(where[pick], minlength=1 << BITS)
    for lang, c in counts.items():
        yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array([lang] * SLICES, pa.string()),
                               pa.array([packed(x) for x in np.split(c, SLICES, axis=1)], pa.binary())], names=["slice", "lang", "counts"])


def _add(batches):
    total: dict = {}
    for b in batches:
        for s, lang, c in zip(*(b.column(i).to_pylist() for i in range(3))):
            row = np.frombuffer(c, dtype=np.int64)
            total[s, lang] = total[s, lang] + row if (s, lang) in total else row
    if total:
        yield pa.record_batch([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.string()),
                               pa.array([packed(c) for c in total.values()], pa.binary()),
                               pa.array([int(c.sum()) for c in total.values()], pa.int64())], names=["slice", "lang", "counts", "n"])


def _mask_slice(langs: list[str], totals: dict):
    words = -(-len(langs) // 64)
    at = {x: i for i, x in enumerate(langs)}

    def run(t: pa.Table) -> pa.Table:
        rate = np.zeros((len(langs), 2 * (1 << BITS) // SLICES))
        for lang, c in zip(t.column("lang").to_pylist(), t.column("counts").to_pylist()):
            rate[at[lang]] = np.frombuffer(c, dtype=np.int64) / max(totals[lang], 1)
        held = (rate > 0) & (rate >= MEMBER)
        masks = np.zeros((words, held.shape[1]), dtype=np.uint64)
        for i, row in enumerate(held):
            masks[i // 64] |= row.astype(np.uint64) << np.uint64(i % 64)
        return pa.table({"slice": t.column("slice")[:1], "masks": pa.array([packed(masks)], pa.binary())})
    return run


def learn(docs: DataFrame, learned: Column, text_col: str = "text", lang_col: str = "lang") -> dict:
    """Bitmask tables from all rows for which ``learned`` holds."""
    spark = docs.sparkSession
    rows = docs.where(learned & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    tally = rows.mapInArrow(_tally, "slice int, lang string, counts binary")
    summed = stored(tally.repartition(shuffle_parts(spark), "slice", "lang").mapInArrow(
        _add, "slice int, lang string, counts binary, n bigint"), "lang-counts")
    totals = {r[0]: r[1] for r in summed.groupBy("lang").agg(F.sum("n") / 2).collect()}  # one row a language
    langs = sorted(totals)
    words = -(-len(langs) // 64)
    masks = np.zeros((words, 2, 1 << BITS), dtype=np.uint64)
    for s, m in summed.groupBy("slice").applyInArrow(_mask_slice(langs, totals), "slice int, masks binary").collect():  # 4 MB per 64 languages
        width = (1 << BITS) // SLICES
        masks[:, :, s * width:(s + 1) * width] = np.frombuffer(m, dtype=np.uint64).reshape(words, 2, width)
    fill = [float(np.prod([((masks[i // 64, t] >> np.uint64(i % 64)) & np.uint64(1)).mean() for t in (0, 1)])) for i in range(len(langs))]
    usual = max(langs, key=lambda x: (totals[x], x)) if langs else None
    return {"langs": langs, "masks": masks, "fill": fill, "usual": usual}


def _has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _predict(model):
    def run(batches):
        m = model.value
        langs, masks, fill = m["langs"], m["masks"], np.array(m["fill"])
        for ids, texts in doc_chunks(batches):
            first, second, lo, hi = _places(texts)
            score = np.zeros((len(langs), len(texts)))
            for w in range(len(masks)):
                held = masks[w, 0][first] & masks[w, 1][second]
                for i in range(64 * w, min(64 * w + 64, len(langs))):
                    run_ = np.zeros(len(held) + 1, dtype=np.int64)
                    np.cumsum((held >> np.uint64(i % 64)) & np.uint64(1), out=run_[1:])
                    score[i] = ((run_[hi] - run_[lo]) / (hi - lo) - fill[i]) / max(1 - fill[i], 1e-9)
            np.maximum(score, 0, out=score)
            names, values = [], []
            for j, t in enumerate(texts):
                if not langs or not _has_letter(t):
                    names.append("und")
                    values.append(0.0)
                    continue
                total = score[:, j].sum()
                best = int(score[:, j].argmax())
                names.append(langs[best] if total > 0 else m["usual"])
                values.append(float(score[best, j] / total) if total > 0 else 1.0 / len(langs))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(names), pa.array(values)], names=["doc_id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, parts: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns only from rows not held out."""
    model = learn(docs, (fold(F.col(id_col), parts) != held), text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    out = texts.mapInArrow(_predict(shared), "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), parts) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
