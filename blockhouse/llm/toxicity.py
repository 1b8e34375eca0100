"""Toxicity by noisy-channel deobfuscation.

Learning
1. Units: words and their 4- to 8-letter beginnings.  Units that mark toxic
   texts are found by counting documents per class over a bounded sample of
   labelled rows (``SAMPLE`` toxic and as many clean ones, by hash).
2. A character trigram model is counted over all texts (a fixed 64**3 table) and
   the marking words are added to it.
3. A logistic curve maps (strongest unit, number of units) to a score.

Scoring
Words of every text are compared with the units.  A word, a run of single
characters or a run of fragments that could hide one becomes a character lattice:
leetspeak signs branch into their letters, repeated letters into one or two, gaps
into nothing or a space.  Gaps are any white space, or signs between letters.
Fragments count only where the decoded text joins them to a whole unit.  Letters of
other widths, and Cyrillic or Greek look-alikes among Latin letters, are undone
first; a word that is a whole unit but for its accents counts as well.
Viterbi decoding under the character model restores the text, which is then
compared with the units again.  Units of up to three letters are compared as they
stand.  A lattice is only built when
the skeleton that all its paths share (look-alikes merged, runs collapsed) is
that of a unit, so skipping one never changes a score.

Defined results: null and empty texts get the lowest score; rows repeat with
their own result; labels that are null or conflict are not learned from; without
toxic labels every score is the base score; a null id is not held out.
"""
from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import doc_chunks, lean, packed, text_bytes
from .language import fold

SAMPLE = 6_000          # labelled rows of each class that the classifier is fitted on
CACHE_WORDS = 300_000
SYMBOLS = 64            # classes of characters in the model
# Signs that stand for letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou", "#": "aeiou", "(": "c"}
_SKELETON = str.maketrans({**{k: v[0] for k, v in LEET.items() if len(v) < 3}, "l": "i", "6": "g", "9": "g"})
_EDGE = re.compile(r"^[^\w@$!|+*#(]+|[^\w@$|+*#]+$")
_TAIL = re.compile(r"([^\w\s])\1{2,}$")
_RUNS = re.compile(r"(.)\1+")
_SPACED = re.compile(r"(?<!\S)\S(?:\s{1,3}\S){2,}(?!\S)")
_GAPS = re.compile(r"\s+")
_INNER = re.compile(r"(?<=.)[._\-~'/,](?=.)")
# Cyrillic and Greek letters that look like Latin ones.
_ALIKE = str.maketrans("аеорсухікмтԁѕјαοενικρτυ", "aeopcyxikmtdsjaoevikptu")
FRAGMENTS = 8           # pieces that a unit may be cut into
_CLASS = np.zeros(128, dtype=np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_SUBSTITUTED, _COLLAPSED, _DOUBLED, _LITERAL = -1.0, -0.5, -1.0, -6.0  # channel log-probabilities


def symbol(ch: str) -> int:
    return int(_CLASS[ord(ch)]) if ord(ch) < 128 else 27 + ord(ch) % (SYMBOLS - 27)


def _symbols(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    return np.where(cp < 128, _CLASS[np.minimum(cp, 127)], 27 + cp % (SYMBOLS - 27))


def clean_word(word: str) -> str:
    w = _EDGE.sub("", word.lower())
    while m := _TAIL.search(w):  # a tail of equal signs behind the word is decoration
        w = _EDGE.sub("", w[:m.start()])
    return w


def plain_letters(word: str) -> str:
    """Letters of other widths, and look-alikes inside words that hold Latin letters too."""
    if word.isascii():
        return word
    word = unicodedata.normalize("NFKC", word)
    return word.translate(_ALIKE) if any("a" <= c <= "z" for c in word) else word


def bare(word: str) -> str:
    """Without accents: these belong to other languages' words, so only whole units are compared."""
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def units_of(word: str) -> list[str]:
    return [word] + [word[:k] + "*" for k in range(4, 9) if len(word) > k]


def skeleton(word: str) -> str:
    return _RUNS.sub(r"\1", _INNER.sub("", word).translate(_SKELETON))


def _unit_counts(only=None):
    """(toxic, text) rows -> documents per unit and class, summed per task."""
    def run(batches):
        known = only.value if only is not None else None
        counts: dict = {}
        for marks, texts in doc_chunks(batches):
            for toxic, t in zip(marks, texts):
                seen = {u for w in set(t.decode("utf-8", "replace").split()) for u in units_of(clean_word(w))}
                for u in (seen if known is None else seen & known):
                    at = counts.setdefault(u, [0, 0])
                    at[toxic] += 1
        rows = list(counts.items())
        for i in range(0, len(rows), 50_000):
            part = rows[i:i + 50_000]
            yield pa.record_batch([pa.array([u for u, _ in part]), pa.array([c[1] for _, c in part], pa.int64()),
                                   pa.array([c[0] for _, c in part], pa.int64())], names=["unit", "toxic", "clean"])
    return run


def _trigrams(batches):
    counts = np.zeros(SYMBOLS ** 3, dtype=np.int64)
    for b in batches:
        for _, texts in doc_chunks([b]):
            s = _symbols(" ".join(t.decode("utf-8", "replace") for t in texts))
            counts += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3)
    if counts.any():
        yield pa.record_batch([pa.array(range(SYMBOLS), pa.int32()), pa.array([packed(c) for c in counts.reshape(SYMBOLS, -1)], pa.binary())],
                              names=["first", "counts"])


def _add(batches):
    total: dict = {}
    for b in batches:
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            row = np.frombuffer(c, dtype=np.int64)
            total[k] = total[k] + row if k in total else row
    if total:
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([packed(c) for c in total.values()], pa.binary())], names=["first", "counts"])


def _character_model(texts: DataFrame, words: dict[str, float]) -> np.ndarray:
    """log P(third | first, second), with backing off to the last character."""
    parts = texts.mapInArrow(lean(_trigrams), "first int, counts binary")
    n = np.zeros((SYMBOLS, SYMBOLS, SYMBOLS))
    for k, c in parts.repartition(8, "first").mapInArrow(lean(_add), "first int, counts binary").collect():  # 64 rows, 2 MB
        n[k] += np.frombuffer(c, dtype=np.int64).reshape(SYMBOLS, SYMBOLS)
    weight = max(10.0, n.sum() * 1e-3 / max(len(words), 1))
    for w in words:
        s = [0, 0, *map(symbol, w.rstrip("*")), *([] if w.endswith("*") else [0])]
        for a, b, c in zip(s, s[1:], s[2:]):
            n[a, b, c] += weight
    two = n.sum(0)
    one = two.sum(0) + 1
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return np.log((n + 5 * p2[None]) / (n.sum(2, keepdims=True) + 5)).astype(np.float32)


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """Alternatives (text, channel log-probability) for each run of equal characters."""
    out, at = [], 0
    while at < len(word):
        ch, end = word[at], at + 1
        while end < len(word) and word[end] == ch:
            end += 1
        k = end - at
        if ch == " " or (ch in "._-~'/," and 0 < at and end < len(word)):
            out.append([("", _COLLAPSED), (" ", _COLLAPSED)])
        else:
            letters = [(x, _SUBSTITUTED) for x in LEET.get(ch, "")] + [(ch, _LITERAL if ch in LEET else 0.0)]
            if k == 1:
                out.append(letters)
            else:
                out.append([(x * m, p + (_COLLAPSED if m == 1 else _DOUBLED)) for x, p in letters for m in (1, 2)])
        at = end
    return out


def viterbi(nodes, model: np.ndarray) -> str:
    """Most probable path through the lattice under the character model."""
    best = {(0, 0): (0.0, None)}  # last two symbols -> (log-probability, path)
    for options in nodes:
        step: dict = {}
        for (a, b), (p, path) in best.items():
            for text, cost in options:
                x, y, q = a, b, p + cost
                for ch in text:
                    z = symbol(ch)
                    q += float(model[x, y, z])
                    x, y = y, z
                if (x, y) not in step or q > step[x, y][0]:
                    step[x, y] = (q, (path, text))
        best = step
    (_, path), out = max(((p + float(model[a, b, 0]), path) for (a, b), (p, path) in best.items()), key=lambda r: r[0]), []
    while path:
        path, text = path
        out.append(text)
    return "".join(reversed(out))


class Scorer:
    """Units of a text, through one bounded cache of words per worker."""

    def __init__(self, units: dict[str, float], model: np.ndarray):
        self.units, self.model, self.cache = units, model, {}
        self.skeletons = {skeleton(u.rstrip("*")) for u in units if len(u) > 3}
        self.whole = {u.translate(_SKELETON) for u in units if len(u) > 3 and u[-1] != "*"}
        self.starts = {s[:k] for s in self.whole for k in range(2, len(s))}
        self.sizes = sorted({len(s) for s in self.skeletons})
        # beginnings that every unit or skeleton has: most words are ruled out by them
        self.heads = {u[:4] for u in units}
        self.skeleton_heads = {s[:self.sizes[0]] for s in self.skeletons}

    def match(self, word: str) -> str | None:
        if word[:4] not in self.heads:
            return None
        found = [u for u in units_of(word) if u in self.units]
        return max(found, key=self.units.__getitem__) if found else None

    def restore(self, word: str) -> list[str]:
        words = viterbi(lattice(word), self.model).split()
        # a gap may have been read as a word end: also compare what follows each word start
        return [u for i in range(len(words)) for w in {words[i], "".join(words[i:])} if (u := self.match(w))]

    def could_hide(self, word: str, anywhere: bool) -> bool:
        if "*" in word or "#" in word:  # any vowel: look for the rest
            return any(c.isalpha() for c in word) and len(word) > 3
        s = skeleton(word.replace(" ", ""))
        if not anywhere and (not self.sizes or s[:self.sizes[0]] not in self.skeleton_heads):
            return False
        starts = range(len(s)) if anywhere else (0,)
        return any(s[i:i + n] in self.skeletons for i in starts for n in self.sizes)

    def word(self, raw: str) -> tuple:
        w = clean_word(raw)
        if not w:
            return ()
        plain = plain_letters(w)
        for form in (w, plain) if plain != w else (w,):
            if u := self.match(form):
                return (u,)
            if self.could_hide(form, False) and (hits := self.restore(form)):
                return tuple(hits)
        return (b,) if not plain.isascii() and (b := bare(plain)) in self.units else ()

    def opens(self, raw: str) -> bool:
        """Whether a word could be the first fragment of a unit."""
        return plain_letters(raw.lower()).translate(_SKELETON) in self.starts

    def joined(self, words: list[str], at: int) -> list[str]:
        """Units that the fragments from ``at`` on make, if decoding joins them."""
        run = plain_letters(words[at].lower())
        for w in words[at + 1:at + FRAGMENTS]:
            run += " " + plain_letters(w.lower())
            s = clean_word(run.replace(" ", "")).translate(_SKELETON)
            if s in self.whole:
                return [u for w in viterbi(lattice(clean_word(run)), self.model).split() if (u := self.match(w))]
            if s not in self.starts:
                break
        return []

    def text(self, text: str) -> set[str]:
        found, words, opening = set(), text.split(), set()
        for w in set(words):
            hit = self.cache.get(w)
            if hit is None:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                units = self.word(w)
                hit = self.cache[w] = (units, not units and self.opens(w))
            found.update(hit[0])
            if hit[1]:
                opening.add(w)
        if opening:
            for at in [i for i, w in enumerate(words) if w in opening]:
                found.update(self.joined(words, at))
        for m in _SPACED.finditer(text):
            s = plain_letters(_GAPS.sub(" ", m[0]).lower())
            if self.could_hide(s, True):
                found.update(self.restore(s))
        return found

    def features(self, text: str) -> tuple[float, float]:
        found = self.text(text)
        return max((self.units[u] for u in found), default=0.0), float(min(len(found), 5))


def _features(model):
    def run(batches):
        scorer = Scorer(*model.value)
        for ids, texts in doc_chunks(batches):
            f = [scorer.features(t.decode("utf-8", "replace")) for t in texts]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([x[0] for x in f]), pa.array([x[1] for x in f])],
                                  names=["doc_id", "strongest", "n_units"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps (bounded sample, three weights)."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple:
    """(unit evidence, character model, logistic weights)."""
    spark = docs.sparkSession
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)")
             .where(learned).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").select("doc_id", "toxic"))
    texts = text_bytes(docs, id_col=id_col, text_col=text_col)
    order = F.xxhash64("doc_id"), "doc_id"
    pick = marks.where("toxic = 1").orderBy(*order).limit(SAMPLE).union(marks.where("toxic = 0").orderBy(*order).limit(SAMPLE))
    picked = spark.createDataFrame([tuple(r) for r in pick.collect()], "doc_id bigint, toxic int")  # <= 2 * SAMPLE rows
    sample = texts.join(F.broadcast(picked), "doc_id").select("toxic", "text")
    n = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    toxic_n, clean_n = n.get(1, 0), n.get(0, 0)
    units: dict[str, float] = {}
    if toxic_n:
        least = max(3, math.ceil(0.005 * toxic_n))
        count = lambda rows, only: rows.mapInArrow(lean(_unit_counts(only)), "unit string, toxic bigint, clean bigint").groupBy("unit")
        often = count(sample.where("toxic = 1"), None).agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= least).collect()
        known = spark.sparkContext.broadcast({r[0] for r in often})
        clean = {r[0]: r[1] for r in count(sample.where("toxic = 0"), known).agg(F.sum("clean").alias("clean")).collect()}
        for u, t in often:
            c = clean.get(u, 0)  # cautious on both sides: one standard deviation off the counts
            e = math.log((t - math.sqrt(t)) / toxic_n) - math.log((c + math.sqrt(c) + 1) / (clean_n + 1))
            if e >= 2.5 and len(u) > 1:  # single letters are no words
                units[u] = e
    model = _character_model(texts.select("doc_id", "text"), units)
    shared = spark.sparkContext.broadcast((units, model))
    f = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text").mapInArrow(lean(_features(shared)), "doc_id bigint, strongest double, n_units double")
    rows = f.join(F.broadcast(picked), "doc_id").select("strongest", "n_units", "toxic").collect()  # <= 2 * SAMPLE small rows
    x = np.array([r[:2] for r in rows], dtype=float).reshape(-1, 2)
    y = np.array([r[2] for r in rows], dtype=float)
    return units, model, _logistic(x, y) if len(rows) and 0 < y.sum() < len(y) else np.array([-6.0, 0.0, 0.0])


def score(docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1, threshold: float = 0.7,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out ids are never read."""
    units, model, w = learn(docs, labels, fold(F.col("doc_id"), parts) != held, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((units, model))
    f = text_bytes(docs, id_col=id_col, text_col=text_col).mapInArrow(lean(_features(shared)), "doc_id bigint, strongest double, n_units double")
    z = F.lit(float(w[0])) + F.lit(float(w[1])) * F.col("strongest") + F.lit(float(w[2])) * F.col("n_units")
    out = f.withColumn("score", 1 / (1 + F.exp(-z)))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), parts) == held, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def _rejected(model, w, threshold):
    def run(batches):
        scorer = Scorer(*model.value)
        for b in batches:
            at = b.schema.get_field_index("_scored_text")
            texts = b.column(at).to_pylist()
            f = [scorer.features(t.decode("utf-8", "replace")) for t in texts]
            keep = [1 / (1 + math.exp(-(w[0] + w[1] * x + w[2] * y))) < threshold for x, y in f]
            yield b.select(["row"]).filter(pa.array(keep))
    return run


def without_toxic(docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1, threshold: float = 0.7,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    units, model, w = learn(docs, labels, fold(F.col("doc_id"), parts) != held, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((units, model))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = docs.select(row, F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("_scored_text"))
    kind = T.StructType().add("row", d.schema["row"].dataType)
    return d.mapInArrow(lean(_rejected(shared, [float(x) for x in w], threshold)), kind).select("row.*")
