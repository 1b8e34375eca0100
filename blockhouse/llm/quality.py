"""Quality rules: a threshold table compiled into one Spark projection.

Only built-in column functions run: words, ratios and repeated windows are
array expressions inside the row, so there is no shuffle and a row's memory
follows its own text.  Rules are (metric, lowest, highest) rows; a bound that
is None is open.  The table is turned into a conjunction of comparisons.

Defined results: a null or blank text has no words, zero metrics and fails the
base rule; a null id stays null; other columns of the input are not looked at;
repeated rows give repeated results; an empty table gives an empty result.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of the four corpus languages.
STOP_WORDS = (
    "the of and to in a is that for it as with on by this be at from are or an not was "
    "le la les de des du un une et est que dans pour en sur par qui au avec "
    "der die das und den von zu mit ist ein eine im auf nicht des dem es "
    "el los las del y un una que en con por para se su al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    metric: str
    low: float | None = None
    high: float | None = None


# Ratios over the words (lines: over the lines that hold a word).
RULES = (
    Rule("mean_word_chars", 1.5, 15.0),
    Rule("symbol_ratio", None, 0.10),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.50),
)


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """One boolean expression that holds when every metric is within its bounds."""
    ok = F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & (F.col(r.metric) >= F.lit(float(r.low)))
        if r.high is not None:
            ok = ok & (F.col(r.metric) <= F.lit(float(r.high)))
    return ok


def _paired(hashes: str, apart: int) -> Column:
    """Hash of entry i with entry i + apart; entries without a partner fall away."""
    left = F.size(hashes) - apart
    return F.when(left > 0, F.zip_with(
        F.slice(hashes, 1, left), F.slice(hashes, 1 + apart, left),
        lambda x, y: F.xxhash64(x, y))).otherwise(F.array().cast("array<bigint>"))


def _covered_words(k: int) -> Column:
    """Words inside windows of ``h`` that occur twice or more: sort (hash, place),
    keep places with an equal neighbour, add up the union of [place, place + k)."""
    pairs = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hash_at = lambda s, j: F.get(s, j)["h"]

    def union_length(p: Column) -> Column:
        gaps = F.transform(p, lambda x, j: F.least(F.lit(k), F.coalesce(F.get(p, j + 1) - x, F.lit(k))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: x["h"].eqNullSafe(hash_at(s, j - 1)) | x["h"].eqNullSafe(hash_at(s, j + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    # each let-binding is a one-element transform, so the arrays are built once
    sized = F.get(F.transform(F.array(F.get(F.transform(F.array(pairs), places), F.lit(0))), union_length), F.lit(0))
    return F.when(F.size(F.array_distinct("h")) == F.size("h"), F.lit(0)).otherwise(sized)


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 20, max_repeat_pct: int = 30,
            window: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and the ratios that the rules test."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = d.select("doc_id", "text", F.array_remove(F.split("text", SEPARATORS), "").alias("words"),
                 F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    d = d.select("doc_id", F.transform("words", lambda x: F.xxhash64(x)).alias("w"),
                 F.size("lines").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    stops = sorted({v for s in STOP_WORDS for v in (s, s.capitalize())})
    d = d.withColumn("h", F.col("w"))
    reach = 1  # window hashes by doubling: 2, 4, ... words, then the overlap that completes the window
    while reach < window:
        step = min(reach, window - reach)
        d = d.withColumn("h", _paired("h", step))
        reach += step
    d = d.select("*", F.size("w").cast("long").alias("n_words"),
                 F.size(F.filter("w", lambda x: x.isin(*[F.xxhash64(F.lit(s)) for s in stops]))).alias("n_stop"))
    d = d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_stop",
                 _covered_words(window).cast("long").alias("n_repeat_words"))
    per = lambda c, of: F.col(c) / F.greatest(F.col(of), F.lit(1))
    d = d.select("*", per("word_chars", "n_words").alias("mean_word_chars"), per("n_symbols", "n_words").alias("symbol_ratio"),
                 per("n_stop", "n_words").alias("stop_word_ratio"), per("n_dup_lines", "n_lines").alias("dup_line_ratio"),
                 ((F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))).alias("base_failed"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & compile_rules(rules)).alias("kept"),
                    "mean_word_chars", "symbol_ratio", "stop_word_ratio", "dup_line_ratio")
