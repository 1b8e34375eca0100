"""Temperature mixing of sources to target weights, in DataFrame operations only.

Source shares p are flattened to p**a / sum(p**a).  The exponent is the
smallest a in [0, 1] (on a grid of 2**-20) whose weights stay within a target
entropy and a repetition limit; both fall as a grows, so a is found by
repeated 32-fold bisection, each step one aggregate over the per-source totals.

The weights are realised as budgeted block permutations.  Each source reads
whole epochs while its token quota lasts; the last, partial epoch walks a
permutation of the source (an md5 key per document, over its source, id and text)
block by block.  The cut in
the permutation is found by two levels of 1,024 blocks and one exact running
sum inside a single block of the second level, so no task ever holds a source,
even when one source has a third of all rows.  The result is one cut key per
source; documents are then mapped row by row and their texts never move.

Rows of one source, id and text are one entry with a count, reduced before any
shuffle; where the quota ends inside such an entry, only as many of its rows as
fit are read once more, so a source whose rows repeat, or share an id or no id,
is read to within one document of its quota like any other.

Tokens are words.  Defined results: a null source counts as the source ''; a
null text has no tokens; documents of a source without tokens are read once;
repeated rows count one by one; a null id counts as ''; different documents of
equal 60-bit keys are taken or left together; an empty table gives an empty result.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import stored

GRID_BITS = 20
WORD = r"[^\x20\x09-\x0D]+"
MAX_BROADCAST_SOURCES = 20_000  # beyond it the join by source is left to Spark


def order_key(seed: int, source: Column, doc_id: Column, text: Column) -> Column:
    """60-bit place of a document in its source's permutation."""
    digest = F.md5(F.coalesce(text.cast("string"), F.lit("")))
    name = F.concat_ws("|", F.lit(str(seed)), source, F.coalesce(doc_id.cast("string"), F.lit("")), digest)
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def _measured(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per entry (source, id, text) with its number of rows."""
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), source.alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
                       order_key(seed, source, F.col(id_col), F.col(text_col)).alias("order_key")
                       ).groupBy("doc_id", "source", "n_tokens", "order_key").agg(F.count("*").alias("n_rows"))


def find_exponent(totals: DataFrame, entropy_gain: float, max_repeat: float, keep_all: bool) -> tuple[float, float]:
    """(exponent, token budget) for per-source totals with tokens.

    The entropy target lies ``entropy_gain`` of the way from the shares' own
    entropy to that of equal weights.  ``keep_all`` sets the budget so that the
    least repeated source is still read once; otherwise it is the corpus size.
    """
    t = totals.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count("*"),
                   F.sum(F.col("tokens") * F.log("tokens"))).first()
    if not t[3]:
        return 1.0, 0.0
    total, least, most, n = float(t[0]), float(t[1]), float(t[2]), t[3]
    own = math.log(total) - float(t[4]) / total
    target = own + entropy_gain * (math.log(n) - own)

    def allowed(a: float, z: float, zlog: float) -> bool:
        entropy = math.log(z) - a * zlog / z
        repeat = (least / most) ** (a - 1) if keep_all else (least / total) ** (a - 1) / z
        return entropy <= target + 1e-9 and repeat <= max_repeat + 1e-9

    share = F.col("tokens") / F.lit(total)
    low, high, unit = 0, 1 << GRID_BITS, 1 << GRID_BITS  # high is always allowed
    while low < high:
        step = max(1, (high - low) // 32)
        grid = sorted({*range(low, high, step), high})
        rows = (totals.select(share.alias("p"), F.explode(F.array(*[F.lit(g) for g in grid])).alias("g"))
                .withColumn("x", F.pow("p", F.col("g") / F.lit(float(unit))))
                .groupBy("g").agg(F.sum("x"), F.sum(F.col("x") * F.log("p"))).collect())  # <= 34 rows
        good = {r[0] for r in rows if allowed(r[0] / unit, r[1], r[2])} | {high}
        first = min(g for g in grid if g in good)
        at = grid.index(first)
        low, high = (first, first) if at == 0 or step == 1 else (grid[at - 1] + 1, first)
    a = high / unit
    z = totals.agg(F.sum(F.pow(share, F.lit(a)))).first()[0]
    return a, (total * z * (most / total) ** (1 - a) if keep_all else total)


def mix_plan(docs: DataFrame, entropy_gain: float = 0.5, max_repeat: float = 4.0, keep_all: bool = False, seed: int = 7,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(entries, one row per source: weight, quota, epochs, cut key, part key and rows).

    A document is read ``epochs`` times, and once more when its order key is at
    most ``cut_key`` (null: no document of the partial epoch fits).  Of the rows of
    the entry at ``part_key``, ``part_rows`` are read once more as well.
    """
    spark = docs.sparkSession
    d = stored(_measured(docs, seed, id_col, text_col, source_col), "mix-docs")
    totals = stored(d.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_rows")).alias("tokens")), "mix-sources")
    with_tokens = totals.where("tokens > 0")
    a, budget = find_exponent(with_tokens, entropy_gain, max_repeat, keep_all)
    raw = with_tokens.withColumn("raw", F.pow(F.col("tokens").cast("double"), F.lit(a)))
    z = raw.agg(F.sum("raw")).first()[0] or 1.0
    plan = totals.withColumn("weight", F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a)) / F.lit(z)).otherwise(0.0))
    plan = (plan.withColumn("quota", F.floor(F.round(F.col("weight") * F.lit(budget), 3)).cast("long"))
            .withColumn("epochs", F.when(F.col("tokens") > 0, F.greatest(F.expr("quota DIV tokens"), F.lit(1 if keep_all else 0))).otherwise(1).cast("long"))
            .withColumn("rest", F.greatest(F.col("quota") - F.col("epochs") * F.col("tokens"), F.lit(0))))
    plan = stored(plan, "mix-plan")

    left = small(plan.where("tokens > 0 and rest > 0").select("source", "rest"), "source")
    cell = d
    size = F.col("n_tokens") * F.col("n_rows")
    for shift in (50, 40):  # 1,024 blocks, then 1,024 blocks of the block that holds the cut
        block = F.shiftright("order_key", shift).bitwiseAND(1023)
        sums = cell.join(left, "source").groupBy("source", "rest", block.alias("b")).agg(F.sum(size).alias("t"))
        run = W.partitionBy("source").orderBy("b")
        cut = (sums.withColumn("before", F.sum("t").over(run) - F.col("t")).where("before <= rest")
               .groupBy("source").agg(F.max_by(F.struct("b", "before", "rest"), "b").alias("c"))
               .select("source", F.col("c.b").alias("cut_b"), (F.col("c.rest") - F.col("c.before")).alias("rest")))
        left = small(stored(cut.select("source", "rest", "cut_b"), "mix-cut"), "source")
        cell = cell.join(left.select("source", "cut_b"), "source").where(block == F.col("cut_b")).drop("cut_b")
        left = left.drop("cut_b")
    # the cell of the cut: documents in key order while the rest lasts; where none
    # fits, the cut lies just before the cell
    run = W.partitionBy("source").orderBy("order_key")
    inside = (cell.join(left, "source").withColumn("used", F.sum(size).over(run.rangeBetween(W.unboundedPreceding, 0)))
              .withColumn("room", F.col("rest") - F.coalesce(F.sum(size).over(run.rangeBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("fits", F.col("used") <= F.col("rest"))
              .groupBy("source").agg(F.max(F.when(F.col("fits"), F.col("order_key"))).alias("fit"),
                                     (F.min(F.shiftright("order_key", 40)) * (1 << 40) - 1).alias("edge"),
                                     F.min(F.when(~F.col("fits"), F.struct("order_key", "room", F.greatest("n_tokens", F.lit(1)).alias("each")))).alias("part"))
              .select("source", F.coalesce("fit", "edge").alias("cut_key"), F.col("part.order_key").alias("part_key"),
                      F.coalesce(F.expr("part.room DIV part.each"), F.lit(0)).alias("part_rows")))
    return d, stored(plan.join(inside, "source", "left"), "mix-cuts")


def small(df: DataFrame, key: str) -> DataFrame:
    """Broadcast a one-row-per-source table only after its size has been checked."""
    n = df.limit(MAX_BROADCAST_SOURCES + 1).count()
    return F.broadcast(df) if n <= MAX_BROADCAST_SOURCES else df


def _copies() -> Column:
    return (F.col("epochs") + F.when(F.col("order_key") <= F.col("cut_key"), 1).otherwise(0)).cast("long")


CHUNK = 10_000


def _times(df: DataFrame, n: str, nth: str) -> DataFrame:
    """Each row ``n`` times, numbered from 1; large counts are dealt over tasks in chunks."""
    few = df.where(F.col(n).between(1, CHUNK)).withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) DIV {CHUNK}")))
    many = df.where(F.col(n) > CHUNK).withColumn("_chunk", chunk).repartition("_chunk")
    most = F.least((F.col("_chunk") + 1) * CHUNK, F.col(n))
    return few.union(many.withColumn(nth, F.explode(F.sequence(F.col("_chunk") * CHUNK + 1, most))).drop("_chunk"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, n_tokens, order_key, block (of 1,024 in the permutation),
    weight of the source and copies: how often the mixture reads the document."""
    d, cuts = mix_plan(docs, **options)
    out = _times(d, "n_rows", "nth").join(small(cuts.select("source", "weight", "epochs", "cut_key", "part_key", "part_rows"), "source"), "source", "left")
    part = F.when((F.col("order_key") == F.col("part_key")) & (F.col("nth") <= F.col("part_rows")), 1).otherwise(0)
    return out.select("doc_id", "source", "n_tokens", "order_key", F.shiftright("order_key", 50).alias("block"),
                      F.round("weight", 6).alias("weight"), (_copies() + part).alias("copies"))


def mixed_documents(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents themselves, each row as often as the mixture reads it.  Rows that
    an entry reads beyond a whole epoch are copies of one of its rows."""
    _, cuts = mix_plan(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    inside = not cuts.where("part_rows > 0").isEmpty()
    cuts = small(cuts.select(F.col("source").alias("_mix_source"), "epochs", "cut_key", "part_key", "part_rows"), "source")
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    names = docs.columns
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), source.alias("_mix_source"),
                       order_key(seed, source, F.col(id_col), F.col(text_col)).alias("order_key")).join(cuts, "_mix_source", "left")
    out = kept.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), _copies().cast("int")))).select("_row.*")
    if inside:  # a second scan, only where the quota of a source ends among repeated rows
        one = kept.where("order_key = part_key AND part_rows > 0").groupBy("_mix_source", "part_rows").agg(F.first("_row").alias("_row"))
        out = out.union(_times(one, "part_rows", "_nth").select("_row.*"))
    return out
