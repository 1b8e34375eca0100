"""Chat format, quality rules, language id, toxicity: brute force, round trips, held-out accuracy."""
import hashlib
import itertools

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from blockhouse.llm import chat, language, quality, toxicity
from blockhouse.llm.common import BATCH_BYTES, lean, text_bytes
from blockhouse.llm.queries import Q
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute

HOSTILE = st.lists(st.sampled_from([*"\\#</> \n:aU\"é", "###", "</turn>", "\\", "### User: ", " </turn>\n"]), max_size=20).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "we: \"ird\n### x"]), HOSTILE), max_size=5))
def test_chat_round_trip(turns):
    reader, out = chat.Reader(), ""
    for role, text in turns:
        segment, start, length = chat.format_turn(role, text)
        assert chat.unescape(segment[start:start + length]) == text
        out += segment
    assert reader.feed(out) == turns
    reader.close()
    pieces = chat.Reader()  # any cut of the stream reads the same
    assert [t for i in range(0, len(out), 7) for t in pieces.feed(out[i:i + 7])] == turns


def _digest(rows):
    want = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    return {c: (len(v), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in v).encode()).hexdigest(),
                sum(len(b) for a, b in v if a == "assistant"),
                hashlib.sha256("".join(b for a, b in v if a == "assistant").encode()).hexdigest()) for c, v in want.items()}


def test_chat_table(spark):
    got = {r[0]: tuple(r)[1:5] for r in Q["op2_chat_format"](spark, SF_SMALL).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hard = "\\### Assistant: </turn> ok"
    assert got == _digest(rows + [(-7, 0, "user", hard), (-7, 1, "assistant", hard)])


def test_chat_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "x"), (1, 1, "assistant", "a" * 200_000), (2, 3, "tool", ""), (2, 3, "tool", "")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "conv_id bigint, turn bigint, role string, text string, segment string")
    got = {r[0]: tuple(r)[1:5] for r in chat.read_back(chat.format_turns(df)).collect()}
    assert got == _digest(rows)
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []
    null = spark.createDataFrame([(None, None, "user", "x"), (None, 1, "user", "y")], df.drop("segment").schema)
    assert chat.read_back(chat.format_turns(null)).select("conv_id", "n_turns").collect() == [(None, 2)]


def _quality(text):
    w = [x.decode() for x in brute.words(text)]
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(8)}
    n = len(covered)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), n,
            len(w) < 20 or 100 * n > 30 * len(w))


def test_quality_odd_rows(spark, odd_docs, no_docs):
    got = sorted((r[0], *r[1:7]) for r in quality.quality(odd_docs).collect())
    want = sorted((r[0], *_quality(r[1])) for r in odd_docs.select("doc_id", "text").collect())
    assert got == want
    assert quality.quality(no_docs).collect() == []


def test_quality_plan_is_native(spark):
    plan = Q["op4_quality_rules"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_quality_rules_are_a_table(spark, odd_docs):
    none = quality.quality(odd_docs, rules=()).where("kept").count()
    strict = quality.quality(odd_docs, rules=(quality.Rule("n_words", 100.0, 130.0),)).where("kept").select("doc_id").collect()
    assert none == 6 and sorted(r[0] for r in strict) == [1, 2, 2, 3, 10]


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    out = Q["op6_language_id"](spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id")
    r = out.where("held_out").agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert r[0] > 150 and r[1] >= 0.98
    assert out.where("score < 0 OR score > 1").isEmpty()


def test_language_filter_returns_all_languages_of_an_ngram(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL")
    model = language.learn(docs, F.lit(True))
    grams, total = {}, {}
    for text, lang in docs.select("text", "lang").collect():
        b = bytes(x + 32 if 65 <= x <= 90 else 32 if 9 <= x <= 13 else x for x in b"  " + text.encode() + b"  ")
        for i in range(len(b) - 3):
            grams.setdefault(b[i:i + 4], {}).setdefault(lang, 0)
            grams[b[i:i + 4]][lang] += 1
        total[lang] = total.get(lang, 0) + len(b) - 3
    every = sorted(grams)
    first, second, lo, _ = language._places([g for g in every])
    at = lo + 2  # behind the two blanks that every text begins with
    held = model["masks"][0, 0][first[at]] & model["masks"][0, 1][second[at]]
    wrong = 0
    for g, bits in zip(every, held.tolist()):
        for i, lang in enumerate(model["langs"]):
            own = grams[g].get(lang, 0) >= max(1, language.MEMBER * total[lang])
            assert bits >> i & 1 or not own
            wrong += (bits >> i & 1) and not own
    assert wrong <= 0.1 * len(every) * len(model["langs"])  # a Bloom filter errs to one side only


def test_language_odd_rows(spark, odd_docs, no_docs):
    got = {r[0]: r for r in language.identify(odd_docs).collect()}
    assert got[4][2] == got[5][2] == got[6][2] == "und" and got[1][2] in {"en", "fr", "de"}
    assert language.identify(odd_docs).count() == odd_docs.count() and language.identify(no_docs).collect() == []
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r[2] for r in language.identify(unlabelled).collect()} == {"und"}


def test_language_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language.fold(F.col("doc_id"), 5) == 0, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    assert sorted(map(tuple, language.identify(docs).collect())) == sorted(map(tuple, language.identify(wrong).collect()))


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    out = Q["op10_toxicity"](spark, SF_CHECK).join(labels, "doc_id").where("held_out")
    r = out.agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 0, F.col("predicted")))).first()
    assert r[0] >= 0.7 and r[1] <= 0.02


def _model(spark):
    docs = [(i, "you are an idiot and a total loser today" if i % 2 else f"the weather is fine and calm today number {i}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, toxic int")
    return df, labels


def test_toxicity_restores_disguises(spark):
    df, labels = _model(spark)
    units, model, _ = toxicity.learn(df, labels, F.lit(True))
    scorer = toxicity.Scorer(units, model)
    for t in ("1d10t", "y o u  i d i o t", "idiooooot", "l0$er", "l.o.s.e.r", "IDIOT!!", "an id*ot here", "i-d-i-o-t"):
        assert scorer.text(t), t
    for t in ("the weather is fine", "a b c d e", "10 100 1,000", "", "### *** ###", "x" * 100_000, "1" * 5000 + "a"):
        assert not scorer.text(t), t


def test_toxicity_restores_spacing_and_look_alikes(spark):
    df, labels = _model(spark)
    units, model, _ = toxicity.learn(df, labels, F.lit(True))
    scorer = toxicity.Scorer(units, model)
    for t in ("i  d  i  o  t", "i\td\ti\to\tt", "l\no\ns\ne\nr", "i\u00a0d\u00a0i\u00a0o\u00a0t", "idi ot", "lo ser.", "los\ner", "l/o/s/e/r",
              "i,d,i,o,t", "idi\u043et", "lose\u0433 l\u043eser", "idi\u00f3t", "\uff49\uff44\uff49\uff4f\uff54", "id i ot"):
        assert scorer.text("so " + t + " it is"), t
    for t in ("id est", "lo behold", "the weather is lo", "i did it", "loose rope", "\u043b\u043e\u0441\u0435\u0440", "idea or"):
        assert not scorer.text(t), t


def test_viterbi_finds_the_best_of_all_paths(spark):
    df, labels = _model(spark)
    units, model, _ = toxicity.learn(df, labels, F.lit(True))
    for word in ("1d10t", "l o ser", "!d!!0t", "l.0.s3r", "a*#t"):
        nodes = toxicity.lattice(word)
        best = max((sum(p for _, p in path) + _plain_log(model, "".join(x for x, _ in path)) for path in itertools.product(*nodes)))
        got = toxicity.viterbi(nodes, model)
        ways = [sum(p for _, p in path) for path in itertools.product(*nodes) if "".join(x for x, _ in path) == got]
        assert max(ways) + _plain_log(model, got) == pytest.approx(best, abs=1e-3)


def _plain_log(model, text):
    s = [0, 0, *map(toxicity.symbol, text), 0]
    return sum(float(model[a, b, c]) for a, b, c in zip(s, s[1:], s[2:]))


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    df, labels = _model(spark)
    empty = labels.limit(0)
    both = odd_docs.select("doc_id", "text").union(df)
    scores = toxicity.score(both, labels.union(spark.createDataFrame([(1, 1), (2, None)], labels.schema)))
    rows = scores.collect()
    assert len(rows) == both.count() and all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.7) for r in rows)
    assert {r[3] for r in toxicity.score(odd_docs, empty).collect()} == {0}
    assert toxicity.score(no_docs, empty).collect() == []
    assert toxicity.without_toxic(odd_docs, labels).columns == odd_docs.columns


def test_toxicity_ignores_held_out_labels(spark):
    df, labels = _model(spark)
    flipped = labels.withColumn("toxic", F.when(language.fold(F.col("doc_id"), 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, toxicity.score(df, labels).collect())) == sorted(map(tuple, toxicity.score(df, flipped).collect()))


def test_arrow_batches_of_texts_are_bounded_by_bytes(spark):
    """10,000 rows a batch alone would hand a worker all of these texts at once."""
    docs = spark.range(0, 1500, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], names=["n"])

    found = [r[0] for r in text_bytes(docs).mapInArrow(sizes, "n bigint").collect()]
    assert sum(found) > 3 * BATCH_BYTES and max(found) < 1.1 * BATCH_BYTES


def test_workers_give_back_what_a_step_freed():
    """Idle workers are kept, and what a step freed between blocks still in use stays theirs."""
    used = []

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(x.split()[1]) for x in f if x.startswith("Anonymous:")) >> 10

    def step(batches):
        for b in batches:
            some = [bytes(100_000) for _ in range(2_000)]  # 200 MB
            used.append(some[::100])  # 2 MB all over them
            del some
            yield pa.record_batch([pa.array([1])], names=["n"])

    before = held()
    assert [b.num_rows for b in lean(step)([None])] == [1]
    assert held() - before < 60
    assert lean(lambda left, right: left)(1, 2) == 1
