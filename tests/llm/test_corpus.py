"""Mixing, packing, training order and the pipeline."""
import hashlib
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from blockhouse.llm import mixing, packing, training_order
from blockhouse.llm.common import stored
from blockhouse.llm.queries import Q
from blockhouse.llm.tokens import Encoder, default_vocabulary
from blockhouse.session import scratch_path
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def _whole_text_ids(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(default_vocabulary())
    tok.encode_special_tokens = True
    return [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_cached_ids_equal_whole_text_ids(docs):
    texts = [r[0] or "" for r in docs.select("text").limit(150).collect()] + [
        "", " ", "  ", "a  b", "a \n b", "\n a", " x", "x ", "a\t b  c  d", "it's <|endoftext|> 12  34!! ?", "x \x85 y\x1c z", "é \U0001f600 中文"]
    enc = Encoder(default_vocabulary())
    for _ in range(2):
        assert [np.frombuffer(enc.ids(t), dtype="<u4").tolist() for t in texts] == _whole_text_ids(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", " ", "a", "Bc", "1", "!", "'s", "é", "\x1c", "."]), max_size=25))
def test_cached_ids_any_white_space(parts):
    text = "".join(parts)
    assert np.frombuffer(_ENC().ids(text), dtype="<u4").tolist() == _whole_text_ids([text])[0]


def _ENC(cache=[]):  # noqa: B006
    return cache[0] if cache else cache.append(Encoder(default_vocabulary())) or cache[0]


def _check_packing(rows, lengths, capacity=2048):
    by_doc, by_seq = {}, {}
    for d, piece, start, length, crc, seq, offset in rows:
        by_doc.setdefault(d, []).append((piece, start, length, crc))
        by_seq.setdefault(seq, []).append((offset, length))
    for d, ps in by_doc.items():
        ps.sort()
        assert [p[0] for p in ps] == list(range(len(ps))) and sum(p[2] for p in ps) == lengths[d]
        assert [p[1] for p in ps] == [sum(q[2] for q in ps[:i]) for i in range(len(ps))]
        assert len(ps) == 1 or (all(p[2] == capacity for p in ps[1:]) and ps[0][2] <= capacity)
    for s in by_seq.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and sum(n for _, n in s) <= capacity
    return by_doc, by_seq


def test_packing_table(spark, docs):
    rows = [tuple(r) for r in Q["op8_best_fit_packing"](spark, SF_SMALL).collect()]
    data = docs.select("doc_id", "text").collect()
    ids = {r[0]: i + [0] for r, i in zip(data, _whole_text_ids([r[1] or "" for r in data]))}
    by_doc, by_seq = _check_packing(rows, {k: len(v) for k, v in ids.items()})
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        for _, start, length, crc in ps:
            assert crc == zlib.crc32(np.array(ids[d][start:start + length], dtype="<u4").tobytes())
    assert len(by_seq) <= math.ceil(sum(map(len, ids.values())) / 2048 * 1.01) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=120), st.sampled_from(["norm", "dot"]), st.integers(1, 9), st.integers(10_000, 30_000))
def test_best_fit_keeps_every_constraint(lengths, score, max_docs, max_attention):
    lengths = np.sort(np.array(lengths))[::-1]
    bins, offsets = packing.best_fit(lengths, 100, max_docs, max_attention, score)
    for b in np.unique(bins):
        mine = np.flatnonzero(bins == b)
        assert lengths[mine].sum() <= 100 and len(mine) <= max_docs and (lengths[mine] ** 2).sum() <= max_attention
        assert offsets[mine].tolist() == np.concatenate([[0], np.cumsum(lengths[mine])[:-1]]).tolist()


def test_packing_odd_rows(spark, odd_docs, no_docs):
    odd = odd_docs.union(odd_docs.limit(1).withColumn("doc_id", F.lit(None).cast("bigint")))
    rows = packing.pack(odd).collect()
    assert sum(r[1] == 0 for r in rows) == odd.count() and [r[3] for r in rows if r[0] in (4, 5)] == [1, 1]
    assert packing.pack(no_docs).collect() == []
    cut = packing.pack(odd_docs, capacity=64, max_docs=2, max_attention=2500)
    assert cut.agg(F.max("length")).first()[0] <= 50
    assert cut.groupBy("sequence_id").count().agg(F.max("count")).first()[0] <= 2


def test_feistel_is_a_bijection():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        out = training_order.feistel(np.arange(n), n, 7)
        assert sorted(out.tolist()) == list(range(n))
    a, b = (training_order.feistel(np.arange(1000), 1000, k) for k in (7, 8))
    assert (a != b).any() and (a != np.arange(1000)).any()


def test_training_order_holds_every_id(spark, docs):
    path = scratch_path(spark, "t-order")
    n = training_order.materialise(docs, path, stride=256, shard_slots=100)
    rows = training_order.read_order(spark, path, 0, 100).orderBy("slot").collect()
    assert [r["slot"] for r in rows] == list(range(n)) and {len(r["ids"]) for r in rows} == {512}
    assert all(r["shard"] == r["slot"] // 100 for r in rows)
    data = docs.select("doc_id", "text").collect()
    ids = _whole_text_ids([r[1] or "" for r in data])
    got = np.concatenate([np.frombuffer(r["ids"], dtype="<u2")[:r["n_ids"]] for r in rows])
    want = np.concatenate([np.array(i + [0]) for i in ids])
    assert len(got) == len(want) and (np.bincount(got, minlength=50300) == np.bincount(want, minlength=50300)).all()
    assert {d for r in rows for d in r["doc_ids"]} == {r[0] for r in data}
    tail = training_order.read_order(spark, path, n - 5, 100)
    assert tail.count() == 5 and "shard" in tail._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]


def test_training_order_refuses_wide_ids(spark, odd_docs, monkeypatch):
    class Wide(Encoder):
        def __init__(self, vocabulary):
            super().__init__(vocabulary)
            self.top = 70_000

    with pytest.raises(ValueError):
        monkeypatch.setattr(training_order, "encoder", Wide)
        list(training_order._sequences(default_vocabulary(), 64)(iter([])))


def test_training_order_odd_rows(spark, odd_docs, no_docs):
    out = training_order.training_order(odd_docs, shard_slots=3, stride=64)
    assert out.agg(F.sum("n_ids")).first()[0] == packing.pieces(odd_docs).agg(F.sum("length")).first()[0]
    assert training_order.training_order(no_docs).collect() == []


def _place(seed, source, i, text):
    digest = hashlib.md5((text or "").encode()).hexdigest()
    return int(hashlib.md5(f"{seed}|{source or ''}|{'' if i is None else i}|{digest}".encode()).hexdigest()[:15], 16)


def _plan(docs, gain, most, keep_all, seed=7):
    """Plain version of the mixture: {source: copies by document}."""
    t = {}
    for i, text, source in docs:
        t.setdefault(source or "", []).append((_place(seed, source, i, text), len(brute.words(text)), i))
    tokens = {s: sum(x[1] for x in v) for s, v in t.items()}
    total, live = sum(tokens.values()), [x for x in tokens.values() if x]
    own = -sum(x / total * math.log(x / total) for x in live)

    def ok(a):
        z = sum((x / total) ** a for x in live)
        w = [(x / total) ** a / z for x in live]
        h = -sum(x * math.log(x) for x in w)
        rep = (min(live) / max(live)) ** (a - 1) if keep_all else max(x / (y / total) for x, y in zip(w, live))
        return h <= own + gain * (math.log(len(live)) - own) + 1e-9 and rep <= most + 1e-9

    a = next(g for g in range(0, 1 + (1 << 20), 1) if ok(g / (1 << 20))) / (1 << 20) if not ok(0) else 0.0
    z = sum((x / total) ** a for x in live)
    budget = total * z * (max(live) / total) ** (1 - a) if keep_all else total
    out = []
    for s, v in t.items():
        quota = math.floor(round((tokens[s] / total) ** a / z * budget, 3)) if tokens[s] else 0
        epochs, rest = divmod(quota, tokens[s]) if tokens[s] else (1, 0)
        if keep_all and not epochs:
            epochs, rest = 1, 0
        used, open_ = 0, rest > 0
        for key, n, i in sorted(v, key=lambda x: x[0]):  # repeated rows lie side by side and are read one by one
            used += n
            open_ = open_ and used <= rest
            out.append((i, s, n, epochs + int(open_)))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"entropy_gain": 0.9, "max_repeat": 1.5}, {"entropy_gain": 1.0, "max_repeat": 1.25, "keep_all": True}])
def test_mixing_matches_plain_version(spark, odd_docs, options):
    rows = [tuple(r) for r in odd_docs.where("doc_id <> 9").select("doc_id", "text", "source").collect()]
    got = mixing.mix(odd_docs.where("doc_id <> 9"), **options).select("doc_id", "source", "n_tokens", "copies").collect()
    want = _plan(rows, options.get("entropy_gain", 0.5), options.get("max_repeat", 4.0), options.get("keep_all", False))
    assert sorted(map(tuple, got), key=str) == want
    docs = mixing.mixed_documents(odd_docs.where("doc_id <> 9"), **options)
    assert docs.columns == odd_docs.columns and docs.count() == sum(r[3] for r in want)
    if options.get("keep_all"):
        assert min(r[3] for r in want) >= 1


def test_mixing_reads_sources_that_share_or_lack_ids(spark):
    rows = ([(None, f"{i} " + "w " * (i % 17), "null ids") for i in range(1000)] + [(5, f"{i} x y z", "one id") for i in range(600)]
            + [(6, "a b c d e f g", "one row")] * 25_000 + [(i, "a b c", "small") for i in range(30)])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(docs)
    want = _plan([tuple(r) for r in docs.collect()], 0.5, 4.0, False)
    assert sorted((tuple(r) for r in out.select("doc_id", "source", "n_tokens", "copies").collect()), key=str) == want
    t = out.groupBy("source").agg(F.first("weight").alias("w"), F.sum(F.col("n_tokens") * F.col("copies")).alias("t"), F.max("n_tokens").alias("one")).collect()
    total = sum(len(brute.words(r[1])) for r in rows)
    assert len(t) == 4 and all(0 <= r["w"] * total - r["t"] < r["one"] + 1 for r in t)
    read = mixing.mixed_documents(docs).groupBy("source").agg(F.count("*")).collect()
    assert dict(map(tuple, read)) == {s: sum(r[3] for r in want if r[1] == s) for s in {r[1] for r in want}}


def test_mixing_table_reaches_its_weights(spark):
    out = Q["op7_mix_sources"](spark, SF_SMALL)
    t = out.groupBy("source").agg(F.first("weight").alias("w"), F.sum(F.col("n_tokens") * F.col("copies")).alias("t"), F.max("n_tokens").alias("one")).collect()
    total = sum(r["t"] for r in t)
    assert all(abs(r["t"] / total - r["w"]) <= 2 * r["one"] / total + 0.01 for r in t) and abs(sum(r["w"] for r in t) - 1) < 1e-3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert mixing.mix(spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)).collect() == []


def test_pipeline_stages_match_brute_force(spark):
    """Each stage on its predecessor's rows against the plain version of its decision."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "mix_sources", "best_fit_packing"]
    d = {"in": docs}
    for name, stage in corpus_pipeline.STAGES:
        d[name] = stored(stage(spark, list(d.values())[-1], SF_CHECK), f"t-{name}")
    text = lambda k: {r["doc_id"]: r["text"] for r in d[k].collect()}
    for k in list(d)[:-1]:
        assert d[k].columns == docs.columns
    first, tox = text("in"), text("toxicity")
    clean = {r[0] for r in labels.where("toxic = 0").collect()}
    assert len(set(first) & clean - set(tox)) <= 0.02 * len(clean) and 0 < len(first) - len(tox) < 0.2 * len(first)
    groups = brute.components(list(tox.items()))
    near = text("ngram_jaccard_join")
    assert set(near) == {i for i, (_, c) in groups.items() if i == c}
    cut, want = text("substring_dedup"), brute.repeats(list(near.items()))
    for i, t in cut.items():
        assert hashlib.sha256(b" ".join(brute.words(t))).hexdigest() == want[i][2]
    assert set(text("mix_sources")) == set(cut)
    lengths = {}
    for r, ids in zip(rows := d["mix_sources"].collect(), _whole_text_ids([r["text"] or "" for r in rows])):
        lengths.setdefault(r["doc_id"], []).append(len(ids) + 1)
    packed = d["best_fit_packing"]
    assert {r[0]: r[1] for r in packed.groupBy("doc_id").agg(F.sum("length")).collect()} == {k: sum(v) for k, v in lengths.items()}
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_pipeline_odd_rows(spark, odd_docs, no_docs, tmp_path):
    for docs, n in ((odd_docs, 5), (no_docs, 0)):
        sf = str(tmp_path / f"sf{n}")
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int").limit(1).write.parquet(f"{sf}/labels.parquet")
        out = corpus_pipeline.run(spark, sf)
        assert out.select("doc_id").distinct().count() >= n and (n or out.count() == 0)
