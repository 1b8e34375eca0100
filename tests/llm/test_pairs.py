"""N-gram join, substring dedup and vector dedup against brute force."""
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from blockhouse.llm import common, ngram_join, substring, vector_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute


def _docs(spark, name="documents"):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def test_hash_words_equals_split():
    text = b" a\tbb\x0bccc  \n\xc3\xa9\xe2\x80\xa8x A aB "
    s, e, h = common.hash_words(text)
    assert [text[a:b] for a, b in zip(s, e)] == text.split()
    low = common.hash_words(text.lower())[2]
    assert (common.hash_words(text, lower=True)[2] == low).all() and not (h == low).all()
    big = b"abc " * (3 * common.CHUNK_BYTES // 4) + b"x" * (5 * common.CHUNK_BYTES)
    s, e, h = common.hash_words(big)
    assert len(s) == len(big.split()) and len(set(h.tolist())) == 2


def test_ngram_join_matches_brute_force(spark):
    docs = _docs(spark)
    got = {r[0]: (r[1], r[2]) for r in ngram_join.similar_groups(docs).collect()}
    assert got == brute.components([tuple(r) for r in docs.select("doc_id", "text").collect()])


def _edited(rng, base, n):
    w = list(base)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 9)}"
    return w


def test_ngram_join_frequent_tokens_and_thresholds(spark, monkeypatch):
    """Everything frequent: pairs of sub-classes carry the join; sizes cross levels;
    keys of more nodes than a unit are split."""
    monkeypatch.setattr(ngram_join, "UNIT", 3)
    monkeypatch.setattr(ngram_join, "frequency_grades", lambda c, least: np.where(c >= 2, 1 + (c > 5), 0).astype(np.uint8))
    rng = random.Random(5)
    docs = []
    for length in (5, 6, 8, 9, 10, 20, 60, 70, 260, 300):
        base = [f"b{length}_{i}" for i in range(length)]
        for _ in range(14):
            docs.append((len(docs), " ".join(_edited(rng, base, rng.choice([0, 1, 1, 2, 3, 5])))))
    got = {r[0]: (r[1], r[2]) for r in ngram_join.similar_groups(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == brute.components(docs)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(4, 400), st.floats(0.8, 1.0), st.integers(0, 3))
def test_index_keys_share_a_key_at_the_threshold(seed, n, jaccard, kind):
    """Any two sets with Jaccard >= 0.8 have an index key in common."""
    rng = np.random.default_rng(seed)
    grades = [np.zeros(1 << 22, np.uint8), np.ones(1 << 22, np.uint8), rng.integers(0, 2, 1 << 22, dtype=np.uint8), rng.integers(0, 4, 1 << 22, dtype=np.uint8)][kind].astype(np.uint8)
    pool = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
    both = math.ceil(jaccard * n)
    extra = rng.integers(0, n - both + 1)
    a = np.sort(pool[:both + extra])
    b = np.sort(np.concatenate([pool[:both], pool[both + extra:n]]))
    if 100 * both < 80 * (len(a) + len(b) - both) or (len(a) == len(b) and (a == b).all()):
        return
    ka, kb = (set(np.concatenate(ngram_join.index_keys(s, grades, 80)).tolist()) for s in (a, b))
    assert ka & kb
    # and the sketch never drops the pair
    x, y = ngram_join.parity_sketch(a), ngram_join.parity_sketch(b)
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        else:
            y = y[:len(y) // 2] ^ y[len(y) // 2:]
    assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * both


def test_ngram_join_odd_rows(spark, odd_docs, no_docs):
    rows = sorted(tuple(r) for r in ngram_join.similar_groups(odd_docs).collect())
    want = brute.components([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert [r for r in rows if r[0] == 2] == [(2, 116, 1)] * 2
    assert {r[0]: r[1:] for r in rows} == want and want[10] == (116, 1) and want[8] == (1, 7) and want[4] == (0, 4)
    assert ngram_join.similar_groups(no_docs).collect() == []
    kept = ngram_join.one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r[0] for r in kept.collect()) == [1, 4, 5, 6, 7, 9, 11, 12]


def test_ngram_join_keeps_clean_rows_of_a_shared_id(spark):
    text = lambda w: " ".join(f"{w}{i}" for i in range(30))
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (3, text("c")), (3, None), (4, text("c")), (5, text("b"))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = ngram_join.one_of_each_group(df).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], rows[2], rows[3], rows[4]], key=str)


def test_connected_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(300, 299), (299, 300), (5, 5)]
    got = dict(tuple(r) for r in common.connected(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 7 for i in range(7, 30)) and got[300] == 299


def test_substring_matches_brute_force(spark):
    docs = _docs(spark)
    got = {r[0]: tuple(r)[1:] for r in substring.repeated_passages(docs).collect()}
    assert got == brute.repeats([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_difference_cover_covers():
    for d in range(substring.PERIOD):
        assert any((a + d) % substring.PERIOD in substring.COVER for a in substring.COVER)


def test_substring_inside_and_across(spark, odd_docs, no_docs):
    p = " ".join(f"p{i}" for i in range(25))
    docs = [(5, f"{p} mid {p} tail"), (3, f"head {p}"), (9, f"{p} x"), (4, " ".join(f"p{i}" for i in range(19))), (6, "q " * 45)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r[0]: tuple(r)[1:] for r in substring.repeated_passages(df).collect()}
    assert got == brute.repeats(docs) and got[5][1] == 50 and got[3][1] == 0 and got[4][1] == 0 and got[6][1] == 44
    odd = [tuple(r) for r in substring.repeated_passages(odd_docs).collect()]
    assert len(odd) == odd_docs.count() and len({r[1:] for r in odd if r[0] == 2}) == 1
    kept = substring.without_repeats(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    by = {r["doc_id"]: r for r in kept.collect()}
    assert by[2]["text"] == "" and by[12]["text"].startswith("Line one here.\nLine") and by[9]["row"] == "y" and by[4]["text"] == ""
    assert substring.repeated_passages(no_docs).collect() == [] and substring.without_repeats(no_docs).collect() == []


def test_substring_null_ids_stay(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "c d")], "doc_id bigint, text string")
    assert substring.repeated_passages(df).count() == 1 and substring.without_repeats(df).count() == 2


def _links(rows):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], dtype=float)
    n = np.sqrt((x * x).sum(1))
    near = (x @ x.T) / np.outer(n, n) >= 0.9
    u = brute.Union(ids)
    for i, j in zip(*np.nonzero(near)):
        u.join(ids[i], ids[j])
    return {ids[i]: (int(near[i].sum()) - 1, u.find(ids[i]), u.find(ids[i]) == ids[i]) for i in range(len(ids))}


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 16))
    rows = [(i, [float(v) for v in base[i % 30] + rng.normal(size=16) * rng.choice([0, 0.1, 0.3])]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    want = _links([(r[0], r[1]) for r in df.collect()])
    for lists in (1, 12):
        got = {r[0]: tuple(r)[1:] for r in vector_dedup.near_vectors(df, lists=lists).collect()}
        assert got == want  # recall and precision 1


def test_vectors_split_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 32)
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in np.ones(8) + rng.normal(size=8) * 0.2]) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {r[0]: tuple(r)[1:] for r in vector_dedup.near_vectors(df).collect()}
    assert got == _links([(r[0], r[1]) for r in df.collect()])


def test_vectors_of_low_rank_in_many_lists(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4096, 6)) @ rng.normal(size=(6, 64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<float>")
    got = {r[0]: tuple(r)[1:] for r in vector_dedup.near_vectors(df, lists=2048).collect()}
    assert got == _links([(r[0], r[1]) for r in df.collect()])


def test_probes_set_on_few_queries_keep_their_recall(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "QUERIES", 256)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4096, 6)) @ rng.normal(size=(6, 64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<float>")
    want = {i: r[0] for i, r in _links([(r[0], r[1]) for r in df.collect()]).items()}
    got = {r[0]: r[1] for r in vector_dedup.near_vectors(df, lists=512).collect()}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.98 * sum(want.values())
    assert {r[0]: r[1] for r in vector_dedup.near_vectors(df, lists=512, exact=True).collect()} == want


def test_margin_falls_back_to_the_exact_bound():
    assert vector_dedup.fitted_margin([], 0.4) == (0.4, None) and vector_dedup.fitted_margin([(0, 3, 9)], 0.4) == (0.4, None)
    assert vector_dedup.fitted_margin([(0, 2, 90), (1, 40, 50), (1, 1, 50)], 0.4) == (0.4, 0.5)  # the other half's margin misses half
    margin, recall = vector_dedup.fitted_margin([(0, 8, 90), (1, 4, 50), (1, 10, 50)], 0.4)
    assert recall == 1 and margin == pytest.approx(0.4 * 1.25 * 10 / vector_dedup.MARGINS)


def test_vectors_of_two_dimensions_link_within_their_own(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (np.ones(d) + rng.normal(size=d) * 0.4).tolist()) for i, d in enumerate([3] * 60 + [5] * 40 + [2])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = {**_links(rows[:60]), **_links(rows[60:100]), 100: (0, 100, True)}
    assert {r[0]: tuple(r)[1:] for r in vector_dedup.near_vectors(df).collect()} == want
    assert sum(want[i][0] for i in range(60)) and sum(want[i][0] for i in range(60, 100))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]),
            (8, [1.0, 0.0, 0.0]), (9, []), (None, [1.0, 0.0]), (10, [-1.0, 0.0]), (11, [0.0, 1e-30])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS node", "2 AS label")
    got = sorted(tuple(r) for r in vector_dedup.near_vectors(df).collect())
    assert got[:3] == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)]
    assert all(r[1:] == (0, r[0], True) for r in got[3:]) and len(got) == 12
    assert vector_dedup.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("cosine", [0.9])
def test_vectors_of_the_table(spark, cosine):
    df = _docs(spark, "embeddings")
    got = {r[0]: tuple(r)[1:] for r in vector_dedup.near_vectors(df, cosine).collect()}
    assert got == _links([(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()])
