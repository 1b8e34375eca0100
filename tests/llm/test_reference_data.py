"""Token alignment, centroid clusters and url filters against brute force."""
import bisect
import hashlib
import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from blockhouse.llm import alignment, centroids, url_filter
from blockhouse.llm.queries import Q, URL_RULES
from blockhouse.llm.tokens import _byte_letters, default_vocabulary
from tests.conftest import SF_SMALL


# ---- alignment -----------------------------------------------------------------

class Plain:
    """Whole-text encoders and per-document lists of (token id, end offset)."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(default_vocabulary())
        self.tok.encode_special_tokens = True
        self.sp = sentencepiece.SentencePieceProcessor(model_file=alignment.default_model())
        letters = _byte_letters()
        with open(default_vocabulary(), encoding="utf-8") as f:
            self.entry = {i: bytes(letters[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items() if all(c in letters for c in t)}

    def tokens(self, text):
        a = [(i, self.entry[i]) for i in self.tok.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.sp.encode(text):
            name = self.sp.id_to_piece(i)
            b.append((i, bytes([int(name[3:5], 16)]) if self.sp.is_byte(i) else name.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return [], []
        return a, b

    def groups(self, text):
        a, b = self.tokens(text)
        ends = []
        for side in (a, b):
            at, e = 0, {}
            for i, x in side:
                at += len(x)
                e[at] = i
            ends.append(e)
        common = sorted(set(ends[0]) & set(ends[1]))
        out = [([], []) for _ in common]
        for side, e in enumerate(ends):
            for x, i in e.items():
                out[bisect.bisect_left(common, x)][side].append(i)
        return len(a), len(b), out, [(ends[0][e], ends[1][e]) for e in common]


def _plain_digests(rows):
    p = Plain()
    docs = [(i, *p.groups(t or "")) for i, t in rows]
    count = Counter(x for d in docs for x in d[4])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(n, top.get(b, 0))
    out = []
    for i, na, nb, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, na, nb, len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if na else ""))
    return out


ODD_TEXTS = [None, "", " ", "  ", "a  b", "a \n b", "\n a", " x", "x ", "▁", "a▁b c", "it's <|endoftext|> <s> <0x41> 12", "é\U0001f600 中文 naïve", "x\x00y", "a\t b  c  d",
             "x \x85 y\x1c z", "one two", "one two", "ﬁ ½ \xa0 z", "word " * 3000 + "end", "<unk></s>"]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)))
def test_common_ends(a, b):
    x, y = (np.array(sorted(s), np.int64) for s in (a, b))
    i, j = alignment.common_ends(x, y)
    assert x[i].tolist() == y[j].tolist() == sorted(a & b)


def test_common_ends_long_gaps():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 10 ** 7, 500))
    b = np.unique(np.concatenate([rng.integers(0, 10 ** 7, 200_000), a[::3]]))
    i, j = alignment.common_ends(b, a)
    assert b[i].tolist() == a[j].tolist() == np.intersect1d(a, b).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "Bc", "hello", "1", "!", "'s", "é", "\x1c", ".", "▁", "\xa0", "<s>"]), max_size=25))
def test_pieces_equal_whole_text(parts):
    text = "".join(parts)
    p, cache = _PLAIN(), alignment._pieces(default_vocabulary(), alignment.default_model())
    rows = cache.rows(alignment.split_pieces(text) if text else [])
    got = [[cache.ids[s][cache.first[s][r]:cache.first[s][r] + cache.count[s][r]].tolist() for r in rows] for s in (0, 1)] if cache.ok[rows].all() else [[], []]
    assert [sum(x, []) for x in got] == [[i for i, _ in side] for side in p.tokens(text)]


def _PLAIN(cache=[]):  # noqa: B006
    return cache[0] if cache else cache.append(Plain()) or cache[0]


@pytest.mark.parametrize("head", [alignment.HEAD, 40, 0])
def test_alignment_matches_brute_force(spark, head, monkeypatch):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "one two three"), (3, "again")]
    rows += [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id") + 1000, "text").limit(60).collect()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS row", "1 AS n_a", "2 AS key")
    got = [tuple(r) for r in alignment.alignment_digests(df.repartition(3), head_pairs=head).collect()]
    assert sorted(got, key=str) == sorted(_plain_digests(rows), key=str)


def test_alignment_whole_table(spark, no_docs):
    out = Q["op11_token_alignment"](spark, SF_SMALL)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect())) == sorted(_plain_digests(rows))
    assert alignment.alignment_digests(no_docs).collect() == [] and alignment.aligned_groups(no_docs).collect() == []


def test_aligned_groups_and_bytes_that_are_no_text(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_TOKENS", 7)
    df = spark.createDataFrame([(1, "unbelievably naïve tokens"), (2, None)], "doc_id bigint, text string")
    df = df.union(spark.sql("SELECT 3L, CAST(X'61FF62' AS STRING)"))
    p = Plain()
    for r in alignment.aligned_groups(df).collect():
        na, nb, groups, _ = p.groups("unbelievably naïve tokens" if r["doc_id"] == 1 else "")
        assert (r["a_sizes"], r["b_sizes"]) == ([len(a) for a, _ in groups], [len(b) for _, b in groups])
        assert (r["a_ids"], r["b_ids"]) == (sum((a for a, _ in groups), []), sum((b for _, b in groups), []))


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_PIECES", 5)
    cache = alignment.Pieces(default_vocabulary(), alignment.default_model())
    for k in range(6):
        rows = cache.rows([f"w{k}", f"v{k}", "same"])
        assert len(rows) == 3 and len(cache.at) <= 5


# ---- clusters ------------------------------------------------------------------

def _plain_clusters(rows, k=16, rounds=3, dims=64, seed=1):
    kept = [(i, [math.floor(64 * x) if abs(x) < 1e300 else int(x) * 64 for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    c = [list(v) for _, v in sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]]
    for left in range(rounds, -1, -1):
        near = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, x)) for x in c]
            near.append((d.index(min(d)), min(d)))
        if left:
            for j in range(len(c)):
                mine = [v for (_, v), (n, _) in zip(kept, near) if n == j]
                if mine:
                    c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = Counter()
    for j, d in near if kept else []:
        own[j] += d
    long = lambda x: x if x < 1 << 63 else None
    return [(i, j, long(d), long(own[j]), long(sum(own.values())), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for (i, _), (j, d) in zip(kept, near)]


def _vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")


def test_clusters_odd_vectors(spark):
    rng = random.Random(4)
    v = lambda s=0.2, n=64: [float(np.float32(rng.gauss(0, s))) for _ in range(n)]
    one = v()
    rows = [(i, v()) for i in range(60)] + [(i, one) for i in range(100, 140)] + [(7, v()), (7, one), (None, v()), (None, one)]
    rows += [(200, None), (201, []), (202, v(n=63)), (203, [None] + v(n=63)), (204, [math.nan] + v(n=63)), (205, [math.inf] + v(n=63)), (206, [0.0] * 64), (207, v(40.0))]
    df = _vectors(spark, rows).selectExpr("*", "1 AS n", "'x' AS ids", "2 AS cluster").repartition(3)
    got = [tuple(r) for r in centroids.cluster_vectors(df)[0].collect()]
    assert sorted(got, key=str) == sorted(_plain_clusters(rows), key=str) and len(got) == 106


@pytest.mark.parametrize("width", [1, 2, 5, 64])
def test_clusters_wide_values_and_widths(spark, width):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) * 10.0 ** rng.choice([0, 3, 9, 12]) for _ in range(64)]) for i in range(50)] + [(60, [3.5e30, -1e300] + [0.25] * 62), (61, [1.0] * 64)]
    got = [tuple(r) for r in centroids.cluster_vectors(_vectors(spark, rows, "double"), width=width)[0].collect()]
    assert sorted(got) == sorted(_plain_clusters(rows)) if all(None not in g for g in got) else sorted(got, key=str) == sorted(_plain_clusters(rows), key=str)


def test_clusters_few_and_none(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert sorted(map(tuple, centroids.cluster_vectors(_vectors(spark, rows))[0].collect())) == sorted(_plain_clusters(rows))
    assert centroids.cluster_vectors(_vectors(spark, rows).limit(0))[0].collect() == []


# ---- urls ----------------------------------------------------------------------

def _plain_judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


URLS = [None, "", "no scheme", "http://a.net/x", "https://EXAMPLE.net/en/1?q#f", "https://www.example.net/EN/", "http://net", "http://net/", "http://planet/", "http://x.net?q=/en/",
        "http://example.com/de/", "http://example.com/d", "http://org/fr/#://x.net/", "http://a.b.c.org/fr/x/y", "http://user@example.net:80/en/", "http://exämple.Net/ü", "ftp://.net/", "http://net./",
        "http://example.net/en/", "http://example.net/en/", "://net/x", "http://a.net/\nline", "x" * 5000 + "://a.net/" + "y" * 5000]


@pytest.mark.parametrize("shipped", [url_filter.SHIPPED_BYTES, 0])
def test_urls_match_brute_force(spark, shipped):
    rules = URL_RULES + [("a.net", "/x", "allow"), ("b.c.org", "/fr/x/", "block"), ("c.org", "/fr/x/y", "allow"), ("a.net", "/x", "block")]
    bad = [(None, "/", "block"), ("org", None, "block"), ("org", "fr", "block"), ("com", "/", "maybe")]
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[3]), (3, URLS[4])]
    df = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "'x' AS host", "1 AS rule", "2 AS digest")
    got = url_filter.judge_urls(df, spark.createDataFrame(rules + bad, url_filter.RULES), shipped_bytes=shipped)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((i, *_plain_judge(u, rules)) for i, u in rows), key=str)
    none = url_filter.judge_urls(df, spark.createDataFrame([], url_filter.RULES), shipped_bytes=shipped)
    assert {r["verdict"] for r in none.collect()} == {"allow"}
    assert url_filter.judge_urls(df.limit(0), spark.createDataFrame(rules, url_filter.RULES), shipped_bytes=shipped).collect() == []


def test_urls_long_list_and_collisions(spark, monkeypatch, tmp_path):
    """Many rules; with every digest equal, the stored strings decide."""
    rng = random.Random(6)
    rules = [(f"h{rng.randrange(300)}.{rng.choice(['net', 'org'])}", "/" + "abc"[:rng.randrange(4)], rng.choice(["allow", "block"])) for _ in range(2000)]
    rules = [(h, p, v) for (h, p), v in {(h, p): v for h, p, v in rules}.items()]
    urls = [(i, f"http://{rng.choice(['', 'www.', 'x.y.'])}h{rng.randrange(330)}.net/{'abcd'[:rng.randrange(5)]}") for i in range(1500)]
    want = sorted((i, *_plain_judge(u, rules)) for i, u in urls)
    df = spark.createDataFrame(urls, "page_id bigint, url string")
    assert sorted(map(tuple, url_filter.judge_urls(df, spark.createDataFrame(rules, url_filter.RULES)).collect()), key=str) == sorted(want, key=str)
    import pyarrow as pa
    import pyarrow.parquet as pq
    few = rules[:12]
    rows = [(0, h + p, "rule", v, []) for h, p, v in few] + [(0, h, "host", None, sorted({len(p) for g, p, _ in few if g == h})) for h in {h for h, _, _ in few}]
    t = pa.table({n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate([
        ("digest", pa.int64()), ("key", pa.string()), ("kind", pa.string()), ("verdict", pa.string()), ("path_lengths", pa.list_(pa.int32()))])})
    pq.write_table(t, tmp_path / "p.parquet")
    array = url_filter.DigestArray([str(tmp_path / "p.parquet")], str(tmp_path / "p.arrow"))
    assert isinstance(array.digest, np.ndarray) and not array.digest.flags.owndata
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda *a, **k: 0)
    asked = list(dict.fromkeys(_plain_judge(u, [])[:2] for _, u in urls))
    best = url_filter.best_rules(array, asked)
    assert {u: array.key[r].as_py() for u, r in best.items()} == {u: w for u in asked if (w := _plain_judge(f"x://{u[0]}{u[1]}", few)[2])}
