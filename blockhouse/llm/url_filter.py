"""URL filters: a rule list as a sorted array of 64-bit digests.

A rule is a host, a path and a verdict.  It fits its host and all subdomains if
the url's path starts with its path; the longest rule (host and path together;
then the longer host) wins, and a url that no rule fits is allowed.

``rule_index`` keys every rule by the xxhash of host + path, sorts the digests
and lays the strings beside them, all by Spark, and writes the parts as Parquet
into the shared folder.  Spark ships the parts to every executor
(``SparkContext.addFile``: a new executor fetches them again); its first Python
worker lays them out as one Arrow file beside them, and all workers map that
file, digests and strings, into memory.  A batch asks for every suffix of its distinct hosts at
once by binary search, then for host and path at the path lengths that occur
with the host; a hit counts only if the stored string is the same, so colliding
digests can't give a wrong verdict.

Lists above ``SHIPPED_BYTES`` (their size is measured) are not shipped: the
distinct probes are joined with the rules by digest and confirmed by string.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule and is allowed; hosts keep ports and user names as they stand; only
A-Z are lower-cased; a rule path is compared as it stands, so ``net/`` does not
fit a url without a path; rules with a null host, a path that doesn't begin with
``/`` or another verdict than allow or block fit nothing; of equal rules block
wins; repeated rows stay; a null id stays null; empty tables are empty.
"""
from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import stored

SEED = 42                     # Spark's xxhash64 starts from this value
SHIPPED_BYTES = 64 << 20
DEFAULT = "allow"
RULES = "host string, path string, verdict string"
_JUDGED = "page_id bigint, host string, path string, rule string, verdict string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null or without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _listed(rules: DataFrame) -> DataFrame:
    """Distinct rules that can fit something: key (host + path), host, verdict."""
    kept = rules.select(F.translate(F.col("host").cast("string"), _UPPER, _LOWER).alias("host"), F.col("path").cast("string").alias("path"),
                        F.col("verdict").cast("string").alias("verdict")).where("host IS NOT NULL AND startswith(path, '/') AND verdict IN ('block', 'allow')")
    return (kept.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .select(F.concat("host", "path").alias("key"), F.length("host").alias("host_chars"), F.length("path").alias("path_chars"), "host", "verdict"))


def rule_index(rules: DataFrame) -> DataFrame:
    """digest, key, kind, verdict, path_lengths, sorted by digest: one row per rule and
    one per host (with the distinct lengths of its rules' paths, in characters)."""
    rows = stored(_listed(rules), "url-rules")
    hosts = rows.groupBy("host").agg(F.sort_array(F.collect_set("path_chars")).alias("path_lengths"))
    both = (rows.select("key", F.lit("rule").alias("kind"), "verdict", F.array().cast("array<int>").alias("path_lengths"))
            .unionByName(hosts.select(F.col("host").alias("key"), F.lit("host").alias("kind"), F.lit(None).cast("string").alias("verdict"), "path_lengths")))
    return stored(both.withColumn("digest", F.xxhash64("key")).repartitionByRange("digest").sortWithinPartitions("digest", "key", "kind"), "url-index")


class DigestArray:
    """Sorted digests with their strings, verdicts and lengths, mapped from one file
    that the first worker of an executor writes out of the shipped parts."""

    def __init__(self, parts: list[str], array_file: str):
        if not os.path.exists(array_file):
            t = pa.concat_tables([pq.read_table(f) for f in parts])
            t = t.take(pc.sort_indices(t, sort_keys=[("digest", "ascending")])).combine_chunks()
            own = f"{array_file}.{uuid.uuid4().hex}"
            with pa.OSFile(own, "wb") as f, pa.ipc.new_file(f, t.schema) as w:
                w.write_table(t, max_chunksize=max(t.num_rows, 1))
            os.replace(own, array_file)  # whole or absent for the other workers
        t = pa.ipc.open_file(pa.memory_map(array_file)).read_all()
        self.key, self.kind, self.verdict, self.lengths, digest = (
            t.column(c).combine_chunks() for c in ("key", "kind", "verdict", "path_lengths", "digest"))
        self.digest = digest.to_numpy(zero_copy_only=t.num_rows > 0)

    def find(self, keys: list[str], kind: str) -> np.ndarray:
        """Row of every key of that kind, -1 without one."""
        want = np.fromiter((xxhash.xxh64_intdigest(k.encode(), seed=SEED) for k in keys), np.uint64, len(keys)).view(np.int64)
        out = np.full(len(keys), -1, np.int64)
        if not len(self.digest) or not keys:
            return out
        at = np.searchsorted(self.digest, want)
        for i in np.flatnonzero(self.digest[np.minimum(at, len(self.digest) - 1)] == want):
            row = int(at[i])
            while row < len(self.digest) and self.digest[row] == want[i]:  # equal digests stand together
                if self.key[row].as_py() == keys[i] and self.kind[row].as_py() == kind:
                    out[i] = row
                    break
                row += 1
        return out


_arrays: dict[str, DigestArray] = {}


def _shipped(names: list[str]) -> DigestArray:
    tag = names[0]
    if tag not in _arrays:
        _arrays.clear()
        _arrays[tag] = DigestArray([SparkFiles.get(n) for n in names], SparkFiles.get(f"{tag}.arrow"))
    return _arrays[tag]


def suffixes(host: str) -> list[str]:
    """The host and what follows each of its dots."""
    out = [host]
    while "." in host:
        host = host.split(".", 1)[1]
        out.append(host)
    return out


def best_rules(array: DigestArray, urls: list[tuple[str, str]]) -> dict[tuple[str, str], int]:
    """Row of the rule that wins, for every distinct (host, path) that has one."""
    asked = list(dict.fromkeys(s for host, _ in urls for s in suffixes(host)))
    lengths = {s: array.lengths[int(r)].as_py() for s, r in zip(asked, array.find(asked, "host")) if r >= 0}
    probes = [(u, s, n) for u in urls for s in suffixes(u[0]) if s in lengths for n in lengths[s] if n <= len(u[1])]
    keys = list(dict.fromkeys(s + u[1][:n] for u, s, n in probes))
    rows = {k: int(r) for k, r in zip(keys, array.find(keys, "rule")) if r >= 0}
    best: dict = {}
    for u, s, n in probes:
        row, rank = rows.get(s + u[1][:n]), (len(s) + n, len(s))
        if row is not None and (u not in best or rank > best[u][0]):
            best[u] = rank, row
    return {u: row for u, (_, row) in best.items()}


def _judge(names: list[str]):
    def run(batches):
        array = _shipped(names)
        for batch in batches:
            urls = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            best = best_rules(array, list(dict.fromkeys(urls)))
            rows = pa.array([best.get(u) for u in urls], pa.int64())
            yield pa.record_batch([*batch.columns, array.key.take(rows), array.verdict.take(rows).fill_null(DEFAULT)],
                                  names=["page_id", "host", "path", "rule", "verdict"])
    return run


def _judge_joined(urls: DataFrame, index: DataFrame) -> DataFrame:
    """The same by joins on digests, for lists too long to ship."""
    distinct = urls.select("host", "path").distinct()
    rules, hosts = index.where("kind = 'rule'"), index.where("kind = 'host'")
    labels = F.split("host", r"\.", -1)
    asked = distinct.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                                                                  lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("s"))
    # hosts are few against urls: the lengths of a suffix are looked up once per distinct suffix
    known = asked.select("s").distinct().join(hosts.select("digest", "key", "path_lengths"), (F.xxhash64("s") == F.col("digest")) & (F.col("s") == F.col("key"))).select("s", "path_lengths")
    cut = (asked.join(known, "s").select("host", "path", "s", F.explode("path_lengths").alias("n")).where(F.col("n") <= F.length("path"))
           .select("host", "path", "s", F.concat("s", F.expr("substring(path, 1, n)")).alias("probe")))
    hit = cut.join(rules.select("digest", "key", "verdict"), (F.xxhash64("probe") == F.col("digest")) & (F.col("probe") == F.col("key")))
    best = hit.groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), F.length("s").alias("h"), F.col("key").alias("rule"), F.col("verdict").alias("v"))).alias("b"))
    best = best.select("host", "path", "b.rule", F.col("b.v").alias("verdict"))
    return urls.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, shipped_bytes: int = SHIPPED_BYTES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``."""
    spark: SparkSession = pages.sparkSession
    host, path = url_parts(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    index = rule_index(rules)
    size = index.agg(F.sum(F.octet_length("key") + 32 + 4 * F.size("path_lengths"))).first()[0] or 0
    if size > shipped_bytes:
        return _judge_joined(urls, index)
    files = sorted(index.inputFiles())
    if not files:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT).alias("verdict"))
    for f in files:
        spark.sparkContext.addFile(f)
    return urls.mapInArrow(_judge([os.path.basename(f) for f in files]), _JUDGED)
