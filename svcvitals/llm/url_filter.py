"""URL filters on a sorted digest array.

Rules (host, path prefix, verdict) are keyed by the 64-bit xxhash of host + path. The
digests lie sorted in one file, which tasks memory-map; each URL's possible rules (every
suffix of its host by labels, times every path-prefix length that occurs among the rules)
are hashed, probed by vectorised binary search, and confirmed against the stored strings,
so a digest collision never decides. The longest confirmed rule wins.

The file goes to the workers with ``SparkContext.addFile``; ``MAX_INDEX_BYTES`` bounds it.
A longer rule list, or one given as a DataFrame, is joined instead: the same digests become
join keys, and Spark shuffles both sides (:func:`judge_by_join`). Results do not depend on
the way: rules are numbered, and of those with one host and path the last one holds.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F

from svcvitals.llm.columns import pick
from svcvitals.llm.files import write_bytes
from svcvitals.llm.tasks import frugal
from svcvitals.session import shared_dir

#: The rules in use: (host, path prefix, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MAX_INDEX_BYTES = 256 << 20
MAGIC = b"URLIDX01"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without '://'."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def pack_rules(rules) -> bytes:
    """The index file: header, digests (sorted), verdicts, string offsets, strings.

    Of rules with the same host and path the last one holds.
    """
    rules = list({(h, p): v for h, p, v in rules}.items())
    keys = [(h + p).encode() for (h, p), _ in rules]
    digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype="<u8")
    order = np.argsort(digests, kind="stable")
    offsets = np.concatenate([[0], np.cumsum([len(keys[i]) for i in order])]).astype("<u8")
    verdicts = np.array([rules[i][1] == "allow" for i in order], dtype="u1")
    hosts = np.array([len(rules[i][0][0].encode()) for i in order], dtype="<u4")
    lengths = np.array(sorted({len(p.encode()) for (_, p), _ in rules}), dtype="<u4")
    head = MAGIC + struct.pack("<QQ", len(keys), len(lengths))
    return (head + digests[order].tobytes() + offsets.tobytes() + hosts.tobytes() + lengths.tobytes() + verdicts.tobytes()
            + b"".join(keys[i] for i in order))


class RuleIndex:
    """The memory-mapped index file."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype="u1", mode="r")
        if raw[:8].tobytes() != MAGIC:
            raise ValueError(f"not a rule index: {path}")
        n, n_lengths = struct.unpack("<QQ", raw[8:24].tobytes())
        at = 24

        def take(dtype, count):
            nonlocal at
            size = np.dtype(dtype).itemsize * count
            at += size
            return raw[at - size:at].view(dtype)

        self.digests, self.offsets, self.hosts = take("<u8", n), take("<u8", n + 1), take("<u4", n)
        self.lengths, self.allow, self.strings = take("<u4", n_lengths), take("u1", n), raw[at:]

    def probe(self, digests: np.ndarray, keys: list[bytes], hosts: list[int]) -> np.ndarray:
        """Index of the rule equal to each key (host of hosts[i] bytes + path), or -1."""
        found = np.full(len(keys), -1, dtype=np.int64)
        if len(self.digests) == 0 or not keys:
            return found
        at = np.searchsorted(self.digests, digests)
        active = np.flatnonzero(at < len(self.digests))
        while len(active):  # equal digests lie side by side
            active = active[self.digests[at[active]] == digests[active]]
            for i in active:
                k = at[i]
                if found[i] < 0 and self.hosts[k] == hosts[i] and self.strings[self.offsets[k]:self.offsets[k + 1]].tobytes() == keys[i]:
                    found[i] = k
            at[active] += 1
            active = active[(at[active] < len(self.digests)) & (found[active] < 0)]
        return found

    def text(self, k: int) -> str:
        return self.strings[self.offsets[k]:self.offsets[k + 1]].tobytes().decode()


def candidate_keys(host: bytes, path: bytes, lengths) -> list[tuple[bytes, int]]:
    """Every (host suffix + path prefix, suffix length) that could be a rule of this URL."""
    labels = host.split(b".")
    suffixes = [b".".join(labels[i:]) for i in range(len(labels))]
    return [(s + path[:n], len(s)) for n in lengths if n <= len(path) for s in suffixes]


def _judge_batch(index: RuleIndex, hosts: list[str], paths: list[str]) -> tuple[list, list]:
    owner, keys, sizes, seen = [], [], [], {}
    lengths = [int(n) for n in index.lengths]
    for i, (h, p) in enumerate(zip(hosts, paths)):
        hb, pb = h.encode(), p.encode()
        for key, n in candidate_keys(hb, pb, lengths) if hb else ():
            owner.append(i)
            keys.append(key)
            sizes.append(n)
    digests = np.fromiter((seen.get(k) or seen.setdefault(k, xxhash.xxh64_intdigest(k)) for k in keys), dtype="<u8", count=len(keys))
    hit = index.probe(digests, keys, sizes)
    rule, verdict, best = [None] * len(hosts), ["allow"] * len(hosts), [(-1, -1)] * len(hosts)
    for j in np.flatnonzero(hit >= 0):
        i, k = owner[j], int(hit[j])
        if (length := (len(keys[j]), sizes[j])) > best[i]:
            best[i], rule[i], verdict[i] = length, index.text(k), "allow" if index.allow[k] else "block"
    return rule, verdict


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, one row per input row (ties and repeats kept).

    Without a rule the verdict is allow and rule is null. A null URL, or one without
    '://', has empty host and path. A rule fits its host and all subdomains when the
    URL's path starts with the rule's path; of those that fit, the longest (host and path)
    wins. Of rules with one host and path the last holds. Empty tables and an empty rule list
    give their plain results. ``rules``: (host, path, verdict) in order, or a DataFrame of
    host, path, verdict and their number ``nth`` (then nothing passes the driver).
    """
    spark = pages.sparkSession
    if isinstance(rules, DataFrame):
        return judge_by_join(pages, rules, id_col, url_col)
    packed = pack_rules(rules)
    if len(packed) > MAX_INDEX_BYTES:
        numbered = [(*rule, nth) for nth, rule in enumerate(rules)]
        return judge_by_join(pages, spark.createDataFrame(numbered, "host string, path string, verdict string, nth long"), id_col, url_col)
    folder = shared_dir(spark, "url-rules")
    name = f"{folder.rsplit('/', 1)[1]}.idx"
    write_bytes(f"{folder}/{name}", packed)
    spark.sparkContext.addFile(f"{folder}/{name}")

    def run(batches):
        index = RuleIndex(SparkFiles.get(name))
        for b in batches:
            rule, verdict = _judge_batch(index, b.column("host").to_pylist(), b.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("host"), b.column("path"),
                                              pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=["page_id", "host", "path", "rule", "verdict"])

    src = pick(pages, page_id=id_col, url=url_col)
    host, path = url_parts(F.col("url"))
    kind = src.schema["page_id"].dataType.simpleString()
    return src.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(
        frugal(run), f"page_id {kind}, host string, path string, rule string, verdict string")


def judge_by_join(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same result for rule lists beyond the bound: digests as join keys.

    rules: host, path, verdict, nth; of those with one host and path the one with the
    greatest nth holds (of equal nth, the greatest verdict). Only distinct (host, path) pairs are probed, so a hot host
    costs what its distinct paths cost.
    """
    src = pick(pages, page_id=id_col, url=url_col)
    host, path = url_parts(F.col("url"))
    urls = src.select("page_id", host.alias("host"), path.alias("path"))
    own = pick(rules, r_host="host", r_path="path", verdict="verdict", nth="nth").groupBy("r_host", "r_path").agg(
        F.max(F.struct("nth", "verdict"))["verdict"].alias("r_verdict"))
    own = own.withColumn("digest", F.xxhash64(F.concat("r_host", "r_path")))
    lengths = [r[0] for r in own.select(F.length("r_path").alias("n")).distinct().orderBy("n").collect()]
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = urls.filter("host <> ''").select("host", "path").distinct().select(
        "host", "path", F.explode(suffixes).alias("suffix")).select(
        "host", "path", "suffix", F.explode(F.array(*[F.lit(n) for n in lengths] or [F.lit(None).cast("int")])).alias("n")).filter(
        F.length("path") >= F.col("n")).withColumn("prefix", F.expr("substring(path, 1, n)"))
    probes = probes.withColumn("digest", F.xxhash64(F.concat("suffix", "prefix")))
    hits = probes.join(own, "digest").filter("suffix = r_host AND prefix = r_path").groupBy("host", "path").agg(
        F.max(F.struct(F.octet_length(F.concat("r_host", "r_path")).alias("n"), F.octet_length("r_host").alias("m"),
                       F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best"))
    return urls.join(hits, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))


__all__ = ["RULES", "MAX_INDEX_BYTES", "url_parts", "pack_rules", "RuleIndex", "candidate_keys", "judge", "judge_by_join"]
