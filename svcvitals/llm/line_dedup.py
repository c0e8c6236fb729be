"""Reversible line dedup: sharded cuckoo filters before exact reference-count tables.

A store keeps, as Parquet segments in a shared folder,

- ``refs``     rows per (line key, document): shard, key, doc_id;
- ``counts``   rows per key and segment: shard, key, n_docs, keeper (smallest document
               holding it); a key's segments add up;
- ``filters``  one cuckoo filter per shard over the keys of ``counts``; its newest counts.

A key is the 128-bit digest of a normalised line; its first bytes name the shard. Inserting
documents reduces their lines to one row per key (map-side combine, so a hot line costs one
row per task) and probes the shard's filter. Keys that it cannot hold are new: their counts
are appended and nothing is looked up. Only documents of the other keys are compared with
the exact references, to leave out what the store has already. An insertion appends segments
of its own rows and rewrites the filters of the shards that it touches; segments written before stay
as they are. A deletion takes references away, recounts, takes keys without references out
of the filter again, and rewrites only the shards in which the documents have lines. After
an insertion and a deletion of the same documents the store answers as before. The filter
never decides; the exact tables do. ``compact`` makes one segment of many.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from svcvitals.llm.columns import pick
from svcvitals.llm.tasks import frugal
from svcvitals.session import shared_dir

STRIP = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
KEYS_PER_SHARD = 20_000
SLOTS = 4
#: A new filter has room for so many times its keys.
ROOM = 2
_COUNTS = "shard int, key binary, n_docs long, keeper long"


class CuckooFilter:
    """Approximate set with deletion: 16-bit fingerprints in buckets of four, two buckets
    per key. ``table`` is a (buckets, 4) array, 0 for an empty slot."""

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, len(table) - 1

    @classmethod
    def sized(cls, n_keys: int) -> "CuckooFilter":
        """Room for n_keys at most 80 % full."""
        buckets = 1 << max(3, int(np.ceil(np.log2(max(1, n_keys) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        return cls(np.frombuffer(data, "<u2").reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of keys given as (n, 2) unsigned 64-bit halves."""
        mark = (keys[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        first = ((keys[:, 1] >> np.uint64(16)) & np.uint64(self.mask)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995) & self.mask)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        mark, a, b = self._places(keys)
        return (self.table[a] == mark[:, None]).any(axis=1) | (self.table[b] == mark[:, None]).any(axis=1)

    def _put(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets; True where there was one."""
        order = np.argsort(bucket, kind="stable")
        sorted_buckets = bucket[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_buckets, sorted_buckets)
        free = self.table[sorted_buckets] == 0
        fits = rank < free.sum(axis=1)
        slot = np.argmax(free & (np.cumsum(free, axis=1) == rank[:, None] + 1), axis=1)
        self.table[sorted_buckets[fits], slot[fits]] = mark[order][fits]
        done = np.zeros(len(mark), dtype=bool)
        done[order[fits]] = True
        return done

    def insert(self, keys: np.ndarray) -> bool:
        """Add distinct keys; False if some found no place (then build a larger filter)."""
        mark, a, b = self._places(keys)
        left = ~self._put(mark, a)
        mark, bucket = mark[left], b[left]
        for turn in range(500):
            left = ~self._put(mark, bucket)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return True
            # one eviction per bucket and turn: swap with an occupant, which moves to its other bucket
            _, at = np.unique(bucket, return_index=True)
            slot = (turn + bucket[at]) % SLOTS
            out = self.table[bucket[at], slot]
            self.table[bucket[at], slot] = mark[at]
            mark[at], bucket[at] = out, self._other(bucket[at], out)
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Take out one fingerprint of each key; the keys must have been inserted."""
        for mark, a, b in zip(*self._places(keys)):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


def line_key(line: str) -> bytes | None:
    """Digest of the normalised line; None for lines too short to count."""
    line = line.strip(STRIP)
    if len(line) < MIN_CHARS:
        return None
    return hashlib.blake2b(line.encode().lower(), digest_size=16).digest()


def _halves(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(len(keys), 2)


def _refs(batches):
    """Distinct line keys of each row with their document."""
    for batch in batches:
        keys, docs = [], []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            own = {line_key(x) for x in (text or "").split("\n")} - {None}
            keys += own
            docs += [doc] * len(own)
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "doc_id": pa.array(docs, pa.int64())})


def _probe_and_add(key, new, filters):
    """cogroup by shard: which keys may be known; the shard's filter with the new ones."""
    shard = key[0].as_py()
    keys = new.column("key").to_pylist()
    halves = _halves(keys)
    had = filters.column("filter").to_pylist()
    n_before = filters.column("n_keys").to_pylist()[0] if had else 0
    if not keys:  # a shard that the insertion does not touch
        return pa.table({name: [] for name in _PROBED_ARROW.names}, schema=_PROBED_ARROW)
    index = CuckooFilter.load(had[0]) if had else CuckooFilter.sized(ROOM * max(len(keys), 16))
    maybe = index.may_hold(halves) if had else np.zeros(len(keys), dtype=bool)
    added = (~maybe).sum()
    full = n_before + added > index.table.size * 0.9 or not index.insert(halves[~maybe])
    rows = {"shard": [shard] * len(keys), "key": keys, "n_docs": new.column("n_docs").to_pylist(), "keeper": new.column("keeper").to_pylist(),
            "maybe": maybe.tolist(), "filter": [None] * len(keys), "n_keys": [None] * len(keys), "full": [None] * len(keys)}
    for name, value in (("shard", shard), ("key", None), ("n_docs", None), ("keeper", None), ("maybe", None),
                        ("filter", index.dump()), ("n_keys", int(n_before + added)), ("full", bool(full))):
        rows[name].append(value)
    return pa.table(rows, schema=_PROBED_ARROW)


_PROBED = "shard int, key binary, n_docs long, keeper long, maybe boolean, filter binary, n_keys long, full boolean"
_PROBED_ARROW = pa.schema([("shard", pa.int32()), ("key", pa.binary()), ("n_docs", pa.int64()), ("keeper", pa.int64()),
                           ("maybe", pa.bool_()), ("filter", pa.binary()), ("n_keys", pa.int64()), ("full", pa.bool_())])
_FILTERS = "shard int, filter binary, n_keys long"
_FILTERS_ARROW = pa.schema([("shard", pa.int32()), ("filter", pa.binary()), ("n_keys", pa.int64())])


_ADDED = "shard int, filter binary, n_keys long, full boolean"
_ADDED_ARROW = pa.schema([("shard", pa.int32()), ("filter", pa.binary()), ("n_keys", pa.int64()), ("full", pa.bool_())])


def _add(key, more, filters):
    had, keys = filters.to_pylist(), more.column("key").to_pylist()
    index = CuckooFilter.load(had[0]["filter"])
    full = had[0]["full"] or not index.insert(_halves(keys))
    return pa.table({"shard": [key[0].as_py()], "filter": [index.dump()], "n_keys": [had[0]["n_keys"] + len(keys)], "full": [full]}, schema=_ADDED_ARROW)


def _build(key, counts):
    """A shard's filter from its exact keys."""
    keys = counts.column("key").to_pylist()
    room = ROOM * len(keys)
    while not (index := CuckooFilter.sized(room)).insert(_halves(keys)):
        room *= 2
    return pa.table({"shard": [key[0].as_py()], "filter": [index.dump()], "n_keys": [len(keys)]}, schema=_FILTERS_ARROW)


def _take_out(key, gone, filters):
    shard, had = key[0].as_py(), filters.column("filter").to_pylist()
    if not had:
        return pa.table({"shard": [], "filter": [], "n_keys": []}, schema=_FILTERS_ARROW)
    index, keys = CuckooFilter.load(had[0]), gone.column("key").to_pylist()
    if keys:
        index.delete(_halves(keys))
    return pa.table({"shard": [shard], "filter": [index.dump()], "n_keys": [filters.column("n_keys").to_pylist()[0] - len(keys)]}, schema=_FILTERS_ARROW)


class LineStore:
    """The store's segments in ``folder``. A segment has the version of the change that wrote
    it; ``bases`` says since which version a rewritten shard's segments count."""

    _TABLES = {"refs": "shard int, key binary, doc_id long", "counts": _COUNTS, "filters": _FILTERS, "bases": "shard int"}

    def __init__(self, spark: SparkSession, n_shards: int, folder: str | None = None):
        self.spark, self.n_shards = spark, n_shards
        self.folder = folder or shared_dir(spark, "line-store")
        self.version = 0
        self.segments: dict[str, list[DataFrame]] = {name: [] for name in self._TABLES}

    @property
    def empty(self) -> bool:
        return not self.segments["filters"]

    def _shard(self) -> Column:
        return F.pmod(F.crc32(F.substring("key", 1, 8)), F.lit(self.n_shards)).cast("int").alias("shard")

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{self.version}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _publish(self, **parts: DataFrame) -> None:
        """Stored tables become the segments of this version."""
        for name, df in parts.items():
            self.segments[name].append(df.withColumn("version", F.lit(self.version)))

    def _all(self, name: str) -> DataFrame:
        if not self.segments[name]:
            return self.spark.createDataFrame([], self._TABLES[name] + ", version int")
        return reduce(DataFrame.unionByName, self.segments[name])

    def _live(self, name: str) -> DataFrame:
        """The rows that count: those that no rewrite of their shard has replaced."""
        rows = self._all(name)
        if self.segments["bases"]:
            bases = self._all("bases").groupBy("shard").agg(F.max("version").alias("base"))
            rows = rows.join(bases, "shard", "left").filter("base IS NULL OR version >= base").drop("base")
        return rows

    @property
    def refs(self) -> DataFrame:
        """shard, key, doc_id; a row may repeat."""
        return self._live("refs").select("shard", "key", "doc_id")

    @property
    def counts(self) -> DataFrame:
        """shard, key, n_docs, keeper: one row per key."""
        rows = self._live("counts").select("shard", "key", "n_docs", "keeper")
        if len(self.segments["counts"]) < 2:
            return rows
        return rows.groupBy("shard", "key").agg(F.sum("n_docs").alias("n_docs"), F.min("keeper").alias("keeper"))

    @property
    def filters(self) -> DataFrame:
        """shard, filter, n_keys: the newest of each shard."""
        rows = self._all("filters")
        if len(self.segments["filters"]) < 2:
            return rows.select("shard", "filter", "n_keys")
        return rows.groupBy("shard").agg(F.max_by(F.struct("filter", "n_keys"), "version").alias("f")).select("shard", "f.*")

    def _refs_of(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return rows.filter("doc_id IS NOT NULL").mapInArrow(frugal(_refs), "key binary, doc_id long").select(self._shard(), "key", "doc_id")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> "LineStore":
        """Add the lines of documents. Rows that repeat a document, or come again, add what is new."""
        first, refs, counts = self.empty, self.refs, self.counts
        known_filters = self.filters
        self.version += 1
        new = self._keep(self._refs_of(docs, id_col, text_col), "refs")
        probed = self._keep(_counted(new).groupBy("shard").cogroup(known_filters.groupBy("shard")).applyInArrow(_probe_and_add, _PROBED), "probed")
        fresh = probed.filter("key IS NOT NULL")
        added = fresh.filter("NOT maybe").select("shard", "key", "n_docs", "keeper")
        filters = probed.filter("filter IS NOT NULL").select("shard", "filter", "n_keys", "full")
        if not first:
            maybe = fresh.filter("maybe").select("shard", "key")
            again = new.join(maybe.select("key"), "key", "left_semi").join(refs.select("key", "doc_id"), ["key", "doc_id"], "left_anti")
            added = added.unionByName(_counted(again))
            # new keys that the filter seemed to hold get their own fingerprint, so that deletion is exact
            false = self._keep(maybe.join(counts.select("key"), "key", "left_anti"), "false")
            filters = self._keep(false.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_add, _ADDED), "added")
        self._publish(refs=new, counts=self._keep(added, "counts"))
        full = filters.filter("full").select("shard")
        if full.head(1):  # shards that have outgrown their filters get new ones from the exact keys
            grown = self.counts.join(full, "shard", "left_semi").groupBy("shard").applyInArrow(_build, _FILTERS)
            filters = filters.filter("NOT full").select("shard", "filter", "n_keys").unionByName(grown)
        self._publish(filters=self._keep(filters.select("shard", "filter", "n_keys"), "filters"))
        return self

    def delete(self, doc_ids: DataFrame, id_col: str = "doc_id") -> "LineStore":
        """Take documents out again; their keys' next smallest documents become keepers."""
        refs, counts, filters = self.refs, self.counts, self.filters
        ids = pick(doc_ids, doc_id=id_col).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        self.version += 1
        touched = self._keep(refs.join(ids, "doc_id", "left_semi").select("shard", "key").distinct(), "touched")
        shards = self._keep(touched.select("shard").distinct(), "bases")
        kept = self._keep(refs.join(shards, "shard", "left_semi").join(ids, "doc_id", "left_anti").select("shard", "key", "doc_id"), "refs")
        recounted = _counted(kept.join(touched.select("key"), "key", "left_semi").select("shard", "key", "doc_id"))
        others = counts.join(shards, "shard", "left_semi").join(touched.select("key"), "key", "left_anti").select("shard", "key", "n_docs", "keeper")
        now = self._keep(others.unionByName(recounted), "counts")
        gone = touched.join(now.select("key"), "key", "left_anti")
        left = filters.join(shards, "shard", "left_semi")
        left = self._keep(gone.groupBy("shard").cogroup(left.groupBy("shard")).applyInArrow(_take_out, _FILTERS), "filters")
        self._publish(refs=kept, counts=now, filters=left, bases=shards)
        return self

    def compact(self) -> "LineStore":
        """One segment of each table; references that repeat are stored once."""
        if not self.empty:
            tables = {"refs": self.refs.distinct(), "counts": self.counts, "filters": self.filters}
            self.version += 1
            kept = {name: self._keep(df, name) for name, df in tables.items()}
            self.segments = {name: [] for name in self._TABLES}
            self._publish(**kept)
        return self

    def repeated(self) -> DataFrame:
        """key, keeper, n_docs of keys that at least two documents hold."""
        return self.counts.filter("n_docs >= 2").select("key", "keeper", "n_docs")

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_lines, n_dropped, text: each row without the lines that it loses.

        A document loses every line whose key another document keeps. A row's keys to lose
        are gathered per document (bounded by the document itself); texts are shuffled once.
        Null or empty text is one empty line; a null id loses nothing.
        """
        lost = self.refs.join(self.repeated(), "key").filter(F.col("doc_id") != F.col("keeper")).groupBy("doc_id").agg(
            F.collect_set("key").alias("lost"))
        rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return rows.join(lost, "doc_id", "left").mapInArrow(frugal(_drop), "doc_id long, n_lines long, n_dropped long, text string")


def _counted(refs: DataFrame) -> DataFrame:
    """One row per key: documents and the smallest of them; repeated refs count once."""
    return refs.groupBy("shard", "key").agg(F.count_distinct("doc_id").alias("n_docs"), F.min("doc_id").alias("keeper"))


def _drop(batches):
    for batch in batches:
        out, n_lines, n_dropped = [], [], []
        for text, lost in zip(batch.column("text").to_pylist(), batch.column("lost").to_pylist()):
            lines = (text or "").split("\n")
            kept = lines
            if lost:
                lost = set(lost)
                kept = [x for x in lines if line_key(x) not in lost]
            out.append("\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                                          pa.array(out, pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])


def shards_for(docs: DataFrame, per_shard: int = KEYS_PER_SHARD, lines_per_doc: int = 10) -> int:
    """Shards of a new store so that each gets about per_shard keys."""
    return max(64, -(-docs.count() * lines_per_doc // per_shard))


__all__ = ["CuckooFilter", "LineStore", "line_key", "shards_for", "STRIP", "MIN_CHARS"]
