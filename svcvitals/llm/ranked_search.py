"""Ranked lexical search, hybrid of term-at-a-time and document-at-a-time.

1. Documents are indexed in blocks: one row per block and term with the term's postings
   (document number within the block, occurrences), and one row with the block's document
   ids and lengths. Terms are strings throughout, no hash decides.
2. Corpus statistics come from the index: the number of documents and terms over all
   blocks, and each query term's document frequency.
3. Queries (items) are dealt into blocks. Index rows whose term occurs in a block of
   queries are brought to it, with the items that hold the term; other postings are never
   moved. Rows of one (query block, document block) lie side by side in a task.
4. There, a query's short lists are summed term at a time into accumulators. The result,
   documents in order with partial scores, then stands beside the long lists as one more
   iterator with bounds. Document ranges are visited in order; a range whose accumulators'
   and lists' bounds together cannot reach the k-th best score so far is skipped, in the
   others documents are scored in full. A task keeps the k best of each query of one query
   block over all its document blocks, so thresholds rise as it goes.

Skipping is exact: bounds are the greatest impacts that occur in a range, and a range that
can still tie is visited.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from svcvitals.llm.bytecols import LOWER, range_hashes, row_slices, rows_of, same_ranges, string_bytes, words
from svcvitals.llm.columns import pick
from svcvitals.llm.tasks import frugal
from svcvitals.sources.tables import materialize

K = 10
#: Bytes of text of an index block.
BLOCK_BYTES = 4 << 20
#: Queries of a query block.
QUERY_BLOCK = 512
#: Documents of a range; lists of at most one posting in SHORT documents are summed first.
RANGE = 64
SHORT = 16
#: All ASCII characters but digits and letters separate terms.
SEPARATOR = np.array([b < 128 and not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122) for b in range(256)])

_INDEX = "block string, term string, n int, total long, docs binary, counts binary"
_INDEX_ARROW = pa.schema([("block", pa.string()), ("term", pa.string()), ("n", pa.int32()), ("total", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary())])


def _grouped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms numbered by their bytes: where one of each lies, and the number of each word."""
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    if len(number) and not same_ranges(data, starts, ends, data, starts[first][number], ends[first][number]).all():
        raw, seen = data.tobytes(), {}
        number = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist())])
        first = np.unique(number, return_index=True)[1]
    return first, number


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a string column."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data[at].tobytes())).cast(pa.string())


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of values as a binary column."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _index(batches):
    """mapInArrow: (doc_id, text) -> index rows of blocks named by partition and number."""
    part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

    def flush():
        nonlocal seq, held, size
        name, (data, offsets, ids, known) = f"{part}-{seq}", _joined(held)
        seq, held, size = seq + 1, [], 0
        data = LOWER[data]
        starts, ends, hashes = words(data, offsets, SEPARATOR, lower=False)
        doc = rows_of(starts, offsets)
        lengths = np.bincount(doc, minlength=len(ids))
        first, number = _grouped(data, starts, ends, hashes)
        pairs, counts = np.unique(number * len(ids) + doc, return_counts=True)
        df = np.bincount(pairs // max(1, len(ids)), minlength=len(first))
        total = np.bincount(number, minlength=len(first))
        yield pa.RecordBatch.from_arrays([
            pa.array([name], pa.string()), pa.array([None], pa.string()), pa.array([int((lengths > 0).sum())], pa.int32()), pa.array([len(starts)], pa.int64()),
            pa.array([np.where(known, ids, 0).astype("<i8").tobytes() + known.astype("u1").tobytes()], pa.binary()),
            pa.array([lengths.astype("<i8").tobytes()], pa.binary())], schema=_INDEX_ARROW)
        ends_of = np.cumsum(df)
        for a in range(0, len(first), 1 << 16):
            b = min(len(first), a + (1 << 16))
            i, j = int(ends_of[a] - df[a]), int(ends_of[b - 1])
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * (b - a), pa.string()), _strings(data, starts[first[a:b]], ends[first[a:b]]), pa.array(df[a:b], pa.int32()), pa.array(total[a:b], pa.int64()),
                _binaries((pairs[i:j] % len(ids)).astype("<u4"), df[a:b]), _binaries(counts[i:j].astype("<u4"), df[a:b])], schema=_INDEX_ARROW)

    for batch in batches:
        data, offsets = string_bytes(batch.column("text"))
        ids = batch.column("doc_id")
        known = np.array(ids.is_valid())
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j in row_slices(offsets):
            held.append((data[offsets[i]:offsets[j]].copy(), offsets[i:j + 1] - offsets[i], ids[i:j], known[i:j]))
            size += int(offsets[j] - offsets[i]) + 64 * (j - i)
            if size >= BLOCK_BYTES:
                yield from flush()
    if held:
        yield from flush()


def _joined(held):
    """Slices of rows as one buffer."""
    base = np.cumsum([0] + [len(d) for d, *_ in held])
    offsets = np.concatenate([[0]] + [o[1:] + b for (_, o, _, _), b in zip(held, base)])
    return np.concatenate([d for d, *_ in held]), offsets, np.concatenate([i for *_, i, _ in held]), np.concatenate([k for *_, k in held])


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: block, term, n, total, docs, counts.

    A row with a term: in how many (n) and which documents of the block it occurs, and how
    often (docs and counts little-endian, 32 bits each). The row of a block without a term: how many of its
    documents have terms, all documents' ids (64 bits each, then a byte each that says whether
    the id is known) and lengths in terms. total is the sum of counts.
    """
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(source.mapInArrow(frugal(_index), _INDEX), "lexical-index")


def _query_terms(batches):
    """mapInArrow: (item, text) -> a row for each item, with its distinct terms."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        data, offsets = string_bytes(batch.column("text"))
        data = LOWER[data]
        starts, ends, _ = words(data, offsets, SEPARATOR, lower=False)
        raw, row = data.tobytes(), rows_of(starts, offsets)
        cut = np.searchsorted(row, np.arange(len(batch) + 1))
        terms = [sorted({raw[a:b].decode() for a, b in zip(starts[i:j].tolist(), ends[i:j].tolist())}) for i, j in zip(cut, cut[1:])]
        keys = [(part << 40) + seq + k for k in range(len(batch))]
        seq += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column("item_id"), pa.array(terms, pa.list_(pa.string()))], names=["item", "item_id", "terms"])


# --- scoring ---------------------------------------------------------------------------------

class Postings:
    """The lists of one document block: documents (sorted) and impacts, with the greatest
    impact of each document range."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray, ends: np.ndarray, n_docs: int):
        self.docs, self.impacts, self.ends = docs, impacts, ends
        self.n_ranges = max(1, -(-n_docs // RANGE))
        self.n_docs = n_docs
        self._bounds: dict[int, np.ndarray] = {}

    def list(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = (int(self.ends[t - 1]) if t else 0), int(self.ends[t])
        return self.docs[a:b], self.impacts[a:b]

    def size(self, t: int) -> int:
        return int(self.ends[t] - (self.ends[t - 1] if t else 0))

    def bounds(self, t: int) -> np.ndarray:
        if t not in self._bounds:
            self._bounds[t] = range_bounds(*self.list(t), self.n_ranges)
        return self._bounds[t]


def range_bounds(docs: np.ndarray, impacts: np.ndarray, n_ranges: int) -> np.ndarray:
    """The greatest impact in each document range; 0 where there is none."""
    out = np.zeros(n_ranges, np.int64)
    if len(docs):
        where = docs // RANGE
        first = np.flatnonzero(np.concatenate([[True], np.diff(where) > 0]))
        out[where[first]] = np.maximum.reduceat(impacts, first)
    return out


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the documents of the lists, in order, with their summed impacts."""
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    dense = np.zeros(n_docs, np.int64)
    for docs, impacts in lists:
        dense[docs] += impacts
    docs = np.flatnonzero(dense)
    return docs, dense[docs]


def search(postings: Postings, terms: list[int], least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the k best (score at least ``least`` and above 0), with
    their full scores; of equal scores all that can count are kept."""
    short = [t for t in terms if postings.size(t) * SHORT <= postings.n_docs]
    long = sorted(set(terms) - set(short), key=postings.size)
    docs, sums = accumulate([postings.list(t) for t in short], postings.n_docs)
    if len(sums) >= k:  # partial scores are never above full ones
        least = max(least, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
    least = max(least, 1)
    if not long:
        keep = sums >= least
        return docs[keep], sums[keep]
    lists = [(docs, sums), *(postings.list(t) for t in long)]
    bounds = range_bounds(docs, sums, postings.n_ranges) + sum(postings.bounds(t) for t in long)
    edges = np.arange(postings.n_ranges + 1) * RANGE
    cuts = [np.searchsorted(d, edges) for d, _ in lists]
    found_docs, found, top = [], [], np.zeros(0, np.int64)
    r = 0
    while r < postings.n_ranges:
        if bounds[r] < least:  # skip to the next range that can reach the threshold
            ahead = np.flatnonzero(bounds[r:] >= least)
            if not len(ahead):
                break
            r += int(ahead[0])
        scores = np.zeros(RANGE, np.int64)
        for (d, v), cut in zip(lists, cuts):
            a, b = cut[r], cut[r + 1]
            if b > a:
                scores[d[a:b] - r * RANGE] += v[a:b]
        good = np.flatnonzero(scores >= least)
        if len(good):
            found_docs.append(good + r * RANGE)
            found.append(scores[good])
            top = np.concatenate([top, scores[good]])
            if len(top) >= k:
                top = np.partition(top, len(top) - k)[len(top) - k:]
                least = max(least, int(top.min()))
        r += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    docs, found = np.concatenate(found_docs), np.concatenate(found)
    keep = found >= least
    return docs[keep], found[keep]


def impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """weight * ((10^9 * tf) div (1000 * tf + 8 * m)), m = 10 + (90 * length * N) div L."""
    if len(lengths) and int(lengths.max()) * 90 * n_docs >= 1 << 63:  # beyond 64 bits: the same, in Python's integers
        share = np.array([90 * int(x) * n_docs // n_terms for x in lengths], dtype=np.int64)
    else:
        share = (90 * lengths * n_docs) // max(1, n_terms)
    m = 10 + share
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


class _Best:
    """The k best of each item of one query block: score, known id first, id."""

    def __init__(self, k: int):
        self.k, self.of = k, {}

    def least(self, item: int) -> int:
        had = self.of.get(item)
        return int(had[0][-1]) if had is not None and len(had[0]) >= self.k else 0

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        had = self.of.get(item)
        if had is not None:
            scores, ids, known = (np.concatenate(x) for x in zip(had, (scores, ids, known)))
        order = np.lexsort((ids, ~known, -scores))[:self.k]
        self.of[item] = (scores[order], ids[order], known[order])

    def batch(self) -> pa.RecordBatch:
        items = [i for i, (s, _, _) in self.of.items() for _ in range(len(s))]
        scores, ids, known = (np.concatenate(x) if self.of else np.zeros(0, np.int64) for x in (zip(*self.of.values()) if self.of else [()] * 3))
        return pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(ids, pa.int64(), mask=~known.astype(bool)), pa.array(scores, pa.int64())],
                                          names=["item", "doc_id", "score"])


def _score(n_docs: int, n_terms: int, k: int):
    """mapInArrow over rows sorted by query block, document block and kind (the documents'
    row first): the task's k best of each item."""

    def run(batches):
        best, of, block, info, rows = _Best(k), None, None, None, []

        def finish():
            if not rows or info is None:
                return
            ids = np.frombuffer(info["docs"], "<i8", len(info["counts"]) // 8)
            known = np.frombuffer(info["docs"], "u1", offset=8 * len(ids)).astype(bool)
            lengths = np.frombuffer(info["counts"], "<i8")
            sizes = np.array([len(r["docs"]) // 4 for r in rows])
            docs = np.frombuffer(b"".join(r["docs"] for r in rows), "<u4").astype(np.int64)
            counts = np.frombuffer(b"".join(r["counts"] for r in rows), "<u4").astype(np.int64)
            weights = np.repeat(np.array([r["weight"] for r in rows], np.int64), sizes)
            postings = Postings(docs, impacts(weights, counts, lengths[docs], n_docs, n_terms), np.cumsum(sizes), len(ids))
            terms: dict[int, list[int]] = {}
            for t, r in enumerate(rows):
                for item in r["items"]:
                    terms.setdefault(item, []).append(t)
            for item, own in terms.items():
                found, scores = search(postings, own, best.least(item), k)
                if len(found):
                    best.add(item, scores, ids[found], known[found])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["q"], row["block"]) != (of, block):
                    finish()
                    rows, info, block = [], None, row["block"]
                    if row["q"] != of:
                        if best.of:
                            yield best.batch()
                        best, of = _Best(k), row["q"]
                if row["items"] is None:
                    info = row
                else:
                    rows.append(row)
        finish()
        if best.of:
            yield best.batch()

    return run


def weight(n_docs: int, df: Column) -> Column:
    """floor(1000 * ln((2 N + 2) / (2 df + 1)))."""
    return F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (F.lit(2) * df + F.lit(1)).cast("double"))).cast("long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents with score above 0.

    Terms are runs of characters other than ASCII signs and white space, A-Z lower-cased;
    null texts have none. An item's rows are ranked from 1 without gaps: by score, then by
    doc_id, rows with a null doc_id last. Every row of items is a query of its own, with its
    terms once each, even where ids repeat or are null; every row of docs is a document of
    its own. Items without terms, and items none of whose terms occur, have no rows. Empty
    tables give no rows. ``docs`` should be read from a table: index blocks are named by scan
    order.
    """
    spark = docs.sparkSession
    index = index_documents(docs, id_col, text_col)
    n_docs, n_terms = (int(x or 0) for x in index.filter("term IS NULL").agg(F.sum("n"), F.sum("total")).first())
    own = pick(items, item_id=item_col, text=item_text_col)
    kind = own.schema["item_id"].dataType.simpleString()
    queries = materialize(own.mapInArrow(_query_terms, f"item long, item_id {kind}, terms array<string>"), "query-terms")
    n_blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    asked = queries.select(F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int").alias("q"), "item", F.explode("terms").alias("term"))
    asked = asked.groupBy("term", "q").agg(F.collect_list("item").alias("items"))
    held = index.filter("term IS NOT NULL")
    df = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weighted = materialize(asked.join(df, "term").select("q", "term", "items", weight(n_docs, F.col("df")).alias("weight")), "query-weights")
    matched = held.join(weighted, "term").select("q", "block", F.lit(1).alias("kind"), "docs", "counts", "weight", "items")
    about = index.filter("term IS NULL").select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("q"), "block",
        F.lit(0).alias("kind"), "docs", "counts", F.lit(None).cast("long").alias("weight"), F.lit(None).cast("array<bigint>").alias("items"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = matched.unionByName(about).repartition(partitions, "block").sortWithinPartitions("q", "block", "kind")
    found = laid.mapInArrow(frugal(_score(n_docs, n_terms, k)), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return best.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


__all__ = ["rank_documents", "index_documents", "search", "accumulate", "impacts", "weight", "Postings", "SEPARATOR"]
