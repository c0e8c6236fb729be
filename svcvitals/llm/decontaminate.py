"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every window of 13 consecutive benchmark words is a pattern (an item of fewer words is one
shorter pattern). Patterns of one length share the tables of the method: a shift table over
blocks of two words says how far the search may skip, and patterns that end in the same
block are found through a bucket of that suffix and compared word by word: first by the
words' hashes, then, for what is left, by their bytes. The words of many documents are searched side by side: each lane of words moves by its own shift, and a
word's number is looked up only where a lane stops.

The benchmark is read by the driver in groups of about ``GROUP_BYTES`` of text; one
group's tables are built and broadcast at a time, and each group is one pass over the
documents. The tables hold the group's words once and grow with its number of windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from svcvitals.llm.bytecols import LOWER, limbs, mixed, ragged, row_slices, same_ranges, string_bytes, words
from svcvitals.llm.columns import pick
from svcvitals.llm.tasks import frugal
from svcvitals.sources.tables import materialize

WINDOW = 13
#: Share of hit words from which a document counts as contaminated: 1 / 20.
HIT_SHARE = 20
GROUP_BYTES = 16 << 20
LANE = 512
#: All ASCII characters but digits and letters separate words.
SEPARATOR = np.array([b < 128 and not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122) for b in range(256)])


class Words:
    """The words of a text: their hashes, and where they lie in its lower-cased bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        self.data, self.starts, self.ends, self.hashes = data, starts, ends, hashes
        self._eight = None

    def __getstate__(self):
        return self.__dict__ | {"_eight": None}

    def eight(self) -> np.ndarray:
        """The limbs of the bytes, made once."""
        if self._eight is None:
            self._eight = limbs(self.data)
        return self._eight

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> "Words":
        """Those of rows of one buffer."""
        a, b = int(offsets[0]), int(offsets[-1])
        starts, ends, hashes = words(data, offsets, SEPARATOR)
        return cls(LOWER[data[a:b]], starts - a, ends - a, hashes)

    def same(self, at: np.ndarray, other: "Words", there: np.ndarray) -> np.ndarray:
        """Whether the words numbered ``at`` have the bytes of the other's words ``there``."""
        return same_ranges(self.data, self.starts[at], self.ends[at], other.data, other.starts[there], other.ends[there], (self.eight(), other.eight()))

    def ranks(self) -> np.ndarray:
        """A number for each word, equal for equal words only."""
        _, first, rank = np.unique(self.hashes, return_index=True, return_inverse=True)
        if len(rank) and not self.same(np.arange(len(rank)), self, first[rank]).all():
            raw, seen = self.data.tobytes(), {}
            rank = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(self.starts.tolist(), self.ends.tolist())])
        return rank


class WuManber:
    """The tables for patterns of one length, given by where they start among ``own`` words."""

    def __init__(self, own: Words, starts: np.ndarray, length: int):
        self.own, self.words, self.length = own, own.hashes, length
        self.block = min(2, self.length)
        size = 1 << max(12, int(np.ceil(np.log2(max(1, len(starts))))) + 3)
        self.mask = np.uint64(size - 1)
        self.shift = np.full(size, self.length - self.block + 1, dtype=np.min_scalar_type(self.length))
        for end in range(self.block, self.length + 1):  # later blocks allow smaller shifts
            self.shift[self._slot(starts, end - 1)] = self.length - end
        suffix = self._slot(starts, self.length - 1)
        order = np.argsort(suffix, kind="stable")
        self.starts, self.order, self.suffix = (x.astype(np.int32) for x in (starts[order], order, suffix[order]))

    def _slot(self, starts: np.ndarray, at: int) -> np.ndarray:
        return self.slots(self.words[starts + at], self.words[starts + at - 1] if self.block == 2 else None)

    def slots(self, last: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        h = last if before is None else last + before * np.uint64(0x9E3779B97F4A7C15)
        return (mixed(h) & self.mask).astype(np.int64)

    def search(self, text: Words, row_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the last word, pattern) of every occurrence; rows end at row_ends."""
        hashes = text.hashes
        starts = np.concatenate([[0], row_ends[:-1]]) if len(row_ends) else np.zeros(0, np.int64)
        lanes = np.maximum(0, -(-(row_ends - starts - self.length + 1) // LANE))
        pos = np.repeat(starts + self.length - 1, lanes) + ragged(lanes) * LANE
        stop = np.minimum(pos + LANE, np.repeat(row_ends, lanes))
        found_at, found = [], []
        while len(pos):
            slot = self.slots(hashes[pos], hashes[pos - 1] if self.block == 2 else None)
            skip = self.shift[slot]
            here = np.flatnonzero(skip == 0)
            if len(here):
                wanted = slot[here].astype(np.int32)
                first = np.searchsorted(self.suffix, wanted)
                counts = np.searchsorted(self.suffix, wanted, side="right") - first
                at = np.repeat(pos[here], counts)
                candidate = np.repeat(first, counts) + ragged(counts)
                for back in range(self.length):  # direct comparison, last word first
                    same = hashes[at - back] == self.words[self.starts[candidate] + (self.length - 1 - back)]
                    at, candidate = at[same], candidate[same]
                for back in range(self.length):
                    same = text.same(at - back, self.own, self.starts[candidate] + (self.length - 1 - back))
                    at, candidate = at[same], candidate[same]
                found_at.append(at)
                found.append(self.order[candidate])
            pos = pos + np.maximum(skip, 1).astype(np.int64)
            left = pos < stop
            pos, stop = pos[left], stop[left]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)


def _equal_windows(rank: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows of ``length`` words, given each word's rank: where each distinct one
    first starts, and each window's number among those. Ranks of 2, 4, ... words name what
    is equal."""
    span = 1
    while 2 * span <= length:
        pairs = rank[:len(rank) - span] * (int(rank.max()) + 1) + rank[span:]
        rank, span = np.unique(pairs, return_inverse=True)[1], 2 * span
    pairs = rank[starts] * (int(rank.max()) + 1) + rank[starts + length - span]
    _, first, which = np.unique(pairs, return_index=True, return_inverse=True)
    return starts[first], which


def build(items: list[tuple[str, str]], window: int = WINDOW) -> list[tuple[WuManber, np.ndarray, np.ndarray]]:
    """For each pattern length: the tables, and each pattern's items as offsets and numbers."""
    texts = pa.array([t for _, t in items], pa.string())
    data, offsets = string_bytes(texts)
    own_words = Words.of(data, offsets)
    ranks = own_words.ranks()
    ends = np.searchsorted(own_words.starts + offsets[0], offsets[1:])
    begins = np.concatenate([np.zeros(min(1, len(ends)), np.int64), ends[:-1]])
    lengths = np.minimum(window, ends - begins)
    out = []
    for length in np.unique(lengths[lengths > 0]).tolist():
        own = np.flatnonzero(lengths == length)
        counts = ends[own] - begins[own] - length + 1
        at = np.repeat(begins[own], counts) + ragged(counts)
        patterns, which = _equal_windows(ranks, at, length)
        pairs = np.unique(which * len(items) + np.repeat(own, counts))
        first = np.searchsorted(pairs, np.arange(len(patterns) + 1) * len(items))
        out.append((WuManber(own_words, patterns, length), first.astype(np.int32), (pairs % len(items)).astype(np.int32)))
    return out


_RESULT = "n_words long, spans array<struct<first:long,last:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _scan(tables, items_of: list[str], kept: list[str]):
    """mapInArrow: each row's word count, hit runs (word numbers) and items."""

    def run(batches):
        numbers = np.array(items_of, dtype=object)
        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            n_words, spans, items = np.zeros(len(batch), np.int64), [[]] * len(batch), [[]] * len(batch)
            for i, j in row_slices(offsets):
                text = Words.of(data, offsets[i:j + 1])
                starts = text.starts
                row_ends = np.searchsorted(starts, offsets[i + 1:j + 1] - offsets[i])
                row_starts = np.concatenate([[0], row_ends[:-1]])
                n_words[i:j] = row_ends - row_starts
                cover, pairs = np.zeros(len(starts) + 1, np.int64), []
                for index, first, owners in tables.value:
                    at, pattern = index.search(text, row_ends)
                    np.add.at(cover, at - index.length + 1, 1)
                    np.add.at(cover, at + 1, -1)
                    row = np.searchsorted(row_ends, at, side="right")
                    counts = first[pattern + 1] - first[pattern]
                    own = owners[np.repeat(first[pattern], counts) + ragged(counts)]
                    pairs.append(np.unique(np.stack([np.repeat(row, counts), own], axis=1), axis=0))
                hit = np.cumsum(cover[:-1]) > 0
                if not hit.any():
                    continue
                at = np.flatnonzero(hit)
                row = np.searchsorted(row_ends, at, side="right")
                new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(row) > 0)])
                a, b = at[new], at[np.concatenate([new[1:], [True]])]
                r = row[new]
                for k in np.unique(r):
                    mine = r == k
                    spans[i + k] = [{"first": int(x), "last": int(y)} for x, y in zip(a[mine] - row_starts[k], b[mine] - row_starts[k])]
                pairs = np.concatenate(pairs)
                for k in np.unique(pairs[:, 0]):
                    items[i + k] = sorted(set(numbers[pairs[pairs[:, 0] == k, 1]]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(n_words), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
                                             names=kept + ["n_words", "spans", "items"])

    return run


def find_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                   group_bytes: int = GROUP_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, kept columns, n_words, n_hit, spans, items, contaminated, one row per input row.

    spans are the maximal runs of hit words (numbers from 0, last inclusive); items the ids
    of the benchmark items with an occurring window, sorted as strings. Null texts have no
    words; items without words match nothing; items with a null id are named ''. With an
    empty benchmark nothing is hit. Repeated rows are judged each for itself.
    """
    spark = docs.sparkSession
    cols = {f"c{k}": c for k, c in enumerate(keep) if c != text_col}
    rows = pick(docs, doc_id=id_col, text=text_col, **cols)
    if text_col in keep:
        cols["text"] = text_col
    names = [c for c in rows.columns if c != "text" or text_col in keep]
    items = pick(benchmark, item=item_col, text=item_text_col).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n_groups = max(1, -(-size // group_bytes))
    if n_groups == 1:
        found = _pass(rows, items, names, window)[0]
    else:
        found = _in_groups(rows, items, names, window, n_groups)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    found = found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words")))
    return found.select(F.col("doc_id").alias(id_col), *[F.col(k).alias(c) for k, c in cols.items()], "n_words", "n_hit", "spans", "items", "contaminated")


def _pass(rows: DataFrame, items: DataFrame, names: list[str], window: int):
    """The named columns and the result of the items for each row, and what was broadcast."""
    group = [(r["item"], r["text"]) for r in items.select("item", "text").collect()]
    tables = rows.sparkSession.sparkContext.broadcast(build(group, window))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    return rows.mapInArrow(frugal(_scan(tables, [name for name, _ in group], names)), f"{kinds}, {_RESULT}"), tables


def _in_groups(rows: DataFrame, items: DataFrame, names: list[str], window: int, n_groups: int) -> DataFrame:
    """The passes of a larger benchmark, one stored after the other and merged by stored row
    numbers, so that each row is judged for itself whatever repeats."""
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "benchmark-rows")
    group = F.pmod(F.xxhash64("item", "text"), F.lit(n_groups)).alias("g")
    items = materialize(items.distinct().select("*", group).sort("g"), "benchmark-items")
    found = None
    for g in range(n_groups):
        one, tables = _pass(rows.select("row", "text"), items.filter(F.col("g") == g), ["row"], window)
        if g:  # the first pass counts every row's words
            one = one.filter(F.size("spans") > 0)
        one = materialize(one, "benchmark-hits")
        tables.destroy()
        found = one if found is None else found.unionByName(one)
    return rows.select("row", *names).join(_merged(found), "row").drop("row")


def _merged(found: DataFrame) -> DataFrame:
    """One row per row number from those of several passes: the union of runs and of items."""
    runs = F.array_sort(F.flatten(F.collect_list("spans")))
    joined = F.aggregate(
        runs, F.array().cast("array<struct<first:long,last:long>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["last"] + 1 >= s["first"]), F.concat(
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
            F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], s["last"]).alias("last")))))
        .otherwise(F.concat(acc, F.array(s))))
    return found.groupBy("row").agg(F.first("n_words").alias("n_words"), joined.alias("spans"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


__all__ = ["Words", "WuManber", "build", "find_benchmark", "SEPARATOR", "WINDOW", "HIT_SHARE"]
