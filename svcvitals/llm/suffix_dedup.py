"""Removal of long repeated byte strings by prefix-free parsing.

A byte is removed when it lies in a string of ``LENGTH`` bytes that also starts anywhere
else in the corpus. Rolling-hash triggers parse every text into phrases; a phrase runs from
one trigger to the next and overlaps it by the trigger's ``TRIGGER`` bytes, so that the
phrases of equal strings are equal. A window of ``LENGTH`` bytes is named by its first
trigger: x bytes of the phrase that ends there (a suffix of a dictionary phrase) and the
parse that follows. Two windows are equal if both agree.

1. *Parse.* Each trigger sends a key of the bytes around it that every one of its windows
   holds, and a digest of all that its windows cover, to the key's bucket. A key that
   occurs once has no repeated windows; a digest that occurs again has only repeated ones.
   The rest need a closer look (borders of repeated regions), and one trigger of each
   repeated digest whose key has others takes part in it.
2. *Order.* In each block, the phrases before those triggers are sorted from their ends
   backwards (the suffix array of the dictionary, by suffixes that end in a trigger), the
   bytes behind them forwards (the suffix array of the parse), both with common lengths.
   Class x of the first and class LENGTH - x of the second combine into the block's corpus
   order: windows of one pair of classes are equal, byte by byte. Blocks are merged by a
   96-bit fingerprint of each class, since a global order would put a passage that a third
   of all documents share into one task.
3. *Removal.* The repeated windows of each document are united into runs and taken out.

Windows whose first trigger lies more than ``REACH`` bytes in, or that have none, are
compared by fingerprint alone. What is sent is packed, one row per block and bucket, and
equal keys of a block are sent once, so a hot passage costs one entry per block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from svcvitals.llm.bytecols import CHUNK, mixed, powers, prefix_sums, ragged, row_slices, string_bytes, window_hashes
from svcvitals.llm.columns import pick
from svcvitals.llm.tasks import frugal
from svcvitals.sources.tables import materialize

LENGTH = 400
TRIGGER = 16
PERIOD = 56
REACH = 300
BLOCK_BYTES = 4 << 20
#: Digests of one key that a block sends, and the place of triggers with further ones.
PER_KEY = 8
NOT_SENT = 0xFFFFFFFF
_U = np.uint64
_PACKED = "bucket int, block string, info boolean, a binary, b binary, c binary, d binary"
_PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.string()), ("info", pa.bool_()),
                           ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])
_ANSWER = "block string, bucket int, info boolean, a binary, b binary, c binary, d binary"
_ANSWER_ARROW = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("info", pa.bool_()),
                           ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])


class Shape:
    """Lengths of a run: windows, triggers, their mean distance, the longest stretch before
    a window's first trigger that is ordered by phrases."""

    def __init__(self, length: int = LENGTH, trigger: int = TRIGGER, period: int = PERIOD, reach: int | None = None):
        self.length, self.trigger, self.period = length, trigger, period
        self.reach = reach or max(trigger, length * REACH // LENGTH)


def triggers(data: np.ndarray, shape: Shape) -> np.ndarray:
    """Ends of the trigger strings in one text, in order."""
    w, out = shape.trigger, []
    limit = _U((1 << 64) // shape.period)
    for a in range(0, max(0, len(data) - w + 1), CHUNK):
        part = data[a:a + CHUNK + w - 1]
        sums = prefix_sums(part)
        n = len(part) - w + 1
        h = mixed((sums[w:] - sums[:-w]) * powers(len(sums), 0, True)[:n])
        out.append(np.flatnonzero(h < limit) + a + w)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class Parse:
    """The triggers of a run of rows with their windows' reach."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shape: Shape):
        self.data, self.offsets, self.shape = data, offsets, shape
        w, length = shape.trigger, shape.length
        found = triggers(data, shape)
        row = np.searchsorted(offsets, found - w, side="right") - 1
        inside = found <= offsets[row + 1] if len(found) else np.zeros(0, bool)
        at, row = found[inside], row[inside]
        begin, end = offsets[row], offsets[row + 1]
        before = np.where(np.concatenate([[False], row[1:] == row[:-1]]), np.concatenate([[0], at[:-1]]), -1) if len(at) else at
        most = np.minimum(shape.reach, at - begin)
        most = np.where(before >= 0, np.minimum(most, at - before + w - 1), most)
        least = np.maximum(w, at + length - end)
        whole = at + length - shape.reach <= end  # its key lies in the row
        self.all_at, self.all_row = at, row
        self.at, self.row, self.most, self.least = at[whole], row[whole], most[whole], least[whole]
        self.first = self.least <= self.most  # the first trigger of one window at least

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Key of what all windows of a trigger share, and digest of all they cover (0 for
        triggers that no window has first; their keys still count as occurrences)."""
        s = self.shape
        key = window_hashes(self.data, self.at - s.trigger, self.at + s.length - s.reach)
        full = window_hashes(self.data, self.at - self.most, np.where(self.first, self.at + s.length - self.least, self.at))
        return key, np.where(self.first, mixed(full + self.most.astype(np.uint64) * _U(0x9E3779B97F4A7C15)), _U(0))

    def plain(self) -> np.ndarray:
        """Starts of windows without a trigger in reach."""
        s = self.shape
        bounds = np.concatenate([self.offsets[:-1] + s.trigger - 1, self.all_at])
        rows = np.concatenate([np.arange(len(self.offsets) - 1), self.all_row])
        order = np.lexsort((bounds, rows))
        bounds, rows = bounds[order], rows[order]
        first = np.maximum(bounds - s.trigger + 1, self.offsets[rows])
        nxt = np.append(bounds[1:], 0)
        same = np.append(rows[1:] == rows[:-1], False)
        last = np.minimum(np.where(same, nxt - s.reach - 1, self.offsets[rows + 1]), self.offsets[rows + 1] - s.length)
        n = np.maximum(0, last - first + 1)
        return np.repeat(first, n) + ragged(n)


def fingerprints(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of each window."""
    a = window_hashes(data, starts, starts + length)
    b = window_hashes(data, starts, starts + length, 1)
    return a, (b >> _U(32)).astype(np.uint32)


def sorted_common(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lexicographic rank order of the rows of a byte matrix, and the length that each row in
    that order has in common with the one before it."""
    width = -(-strings.shape[1] // 8) * 8
    padded = np.zeros((len(strings), width), dtype=np.uint8)
    padded[:, :strings.shape[1]] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    ranked = strings[order]
    differ = ranked[1:] != ranked[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
    return order, np.concatenate([[0], common])


def corpus_order(data: np.ndarray, at: np.ndarray, least: np.ndarray, most: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the triggers in corpus order: starts, and the class of equal windows of each.

    ``at`` are trigger positions; the windows of one start least..most bytes before it.
    """
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length, w = shape.length, shape.trigger
    padded = np.concatenate([np.zeros(shape.reach, np.uint8), data, np.zeros(length, np.uint8)])
    origin = at + shape.reach
    # the dictionary's phrases read backwards from the trigger; beyond a phrase's own reach nothing counts
    back = padded[origin[:, None] - 1 - np.arange(shape.reach)]
    left_order, left_common = sorted_common(back)
    right_order, right_common = sorted_common(padded[origin[:, None] + np.arange(length - w)])
    starts, classes, n_classes = [], [], 0
    for x in range(int(least.min()), int(most.max()) + 1):
        has = (least <= x) & (x <= most)
        if not has.any():
            continue
        left = np.empty(len(at), np.int64)
        left[left_order] = np.cumsum(left_common < x)
        right = np.empty(len(at), np.int64)
        right[right_order] = np.cumsum(right_common < length - x)
        distinct, place = np.unique(left[has] * (len(at) + 1) + right[has], return_inverse=True)
        starts.append(at[has] - x)
        classes.append(place + n_classes)
        n_classes += len(distinct)
    return np.concatenate(starts), np.concatenate(classes)


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_PACKED_ARROW)], schema=_PACKED_ARROW)


def _answer(rows) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ANSWER_ARROW)], schema=_ANSWER_ARROW)


def _blocks(batches, limit: int):
    """(doc keys, bytes, offsets, further columns) of about ``limit`` bytes each."""
    for batch in batches:
        data, offsets = string_bytes(batch.column("text"))
        for i, j in row_slices(offsets, limit):
            yield i, j, batch, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def _keys_of(batch, i: int, j: int) -> tuple[bytes, bytes]:
    return tuple(batch.column(c)[i:j].to_numpy(zero_copy_only=False).astype("<i8").tobytes() for c in ("k1", "k2"))


def _split(n_buckets: int, bucket: np.ndarray) -> np.ndarray:
    return np.searchsorted(bucket, np.arange(n_buckets + 1))


def _send_triggers(shape: Shape, n_buckets: int):
    """mapInArrow: texts -> per bucket the block's distinct (key, digest) pairs; per block what
    leads from its documents' triggers to those pairs.

    Of one key a block sends PER_KEY digests at most; triggers with others stay open (code
    2), which costs their windows a comparison and loses nothing.
    """

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for i, j, batch, data, offsets in _blocks(batches, BLOCK_BYTES):
            seq += 1
            block = f"{part}-{seq}"
            parse = Parse(data, offsets, shape)
            key, full = parse.keys()
            bucket = (key % _U(n_buckets)).astype(np.int64)
            order = np.lexsort((full, key, bucket))
            key, full, bucket = key[order], full[order], bucket[order]
            new_key = np.ones(len(key), dtype=bool)
            new_key[1:] = key[1:] != key[:-1]
            new = new_key.copy()
            new[1:] |= full[1:] != full[:-1]
            first = np.flatnonzero(new)
            pair = np.cumsum(new) - 1
            times = np.bincount(pair, minlength=len(first))
            of_key = np.cumsum(new_key)[first] - 1
            nth = np.arange(len(first)) - np.searchsorted(of_key, of_key)
            sent = nth < PER_KEY
            more = np.bincount(of_key, minlength=int(new_key.sum()))[of_key] > PER_KEY
            place = np.empty(len(key), dtype="<u4")
            place[order] = np.where(sent, np.cumsum(sent) - 1, NOT_SENT)[pair]
            at = first[sent]
            state = ((times > 1) + 2 * more).astype(np.uint8)[sent]
            short, digest, bucket = (key[at] >> _U(32)).astype("<u4"), full[at].astype("<u8"), bucket[at]
            k1, k2 = _keys_of(batch, i, j)
            plain = np.bincount(np.searchsorted(offsets, parse.plain(), side="right") - 1, minlength=j - i) > 0
            counts = np.bincount(parse.row, minlength=j - i).astype("<u4")
            rows = [(zlib.crc32(block.encode()) % n_buckets, block, True, k1 + k2, counts.tobytes(), place.tobytes(), plain.tobytes())]
            ends = _split(n_buckets, bucket)
            rows += [(k, block, False, short[a:b].tobytes(), digest[a:b].tobytes(), state[a:b].tobytes(), None)
                     for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if b > a]
            yield _batch(rows)

    return run


def _judge_triggers(key, table):
    """One bucket: the code of each pair sent.

    0: the key occurs once. 1: the digest occurs again, so all windows are repeated. 2: the
    digest occurs once, the key again. 3: as 1, and chosen to send its windows, because other
    digests have the key. Digest 0 stands for triggers without windows of their own.
    """
    out, own = [], []
    for r in table.to_pylist():
        if r["info"]:
            out.append((r["block"], None, True, r["a"], r["b"], r["c"], r["d"]))
        else:
            own.append(r)
    if own:
        keys, digests, states = (np.concatenate([np.frombuffer(r[c], t) for r in own]) for c, t in (("a", "<u4"), ("b", "<u8"), ("c", np.uint8)))
        order = np.lexsort((digests, keys))
        k, d, s = keys[order], digests[order], states[order]
        new_key = np.concatenate([[True], k[1:] != k[:-1]])
        new_pair = new_key | np.concatenate([[True], d[1:] != d[:-1]])
        key_at, pair_at = np.flatnonzero(new_key), np.flatnonzero(new_pair)
        key_of, pair_of = np.cumsum(new_key) - 1, np.cumsum(new_pair) - 1
        again = (np.bincount(pair_of) > 1) | (np.bitwise_or.reduceat(s & 1, pair_at) > 0)
        various = (np.bincount(key_of[pair_at]) > 1) | (np.bitwise_or.reduceat(s & 2, key_at) > 0)
        code = np.where(various[key_of], np.where(again[pair_of], np.where(new_pair, 3, 1), 2), again[pair_of]).astype(np.uint8)
        back = np.empty(len(k), np.uint8)
        back[order] = code
        at = 0
        for r in own:
            n = len(r["c"])
            out.append((r["block"], r["bucket"], False, back[at:at + n].tobytes(), None, None, None))
            at += n
    return _answer(out)


def _codes_of_docs(key, table):
    """One block: the codes of each document's triggers, for documents with something to do."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["info"])
    answers = sorted((r for r in rows if not r["info"]), key=lambda r: r["bucket"])
    codes = np.frombuffer(b"".join(r["a"] for r in answers) + b"\x02", np.uint8)
    place = np.frombuffer(head["c"], "<u4")
    codes = codes[np.where(place == NOT_SENT, len(codes) - 1, place)]
    counts = np.frombuffer(head["b"], "<u4").astype(np.int64)
    keys = np.frombuffer(head["a"], "<i8").reshape(2, -1)
    plain = np.frombuffer(head["d"], bool)
    ends = np.cumsum(counts)
    out = []
    for n, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
        own = codes[a:b]
        if own.any() or plain[n]:
            out.append((int(keys[0, n]), int(keys[1, n]), own.tobytes(), bool(plain[n] or (own >= 2).any())))
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.bool_()))],
                    names=["k1", "k2", "codes", "open"])


def _joined_codes(batches):
    """mapInArrow: the different code lists of one text -> one list. Of a row that blocks
    repeat, the block chosen to send a digest's windows has 3 and the others 1; both bits
    of every block count."""
    for batch in batches:
        codes = [lists[0] if len(lists) == 1 else np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in lists]).tobytes()
                 for lists in batch.column("lists").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(codes, pa.binary()), batch.column("open")],
                                         names=["k1", "k2", "codes", "open"])


def _send_windows(shape: Shape, n_buckets: int):
    """mapInArrow: texts with their triggers' codes -> per bucket the block's distinct open
    windows (fingerprints), per block the way back to its documents' windows."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for i, j, batch, data, offsets in _blocks(batches, BLOCK_BYTES):
            seq += 1
            block = f"{part}-{seq}"
            parse = Parse(data, offsets, shape)
            codes = np.frombuffer(b"".join(batch.column("codes")[i:j].to_pylist()), np.uint8)
            open_ = np.flatnonzero((codes >= 2) & parse.first)
            starts, classes = corpus_order(data, parse.at[open_], parse.least[open_], parse.most[open_], shape)
            # a window is out if a later trigger whose key lies in the window occurs nowhere else
            ahead = np.concatenate([[0], np.cumsum(codes == 0)])
            after = np.searchsorted(parse.at, starts + shape.trigger)
            until = np.searchsorted(parse.at, starts + shape.reach, side="right")
            keep = ahead[until] == ahead[np.minimum(after, until)]
            starts, classes = starts[keep], classes[keep]
            plain = parse.plain()
            classes = np.concatenate([classes, -1 - np.arange(len(plain))])
            starts = np.concatenate([starts, plain])
            by_start = np.argsort(starts, kind="stable")
            starts, classes = starts[by_start], classes[by_start]
            _, first, place, times = np.unique(classes, return_index=True, return_inverse=True, return_counts=True)
            in_order = np.argsort(first)  # classes by their first window
            number = np.empty(len(first), np.int64)
            number[in_order] = np.arange(len(first))
            first, times, place = first[in_order], times[in_order], number[place]
            a, b = fingerprints(data, starts[first], shape.length)
            bucket = (b % n_buckets).astype("<u2")
            k1, k2 = _keys_of(batch, i, j)
            rows = np.searchsorted(offsets, starts, side="right") - 1
            counts = np.bincount(rows, minlength=j - i).astype("<u4")
            again = np.ones(len(starts), dtype=bool)
            again[first] = False
            local = starts - offsets[rows]
            new = np.flatnonzero(np.concatenate([np.ones(min(1, len(local)), bool), (np.diff(local) != 1) | (np.diff(rows) != 0)]))
            runs = np.stack([local[new], np.diff(np.append(new, len(local)))]).astype("<u4")
            way = struct.pack("<Q", len(first)) + bucket.tobytes() + place[again].astype("<u4").tobytes()
            out = [(zlib.crc32(block.encode()) % n_buckets, block, True, k1 + k2, counts.tobytes(), runs.tobytes(), np.packbits(again).tobytes() + way)]
            order = np.argsort(bucket, kind="stable")
            a, b, times, bucket = a[order].astype("<u8"), b[order].astype("<u4"), (times[order] > 1).astype(np.uint8), bucket[order]
            ends = _split(n_buckets, bucket)
            out += [(k, block, False, a[x:y].tobytes(), b[x:y].tobytes(), times[x:y].tobytes(), None)
                    for k, (x, y) in enumerate(zip(ends[:-1], ends[1:])) if y > x]
            yield _batch(out)

    return run


def _way_back(packed: bytes, n: int) -> np.ndarray:
    """For each of a block's n windows, in order, the place of its answer."""
    size = -(-n // 8)
    again = np.unpackbits(np.frombuffer(packed, np.uint8, size), count=n).astype(bool)
    k = struct.unpack_from("<Q", packed, size)[0]
    bucket = np.frombuffer(packed, "<u2", k, size + 8)
    rank = np.empty(k, np.int64)
    rank[np.argsort(bucket, kind="stable")] = np.arange(k)
    number = np.empty(n, np.int64)
    number[~again] = np.arange(k)
    number[again] = np.frombuffer(packed, "<u4", offset=size + 8 + 2 * k)
    return rank[number]


def _judge_windows(key, table):
    """One bucket: which fingerprints occur more than once."""
    out, own = [], []
    for r in table.to_pylist():
        if r["info"]:
            out.append((r["block"], None, True, r["a"], r["b"], r["c"], r["d"]))
        else:
            own.append(r)
    if own:
        a, b, times = (np.concatenate([np.frombuffer(r[c], t) for r in own]) for c, t in (("a", "<u8"), ("b", "<u4"), ("c", np.uint8)))
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        more = times.copy()
        more[order[1:][same]] = 1
        more[order[:-1][same]] = 1
        at = 0
        for r in own:
            n = len(r["c"])
            out.append((r["block"], r["bucket"], False, more[at:at + n].tobytes(), None, None, None))
            at += n
    return _answer(out)


def _windows_of_docs(key, table):
    """One block: the starts of each document's repeated windows, as runs (first, last)."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["info"])
    answers = sorted((r for r in rows if not r["info"]), key=lambda r: r["bucket"])
    more = np.frombuffer(b"".join(r["a"] for r in answers), np.uint8)
    counts = np.frombuffer(head["b"], "<u4").astype(np.int64)
    first, length = np.frombuffer(head["c"], "<u4").astype(np.int64).reshape(2, -1)
    starts = np.repeat(first, length) + ragged(length)
    way = _way_back(head["d"], len(starts))
    keys = np.frombuffer(head["a"], "<i8").reshape(2, -1)
    ends, out = np.cumsum(counts), []
    for n, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
        own = starts[a:b][more[way[a:b]] == 1]
        if len(own):
            new = np.flatnonzero(np.concatenate([[True], np.diff(own) > 1]))
            runs = np.stack([own[new], own[np.append(new[1:], len(own)) - 1]], axis=1)
            out.append((int(keys[0, n]), int(keys[1, n]), runs.astype("<u4").tobytes()))
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["k1", "k2", "runs"])


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _remove(shape: Shape):
    """mapInArrow: texts with codes and runs of repeated windows -> removed spans, bytes kept."""

    def run(batches):
        for batch in batches:
            codes, runs = batch.column("codes").to_pylist(), batch.column("runs").to_pylist()
            for i, j, _, data, offsets in _blocks([batch], CHUNK):
                parse = None
                if any(codes[i:j]):
                    parse = Parse(data, offsets, shape)
                    ends = np.searchsorted(parse.row, np.arange(j - i), side="right")
                sizes, spans, kept = [], [], []
                for n in range(j - i):
                    begin, size = int(offsets[n]), int(offsets[n + 1] - offsets[n])
                    first, last = [], []
                    if codes[i + n]:
                        own = slice(ends[n - 1] if n else 0, ends[n])
                        sure = (np.frombuffer(codes[i + n], np.uint8) % 2 == 1) & parse.first[own]
                        first.append((parse.at[own] - parse.most[own])[sure] - begin)
                        last.append((parse.at[own] - parse.least[own])[sure] - begin)
                    if runs[i + n]:
                        pairs = np.frombuffer(runs[i + n], "<u4").reshape(-1, 2).astype(np.int64)
                        first.append(pairs[:, 0])
                        last.append(pairs[:, 1])
                    text = data[begin:begin + size]
                    sizes.append(size)
                    if not first or not sum(map(len, first)):
                        spans.append([])
                        kept.append(text.tobytes())
                        continue
                    a, b = np.concatenate(first), np.concatenate(last) + shape.length
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    new = np.concatenate([[True], a[1:] > b[:-1]])
                    a, b = a[new], b[np.append(np.flatnonzero(new)[1:], len(b)) - 1]
                    spans.append([{"first": int(x), "last": int(y) - 1} for x, y in zip(a, b)])
                    edges = np.concatenate([[0], np.stack([a, b], axis=1).ravel(), [size]])
                    kept.append(b"".join(text[x:y].tobytes() for x, y in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], pa.array(sizes, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary())],
                                                 names=["doc_id", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   trigger: int = TRIGGER, period: int = PERIOD) -> DataFrame:
    """doc_id, n_bytes, spans, kept, one row per input row.

    spans are the maximal removed runs of UTF-8 bytes (last inclusive), kept the remaining
    bytes (a cut may fall inside a character). Matches never cross documents; a document's
    own repeats count, and repeated rows are repeats of each other. Null text is empty, and
    texts shorter than ``length`` lose nothing. Null ids are kept. Blocks are named by scan
    order, so ``docs`` should be read from a table rather than from an unordered shuffle.
    """
    spark = docs.sparkSession
    shape = Shape(length, trigger, period)
    buckets = min(1 << 16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("k1"), F.xxhash64("text").alias("k2"))
    codes = materialize(
        rows.filter(F.octet_length("text") >= length).select("k1", "k2", "text").mapInArrow(frugal(_send_triggers(shape, buckets)), _PACKED)
        .groupBy("bucket").applyInArrow(_judge_triggers, _ANSWER)
        .groupBy("block").applyInArrow(_codes_of_docs, "k1 long, k2 long, codes binary, open boolean")
        .groupBy("k1", "k2").agg(F.collect_set("codes").alias("lists"), F.max("open").alias("open"))
        .mapInArrow(frugal(_joined_codes), "k1 long, k2 long, codes binary, open boolean"), "trigger-codes")
    runs = materialize(
        rows.select("k1", "k2", "text").join(codes.filter("open").select("k1", "k2", "codes"), ["k1", "k2"]).sortWithinPartitions("k1", "k2")
        .mapInArrow(frugal(_send_windows(shape, buckets)), _PACKED)
        .groupBy("bucket").applyInArrow(_judge_windows, _ANSWER)
        .groupBy("block").applyInArrow(_windows_of_docs, "k1 long, k2 long, runs binary")
        .dropDuplicates(["k1", "k2"]), "window-runs")
    found = codes.select("k1", "k2", "codes").join(runs, ["k1", "k2"], "full")
    return rows.join(found, ["k1", "k2"], "left").select("doc_id", "text", "codes", "runs").mapInArrow(
        frugal(_remove(shape)), "doc_id long, n_bytes long, spans array<struct<first:long,last:long>>, kept binary")


__all__ = ["Shape", "Parse", "triggers", "sorted_common", "corpus_order", "remove_repeats", "LENGTH"]
