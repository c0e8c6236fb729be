"""Cross-tokenizer alignment by pointer jumping.

Each text is encoded by two tokenizers, whose tokens both spell the same bytes. Tokens of
the two sequences that overlap belong together; a component of overlapping tokens ends
where a token of each ends at one byte. Components are found for whole batches of documents
at once: every token points to its farthest-right overlapping token, and the array of
successors is doubled (succ = succ[succ]) until it converges; each token then names the
last token of its component, which labels the group. Chains of overlaps are short in
common texts and may be as long as a document in others; doubling takes the logarithm.

What pairs of ids share an end is counted over the corpus: each block of documents
contributes its distinct pairs with their counts, so that a frequent pair costs a row per
block, and gets back the pairs' totals, with a mark where a pair is among the most
frequent of its second id.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from svcvitals.llm.bytecols import ragged, row_slices, string_bytes
from svcvitals.llm.columns import pick
from svcvitals.llm.tasks import frugal, frugal_cogroup
from svcvitals.llm.tokenizing import CachedTokenizer
from svcvitals.sources.tables import materialize

#: Bytes of text whose pairs are counted together.
BLOCK_BYTES = 4 << 20
_SPACE_PIECE = "▁"
_loaded: dict[str, "PieceTokenizer"] = {}


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1
    characters for themselves, the other bytes, in order, from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Bytes of each id, one after the other."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        sizes = self.sizes[ids]
        return self.bytes[np.repeat(self.starts[ids], sizes) + ragged(sizes)]


class ByteTokenizer:
    """A byte-level tokenizer of the tokenizers library; literals of special tokens are text."""

    def __init__(self, path: str):
        self.cached = CachedTokenizer.load(path, special_as_text=True)
        t, alphabet = self.cached.tokenizer, byte_level_alphabet()
        entries = [t.id_to_token(i) or "" for i in range(t.get_vocab_size())]
        self.vocabulary = Vocabulary([bytes(alphabet[c] for c in e) if all(c in alphabet for c in e) else e.encode() for e in entries])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.cached.encode(data, offsets)
        return ids.astype(np.int64), counts


class PieceTokenizer:
    """A sentencepiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.vocabulary = Vocabulary([self._bytes(i) for i in range(n)])

    @classmethod
    def load(cls, path: str) -> "PieceTokenizer":
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(_SPACE_PIECE, " ").encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.model.encode(texts, num_threads=1)
        counts = np.array([len(g) for g in got], dtype=np.int64)
        return np.concatenate([np.zeros(0, np.int64), *(np.array(g, dtype=np.int64) for g in got)]), counts


def farthest(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's farthest-right overlapping token. Tokens are numbered by end, those of a
    first: token i of a is i, token j of b is len(a) + j. Where both sequences end a token,
    that of a points to itself and that of b to it."""
    n = len(a_ends)
    to_b = np.searchsorted(b_ends, a_ends)  # the token of b that covers the last byte
    to_a = np.searchsorted(a_ends, b_ends)
    succ_a = np.where(b_ends[to_b] == a_ends, np.arange(n), n + to_b)
    return succ_a, to_a


def components(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The last token (of a) of each token's component, by pointer jumping; the sequences
    must end at the same byte."""
    succ = np.concatenate(farthest(a_ends, b_ends)) if len(a_ends) else np.zeros(0, np.int64)
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            return succ
        succ = further


_STORED = pa.schema([("block", pa.string()), ("docs", pa.binary()), ("packed", pa.binary()), ("pairs", pa.binary()), ("times", pa.binary())])
_STORED_TYPE = "block string, docs binary, packed binary, pairs binary, times binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value: their types and lengths, then their bytes."""
    head = ";".join(f"{x.dtype.str}{len(x)}" for x in arrays).encode()
    return zstandard.ZstdCompressor(level=3).compress(len(head).to_bytes(4, "little") + head + b"".join(x.tobytes() for x in arrays))


def unpack(packed: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    at, out = 4 + int.from_bytes(raw[:4], "little"), []
    for part in raw[4:at].decode().split(";"):
        out.append(np.frombuffer(raw, part[:3], int(part[3:]), at))
        at += out[-1].nbytes
    return out


def _narrow(vocabulary: Vocabulary) -> str:
    """The type of ids while they are stored and moved."""
    return "<u2" if len(vocabulary.sizes) <= 1 << 16 else "<u4"


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b


def align_rows(data: np.ndarray, offsets: np.ndarray, a: ByteTokenizer, b: PieceTokenizer):
    """Of each row: ids and group sizes of both sequences, each with the row's counts:
    (a_ids, a_counts, b_ids, b_counts, a_sizes, b_sizes, group_counts)."""
    sizes = np.diff(offsets)
    # " " + text of every row that is not empty
    led = np.where(sizes > 0, sizes + 1, 0)
    lead = np.concatenate([[0], np.cumsum(led)])
    spaced = np.full(lead[-1], 32, dtype=np.uint8)
    at = np.repeat((lead[:-1] + 1) - offsets[:-1], sizes) + np.arange(offsets[0], offsets[-1])
    spaced[at] = data[offsets[0]:offsets[-1]]
    raw = data[offsets[0]:offsets[-1]].tobytes()
    cut = (offsets - offsets[0]).tolist()
    a_ids, a_counts = a.encode(spaced, lead)
    b_ids, b_counts = b.encode([raw[i:j].decode() for i, j in zip(cut, cut[1:])])
    good = (led > 0) & _spells(a.vocabulary, a_ids, a_counts, spaced, lead) & _spells(b.vocabulary, b_ids, b_counts, spaced, lead)
    a_ids, b_ids = a_ids[np.repeat(good, a_counts)], b_ids[np.repeat(good, b_counts)]
    a_counts, b_counts = np.where(good, a_counts, 0), np.where(good, b_counts, 0)
    a_ends, b_ends = np.cumsum(a.vocabulary.sizes[a_ids]), np.cumsum(b.vocabulary.sizes[b_ids])
    label = components(a_ends, b_ends)
    last = np.flatnonzero(label[:len(a_ids)] == np.arange(len(a_ids)))  # of a, one for each group
    group = np.searchsorted(last, label)
    a_sizes, b_sizes = np.bincount(group[:len(a_ids)], minlength=len(last)), np.bincount(group[len(a_ids):], minlength=len(last))
    row_ends = np.cumsum(a_counts)
    groups = np.diff(np.concatenate([[0], np.searchsorted(last, row_ends)]))
    return a_ids, a_counts, b_ids, b_counts, a_sizes, b_sizes, groups


def _spells(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows whose ids' bytes are the row's bytes."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0], np.cumsum(vocabulary.sizes[ids])])
    same = total[ends] - total[ends - counts] == np.diff(offsets)
    if same.all():
        spelled = vocabulary.spelled(ids)
        wrong = np.flatnonzero(spelled != data)
        same[np.searchsorted(offsets, wrong, side="right") - 1] = False
        return same
    for r in range(len(counts)):
        if same[r]:
            same[r] = np.array_equal(vocabulary.spelled(ids[ends[r] - counts[r]:ends[r]]), data[offsets[r]:offsets[r + 1]])
    return same


def _encode(path_a: str, path_b: str):
    """mapInArrow: (doc_id, text) -> rows of aligned documents (about 1 MB of text, or one
    longer document, each), and a row with each block's distinct pairs and their counts."""

    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        a, b = ByteTokenizer(path_a), PieceTokenizer.load(path_b)
        types = _narrow(a.vocabulary), _narrow(b.vocabulary)
        part, seq, size, pairs = TaskContext.get().partitionId(), 0, 0, {}

        def close():
            nonlocal seq, size, pairs
            keys = np.array(sorted(pairs), dtype="<i8")
            times = np.array([pairs[k] for k in keys.tolist()], dtype="<i8")
            out = pa.RecordBatch.from_pylist([{"block": f"{part}-{seq}", "pairs": keys.tobytes(), "times": times.tobytes()}], schema=_STORED)
            seq, size, pairs = seq + 1, 0, {}
            return out

        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            known = np.array(batch.column("doc_id").is_valid())
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
            for i, j in row_slices(offsets):
                a_ids, a_counts, b_ids, b_counts, a_sizes, b_sizes, groups = align_rows(data, offsets[i:j + 1], a, b)
                linked, times = np.unique(pair_key(a_ids[np.cumsum(a_sizes) - 1], b_ids[np.cumsum(b_sizes) - 1]), return_counts=True)
                for k, t in zip(linked.tolist(), times.tolist()):
                    pairs[k] = pairs.get(k, 0) + t
                packed = pack(*(x.astype("<u4") for x in (a_counts, b_counts, groups)), a_ids.astype(types[0]), b_ids.astype(types[1]),
                              a_sizes.astype("<u4"), b_sizes.astype("<u4"))
                yield pa.RecordBatch.from_pylist([{"block": f"{part}-{seq}", "docs": pack(ids[i:j], known[i:j].astype("|u1")), "packed": packed}], schema=_STORED)
                size += int(offsets[j] - offsets[i]) + 64 * (j - i)
                if size >= BLOCK_BYTES:
                    yield close()
        if size:
            yield close()

    return run


def _pairs(batches):
    """mapInArrow: the packed pairs of blocks -> block, a_id, b_id, n."""
    for batch in batches:
        for block, pairs, times in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "times"))):
            keys, times = np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i8")
            for i in range(0, len(keys), 1 << 16):
                part = keys[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.string()), pa.array(part >> 32, pa.int64()), pa.array(part & 0xFFFFFFFF, pa.int64()),
                                                  pa.array(times[i:i + (1 << 16)], pa.int64())], names=["block", "a_id", "b_id", "n"])


def _cut(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    raw, w = values.tobytes(), values.itemsize
    ends = (np.cumsum(counts, dtype=np.int64) * w).tolist()
    return [raw[e - int(n) * w:e] for e, n in zip(ends, counts)]


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, a_ids binary, b_ids binary, a_sizes binary, b_sizes binary, groups string, n_best long, count_sum long"


def _counted(packed_forms: bool, text: bool):
    """One block: each document with the sums over its links of the pairs' totals."""

    def run(key, docs, totals):
        pairs = pair_key(totals.column("a_id").to_numpy(), totals.column("b_id").to_numpy())
        order = np.argsort(pairs)
        pairs, total, best = pairs[order], totals.column("total").to_numpy()[order], totals.column("best").to_numpy(zero_copy_only=False)[order].astype(bool)
        parts = []
        for about, packed in zip(docs.column("docs"), docs.column("packed")):
            ids, known = unpack(about.as_py())
            *counts, a_ids, b_ids, a_sizes, b_sizes = unpack(packed.as_py())
            at = np.searchsorted(pairs, pair_key(a_ids[np.cumsum(a_sizes, dtype=np.int64) - 1], b_ids[np.cumsum(b_sizes, dtype=np.int64) - 1]))
            ends = [np.cumsum(c, dtype=np.int64) for c in counts]
            begins = [e - c for e, c in zip(ends, counts)]
            sums = [np.concatenate([[0], np.cumsum(x[at].astype(np.int64))]) for x in (best, total)]
            cut = [_cut(x.astype("<u4"), counts[k]) if packed_forms else [None] * len(ids) for x, k in ((a_ids, 0), (b_ids, 1), (a_sizes, 2), (b_sizes, 2))]
            groups = [groups_text(a_ids[a:b], b_ids[c:d], a_sizes[e:f], b_sizes[e:f]) if text else None
                      for a, b, c, d, e, f in zip(*(x.tolist() for be in zip(begins, ends) for x in be))]
            parts.append(pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=known == 0), *[pa.array(c.astype(np.int64)) for c in counts], *[pa.array(c, pa.binary()) for c in cut], pa.array(groups, pa.string()),
                                                     *[pa.array(s[ends[2]] - s[begins[2]], pa.int64()) for s in sums]], names=_RESULT.replace(",", "").split()[::2]))
        return pa.Table.from_batches(parts)

    return run


def pair_totals(blocks: DataFrame) -> DataFrame:
    """a_id, b_id, total, best: how many links hold each pair of ids, and whether no pair
    with the same b_id has more. Partial sums are one row per block and pair."""
    sums = blocks.groupBy("a_id", "b_id").agg(F.sum("n").alias("total"))
    sums = materialize(sums, "pair-totals")
    most = sums.groupBy("b_id").agg(F.max("total").alias("most"))
    return sums.join(most, "b_id").select("a_id", "b_id", "total", (F.col("total") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", packed: bool = True, text: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, a_ids, b_ids, a_sizes, b_sizes, groups, n_best, count_sum, one row per input row.

    a_ids: ids of " " + text by the byte-level tokenizer at ``path_a``; b_ids: ids of text by
    the sentencepiece model at ``path_b``, which adds the space; a_sizes and b_sizes: how many
    tokens of each sequence every group holds, in order (all packed as little-endian unsigned
    32-bit integers; :func:`unpacked` and :func:`groups_text` read them). A group ends where
    tokens of both end at one byte; its last tokens are a link. n_best counts the links whose
    pair of ids is, corpus-wide, among the most frequent of its b id, count_sum adds up their
    pairs' corpus-wide counts.

    Texts that are null or empty, and texts that the tokens of either do not spell byte by
    byte, have no tokens: empty lists and zeros. Repeated rows count each. Rows with a null id
    keep it. An empty table gives no rows. ``docs`` should be read from a table: blocks are
    named by scan order.
    """
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stored = materialize(source.mapInArrow(frugal(_encode(path_a, path_b)), _STORED_TYPE), "aligned")
    blocks = stored.filter("pairs IS NOT NULL").select("block", "pairs", "times").mapInArrow(frugal(_pairs), "block string, a_id long, b_id long, n long")
    answers = blocks.join(pair_totals(blocks), ["a_id", "b_id"]).select("block", "a_id", "b_id", "total", "best")
    rows = stored.filter("packed IS NOT NULL").select("block", "docs", "packed")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(frugal_cogroup(_counted(packed, text)), _RESULT)


def unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4")


def groups_text(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group, in order."""
    a, b, out, i, j = a.tolist(), b.tolist(), [], 0, 0
    for m, n in zip(a_sizes.tolist(), b_sizes.tolist()):
        out.append((str(a[i]) if m == 1 else ",".join(map(str, a[i:i + m]))) + "|" + (str(b[j]) if n == 1 else ",".join(map(str, b[j:j + n]))))
        i, j = i + m, j + n
    return ";".join(out)


__all__ = ["align", "align_rows", "components", "farthest", "groups_text", "unpacked", "ByteTokenizer", "PieceTokenizer"]
