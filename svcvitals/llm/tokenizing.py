"""Token ids of whole texts with the tokenizers library.

A byte-level BPE tokenizer works on pre-tokens, and the same pre-tokens come back millions
of times. Texts are cut where a pre-token ends whatever surrounds it; distinct cuts are
encoded by the library once and their ids are put together again. A cut takes cached ids
only where its bytes are those the ids were made from. Rows that hold the literal of an
added token (as ``<|endoftext|>``) go to the library whole, unless the literals are to be
ordinary text. The result is that of encoding the whole text.
"""

from __future__ import annotations

import os
import re

import numpy as np

from svcvitals.llm.bytecols import ragged, range_hashes, row_slices, same_ranges

#: Distinct cuts that a worker keeps (about 50 bytes each) before it starts afresh.
CACHE_ENTRIES = 1_000_000
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_PUNCT = np.array([33 <= b <= 126 and not a for b, a in enumerate(_ALNUM)])
_VISIBLE = np.array([33 <= b <= 126 for b in range(256)])
_LEAD2 = np.array([0xC3 <= b <= 0xDF for b in range(256)])  # two-byte characters, none of them white space
_PLAIN = re.compile(r" ?\S+")
_loaded: dict[tuple[str, bool], "CachedTokenizer"] = {}


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions where a pre-token starts in any context: row starts; the first ASCII space
    after a visible character or two-byte letter; what follows a lone line break or tab; and
    ASCII punctuation after an ASCII letter or digit."""
    n = len(data)
    start = np.zeros(n + 1, dtype=bool)
    start[offsets] = True
    if n > 1:
        space = _SPACE[data]
        solid = _VISIBLE[data].copy()  # the last byte of a character that is no white space
        solid[1:] |= (data[1:] >= 0x80) & _LEAD2[data[:-1]]
        start[1:n] |= space[1:] & solid[:-1]
        start[1:n] |= _PUNCT[data[1:]] & _ALNUM[data[:-1]]
        opens = _VISIBLE[data] | _LEAD2[data]
        start[2:n] |= opens[2:] & space[1:-1] & (data[1:-1] != 32) & solid[:-2]
    return np.flatnonzero(start[:n])


class _Cache:
    """Cut -> its ids, as an open-addressing table of hashes over one array of ids and one of
    the cuts' bytes (numpy)."""

    def __init__(self, dtype: str):
        self.dtype, self.mask = dtype, (1 << int(np.ceil(np.log2(CACHE_ENTRIES * 2)))) - 1
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.mask + 1, np.uint64)  # 0: free; a cut with hash 0 counts as 1
        self.entry = np.zeros(self.mask + 1, np.int32)
        self.starts, self.ids, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 18, self.dtype), 0
        self.byte_starts, self.bytes = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint8)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, or -1."""
        out = np.full(len(keys), -1, np.int32)
        slot = (keys & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            got = self.keys[slot]
            hit = got == keys[left]
            out[left[hit]] = self.entry[slot[hit]]
            more = ~hit & (got != 0)
            left, slot = left[more], (slot[more] + 1) & self.mask
        return out

    def holds(self, entry: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether each entry was made from the bytes data[start:end]."""
        return same_ranges(data, starts, ends, self.bytes, self.byte_starts[entry], self.byte_starts[entry + 1])

    @staticmethod
    def _appended(ends: np.ndarray, values: np.ndarray, n: int, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Cumulative ends and values with further parts behind the first n entries."""
        new = int(ends[n]) + np.cumsum([len(x) for x in parts])
        while n + len(parts) >= len(ends):
            ends = np.concatenate([ends, np.zeros_like(ends)])
        while new[-1] > len(values):
            values = np.concatenate([values, np.zeros_like(values)])
        values[ends[n]:new[-1]] = np.concatenate(parts)
        ends[n + 1:n + 1 + len(parts)] = new
        return ends, values

    def add(self, keys: np.ndarray, ids: list[np.ndarray], raw: list[bytes]) -> None:
        """Add distinct keys that are not there."""
        self.starts, self.ids = self._appended(self.starts, self.ids, self.n, ids)
        self.byte_starts, self.bytes = self._appended(self.byte_starts, self.bytes, self.n, [np.frombuffer(x, np.uint8) for x in raw])
        entry = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        self.n += len(keys)
        slot = (keys & np.uint64(self.mask)).astype(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.entry[slot[placed]] = entry[placed]
            keys, entry, slot = keys[~placed], entry[~placed], (slot[~placed] + 1) & self.mask


class CachedTokenizer:
    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.literals = [] if special_as_text else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 else None
        kinds = self.tokenizer.pre_tokenizer
        self.splits = self.newline is not None and type(kinds).__name__ == "ByteLevel" and not kinds.add_prefix_space and self.tokenizer.normalizer is None
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.cache = _Cache(self.dtype)

    @classmethod
    def load(cls, path: str, special_as_text: bool = False) -> "CachedTokenizer":
        """One tokenizer and cache for each worker process."""
        if (path, special_as_text) not in _loaded:
            _loaded[path, special_as_text] = cls(path, special_as_text)
        return _loaded[path, special_as_text]

    @property
    def dtype(self) -> str:
        return f"<u{self.width}"

    def _ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids of each cut."""
        out: list = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if _PLAIN.fullmatch(t)]
        for at in range(0, len(plain), 2000):  # a line break between plain cuts is a token of its own
            group = plain[at:at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join([texts[k] for k in group])], add_special_tokens=False)[0].ids, dtype=self.dtype)
            begin = 0
            for k, end in zip(group, np.append(np.flatnonzero(ids == self.newline), len(ids)).tolist()):
                out[k] = ids[begin:end]
                begin = end + 1
        rest = [k for k, x in enumerate(out) if x is None]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
            out[k] = np.array(e.ids, dtype=self.dtype)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows data[offsets[i]:offsets[i+1]], and each row's number of ids."""
        out, counts = [], np.zeros(len(offsets) - 1, np.int64)
        for i, j in row_slices(offsets):
            raw = data[offsets[i]:offsets[j]].tobytes()
            for a, b, whole in self._runs(raw, offsets[i:j + 1] - offsets[i]):
                encode = self._library if whole or not self.splits else self._encode
                ids, own = encode(data[offsets[i + a]:offsets[i + b]], offsets[i + a:i + b + 1] - offsets[i + a])
                out.append(ids)
                counts[i + a:i + b] = own
        return (np.concatenate(out) if out else np.zeros(0, self.dtype)), counts

    def _runs(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int, bool]]:
        """Runs of rows (a, b), and whether they hold an added token's literal."""
        marked = np.zeros(len(offsets) - 1, dtype=bool)
        for literal in self.literals:
            at = raw.find(literal)
            while at >= 0:
                marked[int(np.searchsorted(offsets, at, side="right")) - 1] = True
                at = raw.find(literal, at + 1)
        edges = [0, *(np.flatnonzero(np.diff(marked)) + 1).tolist(), len(marked)]
        return [(a, b, bool(marked[a])) for a, b in zip(edges, edges[1:])]

    def _library(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows encoded whole by the library."""
        raw = data.tobytes()
        got = self.tokenizer.encode_batch_fast([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], add_special_tokens=False)
        return np.concatenate([np.array(e.ids, dtype=self.dtype) for e in got]), np.array([len(e.ids) for e in got])

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(offsets) - 1, np.int64)
        starts = cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = np.maximum(range_hashes(data, starts, ends), np.uint64(1))
        entry = self.cache.find(hashes)
        if (entry < 0).any():
            if self.cache.n > CACHE_ENTRIES:
                self.cache.clear()
                entry[:] = -1
            new = np.flatnonzero(entry < 0)
            keys, first = np.unique(hashes[new], return_index=True)
            raw, at = data.tobytes(), new[first]
            own = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            self.cache.add(keys, self._ids_of([x.decode() for x in own]), own)
            entry[new] = self.cache.find(hashes[new])
        if not (same := self.cache.holds(entry, data, starts, ends)).all():  # another cut has this hash: its row goes whole
            rows = np.unique(np.searchsorted(offsets, starts[~same], side="right") - 1)
            return self._around(data, offsets, rows)
        begin = self.cache.starts[entry].astype(np.int64)
        n = self.cache.starts[entry + 1] - begin
        ids = self.cache.ids[np.repeat(begin, n) + ragged(n)]
        total = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(total[np.searchsorted(starts, offsets)])

    def _around(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The given rows by the library, the others as ever."""
        parts, at = [], 0
        for r in [*rows.tolist(), len(offsets) - 1]:
            if r > at:
                parts.append(self._encode(data[offsets[at]:offsets[r]], offsets[at:r + 1] - offsets[at]))
            if r < len(offsets) - 1:
                parts.append(self._library(data[offsets[r]:offsets[r + 1]], np.array([0, offsets[r + 1] - offsets[r]])))
            at = r + 1
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


__all__ = ["CachedTokenizer", "cuts"]
