"""Token-ID output as length-delimited binary records.

Documents are range-partitioned by id, tokenised whole, and written in ascending id order
as record files in the shared folder. A record is framed as

    length      8 bytes, unsigned, little-endian
    checksum    4 bytes, masked CRC-32C of the length
    payload     id (8 bytes), flags (2; 1: null id), bytes per token (2), tokens (4), tokens
    checksum    4 bytes, masked CRC-32C of the payload

Beside each record file lies an index file (``.idx``): magic, number of records, and the
offset of each record and of the end as 8-byte integers, so that a reader can fetch records
in any order.

Files are written under names that no other attempt uses. Spark keeps the rows of the
attempts that succeed, and these rows, the manifest, are what readers go by: a lost
executor or a second attempt leaves at most files that no manifest names.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from svcvitals.llm.bytecols import row_slices, string_bytes
from svcvitals.llm.columns import pick
from svcvitals.llm.crc32c import crc32c, crc32c_rows, masked
from svcvitals.llm.files import open_fs
from svcvitals.llm.tokenizing import CachedTokenizer
from svcvitals.llm.tasks import frugal
from svcvitals.session import shared_dir
from svcvitals.sources.tables import materialize

HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<qHHI")
INDEX_MAGIC = b"TOKIDX01"
SHARD_BYTES = 256 << 20
READ_BYTES = 4 << 20
END_ID = 0
_MANIFEST = "part int, seq int, file string, n_records long, n_tokens long, n_bytes long"


def payload_head(doc: int | None, width: int, n: int) -> bytes:
    return PAYLOAD.pack(doc or 0, doc is None, width, n)


class RecordWriter:
    """One record file with its index."""

    def __init__(self, uri: str):
        self.uri = uri
        system, path = open_fs(uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.offsets, self.n_tokens = system.open_output_stream(path), [0], 0

    def write(self, payloads: list[bytes]) -> None:
        joined = np.frombuffer(b"".join(payloads), np.uint8)
        ends = np.cumsum([len(p) for p in payloads])
        lengths = np.diff(ends, prepend=0).astype("<u8")
        heads = masked(crc32c_rows(lengths.view(np.uint8).reshape(-1, 8))).tolist()
        tails = masked(crc32c(joined, ends - lengths.astype(np.int64), ends)).tolist()
        frames = []
        for payload, head, tail in zip(payloads, heads, tails):
            frames += [HEAD.pack(len(payload), head), payload, tail.to_bytes(4, "little")]
            self.offsets.append(self.offsets[-1] + HEAD.size + len(payload) + 4)
        self.out.write(b"".join(frames))

    def close(self) -> None:
        self.out.close()
        system, path = open_fs(self.uri + ".idx")
        with system.open_output_stream(path) as out:
            out.write(INDEX_MAGIC + struct.pack("<Q", len(self.offsets) - 1) + np.array(self.offsets, "<u8").tobytes())


def read_index(uri: str) -> np.ndarray:
    """Offsets of a record file's records and of its end."""
    system, path = open_fs(uri + ".idx")
    with system.open_input_file(path) as f:
        data = f.read()
    if data[:8] != INDEX_MAGIC:
        raise ValueError(f"not a record index: {uri}.idx")
    return np.frombuffer(data, "<u8", offset=16, count=struct.unpack_from("<Q", data, 8)[0] + 1).astype(np.int64)


def parse(data: bytes, offsets: np.ndarray) -> list[tuple[int | None, np.ndarray]]:
    """The records of data that start at offsets[:-1]; raises where a checksum is wrong."""
    raw = np.frombuffer(data, np.uint8)
    starts, ends = offsets[:-1], offsets[1:]
    if not len(starts):
        return []
    heads = raw[starts[:, None] + np.arange(HEAD.size)]
    lengths = np.ascontiguousarray(heads[:, :8]).view("<u8")[:, 0]
    if (masked(crc32c_rows(heads[:, :8])) != np.ascontiguousarray(heads[:, 8:]).view("<u4")[:, 0]).any() or (lengths.astype(np.int64) != ends - starts - HEAD.size - 4).any():
        raise ValueError("a record's length does not agree with its checksum or the index")
    a, b = starts + HEAD.size, ends - 4
    if (masked(crc32c(raw, a, b)) != np.ascontiguousarray(raw[b[:, None] + np.arange(4)]).view("<u4")[:, 0]).any():
        raise ValueError("a record's payload does not agree with its checksum")
    out = []
    for at in a.tolist():
        doc, flags, width, n = PAYLOAD.unpack_from(data, at)
        out.append((None if flags & 1 else doc, np.frombuffer(data, f"<u{width}", count=n, offset=at + PAYLOAD.size)))
    return out


def read_records(uri: str, which=None):
    """The records of a file: all in order, read in stretches, or those numbered ``which``."""
    offsets = read_index(uri)
    system, path = open_fs(uri)
    with system.open_input_file(path) as f:
        if which is not None:
            for k in which:
                a, b = int(offsets[k]), int(offsets[k + 1])
                yield from parse(f.read_at(b - a, a), np.array([0, b - a]))
            return
        for i, j in row_slices(offsets, READ_BYTES):
            a, b = int(offsets[i]), int(offsets[j])
            yield from parse(f.read_at(b - a, a), offsets[i:j + 1] - a)


def _write(folder: str, tokenizer_path: str, end_id: int, shard_bytes: int):
    """mapInArrow over sorted rows of one range: writes record files, yields their manifest rows."""

    def run(batches):
        tokenizer = CachedTokenizer.load(tokenizer_path)
        part = TaskContext.get().partitionId()
        writer, seq, done = None, 0, []

        def finish():
            writer.close()
            done.append((part, seq, writer.uri, len(writer.offsets) - 1, writer.n_tokens, writer.offsets[-1]))

        for batch in batches:
            ids = batch.column("doc_id")
            data, offsets = string_bytes(batch.column("text"))
            for i, j in row_slices(offsets):
                tokens, counts = tokenizer.encode(data, offsets[i:j + 1])
                ends = np.cumsum(counts)
                end = np.array([end_id], dtype=tokens.dtype).tobytes()
                payloads = []
                for doc, a, b in zip(ids[i:j].to_pylist(), (ends - counts).tolist(), ends.tolist()):
                    payloads.append(payload_head(doc, tokenizer.width, b - a + 1) + tokens[a:b].tobytes() + end)
                if writer is None:
                    writer = RecordWriter(f"{folder}/tokens-{part:05d}-{seq:04d}-{uuid.uuid4().hex}.rec")
                writer.write(payloads)
                writer.n_tokens += len(tokens) + len(counts)
                if writer.offsets[-1] >= shard_bytes:
                    finish()
                    writer, seq = None, seq + 1
        if writer is not None:
            finish()
        names = ("part", "seq", "file", "n_records", "n_tokens", "n_bytes")
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names=list(names))

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the token records of all documents; the manifest, one row per file.

    Rows go in ascending id order, null ids first; rows that share an id in the order of a
    hash of their text. Null text is empty: its record holds the end id alone. Special
    tokens written out in a text are ordinary text. The manifest has part and seq (the
    files' order), file, n_records, n_tokens, n_bytes and start (tokens in earlier files).
    """
    folder = folder or shared_dir(docs.sparkSession, "tokens")
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    files = materialize(ordered.mapInArrow(frugal(_write(folder, tokenizer_path, end_id, shard_bytes)), _MANIFEST), "token-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def _read(batches):
    for batch in batches:
        for row in batch.to_pylist():
            start, docs, starts, counts, ids, held = row["start"], [], [], [], [], 0
            for doc, tokens in read_records(row["file"]):
                docs.append(doc)
                starts.append(start)
                counts.append(len(tokens))
                ids.append(tokens.astype("<u4").tobytes())
                start += len(tokens)
                held += len(tokens)
                if held >= READ_BYTES:
                    yield _tokens(docs, starts, counts, ids)
                    docs, starts, counts, ids, held = [], [], [], [], 0
            yield _tokens(docs, starts, counts, ids)


def _tokens(docs, starts, counts, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                                      names=["doc_id", "start", "n_tokens", "ids"])


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every record, checksums verified.

    One task reads one file, in stretches of a few MB.
    """
    files = manifest.select("part", "seq", "file", "n_bytes", "start")
    n = max(1, files.count())
    return files.repartitionByRange(n, "part", "seq").mapInArrow(frugal(_read), "doc_id long, start long, n_tokens long, ids binary")


__all__ = ["RecordWriter", "read_index", "read_records", "parse", "write_tokens", "read_tokens", "END_ID"]
