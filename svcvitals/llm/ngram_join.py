"""N-gram Jaccard join of documents, by signature trees.

1. Each text becomes the set of its word n-grams (64-bit hashes). Copies of one set form a
   class, named by a 128-bit digest; its smallest document stands for it.
2. A linked set shares at least ``percent`` of its tokens with another one. Blocks of
   documents send their tokens, packed per bucket, to where each token's repeats are
   counted, and get back how many of each document's tokens occur elsewhere; classes with
   too few are alone.
3. Of the remaining classes (a small part of a corpus), tokens are ordered by how many
   classes hold them, rarest first. Linked sets share one of the first
   n - ceil(percent n / 100) + 1 tokens (prefix filter). Stars over those tokens give
   coarse groups: no link leaves a group.
4. Inside a group, signature trees (:mod:`svcvitals.llm.signature_tree`) are traversed in
   pairs and what they cannot exclude is compared exactly. Small groups share a task; a
   group beyond ``TILE`` classes is dealt into chunks. Every chunk is joined with the
   first; where that leaves classes apart, those outside the largest part are joined with
   every chunk. So a group of near copies costs tasks in proportion to its size.

A component needs no more links than connect it, so pairs that are connected already are
not compared; every document pair that links is connected in the result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from svcvitals.llm.bytecols import mixed, ragged, row_slices, rows_of, string_bytes, words
from svcvitals.llm.columns import pick
from svcvitals.llm.components import components
from svcvitals.llm.signature_tree import SignatureTree, Union, connect
from svcvitals.llm.tasks import frugal
from svcvitals.sources.tables import materialize

N = 4
PERCENT = 85
BLOCK_BYTES = 8 << 20
BLOCK_TOKENS = 1 << 21
TILE = 512
BUNDLE = 2000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each row, sorted: all hashes one after the other, and their number
    per row. A row of fewer words is one gram of all of them; without words it has none."""
    starts, _, h = words(data, offsets)
    rows = rows_of(starts, offsets)
    n_words = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(n_words) - n_words
    grams = np.maximum(n_words - n + 1, (n_words > 0).astype(np.int64))
    at = np.repeat(first, grams) + ragged(grams)
    gram = np.zeros(len(at), dtype=np.uint64)
    length = np.repeat(np.minimum(n_words, n), grams)
    for k in range(n):
        inside = length > k
        gram[inside] = mixed(gram[inside] + _STEP) + h[at[inside] + k]
    gram = mixed(gram + length.astype(np.uint64))
    row = np.repeat(np.arange(len(n_words)), grams)
    order = np.lexsort((gram, row))
    gram, row = gram[order], row[order]
    new = np.ones(len(gram), dtype=bool)
    new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    return gram[new], np.bincount(row[new], minlength=len(n_words))


def set_digests(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 bits for each set of distinct grams, whatever their order; (rows, 2) unsigned."""
    out = np.zeros((len(counts), 2), dtype=np.uint64)
    ends = np.cumsum(counts)
    for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams ^ np.uint64(salt)), dtype=np.uint64)])
        out[:, k] = mixed(total[ends] - total[ends - counts] + counts.astype(np.uint64))
    return out


# --- packed exchange: a block of documents sends each bucket one row of tokens ---------

_PACKED = "bucket int, block string, info boolean, a binary, b binary, c binary"
_PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.string()), ("info", pa.bool_()),
                           ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_ANSWER = "block string, info boolean, a binary, b binary, c binary"
_ANSWER_ARROW = pa.schema([("block", pa.string()), ("info", pa.bool_()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _deal(block: str, grams: np.ndarray, counts: np.ndarray, n_buckets: int, info: tuple[bytes, bytes, bytes], token_type: str) -> pa.RecordBatch:
    """One row per bucket (tokens in document order, tokens per document) and one of info."""
    bucket = ((grams & np.uint64(0xFFFFFFFF)) % np.uint64(n_buckets)).astype(np.uint32)
    doc = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(bucket, kind="stable")
    sent = (grams >> np.uint64(32)).astype("<u4") if token_type == "<u4" else grams.astype("<u8")
    sent, doc, bucket = sent[order], doc[order], bucket[order]
    ends = np.searchsorted(bucket, np.arange(n_buckets + 1))
    rows = [(zlib.crc32(block.encode()) % n_buckets, block, True, *info)]
    for k in range(n_buckets):
        a, b = ends[k], ends[k + 1]
        if b > a:
            rows.append((k, block, False, sent[a:b].tobytes(), np.bincount(doc[a:b], minlength=len(counts)).astype("<u4").tobytes(), None))
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _PACKED_ARROW)], schema=_PACKED_ARROW)


def _scan(n: int, n_buckets: int):
    """mapInArrow: documents -> packed blocks of truncated tokens, with ids, sizes, digests."""

    def run(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal seq, held, size
            ids, grams, counts, digests = (np.concatenate(x) for x in zip(*held))
            info = (ids.astype("<i8").tobytes(), counts.astype("<i8").tobytes(), digests.astype("<u8").tobytes())
            seq, held, size = seq + 1, [], 0
            return _deal(f"{part}-{seq}", grams, counts, n_buckets, info, "<u4")

        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j in row_slices(offsets):
                grams, counts = shingles(data, offsets[i:j + 1], n)
                held.append((ids[i:j], grams, counts, set_digests(grams, counts)))
                size += int(offsets[j] - offsets[i]) + 64 * (j - i)
                if size >= BLOCK_BYTES:
                    yield flush()
        if held:
            yield flush()

    return run


def _bucket_rows(table: pa.Table):
    """(info rows, [block, tokens, counts] of the others) of one bucket."""
    info, own = [], []
    for r in table.to_pylist():
        if r["info"]:
            info.append((r["block"], True, r["a"], r["b"], r["c"]))
        else:
            own.append((r["block"], r["a"], np.frombuffer(r["b"], "<u4").astype(np.int64)))
    return info, own


def _answer(rows) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ANSWER_ARROW)], schema=_ANSWER_ARROW)


def _count_repeats(key, table):
    """One bucket: for each block, how many of each document's tokens occur more than once."""
    info, own = _bucket_rows(table)
    if own:
        tokens = np.concatenate([np.frombuffer(a, "<u4") for _, a, _ in own])
        order = np.argsort(tokens)
        ranked = tokens[order]
        same = ranked[1:] == ranked[:-1]
        more = np.zeros(len(tokens), dtype=bool)
        more[order[1:][same]] = True
        more[order[:-1][same]] = True
        total, at = np.concatenate([[0], np.cumsum(more)]), 0
        for block, _, counts in own:
            ends = at + np.cumsum(counts)
            info.append((block, False, (total[ends] - total[ends - counts]).astype("<u4").tobytes(), None, None))
            at = int(ends[-1])
    return _answer(info)


def _docs_of_block(key, table):
    """One block: id, size, digest and number of repeated tokens of each document."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["info"])
    ids = np.frombuffer(head["a"], "<i8")
    repeats = np.zeros(len(ids), np.int64)
    for r in rows:
        if not r["info"]:
            repeats += np.frombuffer(r["a"], "<u4")
    digests = [head["c"][k:k + 16] for k in range(0, len(head["c"]), 16)]
    return pa.table({"doc_id": ids, "n": np.frombuffer(head["b"], "<i8"), "cid": pa.array(digests, pa.binary()), "repeats": repeats})


def _sets(n: int):
    """mapInArrow: texts of candidate classes -> their sets; other texts under the id are dropped."""

    def run(batches):
        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            cids, nodes = batch.column("cid").to_pylist(), batch.column("class_id").to_pylist()
            for i, j in row_slices(offsets):
                grams, counts = shingles(data, offsets[i:j + 1], n)
                digests = set_digests(grams, counts).astype("<u8")
                ends = np.cumsum(counts)
                rows = [(x, grams[e - k:e].astype("<u8").tobytes())
                        for x, c, k, e, d in zip(nodes[i:j], cids[i:j], counts.tolist(), ends.tolist(), digests) if d.tobytes() == c]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["node", "grams"])

    return run


def _deal_sets(n_buckets: int):
    """mapInArrow: stored sets -> packed blocks of whole tokens."""

    def run(batches):
        part, seq, nodes, sets, size = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            nonlocal seq, nodes, sets, size
            counts = np.array([len(s) for s in sets], dtype=np.int64)
            made = _deal(f"{part}-{seq}", np.concatenate(sets), counts, n_buckets, (np.array(nodes, "<i8").tobytes(), None, None), "<u8")
            seq, nodes, sets, size = seq + 1, [], [], 0
            return made

        for batch in batches:
            for node, grams in zip(batch.column("node").to_pylist(), batch.column("grams").to_pylist()):
                nodes.append(node)
                sets.append(np.frombuffer(grams, "<u8"))
                size += len(sets[-1])
                if size >= BLOCK_TOKENS:
                    yield flush()
        if nodes:
            yield flush()

    return run


def _count_classes(key, table):
    """One bucket: the number of classes that hold each token (255: so many or more)."""
    info, own = _bucket_rows(table)
    if own:
        tokens = np.concatenate([np.frombuffer(a, "<u8") for _, a, _ in own])
        _, place, times = np.unique(tokens, return_inverse=True, return_counts=True)
        rank = np.minimum(times[place], 255).astype(np.uint8)
        at = 0
        for block, sent, counts in own:
            size = len(sent) // 8
            info.append((block, False, sent, counts.astype("<u4").tobytes(), rank[at:at + size].tobytes()))
            at += size
    return _answer(info)


def _prefixes(percent: int):
    """One block of classes: the prefix tokens of each that other classes hold too."""

    def run(key, table):
        rows = table.to_pylist()
        nodes = np.frombuffer(next(r for r in rows if r["info"])["a"], "<i8")
        parts = [r for r in rows if not r["info"]]
        tokens = np.concatenate([np.frombuffer(r["a"], "<u8") for r in parts])
        rank = np.concatenate([np.frombuffer(r["c"], np.uint8) for r in parts])
        doc = np.concatenate([np.repeat(np.arange(len(nodes)), np.frombuffer(r["b"], "<u4")) for r in parts])
        order = np.lexsort((tokens, rank, doc))
        tokens, rank, doc = tokens[order], rank[order], doc[order]
        size = np.bincount(doc, minlength=len(nodes))
        place = ragged(size)
        keep = (place < np.repeat(size - (-(-percent * size // 100)) + 1, size)) & (rank > 1)
        return pa.table({"token": tokens[keep].view("<i8"), "node": nodes[doc[keep]]})

    return run


# --- joining the groups --------------------------------------------------------------------

_LABEL = "node long, root long"


def _tree_order(nodes: list[int], sets: list[np.ndarray]) -> list[int]:
    """Similar sets side by side: by smallest token, then size."""
    return sorted(range(len(sets)), key=lambda k: (int(sets[k][0]), len(sets[k]), nodes[k]))


def _join_tile(percent: int):
    """One tile (or bundle of small groups): each class with the smallest it is connected to.

    Rows with side 0 are joined with each other and with side 1; rows of side 1 are not
    joined among themselves (another tile does that). ``label`` marks what is connected.
    """

    def run(key, table):
        groups: dict = {}
        for r in table.to_pylist():
            groups.setdefault(r["grp"], []).append(r)
        found = []
        for rows in groups.values():
            sides = ([], [])
            for r in rows:
                sides[r["side"]].append(r)
            nodes, labels, trees = [], [], []
            for side in sides:
                sets = [np.frombuffer(r["grams"], "<u8") for r in side]
                order = _tree_order([r["node"] for r in side], sets)
                nodes += [side[k]["node"] for k in order]
                labels += [side[k]["label"] for k in order]
                trees.append(SignatureTree([sets[k] for k in order]))
            union, seen = Union(len(nodes)), {}
            for k, label in enumerate(labels):
                union.join(k, seen.setdefault(label, k))
            own = len(trees[0].sets)
            if own:
                connect(trees[0], trees[0], union, 0, 0, percent)
            if own and trees[1].sets:
                connect(trees[0], trees[1], union, 0, own, percent)
            least: dict = {}
            roots = union.roots().tolist()
            for node, root in zip(nodes, roots):
                least[root] = min(node, least.get(root, node))
            found += [(node, least[root]) for node, root in zip(nodes, roots)]
        return pa.table({"node": pa.array([f[0] for f in found], pa.int64()), "root": pa.array([f[1] for f in found], pa.int64())})

    return run


def _labels(sets: DataFrame, coarse: DataFrame, percent: int, tile: int) -> DataFrame:
    """node, component of the classes in coarse groups.

    sets: node, grams; coarse: node, component.
    """
    sizes = coarse.groupBy("component").agg(F.count(F.lit(1)).alias("members")).select(
        F.col("component").alias("grp"), F.ceil(F.col("members") / tile).cast("int").alias("chunks"))
    rows = materialize(sets.join(coarse.withColumnRenamed("component", "grp"), "node").join(sizes, "grp").select(
        "node", "grp", "grams", "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")), "join-groups")
    # every chunk with the first; groups of one chunk are bundled and done then
    n_bundles = max(1, rows.count() // BUNDLE)
    small = rows.filter("chunks = 1").select(
        F.format_string("s%d", F.pmod(F.xxhash64("grp"), F.lit(n_bundles))).alias("tile"), "grp", "node", "grams", F.lit(0).alias("side"))
    large = rows.filter("chunks > 1").withColumn("to", F.when(F.col("chunk") == 0, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk")))
    large = large.select("*", F.explode("to").alias("t")).select(
        F.concat_ws("-", "grp", "t").alias("tile"), "grp", "node", "grams", (F.col("t") != F.col("chunk")).cast("int").alias("side"))
    first = materialize(small.unionByName(large).withColumn("label", F.col("node")).groupBy("tile").applyInArrow(_join_tile(percent), _LABEL), "roots")
    beyond = rows.filter("chunks > 1").select("node", "grp", "chunks", "chunk")
    if not beyond.head(1):
        return first.select("node", F.col("root").alias("component"))
    # large groups: what the first chunk connects; then classes outside the largest part meet every chunk
    in_large = first.join(beyond.select("node"), "node", "left_semi").select(F.col("node").alias("a"), F.col("root").alias("b"))
    parts = components(in_large).select("node", F.col("component").alias("label"))
    known = materialize(beyond.join(parts, "node", "left").withColumn("label", F.coalesce("label", "node")), "large-groups")
    counts = known.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("k"))
    main = counts.groupBy("grp").agg(F.max(F.struct("k", "label"))["label"].alias("main"), F.sum("k").alias("all"), F.max("k").alias("most"))
    main = main.filter("most < all").withColumn("pieces", F.ceil((F.col("all") - F.col("most")) / tile).cast("int"))
    known_sets = known.join(main, "grp").join(rows.select("node", "grams"), "node").withColumn(
        "piece", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("pieces")).cast("int"))
    known_sets = materialize(known_sets, "join-rest")
    edges = known.select(F.col("node").alias("a"), F.col("label").alias("b"))
    if known_sets.head(1):
        rest = known_sets.filter("label <> main").select("grp", "node", "grams", "label", F.lit(0).alias("side"), "piece",
                                                         F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("c"))
        others = known_sets.select("grp", "node", "grams", "label", F.lit(1).alias("side"),
                                   F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.col("chunk").alias("c"))
        tiles = rest.unionByName(others).withColumn("tile", F.concat_ws("-", "grp", "piece", "c"))
        more = tiles.select("tile", "grp", "node", "grams", "side", "label").groupBy("tile").applyInArrow(_join_tile(percent), _LABEL)
        edges = components(edges.unionByName(more.select(F.col("node").alias("a"), F.col("root").alias("b")))).select(
            F.col("node").alias("a"), F.col("component").alias("b"))
    done = first.join(beyond.select("node"), "node", "left_anti").select("node", F.col("root").alias("component"))
    return done.unionByName(edges.select(F.col("a").alias("node"), F.col("b").alias("component")))


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, one row per input row.

    Documents link when 100 * |A & B| >= percent * |A | B| over their sets of word n-grams;
    component_id is the smallest document reachable by links (itself included), class_id the
    smallest with the same set. Documents without words link with nothing. Repeated rows of
    one id get the same row again; rows of one id with different texts are classes of their
    own, and classes with the same smallest document are one node. Rows with a null id keep null ids and link with nothing. Blocks are named by scan
    order, so ``docs`` should be read from a table rather than from an unordered shuffle.
    """
    spark = docs.sparkSession
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = materialize(
        source.filter("doc_id IS NOT NULL").mapInArrow(frugal(_scan(n, buckets)), _PACKED).groupBy("bucket").applyInArrow(_count_repeats, _ANSWER)
        .groupBy("block").applyInArrow(_docs_of_block, "doc_id long, n long, cid binary, repeats long"), "shingle-counts")
    classes = materialize(table.filter("n > 0").groupBy("cid").agg(
        F.min("doc_id").alias("class_id"), F.max("n").alias("n"), F.max("repeats").alias("repeats")), "classes")
    candidates = classes.filter(F.col("repeats") * 100 >= F.col("n") * percent).select("cid", F.col("class_id").alias("doc_id"))
    texts = source.join(candidates, "doc_id").select(F.col("doc_id").alias("class_id"), "cid", "text")
    sets = materialize(texts.mapInArrow(frugal(_sets(n)), "node long, grams binary").dropDuplicates(["node", "grams"]), "sets")
    shared = materialize(sets.mapInArrow(frugal(_deal_sets(buckets)), _PACKED).groupBy("bucket").applyInArrow(_count_classes, _ANSWER)
                         .groupBy("block").applyInArrow(_prefixes(percent), "token long, node long"), "prefixes")
    hubs = shared.groupBy("token").agg(F.min("node").alias("hub"))
    coarse = materialize(components(shared.join(hubs, "token").select(F.col("node").alias("a"), F.col("hub").alias("b"))), "coarse")
    named = _labels(sets, coarse, percent, tile).groupBy("node").agg(F.min("component").alias("component_id"))
    of_class = classes.select("cid", "class_id").join(named.withColumnRenamed("node", "class_id"), "class_id", "left")
    result = table.join(of_class, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "class_id", "doc_id").alias("component_id"))
    lost = source.filter("doc_id IS NULL")
    nulls = lost.mapInArrow(frugal(_sizes(n)), "n_shingles long").select(
        F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("component_id"))
    return result.unionByName(nulls)


def _sizes(n: int):
    def run(batches):
        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            for i, j in row_slices(offsets):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(data, offsets[i:j + 1], n)[1].astype(np.int64))], names=["n_shingles"])

    return run


__all__ = ["join_documents", "shingles", "set_digests", "N", "PERCENT"]
