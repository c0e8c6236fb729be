"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are turned into integer weights. Candidates are packed into blocks that hold, for
every term (component), a posting list of rows and weights without zeros. A block of
queries is scored against a block of candidates term by term: each query weight is
scattered over the term's postings into a dense score array. A partition selection keeps
the k best of each array, and the blocks' bests are merged.

Every block of queries meets every block of candidates by an equi-join: candidate blocks
have a slot (hash modulo the number of slots), query blocks are sent once to each slot.
Tasks hold one block of each and the best k of a bounded number of query blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from svcvitals.llm.columns import pick
from svcvitals.llm.tasks import frugal
from svcvitals.sources.tables import materialize

BLOCK = 1024
QUERY_BLOCK = 256
HELD_QUERY_BLOCKS = 64
_PACKED = "n long, dim int, ids binary, weights binary"


def _pack(scale: float, block: int):
    """mapInArrow: (vec_id, vector) -> packed integer blocks; invalid vectors take no part."""

    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            lists = batch.column("vector")
            counts = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
            flat = lists.flatten()
            values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.array(lists.is_valid()) if len(lists) else np.zeros(0, bool)
            starts = np.concatenate([[0], np.cumsum(np.where(whole, counts, 0))])[:-1]
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            ends = starts + np.where(whole, counts, 0)
            good = whole & (bad[ends] == bad[starts])
            for dim in np.unique(counts[good]):
                rows = np.flatnonzero(good & (counts == dim))
                for at in range(0, len(rows), block):
                    r = rows[at:at + block]
                    x = np.floor(scale * values[starts[r][:, None] + np.arange(dim)])
                    top = float(1 << 63)
                    w = np.where(x >= top, (1 << 63) - 1, np.where(x < -top, -(1 << 63), np.clip(x, -top, top - 1024).astype(np.int64)))
                    yield pa.RecordBatch.from_pydict({
                        "n": pa.array([len(r)], pa.int64()), "dim": pa.array([int(dim)], pa.int32()),
                        "ids": pa.array([ids[r].astype("<i8").tobytes()], pa.binary()),
                        "weights": pa.array([np.ascontiguousarray(w.T).astype("<i8").tobytes()], pa.binary())})

    return run


def scores(query_weights: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Dense scores (queries x candidates); terms beyond the shorter vector count as 0."""
    acc = np.zeros((query_weights.shape[1], n), dtype=np.int64)
    for term in range(min(len(query_weights), len(postings))):
        rows, weights = postings[term]
        own = query_weights[term]
        some = np.flatnonzero(own)
        if len(rows) == n and len(some) == len(own):
            acc += np.multiply.outer(own, weights)
        elif len(rows) and len(some):
            acc[some[:, None], rows[None, :]] += np.multiply.outer(own[some], weights)
    return acc


def best(ids: np.ndarray, found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with their ids, ties to the smaller id."""
    if len(found) > k:
        least = np.partition(found, len(found) - k)[len(found) - k]
        keep = np.flatnonzero(found >= least)
        ids, found = ids[keep], found[keep]
    order = np.lexsort((ids, -found.astype(object) if (found == np.iinfo(np.int64).min).any() else -found))[:k]
    return ids[order], found[order]


def _search(k: int):
    """mapInArrow over joined blocks: the best k of each query among the task's candidates."""

    def run(batches):
        held: dict[bytes, dict[int, tuple[np.ndarray, np.ndarray]]] = {}

        def flush():
            rows = [(q, i, s) for per in held.values() for q, (ids, found) in per.items() for i, s in zip(ids.tolist(), found.tolist())]
            held.clear()
            if rows:
                q, i, s = zip(*rows)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                terms = np.frombuffer(row["weights"], "<i8").reshape(row["dim"], len(ids))
                postings = [(at, w[at]) for w in terms for at in (np.flatnonzero(w),)]
                queries = np.frombuffer(row["q_ids"], "<i8")
                weights = np.frombuffer(row["q_weights"], "<i8").reshape(row["q_dim"], len(queries))
                mine = held.setdefault(row["q_ids"], {})
                for at in range(0, len(queries), 32):
                    acc = scores(weights[:, at:at + 32], postings, len(ids))
                    for q, found in zip(queries[at:at + 32].tolist(), acc):
                        other = ids != q
                        had = mine.get(q)
                        top = best(ids[other], found[other], k)
                        mine[q] = top if had is None else best(np.concatenate([had[0], top[0]]), np.concatenate([had[1], top[1]]), k)
                if len(held) > HELD_QUERY_BLOCKS:
                    yield from flush()
        yield from flush()

    return run


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products.

    ``is_query`` is a Column over vec_id. Every row but those with the query's own id is a
    candidate. Components become floor(scale * x), x as double (beyond 64 bits: the nearest
    long); sums wrap as longs do. Null vectors, ids that are null, and vectors that hold a
    null or non-finite component take no part; an empty vector scores 0. Rows that repeat
    exactly count once; of different vectors under one id, the best scores are listed.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, vec_id=id_col, vector=vector_col).filter("vec_id IS NOT NULL")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")).distinct()
    rows = materialize(rows, "vectors")
    slots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    candidates = rows.mapInArrow(frugal(_pack(scale, BLOCK)), _PACKED).withColumn(
        "slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int"))
    queries = rows.filter(is_query).mapInArrow(frugal(_pack(scale, QUERY_BLOCK)), _PACKED).select(
        F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("weights").alias("q_weights"),
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    found = queries.join(candidates, "slot").select("q_dim", "q_ids", "q_weights", "dim", "ids", "weights").mapInArrow(
        frugal(_search(k)), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


__all__ = ["top_k", "scores", "best"]
