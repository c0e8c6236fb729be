"""Mixing sources to target weights, DataFrame functions only.

Tokens are aggregated per source; a source's repetition rate is its target over its
tokens. Each document is taken floor(rate) times, plus one copy when a hash of its id, its
text and the source's seed falls below the rate's fraction (a Bernoulli draw that reruns
repeat; rows that share an id, as null ids, draw apart where their texts differ).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from svcvitals.llm.columns import pick, word_count
from svcvitals.sources.tables import materialize

#: Weights of the sources in code-point order, null last, repeated as often as needed.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
N_SEEDS = 32


def text_hash(text: Column) -> Column:
    """What a row's draw takes of its text; null and empty texts differ."""
    return F.xxhash64(F.lit("mix"), text)


def draw(id_col: Column, hashed: Column, seed: Column) -> Column:
    """A number in [0, 1) from the id, the text's hash and the (int) seed; the same in each run."""
    return F.shiftrightunsigned(F.xxhash64(seed, id_col, hashed), 11).cast("double") / float(1 << 53)


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size -> the same with weight, target and rate.

    Targets sum to share * all sizes, in proportion to the weights, and none is above cap *
    its source's size: target = min(cap * size, level * weight). With the sources sorted by
    cap * size / weight, the first k are at their cap; the level is found where what the
    others get by weight reaches no cap. One row per source takes part in these windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.select("source", "source_size",
                            F.array(*[F.lit(float(w)) for w in weights])[
                                ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")].alias("weight"))
    limit = F.col("source_size") * F.lit(float(cap))
    by_ratio = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    levels = ranked.select("*", limit.alias("most"), (
        (total - F.coalesce(F.sum(limit).over(earlier), F.lit(0.0))) / F.sum("weight").over(later)).alias("level"))
    levels = levels.select("*", F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(
        F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("level")))
        ).over(everything)["level"].alias("common"))
    target = F.least("most", F.coalesce(F.col("common") * F.col("weight"), F.col("most")))
    return levels.select("source", "source_size", "weight", target.alias("target"),
                         F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def _with_sources(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's row; null is a source too. Left to the planner: the sources'
    table is broadcast where it is small."""
    sources = sources.withColumnRenamed("source", "own_source")
    return df.join(sources, F.col("source").eqNullSafe(F.col("own_source"))).drop("own_source")


def _copies(seed: Column) -> Column:
    """Copies of a row with doc_id, text_hash and its source's rate, for a seed column."""
    fraction = F.col("rate") - F.floor("rate")
    return (F.floor("rate") + (draw(F.col("doc_id"), F.col("text_hash"), seed) < fraction).cast("long")).cast("long")


def plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, n_seeds: int = N_SEEDS) -> DataFrame:
    """source, source_size, weight, target, rate, seed from rows (doc_id, source, text_hash, size).

    Of n_seeds hash seeds, each source gets the one whose draws come nearest to its target:
    all are summed in one aggregation with map-side combine, so a hot source costs one
    partial row per task.
    """
    targets = materialize(source_targets(sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")),
                                         weights, share, cap), "mix-targets")
    drawn = _with_sources(sized, targets).groupBy("source").agg(
        *[F.sum(F.col("size") * _copies(F.lit(k))).alias(f"s{k}") for k in range(n_seeds)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"s{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(n_seeds)]))
    seeds = _with_sources(drawn, targets).select("source", "source_size", "weight", "target", "rate", nearest["seed"].alias("seed"))
    return materialize(seeds, "mix-plan")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, text_hash, size, written once: texts are read once and never shuffled."""
    return materialize(pick(docs, doc_id=id_col, source=source_col, text=text_col).select(
        "doc_id", "source", text_hash(F.col("text")).alias("text_hash"), word_count(F.col("text")).alias("size")), "mix-sizes")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken, one row per input row.

    Null text: size 0. Null source: a source of its own, last in order. Rows of equal id
    and text draw alike. A source without words: target and rate 0, so none of it is taken. Empty tables
    give no rows. Options: weights, share, cap, n_seeds (see :func:`plan`).
    """
    sized = _sized(docs, id_col, text_col, source_col)
    return _with_sources(sized, plan(sized, **options)).withColumn("copies", _copies(F.col("seed"))).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the input's rows and columns, each row as often as it is taken."""
    names = docs.columns
    kept = [f"k{i}" for i in range(len(names))]
    seeds = plan(_sized(docs, id_col, text_col, source_col), **options)
    rows = docs.toDF(*kept).withColumns({"doc_id": F.col(kept[names.index(id_col)]), "source": F.col(kept[names.index(source_col)]),
                                          "text_hash": text_hash(F.col(kept[names.index(text_col)]))})
    taken = _with_sources(rows, seeds).withColumn("copies", _copies(F.col("seed"))).filter("copies > 0").select(
        *kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return taken.select(*[F.col(k).alias(n) for k, n in zip(kept, names)])


__all__ = ["draw", "text_hash", "source_targets", "plan", "mix", "emit", "WEIGHTS", "SHARE", "CAP", "N_SEEDS"]
