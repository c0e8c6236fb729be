"""Exact percentiles that never hold a whole group in one task.

Definition (the same as Spark's ``percentile``): for a group of n values sorted as
x[0..n-1], pos = (n - 1) * p, lo = floor(pos), hi = ceil(pos); the result is x[lo] when
lo == hi or x[lo] == x[hi], else (hi - pos) * x[lo] + (pos - lo) * x[hi].

One lazy plan for every size, without sampling and without a write:

1. Values are reduced to distinct (group, range, value, weight) rows. A value's range is a
   monotonic function of it (its logarithm in steps of 1/1024 octave), so ranges need no look
   at the data. The shuffle is keyed on all of them: a hot group spreads over every reducer,
   and map-side combining collapses repeated values before the shuffle.
2. Weights are summed per (group, range) and prefix-summed over a group's ranges, which are
   few whatever the number of its values. That tells which ranges hold the wanted ranks: two
   per percentile at most.
3. Only the rows of those ranges go on; a running sum within (group, range) gives each value
   its ranks, and the values that hold a wanted rank are kept. Both branches read the one
   shuffle of step 1, so the input is scanned once.

A task holds the values of a group that lie within 0.07 % of each other, as a sorted stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

G = "_g"
#: Steps of an octave: how finely a group's values are dealt.
STEPS = 1024


def value_range(v: Column) -> Column:
    """The number of a value's range: never smaller for a greater value, in Spark's order of
    doubles (-infinity, negative, zero, positive, infinity, NaN). NULL stays NULL."""
    step = F.floor(F.log2(F.abs(v)) * F.lit(float(STEPS))).cast("long") + F.lit(1100 * STEPS)
    infinite = F.lit(3000 * STEPS)
    return (F.when(F.isnan(v), F.lit(4000 * STEPS)).when(v == F.lit(0.0), F.lit(0))
            .when(v == F.lit(float("inf")), infinite).when(v == F.lit(float("-inf")), -infinite)
            .when(v > 0, step).when(v < 0, -step)).cast("long")


def _positions(percentiles: dict[str, float]) -> list[tuple[str, Column, Column, Column]]:
    """(name, pos, lower rank, upper rank) of each percentile, from the group's total ``_n``."""
    out = []
    for name, p in percentiles.items():
        pos = (F.col("_n") - F.lit(1)).cast("double") * F.lit(float(p))
        out.append((name, pos, F.floor(pos).cast("long"), F.ceil(pos).cast("long")))
    return out


def exact_percentiles(df: DataFrame, keys: list[str], value: str, percentiles: dict[str, float],
                      extra: list[Column] | None = None) -> DataFrame:
    """Per group of ``keys``: one column per ``percentiles`` item (name -> p), NULL
    values ignored, groups whose values are all NULL give NULL. ``extra`` aggregate
    columns (fixed-width, e.g. ``F.max('scale')``) are computed per group alongside.
    """
    value_col = F.col(value).cast("double")
    distinct = (df.withColumns({G: F.struct(*[F.col(k) for k in keys]), "_v": value_col, "_range": value_range(value_col)}).groupBy(G, "_range", "_v")
                .agg(F.count("_v").alias("_w"), *(extra or [])))
    extra_names = [c for c in distinct.columns if c not in (G, "_range", "_v", "_w")]

    sums = distinct.groupBy(G, "_range").agg(F.sum("_w").alias("_c"), *[F.max(c).alias(c) for c in extra_names])
    group = Window.partitionBy(G)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(G, "_range", "_c", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_offset"),
                          F.sum("_c").over(group).alias("_n"), *[F.max(c).over(group).alias(c) for c in extra_names])
    wanted = _positions(percentiles)
    hit = F.col("_n") == 0
    for _, _, lo, hi in wanted:
        for rank in (lo, hi):
            hit = hit | ((F.col("_offset") <= rank) & (rank < F.col("_offset") + F.col("_c")))
    offsets = offsets.filter(hit).drop("_c")

    within = Window.partitionBy(G, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # NULL ranges are those of groups without values. The extra columns are read here too, so
    # that both branches ask for the same columns and share the shuffle.
    own = {c: f"_own_{c}" for c in extra_names}
    ranks = (distinct.select(F.col(G).alias("_g1"), F.col("_range").alias("_r1"), "_v", "_w", *[F.col(c).alias(o) for c, o in own.items()])
             .join(offsets, F.col("_g1").eqNullSafe(F.col(G)) & F.col("_r1").eqNullSafe(F.col("_range")))
             .select(G, "_range", "_v", "_w", "_n", "_offset", *[F.greatest(c, o).alias(c) for c, o in own.items()], F.sum("_w").over(within).alias("_upto"))
             .select(G, "_v", "_n", *extra_names, (F.col("_offset") + F.col("_upto")).alias("_end"),
                     (F.col("_offset") + F.col("_upto") - F.col("_w")).alias("_begin")))
    holds = {(name, side): (F.col("_begin") <= rank) & (rank < F.col("_end"))
             for name, _, lo, hi in wanted for side, rank in (("lo", lo), ("hi", hi))}
    needed = F.lit(False)
    for h in holds.values():
        needed = needed | h
    picked = (ranks.filter(needed | (F.col("_n") == 0)).groupBy(G)
              .agg(F.max("_n").alias("_n"), *[F.max(c).alias(c) for c in extra_names],
                   *[F.max(F.when(h, F.col("_v"))).alias(f"_{side}_{name}") for (name, side), h in holds.items()]))
    cols = []
    for name, pos, lo, hi in wanted:
        xl, xh = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        cols.append(F.when((hi == lo) | (xl == xh), xl)
                    .otherwise((hi.cast("double") - pos) * xl + (pos - lo.cast("double")) * xh).alias(name))
    return picked.select(*[F.col(f"{G}.{k}").alias(k) for k in keys], *extra_names, *cols)
