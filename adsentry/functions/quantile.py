"""F-1: the exclusive quantile used by the outlier fences, fully distributed.

Definition (fixed by the original fence job): walk the distinct values in
ascending order and return the first value ``v`` whose number of rows
*strictly below* ``v`` is at least ``p * n``. If there is none the quantile
is 0.0 (``empty="zero"``, the original behaviour) or the largest value
(``empty="max"``). This differs from ``percentile_disc``: on 1..100 it gives
51 and 96 at p = .50 and .95.

Plan, all lazy and inside one query (the result is one scalar subquery):

1. ``percentile_approx`` at ``p - m`` and ``p + m``, at every quarter, and the
   exact minimum and maximum give a few cut points (a mergeable sketch:
   partial aggregation, bounded memory).
2. One aggregate over the distinct values (``groupBy(v).count()``, map-side
   combined, so a value held by a third of all rows is still one row per
   task) counts the rows below and up to every cut point and finds its
   successor. The largest cut point provably below the answer and the
   smallest one provably not before it bound the band. The minimum and the
   maximum are among them, so there always is one.
3. An ordered running sum over each band, offset by the rows below it, finds
   the answer exactly. The bands of all requested probabilities go through one
   window partitioned by probability, so each band is one task.

``percentile_approx`` documents a rank error of at most ``1 / accuracy``; with
the margin ``m = 2 / accuracy`` a band holds roughly ``4 m`` of the rows. A
sketch that missed its bound would only widen the band to the next cut point.
The input itself is never collected anywhere. ``p = 0`` is the minimum.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000
GRID = 4


def _around(points: str, target: Column) -> tuple[Column, Column]:
    """The cut points next to the answer: the last with fewer rows below, the first with enough up to it."""
    lo = F.array_max(F.filter(points, lambda c: c["below"] < target))  # structs order by their cut
    hi = F.array_min(F.filter(points, lambda c: c["upto"] >= target))
    return lo, hi


def exclusive_quantiles_frame(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    *,
    empty: str = "zero",
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """One row with columns ``q0 .. q{k-1}`` (DOUBLE), the quantiles of ``probs``."""
    if empty not in ("zero", "max"):
        raise ValueError("empty must be 'zero' or 'max'")
    margin = 2.0 / accuracy
    vals = df.select(F.col(value).alias("v")).where(F.col("v").isNotNull())
    pcts = [k / GRID for k in range(1, GRID)]
    for p in probs:
        pcts += [max(p - margin, 0.0), min(p + margin, 1.0)]

    # 1. cut points from a sketch, plus n, the minimum and the maximum
    stats = vals.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.concat(F.percentile_approx("v", pcts, accuracy), F.array(F.min("v"), F.max("v"))).alias("cuts"),
            F.min("v").cast("double").alias("vmin"),
        ).alias("s")
    ).scalar()

    # 2. exact counts around each cut point over the distinct values
    distinct = vals.groupBy("v").agg(F.count(F.lit(1)).alias("cnt"))
    v, cnt = F.col("v"), F.col("cnt")
    with_stats = distinct.withColumn("s", stats)
    points = []
    for j in range(len(pcts) + 2):
        cut = F.get(F.col("s.cuts"), j)
        points.append(
            F.struct(
                F.max(cut).alias("cut"),
                F.coalesce(F.sum(F.when(v < cut, cnt)), F.lit(0)).alias("below"),
                F.coalesce(F.sum(F.when(v <= cut, cnt)), F.lit(0)).alias("upto"),
                F.min(F.when(v > cut, v)).alias("next"),
            )
        )
    bands = with_stats.agg(F.struct(F.max("s.n").alias("n"), F.array(*points).alias("a")).alias("bb")).scalar()

    # 3. ordered running sum inside each band: the bands of all probabilities
    #    go through one window partitioned by probability (one band per task)
    with_bands = distinct.withColumn("bb", bands)
    tagged = []
    for i, p in enumerate(probs):
        target = F.lit(float(p)) * F.col("bb.n")
        lo, hi = _around("bb.a", target)
        tagged.append(
            with_bands.where((v >= lo["cut"]) & (v <= F.coalesce(hi["next"], hi["cut"]))).select(
                F.lit(i).alias("i"), v, cnt, lo["below"].alias("offset"), target.alias("target")
            )
        )
    order = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum(cnt).over(order), F.lit(0)) + F.col("offset")
    found = (
        reduce(DataFrame.unionByName, tagged)
        .withColumn("below", below)
        .where(F.col("below") >= F.col("target"))
        .groupBy("i")
        .agg(F.min("v").cast("double").alias("q"))
    )
    fallback = F.lit(0.0) if empty == "zero" else vals.agg(F.max("v").cast("double")).scalar()
    qs = [F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))]
    found_or_least = [F.col(f"q{i}") if p > 0 else stats["vmin"] for i, p in enumerate(probs)]
    # A global aggregate yields one row even when no probability found a value.
    return found.agg(*qs).select(*[F.coalesce(q, fallback).alias(f"q{i}") for i, q in enumerate(found_or_least)])


def exclusive_quantiles(df: DataFrame, value: str, probs: Sequence[float], **kw) -> dict[float, Column]:
    """Exclusive quantiles of ``df[value]`` (NULLs ignored) as scalar columns."""
    frame = exclusive_quantiles_frame(df, value, probs, **kw)
    packed = frame.select(F.struct(*frame.columns).alias("q")).scalar()
    return {p: packed[f"q{i}"] for i, p in enumerate(probs)}


def exclusive_quantile(df: DataFrame, value: str, p: float, **kw) -> Column:
    """Single exclusive quantile, see :func:`exclusive_quantiles_frame`."""
    return exclusive_quantiles(df, value, [p], **kw)[p]


def fence_bounds(
    df: DataFrame,
    value: str,
    low_p: float,
    high_p: float,
    k: float,
    *,
    log: bool = False,
    empty: str = "zero",
    accuracy: int = DEFAULT_ACCURACY,
) -> Column:
    """Upper fence ``qh + k (qh - ql)`` as one scalar subquery.

    With ``log=True`` the quantiles are taken of the value and then logged,
    and a missing quantile stays 0.0 in log space, as in the original job.
    """
    frame = exclusive_quantiles_frame(df, value, [low_p, high_p], empty=empty, accuracy=accuracy)
    ql, qh = F.col("q0"), F.col("q1")
    if log:
        ql = F.when(ql > 0, F.ln(ql)).otherwise(F.lit(0.0))
        qh = F.when(qh > 0, F.ln(qh)).otherwise(F.lit(0.0))
    return frame.select((qh + F.lit(float(k)) * (qh - ql)).alias("bound")).scalar()
