"""A-13: Pearson correlation of two keyed profiles over their common keys.

Written as five sums and a guarded division rather than ``corr()``: the
original returns 0 when the denominator is 0 and NaN when there is no common
key, while Spark's ``corr`` raises on zero variance under ANSI mode and
gives NULL for a single pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pearson_score(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_value: str,
    right_value: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """``(*by, n, score)``: correlation of ``left_value`` and ``right_value`` over common keys.

    An equi-join on ``(*by, key)`` then one partial + final aggregation per
    group; with no ``by`` the result is one row even when nothing matches,
    and with ``by`` every group present on either side gets a row (NaN when
    the sides share no key).
    """
    by = list(by)
    right_value = right_value or left_value
    x = left.select(*by, key, F.col(left_value).cast("double").alias("_x"))
    y = right.select(*by, key, F.col(right_value).cast("double").alias("_y"))
    # groups match NULL-safely; a NULL key matches nothing
    on = F.col(f"x.{key}") == F.col(f"y.{key}")
    for c in by:
        on = on & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    sums = (
        x.alias("x").join(y.alias("y"), on).select(*[F.col(f"x.{c}").alias(c) for c in by], "_x", "_y")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("_x").alias("sx"),
            F.sum("_y").alias("sy"),
            F.sum(F.col("_x") * F.col("_x")).alias("sxx"),
            F.sum(F.col("_y") * F.col("_y")).alias("syy"),
            F.sum(F.col("_x") * F.col("_y")).alias("sxy"),
        )
    )
    if by:
        # Groups present on one side only have no common key: n = 0, score NaN.
        groups = left.select(*by).unionByName(right.select(*by)).distinct()
        same = F.lit(True)
        for c in by:
            same = same & F.col(f"g.{c}").eqNullSafe(F.col(f"s.{c}"))
        sums = groups.alias("g").join(sums.alias("s"), same, "left").select(
            *[F.col(f"g.{c}").alias(c) for c in by], F.coalesce("n", F.lit(0)).alias("n"), "sx", "sy", "sxx", "syy", "sxy"
        )
    return sums.select(*by, "n", _score(*[F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]).alias("score"))


def _score(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """The guarded division of the five sums."""
    n = n.cast("double")
    num = sxy - F.try_divide(sx * sy, n)
    den = F.sqrt((sxx - F.try_divide(sx * sx, n)) * (syy - F.try_divide(sy * sy, n)))
    return F.when(n == 0, F.lit(float("nan"))).when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num, den))


def pearson_of_maps(left: Column | str, right: Column | str) -> Column:
    """``struct<n, score>``: the same correlation of two MAP columns over their common keys, within the row.

    A NULL map has no key. A key whose value is NULL on a side counts as
    missing there. No join and no shuffle; the sums run in key order of the
    left map.
    """
    both = F.map_zip_with(
        left, right, lambda k, x, y: F.when(x.isNotNull() & y.isNotNull(), F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    )
    values = F.coalesce(F.filter(F.map_values(both), lambda v: v.isNotNull()), F.array())
    zero = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in ("sx", "sy", "sxx", "syy", "sxy")])
    return F.aggregate(
        values,
        zero,
        lambda s, v: F.struct(
            (s["n"] + 1).alias("n"),
            (s["sx"] + v["x"]).alias("sx"),
            (s["sy"] + v["y"]).alias("sy"),
            (s["sxx"] + v["x"] * v["x"]).alias("sxx"),
            (s["syy"] + v["y"] * v["y"]).alias("syy"),
            (s["sxy"] + v["x"] * v["y"]).alias("sxy"),
        ),
        lambda s: F.struct(s["n"].alias("n"), _score(*[s[c] for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]).alias("score")),
    )
