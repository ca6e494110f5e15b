"""Hour-of-day profiles and each address's departure from the population (A-08..A-10)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsentry.functions.hours import HOURS, hour_count_columns, hour_label, hour_names, with_hour

METRICS = ("mse", "rmse", "sse", "pearson")


def population_hour_counts(visits: DataFrame, ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """``h00`` .. ``h23`` counts and the total ``n``: one row, or one per ``by`` group.

    A partial + final aggregate either way (one row per task and group).
    """
    rows = with_hour(visits, ts, *by)
    aggs = (*hour_count_columns(), F.count(F.lit(1)).alias("n"))
    return rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs)


def population_hour_share(visits: DataFrame, ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """A-08: ``(*by, hh, share)``: 24 rows (per group), hours without traffic at 0, summing to 1."""
    counts = population_hour_counts(visits, ts, by)
    arr = F.array(*[F.col(h) for h in hour_names()])
    return counts.select(*by, F.posexplode(arr).alias("h", "c"), "n").select(
        *by, hour_label("h").alias("hh"), F.try_divide(F.col("c"), F.col("n")).alias("share")
    )


def _sum(terms: list[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def _score(metric: str) -> Column:
    """Score of the 24 shares ``h{hh} / size`` against ``pop[h]``, as one SQL expression.

    Sums run left to right over the hours, so the result is reproducible.
    """
    s = [f"(h{h:02d} / size)" for h in HOURS]
    p = [f"pop[{h}]" for h in HOURS]
    n = float(len(HOURS))
    if metric in ("mse", "rmse", "sse"):
        sse = _sum([f"({a} - {b}) * ({a} - {b})" for a, b in zip(s, p)])
        expr = {"sse": sse, "mse": f"{sse} / {n}", "rmse": f"sqrt({sse} / {n})"}[metric]
    elif metric == "pearson":
        sx, sy = _sum(s), _sum(p)
        sxx, syy = _sum([f"{a} * {a}" for a in s]), _sum([f"{b} * {b}" for b in p])
        sxy = _sum([f"{a} * {b}" for a, b in zip(s, p)])
        num = f"({sxy} - {sx} * {sy} / {n})"
        den = f"sqrt(({sxx} - {sx} * {sx} / {n}) * ({syy} - {sy} * {sy} / {n}))"
        expr = f"CASE WHEN {den} = 0 THEN 0.0 ELSE try_divide({num}, {den}) END"
    else:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    return F.expr(expr)


def ip_hour_deviation(
    visits: DataFrame,
    metric: str = "mse",
    drop_null_ip: bool = False,
    ip: str = "ip",
    ts: str = "ts",
) -> DataFrame:
    """A-09: ``(ip, size, flag, coef)``: each address's 24-bin hour profile against the population.

    One hash aggregation keyed by address builds ``size`` and 24 conditional
    counts with map-side combine (no per-address list of timestamps). The
    population profile is a scalar subquery of 24 doubles, so there is no
    join at all; the score is a flat codegen'd expression. ``coef`` is the
    mean squared difference of shares by default (``rmse``, ``sse`` and
    ``pearson`` are options). A NULL address is a group of its own unless
    ``drop_null_ip``. ``flag`` is always TRUE.
    """
    return deviation_of_counts(address_hour_counts(visits, ip, ts), metric, drop_null_ip)


def address_hour_counts(visits: DataFrame, ip: str = "ip", ts: str = "ts") -> DataFrame:
    """``ip, size, h00 .. h23``: views of every address by hour, the NULL address included."""
    return with_hour(visits, ts, F.col(ip).alias("ip")).groupBy("ip").agg(
        F.count(F.lit(1)).alias("size"), *hour_count_columns()
    )


def _summed(counts) -> DataFrame:
    return counts.agg(*[F.sum(h).alias(h) for h in hour_names()], F.sum("size").alias("n"))


def share_of_counts(counts: DataFrame) -> DataFrame:
    """A-08 of the visits behind :func:`address_hour_counts`, without reading them again."""
    arr = F.array(*[F.col(h) for h in hour_names()])
    return _summed(counts).select(F.posexplode(arr).alias("h", "c"), "n").select(
        hour_label("h").alias("hh"), F.try_divide(F.col("c"), F.col("n")).alias("share")
    )


def deviation_of_counts(
    counts: DataFrame, metric: str = "mse", drop_null_ip: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """A-09 of the counts of :func:`address_hour_counts`.

    The population is the sum of the addresses' counts, as a scalar subquery;
    with ``by`` (further columns of ``counts``) every group has its own, one
    row a group, joined by whatever size Spark finds it has.
    """
    by = list(by)
    shares = F.array(*[F.try_divide(F.col(h), F.col("n")) for h in hour_names()])
    per_ip = counts.where(F.col("ip").isNotNull()) if drop_null_ip else counts
    if by:
        pop = _summed(counts.groupBy(*by)).select(*[F.col(c).alias(f"_{c}") for c in by], shares.alias("pop"))
        with_pop = per_ip.join(pop, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]))
    else:
        # The subquery is attached once; the score refers to the column.
        with_pop = per_ip.withColumn("pop", _summed(counts).select(shares.alias("p")).scalar())
    return with_pop.select(*by, "ip", "size", F.lit(True).alias("flag"), _score(metric).alias("coef"))


def ip_hour_deviation_ranked(scores: DataFrame) -> DataFrame:
    """A-10: A-09 by ``size`` descending (ties by address)."""
    return scores.where(F.col("flag")).orderBy(F.desc("size"), F.asc_nulls_first("ip"))
