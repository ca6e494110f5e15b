"""T1: visits -> per-address hour-profile scores -> two fences -> blacklist.

The original ran this as two jobs joined by a text file, collected both
quantile histograms to the driver and wrote the population profile from the
driver. Here it is one chain of DataFrames: the hour counts per address are
materialised once (one shuffle keyed by address, map-side combined), the
fences are scalar subqueries over that small table, and every output is an
ordinary DataFrame the caller writes with any sink.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.functions.quantile import exclusive_quantiles_frame
from adsentry.operators import fences, hour_profile
from adsentry.plans.common import materialize


@dataclass
class BlacklistOutputs:
    population: DataFrame  # A-08 (hh, share)
    scores: DataFrame  # A-09 (ip, size, flag, coef)
    candidates: DataFrame  # A-11 (ip, size, coef)
    blacklist: DataFrame  # A-12 (ip)


def fence_diagnostics(scores: DataFrame, candidates: DataFrame, blacklist: DataFrame, volume_k: float = fences.VOLUME_K,
                      score_k: float = fences.SCORE_K, empty: str = "zero") -> DataFrame:
    """One row: both fences' quantiles and bounds and the row counts at each step.

    The values the original job printed (volume upper bound, candidates, score
    bound, blacklist size), as a small DataFrame the caller shows or logs.
    """
    vq = exclusive_quantiles_frame(scores, "size", [fences.VOLUME_LOW_P, fences.VOLUME_HIGH_P], empty=empty)
    sq = exclusive_quantiles_frame(candidates, "coef", [fences.SCORE_LOW_P, fences.SCORE_HIGH_P], empty=empty)
    v = vq.select(F.struct("q0", "q1").alias("v")).scalar()
    c = sq.select(F.struct("q0", "q1").alias("c")).scalar()
    lv = [F.when(v[q] > 0, F.ln(v[q])).otherwise(F.lit(0.0)) for q in ("q0", "q1")]
    counts = (
        scores.agg(F.count(F.lit(1)).alias("n")).select(
            F.col("n").alias("addresses"),
            candidates.agg(F.count(F.lit(1))).scalar().alias("candidates"),
            blacklist.agg(F.count(F.lit(1))).scalar().alias("blacklisted"),
        )
    )
    return counts.select(
        "*",
        v["q0"].alias("volume_q_low"),
        v["q1"].alias("volume_q_high"),
        F.exp(lv[1] + F.lit(volume_k) * (lv[1] - lv[0])).alias("volume_upper_bound"),
        c["q0"].alias("score_q_low"),
        c["q1"].alias("score_q_high"),
        (c["q1"] + F.lit(score_k) * (c["q1"] - c["q0"])).alias("score_upper_bound"),
    )


def build_blacklist(
    visits: DataFrame,
    metric: str = "mse",
    volume_k: float = fences.VOLUME_K,
    score_k: float = fences.SCORE_K,
    empty: str = "zero",
    materialize_how: str = "checkpoint",
) -> BlacklistOutputs:
    """Run the whole chain; the counts behind ``scores`` and ``candidates`` are materialised once."""
    counts = hour_profile.address_hour_counts(visits)
    return blacklist_of_counts(counts, metric, volume_k, score_k, empty, materialize_how)


def blacklist_of_counts(
    counts: DataFrame,
    metric: str = "mse",
    volume_k: float = fences.VOLUME_K,
    score_k: float = fences.SCORE_K,
    empty: str = "zero",
    materialize_how: str = "checkpoint",
) -> BlacklistOutputs:
    """The chain from the addresses' hour counts on (of visits, or of stored days)."""
    counts = materialize(counts, materialize_how)
    scores = hour_profile.deviation_of_counts(counts, metric=metric)
    candidates = materialize(fences.ip_volume_candidates(scores, k=volume_k, empty=empty), materialize_how)
    blacklist = fences.ip_blacklist(candidates, k=score_k, empty=empty)
    return BlacklistOutputs(hour_profile.share_of_counts(counts), scores, candidates, blacklist)
