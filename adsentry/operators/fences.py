"""Quantile-fence blacklist (A-11, A-12).

Two outlier fences in a row: first on log volume, then on the hour-profile
score of the volume outliers. The bounds are scalar subqueries computed with
the distributed exclusive quantile (``functions.quantile``); the fences
themselves are plain filters, so nothing is collected to the driver and the
whole chain stays one lazy plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.functions.quantile import DEFAULT_ACCURACY, fence_bounds

# Fence quantiles and multipliers of the original jobs.
VOLUME_LOW_P, VOLUME_HIGH_P, VOLUME_K = 0.50, 0.95, 3.0
SCORE_LOW_P, SCORE_HIGH_P, SCORE_K = 0.25, 0.75, 1.5


def ip_volume_candidates(
    scores: DataFrame,
    k: float = VOLUME_K,
    low_p: float = VOLUME_LOW_P,
    high_p: float = VOLUME_HIGH_P,
    empty: str = "zero",
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """A-11: ``(ip, size, coef)`` rows with ``ln(size) > qh + k (qh - ql)``.

    ``ql``/``qh`` are exclusive quantiles of ``size`` taken in log space; a
    missing quantile is 0.0 (``empty="zero"``) as in the original, or the
    largest value (``empty="max"``). Empty input gives no rows.
    """
    bound = fence_bounds(scores, "size", low_p, high_p, k, log=True, empty=empty, accuracy=accuracy)
    return scores.where(F.ln(F.col("size")) > bound).select("ip", "size", "coef")


def ip_blacklist(
    candidates: DataFrame,
    k: float = SCORE_K,
    low_p: float = SCORE_LOW_P,
    high_p: float = SCORE_HIGH_P,
    empty: str = "zero",
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """A-12: ``(ip)`` of the candidates with ``coef > q75 + k (q75 - q25)``."""
    bound = fence_bounds(candidates, "coef", low_p, high_p, k, log=False, empty=empty, accuracy=accuracy)
    return candidates.where(F.col("coef") > bound).select("ip")
