"""Column-level helpers shared by the operators."""

from adsentry.functions.ip import is_quad, matches_target, same_subnet24, subnet24
from adsentry.functions.hours import HOURS, hour_label, hour_of
from adsentry.functions.quantile import exclusive_quantile, fence_bounds

__all__ = [
    "HOURS",
    "exclusive_quantile",
    "fence_bounds",
    "hour_label",
    "hour_of",
    "is_quad",
    "matches_target",
    "same_subnet24",
    "subnet24",
]
