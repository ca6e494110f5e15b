"""Activity of one target address or range (A-04..A-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.functions.hours import hour_label
from adsentry.functions.ip import matches_target


def ip_hour_counts(
    visits: DataFrame, target: str, match: str = "contains", ts: str = "ts", strict: bool = False
) -> DataFrame:
    """A-04: ``(hh, n)``: visits per hour of day whose ``ip`` is a quad hitting ``target``.

    Only hours that occur are returned. The plain substring / prefix test is
    a separate conjunct so it reaches a Parquet scan as a pushed filter (a
    prefix can skip row groups by their min/max statistics); the quad test
    follows, ahead of a partial aggregation on at most 24 keys.
    """
    ip = F.col("ip")
    raw_hit = ip.startswith(target) if match == "prefix" else ip.contains(target)
    return (
        visits.where(raw_hit)
        .where(matches_target("ip", target, match, strict))
        .groupBy(hour_label(F.hour(ts)).alias("hh"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def target_ip_visits(visits: DataFrame, target: str, match: str = "contains", strict: bool = False) -> DataFrame:
    """Visits with at least one order whose view address hits ``target``.

    The test runs over the ``orders.view_ip`` array rather than the order
    structs, so a Parquet scan reads only that nested field.
    """
    hit = F.exists(F.col("orders.view_ip"), lambda ip: matches_target(ip, target, match, strict))
    return visits.where(hit)


def target_ip_freq(
    visits: DataFrame, target: str, by: str, match: str = "contains", strict: bool = False
) -> DataFrame:
    """Records per value of ``by`` among the visits that hit ``target``."""
    return target_ip_visits(visits, target, match, strict).groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def target_ip_uid_freq(visits: DataFrame, target: str, match: str = "contains", strict: bool = False) -> DataFrame:
    """A-05: ``(uid, n)``."""
    return target_ip_freq(visits, target, "uid", match, strict)


def target_ip_app_freq(visits: DataFrame, target: str, match: str = "contains", strict: bool = False) -> DataFrame:
    """A-06: ``(app_id, n)``."""
    return target_ip_freq(visits, target, "app_id", match, strict)


def target_ip_exchange_freq(visits: DataFrame, target: str, match: str = "contains", strict: bool = False) -> DataFrame:
    """A-07: ``(exchange_id, n)``."""
    return target_ip_freq(visits, target, "exchange_id", match, strict)
