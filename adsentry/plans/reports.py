"""Daily report suite (A-17) and range back-fill (A-20).

Reports are registry entries chosen by name, of two kinds:

* *model reports* count the page views of a key (an address or a user) and
  give a histogram of PV ranges (A-18/A-19), one output per event kind;
* *count reports* add up requests, impressions and clicks per user and day,
  with new and known users told apart (A-16).

A report states its *facts*: what one session adds to it. The facts of all
named reports come out of one scan by one Expand-like explode, tagged by
report, and go through the same two aggregations (per key, then per bucket).

Every report takes ``by`` grouping keys (``day``, or ``platform`` and
``day``), so a back-fill over a range of days is **one** job instead of a loop
of daily jobs. Its output replaces exactly the days of the range.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adsentry.operators import sessions as so
from adsentry.plans.common import materialize
from adsentry.sources import sinks, versioned

COUNT_METRICS = ("requests", "impressions", "clicks")


@dataclass(frozen=True)
class Report:
    kind: str  # "model" (one PV count a key) or "count" (sums per user and day)
    outputs: tuple[str, ...]  # names in the written table
    facts: Callable[[], Column]  # one session's facts as an array (see ``_fact``; NULL entries say nothing)


def _fact(report: str, key: Column, a: Column, media: Column | None = None, day: Column | None = None,
          b: Column | None = None, c: Column | None = None) -> Column:
    """A session's share in ``report``: the key it counts for and up to three numbers to add up."""
    return F.struct(
        F.lit(report).alias("report"),
        (F.lit(None).cast("string") if media is None else media).alias("_media"),
        key.alias("_key"),
        (F.lit(None).cast("date") if day is None else day).alias("_day"),
        *[(F.lit(0) if x is None else x).cast("long").alias(n) for n, x in (("_a", a), ("_b", b), ("_c", c))],
    )


def _events() -> Column:
    return F.coalesce(F.col("events"), F.array())


def _with_member(field: str) -> Column:
    return F.size(F.filter(_events(), lambda e: e[field].isNotNull()))


_MEMBERS = tuple(zip(so.KINDS, ("req", "imp", "cli")))


def _address_pv_report(name: str) -> Report:
    """Addresses by PV range: a fact for every member of every event."""

    def facts() -> Column:
        one = F.lit(1)
        members = lambda e: F.array(
            *[F.when(e[f].isNotNull(), _fact(f"{name}_{k}", e[f]["ip"], one)) for k, f in _MEMBERS]
        )
        return F.flatten(F.transform(_events(), members))

    return Report("model", tuple(f"{name}_{k}" for k in so.KINDS), facts)


def _user_pv_report(name: str) -> Report:
    """Users by PV range: a session's members are counted in its row."""

    def facts() -> Column:
        sizes = [(k, _with_member(f)) for k, f in _MEMBERS]
        return F.array(*[F.when(n > 0, _fact(f"{name}_{k}", F.col("uid"), n)) for k, n in sizes])

    return Report("model", tuple(f"{name}_{k}" for k in so.KINDS), facts)


def _new_user_report(name: str) -> Report:
    """Per (by, media, new/known): users and request / impression / click sums."""

    def facts() -> Column:
        requests, shown, clicked = F.size(_events()), _with_member("imp"), _with_member("cli")
        return F.array(_fact(name, F.col("uid"), requests, F.col("media_key"), F.col("day"), shown, clicked))

    return Report("count", (name,), facts)


def user_day_counts(sessions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums per (by, media, user, day): a narrow form of A-14, combined before the shuffle."""
    ev = F.col("events")
    present = (ev, F.filter(ev, lambda e: e["imp"].isNotNull()), F.filter(ev, lambda e: e["cli"].isNotNull()))
    sizes = [F.coalesce(F.when(x.isNotNull(), F.size(x)), F.lit(0)) for x in present]
    keys = list(dict.fromkeys([*by, "media_key", "uid", "day"]))
    return (
        sessions.select(*keys, *[s.alias(m) for s, m in zip(sizes, COUNT_METRICS)])
        .groupBy(*keys)
        .agg(*[F.sum(m).alias(m) for m in COUNT_METRICS])
    )


# Report names of the original daily job.
REPORTS: dict[str, Report] = {
    "AD_IP_PVRANGE": _address_pv_report("AD_IP_PVRANGE"),
    "AD_USER_PVRANGE": _user_pv_report("AD_USER_PVRANGE"),
    "AD_NEW_USER_PV": _new_user_report("AD_NEW_USER_PV"),
}


def _new_flag(keyed: DataFrame, counted: Column, new_users: DataFrame | None) -> DataFrame:
    """``_new``: is the user's row on its first day? (FALSE or TRUE without meaning on other facts)"""
    if new_users is None:  # the sessions are all the history there is: a row a day and platform in a window
        first = F.min("_day").over(Window.partitionBy("report", "_media", "_key"))
        return keyed.withColumn("_new", F.col("_day").eqNullSafe(first))
    # the day is a join key too, so a user seen every day stays spread
    idx = new_users.select(
        F.col("media_key").alias("_nm"), F.col("uid").alias("_nk"), F.col("day").alias("_nd"), F.lit(True).alias("_hit")
    )
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("_media", "_nm"), ("_key", "_nk"), ("_day", "_nd"))]
    return keyed.join(idx, reduce(and_, same) & counted, "left").withColumn("_new", F.coalesce("_hit", F.lit(False)))


def report_rows(
    sessions: DataFrame,
    names: Sequence[str] = tuple(REPORTS),
    by: Sequence[str] = ("day",),
    new_users: DataFrame | None = None,
) -> DataFrame:
    """A-17: the named reports as rows ``(report, *by, bucket, metric, value)``, one lazy plan.

    ``new_users`` has ``media_key, uid, day``: the first day of every user seen
    up to the last day reported (an index of A-16 will do). Without it the
    sessions are taken as the whole history. All reports share one scan of the
    sessions and nothing is persisted: facts are summed per key map-side
    first, so a hot address or user is one row a task.
    """
    if not names:
        raise ValueError("name at least one report")
    unknown = [n for n in names if n not in REPORTS]
    if unknown:
        raise KeyError(f"unknown reports: {unknown}")
    by, chosen = list(by), [REPORTS[n] for n in dict.fromkeys(names)]
    count_outputs = [o for r in chosen if r.kind == "count" for o in r.outputs]
    counted = F.col("report").isin(count_outputs) if count_outputs else F.lit(False)

    said = F.filter(F.concat(*[r.facts() for r in chosen]), lambda f: f.isNotNull())
    facts = sessions.select(*by, F.explode(said).alias("_f")).select(*by, "_f.*")
    keyed = facts.groupBy(*by, "report", "_media", "_key", "_day").agg(*[F.sum(c).alias(c) for c in ("_a", "_b", "_c")])
    if count_outputs:
        keyed = _new_flag(keyed, counted, new_users)
        user_kind = F.when(F.col("_new"), F.lit("new")).otherwise(F.lit("known"))
        bucket = F.when(counted, F.concat_ws("|", "_media", user_kind)).otherwise(so.pv_range(F.col("_a")))
        # with the day among the keys a user has one row there
        users = F.count("_key") if "day" in by else F.count_distinct(F.when(counted, F.col("_key")))
    else:
        bucket, users = so.pv_range(F.col("_a")), F.lit(0)
    out = keyed.groupBy(*by, "report", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), users.alias("users"), *[F.sum(c).alias(m) for c, m in zip(("_a", "_b", "_c"), COUNT_METRICS)]
    )
    metric = lambda m: F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("value"))
    values = F.when(counted, F.array(*[metric(m) for m in ("users", *COUNT_METRICS)])).otherwise(F.array(metric("n")))
    return out.select("report", *by, "bucket", F.explode(values).alias("_m")).select("report", *by, "bucket", "_m.metric", "_m.value")


def report_suite(
    sessions: DataFrame,
    names: Sequence[str] = tuple(REPORTS),
    by: Sequence[str] = ("day",),
    new_users: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The reports as one frame per output name, for callers that write each to its own place."""
    out: dict[str, DataFrame] = {}
    for name in names:
        rows = report_rows(sessions, [name], by, new_users)
        out |= {o: rows.where(F.col("report") == o).drop("report") for o in REPORTS[name].outputs}
    return out


def _in_range(start: str, end: str) -> Column:
    return (F.col("day") >= F.to_date(F.lit(start))) & (F.col("day") < F.to_date(F.lit(end)))


def first_seen(sessions: DataFrame) -> DataFrame:
    """``media_key, uid, day``: the first day of every user of a media key."""
    return sessions.groupBy("media_key", "uid").agg(F.min("day").alias("day"))


def daily_backfill(
    sessions: DataFrame,
    start: str,
    end: str,
    names: Sequence[str] = tuple(REPORTS),
    new_users: DataFrame | None = None,
    by: Sequence[str] = ("day",),
) -> DataFrame:
    """A-20: every report for each day in ``[start, end)`` (end excluded), long form.

    One job over the whole range; the ``day`` filter prunes ``day=``
    partitions when the sessions are stored by day. With ``new_users`` (see
    :func:`read_first_seen`) no session outside the range is read; without it
    first days come from the sessions before ``end``.
    """
    if new_users is None and any(REPORTS[n].kind == "count" for n in names if n in REPORTS):
        new_users = first_seen(sessions.where(F.col("day") < F.to_date(F.lit(end))))
    return report_rows(sessions.where(_in_range(start, end)), names, by, new_users)


def read_first_seen(spark: SparkSession, path: str, end: str | None = None) -> DataFrame:
    """The stored first days (see :func:`update_first_seen`), of the days before ``end``."""
    stored = spark.read.schema("media_key string, uid string, day date").parquet(path)
    if end is not None:
        stored = stored.where(F.col("day") < F.to_date(F.lit(end)))
    # a day filled in later may have met a user before the stored day did
    return first_seen(stored)


def update_first_seen(sessions: DataFrame, path: str, start: str, end: str) -> None:
    """Replace the days ``[start, end)`` of the first-seen table at ``path``.

    Only the sessions of the range and the earlier part of the table are
    read. When sessions are taken out of a day after it was stored, run this
    from that day to the last one, since a user lost there may be new later.
    """
    spark = sessions.sparkSession
    found = first_seen(sessions.where(_in_range(start, end)))
    if sinks.path_exists(spark, path):
        before = read_first_seen(spark, path, start).select(F.col("media_key").alias("_m"), F.col("uid").alias("_u"))
        same = [F.col("media_key").eqNullSafe(F.col("_m")), F.col("uid").eqNullSafe(F.col("_u"))]
        found = found.join(before, reduce(and_, same), "left_anti")
    _replace_days(found, path, ("day",), start, end, {})


def _replace_days(
    rows: DataFrame, path: str, partition_by: Sequence[str], start: str, end: str, scope: dict[str, Sequence[str]]
) -> None:
    """Write ``rows`` and remove the other stored partitions of ``[start, end)`` within ``scope``."""
    rows = materialize(rows)  # read twice below, and the table itself may be among its inputs
    present = {tuple(str(v) for v in r) for r in rows.select(*partition_by).distinct().collect()}  # one row a partition
    sinks.write_partitions(rows, path, partition_by)
    sinks.drop_partitions(rows.sparkSession, path, partition_by, ("day", start, end), scope, keep=present)


def write_backfill(
    long_rows: DataFrame,
    path: str,
    start: str,
    end: str,
    names: Sequence[str] = tuple(REPORTS),
    platforms: Sequence[str] | None = None,
) -> None:
    """Replace the days ``[start, end)`` of the named reports at ``path``.

    Partitioned by ``(report, day)``, or ``(platform, report, day)`` where the
    rows carry a platform; then ``platforms`` limits what is replaced. A day
    that has no rows any more loses those it had. Other days, reports and
    platforms are left alone.
    """
    partition_by = [c for c in ("platform", "report", "day") if c in long_rows.columns]
    scope = {"report": [o for n in names for o in REPORTS[n].outputs]}
    if platforms is not None:
        scope["platform"] = list(platforms)
    _replace_days(long_rows, path, partition_by, start, end, scope)


def write_backfill_versioned(
    long_rows: DataFrame,
    path: str,
    start: str,
    end: str,
    names: Sequence[str] = tuple(REPORTS),
    platforms: Sequence[str] | None = None,
) -> int:
    """:func:`write_backfill` in one step, into a versioned table (read it by ``versioned.read_table``).

    Until the last rename readers see all the old days, after it all the new
    ones; a run that fails in between changes nothing.
    """
    partition_by = [c for c in ("platform", "report", "day") if c in long_rows.columns]
    scope = {"report": [o for n in names for o in REPORTS[n].outputs]}
    if platforms is not None:
        scope["platform"] = list(platforms)
    return versioned.replace_days(long_rows, path, partition_by, start, end, scope)
