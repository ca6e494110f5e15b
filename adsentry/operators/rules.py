"""Pluggable cheater rules (A-22) and their summary (A-23).

The original chose rule classes by name and ran each over one cached profile
scan; the rule bodies are not public. Rules read *facts*, one row per user and
attribute value: ``uid, kind, value``. ``facts_from_events`` makes them from
flat profile rows, ``facts_from_profiles`` from stored profiles with arrays.
The rules are

* *count rules*: more than so many distinct values of one kind. All named ones
  run in one pass: distinct facts, then one count per user and kind;
* *frame rules*: a function of the facts (and context such as a blacklist)
  giving the distinct ``(uid, value)`` that break it; its joins are sized by Spark;
* *SQL rules*: any function of the session's catalog with the signature
  ``(kind STRING, n BIGINT) RETURNS BOOLEAN``, named like a rule: is a user with
  ``n`` distinct values of ``kind`` a suspect? They are looked up by name at run
  time, so a rule needs no code in this package, and share the pass of the count rules.

A trial carries how many values broke the rule and, with ``evidence=True``, all
of these values. ``cheater_evidence`` has them as one flat row per value, for
users with more of them than a row should hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUT_COLS = ("uid", "day", "rule", "n")

# More distinct values than this of one user are suspect.
MAX_CARRIERS = 3
MAX_HARDWARE = 3


@dataclass(frozen=True)
class CountRule:
    kind: str
    limit: int


@dataclass(frozen=True)
class FrameRule:
    values: Callable[..., DataFrame]  # distinct ``(uid, value)``: the whole evidence


def facts_from_events(events: DataFrame) -> DataFrame:
    """``uid, kind, value`` of flat rows ``uid, location, operator, hardware`` (NULL values say nothing)."""
    kinds = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"))
          for kind, c in (("location", "location"), ("carrier", "operator"), ("hardware", "hardware")) if c in events.columns]
    )
    return events.select("uid", F.explode(F.filter(kinds, lambda x: x["value"].isNotNull())).alias("f")).select("uid", "f.*")


def facts_from_profiles(profiles: DataFrame) -> DataFrame:
    """The same of stored profiles ``uid, locations, operators, hardware`` (arrays)."""
    parts = [
        profiles.select("uid", F.lit(kind).alias("kind"), F.explode(c).alias("value"))
        for kind, c in (("location", "locations"), ("carrier", "operators"), ("hardware", "hardware")) if c in profiles.columns
    ]
    return reduce(lambda a, b: a.unionByName(b), parts).where(F.col("value").isNotNull())


def _counted(hits: DataFrame, keys: Sequence[str], evidence: bool = False) -> DataFrame:
    """``keys, n`` of distinct rows ``keys, value``: combined before the shuffle, however many values a user has;
    with ``evidence`` also ``found``, these values."""
    found = [F.collect_list("value").alias("found")] if evidence else []
    return hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *found)


def _blacklisted_values(facts: DataFrame, blacklist: DataFrame | None = None, **_) -> DataFrame:
    """Users' distinct locations on the blacklist (a semi join; Spark sizes it)."""
    if blacklist is None:
        raise ValueError("rule 'blacklisted_ip' needs blacklist=")
    ips = blacklist.select(F.col("ip").alias("value")).distinct()
    return facts.where(F.col("kind") == "location").select("uid", "value").distinct().join(ips, "value", "left_semi")


RULES: dict[str, CountRule | FrameRule] = {
    "many_carriers": CountRule("carrier", MAX_CARRIERS),
    "many_hardware": CountRule("hardware", MAX_HARDWARE),
    "blacklisted_ip": FrameRule(_blacklisted_values),
}


def _known(facts: DataFrame, rules: Sequence[str]) -> None:
    catalog = facts.sparkSession.catalog
    unknown = [r for r in rules if r not in RULES and not catalog.functionExists(r)]
    if unknown:
        raise KeyError(f"unknown rules: {unknown}")
    if not rules:
        raise ValueError("no rules given")


def _count_rules(rules: Sequence[str]) -> dict[str, CountRule | None]:
    """The named rules that look at a user's count of one kind: ours, and SQL functions (None)."""
    return {r: RULES.get(r) for r in rules if not isinstance(RULES.get(r), FrameRule)}


def _of_kinds(facts: DataFrame, counted: dict[str, CountRule | None]) -> DataFrame:
    """The facts these rules may look at: all of them for an SQL function."""
    if None in counted.values():
        return facts
    return facts.where(F.col("kind").isin(sorted({c.kind for c in counted.values()})))


def _with_broken(counts: DataFrame, counted: dict[str, CountRule | None], kind: str, n: str) -> DataFrame:
    """One row per row of ``counts`` and rule that ``n`` distinct values of ``kind`` break, named in ``rule``."""
    flags = {
        r: F.call_function(r, F.col(kind), F.col(n)) if c is None else (F.col(kind) == c.kind) & (F.col(n) > c.limit)
        for r, c in counted.items()
    }
    # columns first: an SQL function can't stand within a generator
    tested = counts.select("*", *[b.alias(f"_broken{i}") for i, b in enumerate(flags.values())])
    names = F.array(*[F.when(F.col(f"_broken{i}"), F.lit(r)) for i, r in enumerate(flags)])
    return tested.select(*counts.columns, F.explode(F.filter(names, lambda r: r.isNotNull())).alias("rule"))


def cheater_trials(
    facts: DataFrame, rules: Sequence[str], day: str | None = None, evidence: bool = False, **context
) -> DataFrame:
    """A-22: ``(uid, day, rule, n)``: one row per user and rule it breaks, with the
    number of values that broke it; ``cheater_evidence`` has these, a row each.

    ``day`` is the day of the trial (yyyy-MM-dd), carried as a DATE. With
    ``evidence`` a column of that name follows: all the values, in order, joined
    by commas.
    """
    _known(facts, rules)
    counted = _count_rules(rules)
    found = ["found"] if evidence else []
    parts: list[DataFrame] = []
    if counted:
        per = _counted(_of_kinds(facts, counted).distinct(), ["uid", "kind"], evidence)
        broken = _with_broken(per, counted, "kind", "n").select("uid", "rule", "n", *found)
        if None in counted.values():  # an SQL rule may be broken by several kinds
            all_found = [F.flatten(F.collect_list("found")).alias("found")] if evidence else []
            broken = broken.groupBy("uid", "rule").agg(F.sum("n").alias("n"), *all_found)
        parts.append(broken)
    for r in rules:
        if r not in counted:
            per = _counted(RULES[r].values(facts, **context), ["uid"], evidence)
            parts.append(per.select("uid", F.lit(r).alias("rule"), "n", *found))
    trials = reduce(lambda a, b: a.unionByName(b), parts).withColumn("day", F.to_date(F.lit(day)))
    whole = [F.array_join(F.sort_array("found"), ",").alias("evidence")] if evidence else []
    return trials.select(*OUT_COLS, *whole)


def cheater_evidence(facts: DataFrame, rules: Sequence[str], day: str | None = None, **context) -> DataFrame:
    """``(uid, day, rule, value)``: every distinct value that broke a rule of
    ``cheater_trials``, one row each and none left out; no list per user."""
    _known(facts, rules)
    parts: list[DataFrame] = []
    counted = _count_rules(rules)
    if counted:
        distinct = _of_kinds(facts, counted).select("uid", "kind", "value").distinct()
        per = distinct.groupBy(F.col("uid").alias("_uid"), F.col("kind").alias("_kind")).agg(F.count(F.lit(1)).alias("_n"))
        broken = _with_broken(per, counted, "_kind", "_n").select("_uid", "_kind", "rule")
        same = F.col("uid").eqNullSafe(F.col("_uid")) & (F.col("kind") == F.col("_kind"))
        parts.append(distinct.join(broken, same).select("uid", "rule", "value"))
    for r in rules:
        if r not in counted:
            parts.append(RULES[r].values(facts, **context).select("uid", F.lit(r).alias("rule"), "value"))
    whole = reduce(lambda a, b: a.unionByName(b), parts)
    return whole.select("uid", F.to_date(F.lit(day)).alias("day"), "rule", "value")


def cheater_summary(trials: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """A-23: the union of the rule outputs without empty rows and repeats."""
    frames = [trials] if isinstance(trials, DataFrame) else list(trials)
    return reduce(lambda a, b: a.unionByName(b), frames).dropna(how="all").distinct()


def cheater_users(summary: DataFrame) -> DataFrame:
    """``(uid, rules)``: every known user once, with the rules that caught it
    (bounded by the number of rules)."""
    return (
        summary.where(F.col("uid").isNotNull())
        .groupBy("uid")
        .agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("rules"))
    )
