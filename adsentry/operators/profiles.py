"""User-profile histograms (A-30..A-32, A-34; A-33 lives in ``subnet``).

Two forms of each: over stored profiles (one row per user with arrays) and,
``*_flat``, over flat rows of one attribute value each, where a user may have
any share of all rows: distinct values and sums, never a list per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def operator_count_histogram(profiles: DataFrame, operators: str = "operators") -> DataFrame:
    """A-30: ``(n_operators, n_profiles)``: distinct carriers per profile row."""
    n = F.size(F.array_distinct(F.col(operators)))
    return profiles.groupBy(n.alias("n_operators")).agg(F.count(F.lit(1)).alias("n_profiles"))


def interest_pv(profiles: DataFrame, interests: str = "interests") -> DataFrame:
    """A-31: ``(interest, pv)``: occurrences of each interest over all profile rows."""
    return (
        profiles.select(F.explode(F.col(interests)).alias("interest"))
        .groupBy("interest")
        .agg(F.count(F.lit(1)).alias("pv"))
    )


def interest_uv(profiles: DataFrame, interests: str = "interests") -> DataFrame:
    """A-32: ``(interest, uv)``: profile rows having each interest (deduplicated per row)."""
    return (
        profiles.select(F.explode(F.array_distinct(F.col(interests))).alias("interest"))
        .groupBy("interest")
        .agg(F.count(F.lit(1)).alias("uv"))
    )


def profile_uids(profiles: DataFrame) -> DataFrame:
    """A-34: the ``uid`` of every profile row (a load check)."""
    return profiles.select("uid")


def operator_count_histogram_flat(events: DataFrame, operator: str = "operator") -> DataFrame:
    """A-30 on flat rows; users without a carrier count 0."""
    pairs = events.select("uid", F.col(operator).alias("operator")).distinct()
    per_user = pairs.groupBy("uid").agg(F.count("operator").cast("int").alias("n_operators"))
    return per_user.groupBy("n_operators").agg(F.count(F.lit(1)).alias("n_profiles"))


def interest_pv_flat(events: DataFrame, interest: str = "interest") -> DataFrame:
    """A-31 on flat rows."""
    rows = events.select(F.col(interest).alias("interest")).where(F.col("interest").isNotNull())
    return rows.groupBy("interest").agg(F.count(F.lit(1)).alias("pv"))


def interest_uv_flat(events: DataFrame, interest: str = "interest") -> DataFrame:
    """A-32 on flat rows: users having each interest."""
    rows = events.select("uid", F.col(interest).alias("interest")).where(F.col("interest").isNotNull()).distinct()
    return rows.groupBy("interest").agg(F.count(F.lit(1)).alias("uv"))


def profile_uids_flat(events: DataFrame) -> DataFrame:
    """A-34 on flat rows: every user once."""
    return events.select("uid").distinct()
