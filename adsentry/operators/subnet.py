"""Page views by /24 subnet (A-01..A-03) and neighbouring-subnet hops (A-33)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adsentry.functions.ip import is_quad, same_subnet24, subnet24
from adsentry.functions.ranking import ROWS_PER_BLOCK, in_blocks

# Fixed value: views above which a /24 is reported as a top subnet.
TOP_SUBNET_THRESHOLD = 180000


def view_ips(visits: DataFrame, orders: str = "orders") -> DataFrame:
    """One row per view address of every order (``view_ip``).

    ``explode_outer`` (a NULL row for an empty list, removed by the quad
    test that always follows) keeps Catalyst from inferring a ``size > 0``
    filter that re-evaluates a computed ``orders`` column below the project.
    """
    return visits.select(F.explode_outer(F.col(orders)["view_ip"]).alias("view_ip"))


def subnet24_pv(visits: DataFrame, strict: bool = False) -> DataFrame:
    """A-01: ``(subnet, pv)``: page views per /24 of the order view addresses.

    Explode, keep dotted quads, cut to three octets, count. The count is a
    partial + final hash aggregate, so a hot subnet costs one row per task.
    """
    ips = view_ips(visits)
    return (
        ips.where(is_quad("view_ip", strict=strict))
        .groupBy(subnet24("view_ip").alias("subnet"))
        .agg(F.count(F.lit(1)).alias("pv"))
    )


def subnet24_pv_histogram(subnet_pv: DataFrame) -> DataFrame:
    """A-02: ``(pv, n_subnets)``: how many subnets have each view count."""
    return subnet_pv.groupBy("pv").agg(F.count(F.lit(1)).alias("n_subnets"))


def top_subnet24(visits: DataFrame, threshold: int = TOP_SUBNET_THRESHOLD, strict: bool = False) -> DataFrame:
    """A-03: subnets with strictly more than ``threshold`` views."""
    return subnet24_pv(visits, strict=strict).where(F.col("pv") > F.lit(threshold))


def adjacent_subnet_pairs(locations: str = "locations"):
    """Per-row count of consecutive location pairs inside one /24."""
    locs = F.col(locations)
    pairs = F.greatest(F.size(locs) - 1, F.lit(0))
    hits = F.zip_with(
        F.slice(locs, 1, pairs),
        F.slice(locs, 2, pairs),
        lambda a, b: same_subnet24(a, b),
    )
    return F.size(F.filter(hits, lambda x: x))


def adjacent_subnet_histogram(profiles: DataFrame, locations: str = "locations") -> DataFrame:
    """A-33: ``(n_pairs, n_profiles)``: neighbouring same-/24 location pairs per profile row.

    The pairs are counted inside each row with array functions (no explode,
    no shuffle until the final small histogram).
    """
    return profiles.groupBy(adjacent_subnet_pairs(locations).alias("n_pairs")).agg(
        F.count(F.lit(1)).alias("n_profiles")
    )


def adjacent_subnet_histogram_flat(events: DataFrame, location: str = "location", block: int = ROWS_PER_BLOCK) -> DataFrame:
    """A-33 on flat rows ``uid, ts, event_id, location``: the same histogram without a list per user.

    All rows are put in the order (uid, ts, event_id) and cut into blocks of
    ``block`` rows, whoever they belong to: neighbours are paired within (user,
    block), the seams between a user's blocks from one row a block with its
    first and last location. So a user, or one hour of it, may hold any share
    of the rows and no task sorts more than its blocks.
    """
    rows = in_blocks(
        events.select("uid", "ts", "event_id", F.col(location).alias("loc")), ["uid", "ts", "event_id"], block
    )
    in_block = Window.partitionBy("uid", "_block").orderBy("_at")
    same = lambda a, b: F.coalesce(same_subnet24(a, b), F.lit(False)).cast("int")
    at = F.struct("_at", "loc")
    blocks = (
        rows.withColumn("hit", same(F.lag("loc").over(in_block), F.col("loc")))
        .groupBy("uid", "_block")
        .agg(F.sum("hit").alias("hits"), F.min(at)["loc"].alias("first"), F.max(at)["loc"].alias("last"))
    )
    by_block = Window.partitionBy("uid").orderBy("_block")  # a user's rows / block
    users = (
        blocks.withColumn("seam", same(F.lag("last").over(by_block), F.col("first")))
        .groupBy("uid")
        .agg((F.sum("hits") + F.sum("seam")).cast("int").alias("n_pairs"))
    )
    return users.groupBy("n_pairs").agg(F.count(F.lit(1)).alias("n_profiles"))
