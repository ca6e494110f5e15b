"""Ad-session analytics: counts per wide key, watchlists, new users, PV ranges (A-14..A-16, A-18, A-19, A-21).

A session row carries ``events ARRAY<STRUCT<req, imp, cli>>`` where each
member is ``STRUCT<ts, ip>`` or NULL. Per-session numbers are array
expressions evaluated inside the row; only the final keyed sums shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adsentry.functions.ranking import dense_index

# The dimensions of the original daily count key, in order
# (platform, media, user, province, device model, network, ad unit, then the
# hour of the first request, device ip, impression ips, click ips, carrier,
# user agent, os, os version, imei, vendor, resolution).
SESSION_DIMS = ("platform", "media_key", "uid", "province", "device_model", "network", "ad_unit")
DEVICE_DIMS = ("device_ip", "carrier", "user_agent", "os", "os_version", "imei", "vendor", "resolution")

# Our PV range buckets (the original report bodies are absent).
PV_RANGES = ("1", "2-5", "6-20", "21-100", ">100")
KINDS = ("REQ", "IMP", "CLI")


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def session_counts(sessions: DataFrame, dims: Sequence[str] | None = None) -> DataFrame:
    """A-14: sums of (requests, impressions, clicks) per session key.

    The key is ``dims`` (default: the original dimensions present in the
    frame), the hour of the first request (NULL when there is none), and the
    ordered lists of impression and click addresses. Arrays group by value.
    """
    dims = list(dims) if dims is not None else _present(sessions, SESSION_DIMS + DEVICE_DIMS)
    ev = F.col("events")
    imps = F.filter(ev, lambda e: e["imp"].isNotNull())
    clis = F.filter(ev, lambda e: e["cli"].isNotNull())
    keyed = sessions.select(
        *dims,
        F.hour(F.get(ev, 0)["req"]["ts"]).alias("hour"),
        F.transform(imps, lambda e: e["imp"]["ip"]).alias("imp_ips"),
        F.transform(clis, lambda e: e["cli"]["ip"]).alias("cli_ips"),
        *[F.coalesce(F.when(x.isNotNull(), F.size(x)), F.lit(0)).alias(c) for x, c in ((ev, "_req"), (imps, "_imp"), (clis, "_cli"))],
    )
    return keyed.groupBy(*dims, "hour", "imp_ips", "cli_ips").agg(
        F.sum("_req").alias("requests"), F.sum("_imp").alias("impressions"), F.sum("_cli").alias("clicks")
    )


WATCH_SALTS = 8


def watchlist_ip_events(
    sessions: DataFrame,
    watchlist: Sequence[str] | DataFrame,
    media_keys: Sequence[str] | None = None,
    salts: int = WATCH_SALTS,
) -> DataFrame:
    """A-15: ``(kind, ip, n)`` per event of the watched media.

    An event counts as ``imp`` when its impression address is listed, else
    as ``cli`` when its click address is, else as ``(Other, Other)``. A
    literal list is an in-set test; a DataFrame watchlist (column ``ip``, of
    any size) is joined, see :func:`_listed_pairs`.
    """
    rows = sessions.where(F.col("media_key").isin(list(media_keys))) if media_keys is not None else sessions
    # Zip the two address arrays (one entry per event, NULL where the member
    # is absent) so a Parquet scan reads only events.imp.ip and events.cli.ip.
    pairs = F.arrays_zip(F.col("events.imp.ip").alias("imp_ip"), F.col("events.cli.ip").alias("cli_ip"))
    ev = rows.select(F.explode(pairs).alias("e")).select("e.imp_ip", "e.cli_ip")
    if isinstance(watchlist, DataFrame):
        return _listed_pairs(ev, watchlist, salts)
    ips = list(watchlist)
    imp_hit = F.coalesce(F.col("imp_ip").isin(ips), F.lit(False))
    cli_hit = F.coalesce(F.col("cli_ip").isin(ips), F.lit(False))
    kind = F.when(imp_hit, F.lit("imp")).when(cli_hit, F.lit("cli")).otherwise(F.lit("Other"))
    ip = F.when(imp_hit, F.col("imp_ip")).when(cli_hit, F.col("cli_ip")).otherwise(F.lit("Other"))
    return ev.groupBy(kind.alias("kind"), ip.alias("ip")).agg(F.count(F.lit(1)).alias("n"))


def _listed_pairs(ev: DataFrame, watchlist: DataFrame, salts: int) -> DataFrame:
    """A-15 against a table: events move once, as counts of address pairs.

    The pairs meet the list by impression address, those of one address spread
    by the click address over ``salts`` copies of the list, as a hot address
    has many pairs. What is not listed there shrinks to one row per click
    address before it meets the list again.
    """
    listed = watchlist.where(F.col("ip").isNotNull()).select(F.col("ip").alias("_w")).distinct()
    copies = listed.select(F.col("_w"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_c"))
    pairs = ev.groupBy("imp_ip", "cli_ip").agg(F.count(F.lit(1)).alias("n"))
    spread = pairs.withColumn("_s", F.pmod(F.hash("cli_ip"), F.lit(salts)))
    by_imp = spread.join(copies, (F.col("imp_ip") == F.col("_w")) & (F.col("_s") == F.col("_c")), "left")
    seen = F.col("_w").isNotNull()
    rest = by_imp.groupBy(seen.alias("imp_hit"), F.when(seen, F.col("imp_ip")).otherwise(F.col("cli_ip")).alias("ip")).agg(
        F.sum("n").alias("n")
    )
    by_cli = rest.join(listed, (F.col("ip") == F.col("_w")) & ~F.col("imp_hit"), "left")
    kind = F.when(F.col("imp_hit"), F.lit("imp")).when(seen, F.lit("cli")).otherwise(F.lit("Other"))
    ip = F.when(kind != "Other", F.col("ip")).otherwise(F.lit("Other"))
    return by_cli.select(kind.alias("kind"), ip.alias("ip"), "n").groupBy("kind", "ip").agg(F.sum("n").alias("n"))


def new_user_index(sessions: DataFrame, day: str | None = None) -> DataFrame:
    """New-user index ``(media_key, uid, day, idx)``.

    A user is new on the first ``day`` it has a session for a media key;
    ``idx`` numbers the day's new users 1.. in ``(media_key, uid)`` order
    (distributed, see ``functions.ranking``). ``day`` keeps one day only.
    """
    first = sessions.groupBy("media_key", "uid").agg(F.min("day").alias("day"))
    if day is not None:
        first = first.where(F.col("day") == F.to_date(F.lit(day)))
    return dense_index(first, ["media_key", "uid"], group_col="day")


def user_new_index(counts: DataFrame, new_users: DataFrame) -> DataFrame:
    """A-16: the session counts with the new-user index attached.

    Left join on ``(media_key, uid, day)``: ``idx`` is NULL and ``is_new``
    FALSE for users seen before.
    """
    key = ("media_key", "uid", "day")
    idx = new_users.select(*[F.col(c).alias(f"_{c}") for c in key], "idx")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    return counts.join(idx, same, "left").drop(*[f"_{c}" for c in key]).withColumn("is_new", F.col("idx").isNotNull())


def pv_range(n: Column) -> Column:
    """Bucket label of a positive count."""
    return (
        F.when(n == 1, F.lit("1"))
        .when(n <= 5, F.lit("2-5"))
        .when(n <= 20, F.lit("6-20"))
        .when(n <= 100, F.lit("21-100"))
        .otherwise(F.lit(">100"))
    )


def _kind_keys(sessions: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """One row per (event, kind) present, with the key the kind is counted by.

    The three members of every event are flattened into one array first, so
    a single explode yields the member rows directly.
    """

    def members(e: Column) -> Column:
        out = []
        for kind, field in zip(KINDS, ("req", "imp", "cli")):
            k = e[field]["ip"] if key == "ip" else F.col("uid")
            out.append(F.struct(F.lit(kind).alias("kind"), k.alias("k"), e[field].isNotNull().alias("has")))
        return F.array(*out)

    flat = F.flatten(F.transform("events", members))
    return (
        sessions.select(*by, F.explode(flat).alias("m"))
        .where(F.col("m.has"))
        .select(*by, F.col("m.kind").alias("kind"), F.col("m.k").alias("k"))
    )


def pv_range_histogram(sessions: DataFrame, key: str = "ip", by: Sequence[str] = ()) -> DataFrame:
    """``(*by, kind, pv_range, n)``: how many keys fall in each PV range, per event kind.

    ``key="ip"`` counts by the address of each member (A-18), ``key="uid"``
    by user (A-19). Both steps are partial + final aggregations.
    """
    by = list(by)
    per_key = _kind_keys(sessions, key, by).groupBy(*by, "kind", "k").agg(F.count(F.lit(1)).alias("pv"))
    return per_key.groupBy(*by, "kind", pv_range(F.col("pv")).alias("pv_range")).agg(
        F.count(F.lit(1)).alias("n")
    )


def ip_pv_range(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A-18: PV-range histogram of addresses for requests, impressions and clicks."""
    return pv_range_histogram(sessions, "ip", by)


def user_pv_range(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A-19: PV-range histogram of users for requests, impressions and clicks."""
    return pv_range_histogram(sessions, "uid", by)


# Actions that carry an impression / a click.
SHOWN_ACTIONS = ("view", "click", "purchase")
CLICK_ACTIONS = ("click", "purchase")


def third_party_normalize(log: DataFrame, observation: Observation | None = None) -> DataFrame:
    """A-21: foreign monitor records -> session rows (one per record); failures dropped.

    A record converts when it has a user and a known action; the epoch
    milliseconds become a wall-clock timestamp in the session time zone. With
    an ``Observation``, ``records`` and ``rejected`` are counted in the same
    pass (available after the first action).
    """
    ts = F.timestamp_millis(F.col("at_ms")).cast("timestamp_ntz")
    member = F.struct(ts.alias("ts"), F.col("addr").alias("ip"))
    action = F.col("action")
    event = F.struct(
        member.alias("req"),
        F.when(action.isin(*SHOWN_ACTIONS), member).alias("imp"),
        F.when(action.isin(*CLICK_ACTIONS), member).alias("cli"),
    )
    known = action.isin("view", "click", "purchase", "signup")
    converted = F.when(
        F.col("user_ref").isNotNull() & F.coalesce(known, F.lit(False)),
        F.struct(
            F.col("plat").alias("platform"),
            F.col("media").alias("media_key"),
            F.col("user_ref").alias("uid"),
            F.col("slot").alias("ad_unit"),
            F.to_date(ts).alias("day"),
            F.array(event).alias("events"),
        ),
    )
    out = log.select(converted.alias("s"))
    if observation is not None:
        out = out.observe(
            observation,
            F.count(F.lit(1)).alias("records"),
            F.count(F.when(F.col("s").isNull(), F.lit(1))).alias("rejected"),
        )
    return out.where(F.col("s").isNotNull()).select("s.*")
