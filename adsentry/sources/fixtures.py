"""Derived input views over the driver's read-only tables.

The analytics operators read ad-traffic records (visits, user profiles, ad
sessions, device logs). Those are derived here from the given tables so that
every query's work grows with them. Each view has a Spark definition (the
DataFrame builders) and a DuckDB definition (``DUCKDB_VIEWS``) used by the
independent SQL oracle; the two must stay row-for-row equal.

Profiles have one row per user; as a user may hold any share of all traffic,
the registered profile queries run on the flat ``profile_events`` and never
build that row. A session is what one user does at one ad unit within a clock
hour (a session time window), so it is bounded by meaning.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsentry.sources.readers import read_records

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the synthetic fixtures (documentation / private ranges).
HEAVY_IP = "203.0.113.9"
CLICK_RELAY_IP = "10.9.9.9"
PROFILE_INTEREST_K = 8
PROFILE_OPERATOR_K = 4
PROFILE_HARDWARE_K = 6


# Read schemas of the given tables the views use (timestamps without zone).
# With a declared schema the scan needs no inference job and reads only
# these columns; the other tables are read with their footer schema.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT",
    "part": "p_partkey BIGINT, p_brand STRING, p_type STRING, p_size INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables (column pruning and pushdown apply)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in TABLE_SCHEMAS:
        return read_records(spark, path, TABLE_SCHEMAS[name])
    return spark.read.parquet(path)


def _s(c: Column) -> Column:
    return c.cast("string")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid/visit records: one per event, with a messy ``ip`` and view orders.

    ``event_id BIGINT, uid, app_id, exchange_id STRING, k INT,
    ts TIMESTAMP_NTZ, ip STRING, orders ARRAY<STRUCT<view_ip, view_ts>>``
    """
    return visits_from_events(table(spark, sf_dir, "events"))


def visits_from_events(ev: DataFrame) -> DataFrame:
    """The visits projection of an ``events`` frame (batch or streaming)."""
    k = F.get_json_object("props", "$.k").cast("int")
    base = ev.select(
        "event_id",
        _s(F.col("user_id")).alias("uid"),
        F.col("event_type").alias("app_id"),
        F.concat(F.lit("x"), _s(F.col("user_id") % 5)).alias("exchange_id"),
        k.alias("k"),
        "ts",
        "user_id",
    )
    eid, uid_n, k = F.col("event_id"), F.col("user_id"), F.col("k")
    ip = (
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
        .when(eid % 89 == 0, F.lit("10.1.2"))
        .when(eid % 83 == 0, F.lit("10.1.2.3."))
        .when((F.hour("ts") == 3) & (k < 50), F.lit(HEAVY_IP))
        .when(k < 40, F.concat(F.lit("198.51.100."), _s(k % 20)))
        .otherwise(
            F.concat(F.lit("10."), _s(uid_n % 4), F.lit("."), _s(uid_n % 50), F.lit("."), _s(eid % 8))
        )
    )
    with_ip = base.withColumn("ip", ip)
    view = lambda vip: F.struct(vip.alias("view_ip"), F.col("ts").alias("view_ts"))
    orders = F.slice(
        F.array(
            view(F.col("ip")),
            view(F.concat(F.lit("10.0.0."), _s(k % 9))),
            view(F.when(eid % 7 == 0, F.lit("10.8.8.8."))),
        ),
        F.lit(1),
        k % 4,
    )
    return with_ip.select("event_id", "uid", "app_id", "exchange_id", "k", "ts", "ip", orders.alias("orders"))


def profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat profile rows, one per visit: ``uid, ts, event_id, location, interest, operator, hardware``.

    ``location`` is never NULL; the other attributes are NULL where the visit
    says nothing about them.
    """
    k, uid_i = F.col("k"), F.col("uid").cast("int")
    triple = F.concat_ws("|", F.concat(F.lit("vd"), _s(uid_i % 9)), F.concat(F.lit("dm"), _s(k)), F.concat(F.lit("r"), _s(k % 4)))
    return visits(spark, sf_dir).select(
        "uid",
        "ts",
        "event_id",
        F.coalesce("ip", F.lit("")).alias("location"),
        F.when(k < PROFILE_INTEREST_K, F.col("app_id")).alias("interest"),
        F.when(k < PROFILE_OPERATOR_K, F.concat(F.lit("op"), _s(k % 4))).alias("operator"),
        F.when(k < PROFILE_HARDWARE_K, triple).alias("hardware"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored form of the profiles, one row per user with time-ordered arrays:
    ``uid STRING, locations, interests, operators ARRAY<STRING>`` (for the
    array operators; a user's row must fit in memory)."""
    e = F.array_sort(F.collect_list(F.struct("ts", "event_id", "location", "interest", "operator")))
    rows = profile_events(spark, sf_dir).groupBy("uid").agg(e.alias("e"))
    said = lambda c: F.filter(F.transform("e", lambda x: x[c]), lambda v: v.isNotNull())
    return rows.select(
        "uid", said("location").alias("locations"), said("interest").alias("interests"), said("operator").alias("operators")
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad sessions: ``platform, media_key, uid, ad_unit, day, window_start`` and ``events``.

    ``events ARRAY<STRUCT<req, imp, cli: STRUCT<ts TIMESTAMP_NTZ, ip STRING>>>``
    in time order. Every event has ``req``; view, click and purchase have
    ``imp``; click and purchase have ``cli`` (from a relay address when
    ``k % 10 = 0``).
    """
    v = visits(spark, sf_dir)
    uid_i = F.col("uid").cast("int")
    keyed = v.select(
        F.concat(F.lit("p"), _s(uid_i % 2)).alias("platform"),
        F.concat(F.lit("m"), _s(uid_i % 3)).alias("media_key"),
        "uid",
        F.concat(F.lit("u"), _s(uid_i % 6)).alias("ad_unit"),
        F.to_date("ts").alias("day"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"),
        F.struct("ts", "event_id", "ip", "app_id", "k").alias("e"),
    )
    grouped = keyed.groupBy("platform", "media_key", "uid", "ad_unit", "day", "window_start").agg(
        F.array_sort(F.collect_list("e")).alias("e")
    )

    def to_event(x: Column) -> Column:
        at = lambda ip: F.struct(x["ts"].alias("ts"), ip.alias("ip"))
        shown = x["app_id"].isin("view", "click", "purchase")
        clicked = x["app_id"].isin("click", "purchase")
        cli_ip = F.when(x["k"] % 10 == 0, F.lit(CLICK_RELAY_IP)).otherwise(x["ip"])
        return F.struct(
            at(x["ip"]).alias("req"),
            F.when(shown, at(x["ip"])).alias("imp"),
            F.when(clicked, at(cli_ip)).alias("cli"),
        )

    return grouped.select(
        "platform", "media_key", "uid", "ad_unit", "day", "window_start", *device_columns(), F.transform("e", to_event).alias("events")
    )


def device_columns() -> list[Column]:
    """Device attributes of a session, as functions of ``uid`` (the IMEI is hashed)."""
    u = F.col("uid").cast("int")
    tag = lambda prefix, n: F.concat(F.lit(prefix), _s(u % n))
    return [
        tag("pr", 7).alias("province"),
        tag("dm", 11).alias("device_model"),
        tag("n", 3).alias("network"),
        F.concat(F.lit("10."), _s(u % 4), F.lit("."), _s(u % 50), F.lit(".1")).alias("device_ip"),
        tag("op", 4).alias("carrier"),
        tag("ua", 5).alias("user_agent"),
        tag("os", 2).alias("os"),
        tag("v", 6).alias("os_version"),
        F.sha2(F.concat(F.lit("35"), F.lpad("uid", 13, "0")), 256).alias("imei"),
        tag("vd", 9).alias("vendor"),
        tag("r", 4).alias("resolution"),
    ]


def devices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device log: ``manufacturer, model, resolution, device_id`` (all strings)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    j = li.join(pa, li.l_partkey == pa.p_partkey)
    return j.select(
        F.col("p_brand").alias("manufacturer"),
        F.col("p_type").alias("model"),
        _s(F.col("p_size")).alias("resolution"),
        _s(F.col("l_suppkey")).alias("device_id"),
    )


def devices_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third-party device log with identifiers, all nullable:
    ``manufacturer, model, resolution, imei, android_id, mac, openudid``."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    j = li.join(pa, li.l_partkey == pa.p_partkey)
    ln = F.col("l_linenumber")
    imei = (
        F.when(ln % 3 == 0, F.lit(None).cast("string"))
        .when(ln % 3 == 1, F.lit("12345"))
        .otherwise(
            F.concat(
                F.lit("35"),
                F.lpad(_s(F.col("l_suppkey") % 7), 3, "0"),
                F.lpad(_s(F.col("l_orderkey")), 10, "0"),
            )
        )
    )
    return j.select(
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).alias("manufacturer"),
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_type")).alias("model"),
        F.when(F.col("p_size") % 7 != 0, _s(F.col("p_size"))).alias("resolution"),
        imei.alias("imei"),
        _s(F.col("l_suppkey")).alias("android_id"),
        F.lit(None).cast("string").alias("mac"),
        F.lit(None).cast("string").alias("openudid"),
    )


def hardware_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty hardware triples ``f1, f2, f3``; some carry ``maker|model`` in f1."""
    d = devices_ext(spark, sf_dir)
    maker = F.coalesce("manufacturer", F.lit("empty"))
    model = F.coalesce("model", F.lit("unknow"))
    return d.select(
        F.when(F.col("resolution").isin("8", "9"), F.concat(maker, F.lit("|"), model)).otherwise(maker).alias("f1"),
        F.when(F.col("resolution") == "10", F.lit("")).otherwise(model).alias("f2"),
        F.coalesce("resolution", F.lit("empty")).alias("f3"),
    )


def third_party_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A foreign monitor log, one flat record per ad action.

    ``record_id BIGINT, plat STRING, media STRING, user_ref STRING, slot STRING,
    action STRING, at_ms BIGINT (epoch millis), addr STRING``
    """
    v = visits(spark, sf_dir)
    uid_i = F.col("uid").cast("int")
    return v.select(
        F.col("event_id").alias("record_id"),
        F.concat(F.lit("p"), _s(uid_i % 2)).alias("plat"),
        F.concat(F.lit("m"), _s(uid_i % 3)).alias("media"),
        F.col("uid").alias("user_ref"),
        F.concat(F.lit("u"), _s(uid_i % 6)).alias("slot"),
        F.col("app_id").alias("action"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"),
        F.col("ip").alias("addr"),
    )


EVENTS_SCHEMA = TABLE_SCHEMAS["events"]

BUILDERS = {
    "visits": visits,
    "profile_events": profile_events,
    "profiles": profiles,
    "sessions": sessions,
    "devices_raw": devices_raw,
    "devices_ext": devices_ext,
    "hardware_rows": hardware_rows,
    "third_party_log": third_party_log,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived view, by name."""
    if name in BUILDERS:
        return BUILDERS[name](spark, sf_dir)
    return table(spark, sf_dir, name)


# ---------------------------------------------------------------------------
# DuckDB definitions of the same views (oracle side). Dependencies are listed
# so a query's WITH clause carries exactly the views it needs, in order.

DUCKDB_VIEWS: dict[str, str] = {
    "visits": f"""
SELECT event_id, uid, app_id, exchange_id, k, ts, ip,
  ([{{'view_ip': ip, 'view_ts': ts}},
    {{'view_ip': concat('10.0.0.', cast(k % 9 AS VARCHAR)), 'view_ts': ts}},
    {{'view_ip': CASE WHEN event_id % 7 = 0 THEN '10.8.8.8.' END, 'view_ts': ts}}])[1:k % 4] AS orders
FROM (SELECT event_id, cast(user_id AS VARCHAR) AS uid, event_type AS app_id,
        concat('x', cast(user_id % 5 AS VARCHAR)) AS exchange_id, k, ts,
        CASE WHEN event_id % 97 = 0 THEN NULL
             WHEN event_id % 89 = 0 THEN '10.1.2'
             WHEN event_id % 83 = 0 THEN '10.1.2.3.'
             WHEN hour(ts) = 3 AND k < 50 THEN '{HEAVY_IP}'
             WHEN k < 40 THEN concat('198.51.100.', cast(k % 20 AS VARCHAR))
             ELSE concat('10.', cast(user_id % 4 AS VARCHAR), '.', cast(user_id % 50 AS VARCHAR), '.',
                         cast(event_id % 8 AS VARCHAR))
        END AS ip
      FROM (SELECT *, cast(json_extract_string(props, '$.k') AS INT) AS k FROM events))""",
    "profile_events": f"""
SELECT uid, ts, event_id, coalesce(ip, '') AS location, CASE WHEN k < {PROFILE_INTEREST_K} THEN app_id END AS interest,
  CASE WHEN k < {PROFILE_OPERATOR_K} THEN concat('op', cast(k % 4 AS VARCHAR)) END AS operator,
  CASE WHEN k < {PROFILE_HARDWARE_K} THEN concat('vd', cast(cast(uid AS INT) % 9 AS VARCHAR), '|dm', cast(k AS VARCHAR), '|r',
       cast(k % 4 AS VARCHAR)) END AS hardware
FROM visits""",
    "profiles": """
SELECT uid, list(location ORDER BY ts, event_id) AS locations,
  coalesce(list(interest ORDER BY ts, event_id) FILTER (WHERE interest IS NOT NULL), []) AS interests,
  coalesce(list(operator ORDER BY ts, event_id) FILTER (WHERE operator IS NOT NULL), []) AS operators,
  coalesce(list(hardware ORDER BY ts, event_id) FILTER (WHERE hardware IS NOT NULL), []) AS hardware
FROM profile_events GROUP BY uid""",
    "sessions": f"""
SELECT concat('p', cast(cast(uid AS INT) % 2 AS VARCHAR)) AS platform,
  concat('m', cast(cast(uid AS INT) % 3 AS VARCHAR)) AS media_key, uid,
  concat('u', cast(cast(uid AS INT) % 6 AS VARCHAR)) AS ad_unit, cast(ts AS DATE) AS day,
  date_trunc('hour', ts) AS window_start,
  concat('pr', cast(cast(uid AS INT) % 7 AS VARCHAR)) AS province,
  concat('dm', cast(cast(uid AS INT) % 11 AS VARCHAR)) AS device_model,
  concat('n', cast(cast(uid AS INT) % 3 AS VARCHAR)) AS network,
  concat('10.', cast(cast(uid AS INT) % 4 AS VARCHAR), '.', cast(cast(uid AS INT) % 50 AS VARCHAR), '.1') AS device_ip,
  concat('op', cast(cast(uid AS INT) % 4 AS VARCHAR)) AS carrier,
  concat('ua', cast(cast(uid AS INT) % 5 AS VARCHAR)) AS user_agent,
  concat('os', cast(cast(uid AS INT) % 2 AS VARCHAR)) AS os,
  concat('v', cast(cast(uid AS INT) % 6 AS VARCHAR)) AS os_version,
  sha256(concat('35', lpad(uid, 13, '0'))) AS imei,
  concat('vd', cast(cast(uid AS INT) % 9 AS VARCHAR)) AS vendor,
  concat('r', cast(cast(uid AS INT) % 4 AS VARCHAR)) AS resolution,
  list({{'req': {{'ts': ts, 'ip': ip}},
        'imp': CASE WHEN app_id IN ('view', 'click', 'purchase') THEN {{'ts': ts, 'ip': ip}} END,
        'cli': CASE WHEN app_id IN ('click', 'purchase')
                    THEN {{'ts': ts, 'ip': CASE WHEN k % 10 = 0 THEN '{CLICK_RELAY_IP}' ELSE ip END}} END}}
       ORDER BY ts, event_id) AS events
FROM visits GROUP BY ALL""",
    "devices_raw": """
SELECT p_brand AS manufacturer, p_type AS model, cast(p_size AS VARCHAR) AS resolution,
  cast(l_suppkey AS VARCHAR) AS device_id
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "devices_ext": """
SELECT CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS manufacturer,
  CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS model,
  CASE WHEN p_size % 7 <> 0 THEN cast(p_size AS VARCHAR) END AS resolution,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN '12345'
       ELSE concat('35', lpad(cast(l_suppkey % 7 AS VARCHAR), 3, '0'), lpad(cast(l_orderkey AS VARCHAR), 10, '0'))
  END AS imei,
  cast(l_suppkey AS VARCHAR) AS android_id, cast(NULL AS VARCHAR) AS mac, cast(NULL AS VARCHAR) AS openudid
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "hardware_rows": """
SELECT CASE WHEN resolution IN ('8', '9') THEN concat(coalesce(manufacturer, 'empty'), '|', coalesce(model, 'unknow'))
            ELSE coalesce(manufacturer, 'empty') END AS f1,
  CASE WHEN resolution = '10' THEN '' ELSE coalesce(model, 'unknow') END AS f2,
  coalesce(resolution, 'empty') AS f3
FROM devices_ext""",
    "third_party_log": """
SELECT event_id AS record_id,
  concat('p', cast(cast(uid AS INT) % 2 AS VARCHAR)) AS plat,
  concat('m', cast(cast(uid AS INT) % 3 AS VARCHAR)) AS media,
  uid AS user_ref,
  concat('u', cast(cast(uid AS INT) % 6 AS VARCHAR)) AS slot,
  app_id AS action, epoch_us(ts) // 1000 AS at_ms, ip AS addr
FROM visits""",
}

VIEW_DEPS: dict[str, tuple[str, ...]] = {
    "visits": (),
    "profile_events": ("visits",),
    "profiles": ("profile_events",),
    "sessions": ("visits",),
    "devices_raw": (),
    "devices_ext": (),
    "hardware_rows": ("devices_ext",),
    "third_party_log": ("visits",),
}


@lru_cache(maxsize=None)
def _closure(names: tuple[str, ...]) -> tuple[str, ...]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for d in VIEW_DEPS[n]:
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return tuple(seen)


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with a WITH clause defining the named DuckDB views."""
    ctes = [f"{n} AS ({DUCKDB_VIEWS[n].strip()})" for n in _closure(tuple(names))]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
