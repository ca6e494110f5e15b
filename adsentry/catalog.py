"""Registered queries: one Spark callable and one DuckDB oracle per operator.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs an operator over the
derived views of the given tables (whole tables, every row). ``ORACLE[name]``
is an independent DuckDB formulation over the same parquet tables; the
driver compares the two at sf0.01. Computed columns carry the same alias on
both sides. Arrays in outputs are rendered as comma-joined strings on both
sides so the comparison does not depend on how each engine prints lists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsentry.functions.hours import HOURS
from adsentry.operators import correlation, fences, gap_sessions, hardware, hour_profile, rules, subnet, target_ip
from adsentry.operators import profiles as profiles_ops
from adsentry.operators import user_bitmaps
from adsentry.operators import sessions as sessions_ops
from adsentry.plans import hour_store, reports
from adsentry.plans.blacklist import blacklist_of_counts, build_blacklist
from adsentry.plans.common import materialize
from adsentry.sources import fixtures as fx
from adsentry.sources.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered queries.
HOUR_TARGET = "198.51.100.1"  # substring: hits .1 and .10-.19 of the range
ORDER_TARGET = "203.0.113"
TOP_PV = 100  # the operator's default threshold is above every subnet of the given tables

# DuckDB spellings of the column helpers (oracle side only).
SQL_QUAD = "(length(rtrim({x}, '.')) - length(replace(rtrim({x}, '.'), '.', '')) = 3)"
SQL_SUBNET = "array_to_string(string_split({x}, '.')[1:3], '.')"
SQL_HH = "lpad(cast(hour({x}) AS VARCHAR), 2, '0')"


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def _v(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fx.view(spark, sf_dir, name)


# --------------------------------------------------------------------------
# A-01 .. A-03: subnets


@register(
    "subnet24_pv",
    with_views(
        f"""
SELECT {SQL_SUBNET.format(x='v')} AS subnet, count(*) AS pv
FROM (SELECT u.view_ip AS v FROM (SELECT unnest(orders) AS u FROM visits))
WHERE {SQL_QUAD.format(x='v')}
GROUP BY 1""",
        "visits",
    ),
)
def q_subnet24_pv(spark, sf_dir):
    return subnet.subnet24_pv(_v(spark, sf_dir, "visits")).orderBy(F.desc("pv"), "subnet")


@register(
    "subnet24_pv_histogram",
    with_views(
        f"""
SELECT pv, count(*) AS n_subnets FROM (
  SELECT {SQL_SUBNET.format(x='v')} AS subnet, count(*) AS pv
  FROM (SELECT u.view_ip AS v FROM (SELECT unnest(orders) AS u FROM visits))
  WHERE {SQL_QUAD.format(x='v')} GROUP BY 1)
GROUP BY pv""",
        "visits",
    ),
)
def q_subnet24_pv_histogram(spark, sf_dir):
    pv = subnet.subnet24_pv(_v(spark, sf_dir, "visits"))
    return subnet.subnet24_pv_histogram(pv).orderBy(F.desc("pv"))


@register(
    "top_subnet24",
    with_views(
        f"""
SELECT * FROM (
  SELECT {SQL_SUBNET.format(x='v')} AS subnet, count(*) AS pv
  FROM (SELECT u.view_ip AS v FROM (SELECT unnest(orders) AS u FROM visits))
  WHERE {SQL_QUAD.format(x='v')} GROUP BY 1)
WHERE pv > {TOP_PV}""",
        "visits",
    ),
)
def q_top_subnet24(spark, sf_dir):
    return subnet.top_subnet24(_v(spark, sf_dir, "visits"), TOP_PV).orderBy(F.desc("pv"), "subnet")


# --------------------------------------------------------------------------
# A-04 .. A-07: one target address


@register(
    "ip_hour_counts",
    with_views(
        f"""
SELECT {SQL_HH.format(x='ts')} AS hh, count(*) AS n FROM visits
WHERE {SQL_QUAD.format(x='ip')} AND contains(ip, '{HOUR_TARGET}')
GROUP BY 1""",
        "visits",
    ),
)
def q_ip_hour_counts(spark, sf_dir):
    return target_ip.ip_hour_counts(_v(spark, sf_dir, "visits"), HOUR_TARGET).orderBy("hh")


def _target_sql(col: str) -> str:
    cond = f"{SQL_QUAD.format(x='o.view_ip')} AND contains(o.view_ip, '{ORDER_TARGET}')"
    return with_views(
        f"""
SELECT {col}, count(*) AS n FROM visits
WHERE len(list_filter(orders, lambda o: {cond})) > 0
GROUP BY {col}""",
        "visits",
    )


@register("target_ip_uid_freq", _target_sql("uid"))
def q_target_ip_uid_freq(spark, sf_dir):
    return target_ip.target_ip_uid_freq(_v(spark, sf_dir, "visits"), ORDER_TARGET).orderBy(F.desc("n"), "uid")


@register("target_ip_app_freq", _target_sql("app_id"))
def q_target_ip_app_freq(spark, sf_dir):
    return target_ip.target_ip_app_freq(_v(spark, sf_dir, "visits"), ORDER_TARGET).orderBy(F.desc("n"), "app_id")


@register("target_ip_exchange_freq", _target_sql("exchange_id"))
def q_target_ip_exchange_freq(spark, sf_dir):
    df = target_ip.target_ip_exchange_freq(_v(spark, sf_dir, "visits"), ORDER_TARGET)
    return df.orderBy(F.desc("n"), "exchange_id")


# --------------------------------------------------------------------------
# A-08 .. A-12: hour profiles and fences

_SQL_POP = """
pop_counts AS (SELECT hour(ts) AS h, count(*) AS c FROM visits GROUP BY 1),
pop_total AS (SELECT count(*) AS n FROM visits),
pop AS (SELECT g.range AS h, coalesce(c.c, 0) / t.n AS p
        FROM range(24) g LEFT JOIN pop_counts c ON c.h = g.range CROSS JOIN pop_total t)"""

_SQL_POP_WIDE = "pop_wide AS (SELECT " + ", ".join(
    f"max(p) FILTER (WHERE h = {h}) AS p{h:02d}" for h in HOURS
) + " FROM pop)"

_SQL_PER_IP = (
    "per_ip AS (SELECT ip, count(*) AS size, "
    + ", ".join(f"count(*) FILTER (WHERE hour(ts) = {h}) AS c{h:02d}" for h in HOURS)
    + " FROM visits GROUP BY ip)"
)

_SQL_MSE = (
    "("
    + " + ".join(f"(c{h:02d} / size - p{h:02d}) * (c{h:02d} / size - p{h:02d})" for h in HOURS)
    + f") / {float(len(HOURS))}"
)

_SQL_SCORES = f"""WITH {_SQL_POP},
{_SQL_POP_WIDE},
{_SQL_PER_IP},
scores AS (SELECT ip, size, true AS flag, {_SQL_MSE} AS coef FROM per_ip CROSS JOIN pop_wide)"""


def _sql_xquantile(src: str, col: str, p: float) -> str:
    """Exclusive quantile in SQL: first distinct value with rows-below >= p * n, else 0."""
    return f"""coalesce((SELECT min(v) FROM (
  SELECT v, coalesce(sum(cnt) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(cnt) OVER () AS n
  FROM (SELECT {col} AS v, count(*) AS cnt FROM {src} GROUP BY 1)) WHERE below >= {p} * n), 0)"""


_SQL_CANDIDATES = f"""{_SQL_SCORES},
vq AS (SELECT {_sql_xquantile('scores', 'size', fences.VOLUME_LOW_P)} AS ql,
              {_sql_xquantile('scores', 'size', fences.VOLUME_HIGH_P)} AS qh),
vb AS (SELECT lqh + {fences.VOLUME_K} * (lqh - lql) AS bound FROM (
         SELECT CASE WHEN ql > 0 THEN ln(ql) ELSE 0.0 END AS lql,
                CASE WHEN qh > 0 THEN ln(qh) ELSE 0.0 END AS lqh FROM vq)),
candidates AS (SELECT ip, size, coef FROM scores CROSS JOIN vb WHERE ln(size) > bound)"""


@register(
    "population_hour_share",
    with_views(
        f"""WITH {_SQL_POP}
SELECT lpad(cast(h AS VARCHAR), 2, '0') AS hh, p AS share FROM pop""",
        "visits",
    ),
)
def q_population_hour_share(spark, sf_dir):
    return hour_profile.population_hour_share(_v(spark, sf_dir, "visits")).orderBy("hh")


@register("ip_hour_deviation", with_views(f"{_SQL_SCORES}\nSELECT * FROM scores", "visits"))
def q_ip_hour_deviation(spark, sf_dir):
    return hour_profile.ip_hour_deviation(_v(spark, sf_dir, "visits"))


@register("ip_hour_deviation_ranked", with_views(f"{_SQL_SCORES}\nSELECT * FROM scores WHERE flag", "visits"))
def q_ip_hour_deviation_ranked(spark, sf_dir):
    return hour_profile.ip_hour_deviation_ranked(hour_profile.ip_hour_deviation(_v(spark, sf_dir, "visits")))


@register("ip_volume_candidates", with_views(f"{_SQL_CANDIDATES}\nSELECT * FROM candidates", "visits"))
def q_ip_volume_candidates(spark, sf_dir):
    scores = materialize(hour_profile.ip_hour_deviation(_v(spark, sf_dir, "visits")))
    return fences.ip_volume_candidates(scores).orderBy(F.desc("coef"), F.asc_nulls_first("ip"))


@register(
    "ip_blacklist",
    with_views(
        f"""{_SQL_CANDIDATES},
sq AS (SELECT {_sql_xquantile('candidates', 'coef', fences.SCORE_LOW_P)} AS ql,
              {_sql_xquantile('candidates', 'coef', fences.SCORE_HIGH_P)} AS qh)
SELECT ip FROM candidates CROSS JOIN sq WHERE coef > qh + {fences.SCORE_K} * (qh - ql)""",
        "visits",
    ),
)
def q_ip_blacklist(spark, sf_dir):
    return build_blacklist(_v(spark, sf_dir, "visits")).blacklist


_SQL_WEEK_COUNTS = ", ".join(f"count(*) FILTER (WHERE hour(ts) = {h}) AS {{p}}{h:02d}" for h in HOURS)
_SQL_WEEK_MSE = (
    "("
    + " + ".join(f"(c{h:02d} / size - p{h:02d} / total) * (c{h:02d} / size - p{h:02d} / total)" for h in HOURS)
    + f") / {float(len(HOURS))}"
)


@register(
    "ip_hour_deviation_weeks",
    with_views(
        f"""WITH v AS (SELECT date_trunc('week', ts)::DATE AS week, ip, ts FROM visits WHERE ts IS NOT NULL),
per_ip AS (SELECT week, ip, count(*) AS size, {_SQL_WEEK_COUNTS.format(p='c')} FROM v GROUP BY week, ip),
pop AS (SELECT week, count(*) AS total, {_SQL_WEEK_COUNTS.format(p='p')} FROM v GROUP BY week)
SELECT week, ip, size, true AS flag, {_SQL_WEEK_MSE} AS coef FROM per_ip JOIN pop USING (week)""",
        "visits",
    ),
)
def q_ip_hour_deviation_weeks(spark, sf_dir):
    return hour_store.weekly_deviation(materialize(hour_store.day_counts(_v(spark, sf_dir, "visits"))))


BLACKLIST_START, BLACKLIST_END = "2024-01-03", "2024-01-29"


@register(
    "ip_blacklist_days",
    with_views(
        f"""{_SQL_CANDIDATES.replace('FROM visits', f"FROM visits WHERE ts >= TIMESTAMP '{BLACKLIST_START}' AND ts < TIMESTAMP '{BLACKLIST_END}'")},
sq AS (SELECT {_sql_xquantile('candidates', 'coef', fences.SCORE_LOW_P)} AS ql,
              {_sql_xquantile('candidates', 'coef', fences.SCORE_HIGH_P)} AS qh)
SELECT s.ip, s.size, s.coef, c.size IS NOT NULL AS candidate,
  coalesce(c.coef > qh + {fences.SCORE_K} * (qh - ql), false) AS listed
FROM scores s LEFT JOIN candidates c ON c.ip IS NOT DISTINCT FROM s.ip CROSS JOIN sq""",
        "visits",
    ),
)
def q_ip_blacklist_days(spark, sf_dir):
    stored = materialize(hour_store.day_counts(_v(spark, sf_dir, "visits")))
    days = stored.where((F.col("day") >= F.lit(BLACKLIST_START).cast("date")) & (F.col("day") < F.lit(BLACKLIST_END).cast("date")))
    out = blacklist_of_counts(hour_store.merged_counts(days))
    rows = out.scores.select("ip", "size", "coef")
    for name, hits in (("candidate", out.candidates), ("listed", out.blacklist)):
        hit = hits.select(F.col("ip").alias("_ip"), F.lit(True).alias("_hit"))
        rows = rows.join(hit, F.col("ip").eqNullSafe(F.col("_ip")), "left").withColumn(name, F.coalesce("_hit", F.lit(False)))
        rows = rows.drop("_ip", "_hit")
    return rows


# --------------------------------------------------------------------------
# A-13: correlation of two hour profiles (clicks against views)


def _sql_share(name: str, app: str) -> str:
    return f"""{name}_c AS (SELECT hour(ts) AS h, count(*) AS c FROM visits WHERE app_id = '{app}' GROUP BY 1),
{name}_t AS (SELECT count(*) AS n FROM visits WHERE app_id = '{app}'),
{name} AS (SELECT lpad(cast(g.range AS VARCHAR), 2, '0') AS hh, coalesce(c.c, 0) / t.n AS share
           FROM range(24) g LEFT JOIN {name}_c c ON c.h = g.range CROSS JOIN {name}_t t)"""


@register(
    "pearson_score",
    with_views(
        f"""WITH {_sql_share('cx', 'click')},
{_sql_share('vy', 'view')},
s AS (SELECT count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(y * y) AS syy, sum(x * y) AS sxy
      FROM (SELECT cx.share AS x, vy.share AS y FROM cx JOIN vy USING (hh)))
SELECT n, round(CASE WHEN n = 0 THEN 'nan'::DOUBLE WHEN den = 0 THEN 0.0 ELSE num / den END, 9) AS score
FROM (SELECT n, sxy - sx * sy / n AS num, sqrt((sxx - sx * sx / n) * (syy - sy * sy / n)) AS den FROM s)""",
        "visits",
    ),
)
def q_pearson_score(spark, sf_dir):
    v = _v(spark, sf_dir, "visits")
    clicks = hour_profile.population_hour_share(v.where(F.col("app_id") == "click"))
    views = hour_profile.population_hour_share(v.where(F.col("app_id") == "view"))
    out = correlation.pearson_score(clicks, views, "hh", "share")
    return out.select("n", F.round("score", 9).alias("score"))


def _sql_share_by(name: str, app: str, by: str) -> str:
    return f"""{name}_c AS (SELECT {by}, hour(ts) AS h, count(*) AS c FROM visits WHERE app_id = '{app}' GROUP BY 1, 2),
{name}_t AS (SELECT {by}, count(*) AS n FROM visits WHERE app_id = '{app}' GROUP BY 1),
{name} AS (SELECT t.{by}, lpad(cast(g.range AS VARCHAR), 2, '0') AS hh, coalesce(c.c, 0) / t.n AS share
           FROM {name}_t t CROSS JOIN range(24) g LEFT JOIN {name}_c c ON c.{by} = t.{by} AND c.h = g.range)"""


@register(
    "pearson_score_by_exchange",
    with_views(
        f"""WITH {_sql_share_by('cx', 'click', 'exchange_id')},
{_sql_share_by('vy', 'view', 'exchange_id')},
s AS (SELECT exchange_id, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(y * y) AS syy,
             sum(x * y) AS sxy
      FROM (SELECT exchange_id, cx.share AS x, vy.share AS y FROM cx JOIN vy USING (exchange_id, hh))
      GROUP BY exchange_id)
SELECT exchange_id, n,
  round(CASE WHEN n = 0 THEN 'nan'::DOUBLE WHEN den = 0 THEN 0.0 ELSE num / den END, 9) AS score
FROM (SELECT g.exchange_id, coalesce(s.n, 0) AS n, sxy - sx * sy / s.n AS num,
             sqrt((sxx - sx * sx / s.n) * (syy - sy * sy / s.n)) AS den
      FROM (SELECT exchange_id FROM cx UNION SELECT exchange_id FROM vy) g LEFT JOIN s USING (exchange_id))""",
        "visits",
    ),
)
def q_pearson_score_by_exchange(spark, sf_dir):
    v = _v(spark, sf_dir, "visits")
    by = ["exchange_id"]
    clicks = hour_profile.population_hour_share(v.where(F.col("app_id") == "click"), by=by)
    views = hour_profile.population_hour_share(v.where(F.col("app_id") == "view"), by=by)
    out = correlation.pearson_score(clicks, views, "hh", "share", by=by)
    return out.select("exchange_id", "n", F.round("score", 9).alias("score"))


@register(
    "pearson_of_hour_maps",
    with_views(
        """WITH c AS (SELECT uid, hour(ts) AS h, count(*) AS x FROM visits WHERE app_id = 'click' GROUP BY 1, 2),
v AS (SELECT uid, hour(ts) AS h, count(*) AS y FROM visits WHERE app_id = 'view' GROUP BY 1, 2),
s AS (SELECT uid, count(*) AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy, sum(x * x)::DOUBLE AS sxx, sum(y * y)::DOUBLE AS syy,
             sum(x * y)::DOUBLE AS sxy FROM c JOIN v USING (uid, h) GROUP BY uid)
SELECT u.uid, coalesce(s.n, 0) AS n,
  round(CASE WHEN s.n IS NULL THEN 'nan'::DOUBLE WHEN den = 0 THEN 0.0 ELSE num / den END, 9) AS score
FROM (SELECT DISTINCT uid FROM visits) u
LEFT JOIN (SELECT uid, n, sxy - sx * sy / n AS num, sqrt((sxx - sx * sx / n) * (syy - sy * sy / n)) AS den FROM s) s
  ON s.uid IS NOT DISTINCT FROM u.uid""",
        "visits",
    ),
)
def q_pearson_of_hour_maps(spark, sf_dir):
    v = _v(spark, sf_dir, "visits").select("uid", "app_id", F.hour("ts").alias("h"))
    count = lambda app, h: F.count(F.when((F.col("app_id") == app) & (F.col("h") == h), F.lit(1)))
    hours = F.array(*[F.lit(h) for h in HOURS])
    # maps of the hours that have traffic
    per_user = v.groupBy("uid").agg(
        *[F.map_filter(F.map_from_arrays(hours, F.array(*[count(app, h) for h in HOURS])), lambda h, n: n > 0).alias(app)
          for app in ("click", "view")]
    )
    score = per_user.select("uid", correlation.pearson_of_maps("click", "view").alias("s"))
    return score.select("uid", "s.n", F.round("s.score", 9).alias("score"))


# --------------------------------------------------------------------------
# A-14 .. A-21: sessions and reports

WATCH_IPS = (fx.HEAVY_IP, fx.CLICK_RELAY_IP)
WATCH_MEDIA = ("m0", "m1")
COUNT_DIMS = sessions_ops.SESSION_DIMS + sessions_ops.DEVICE_DIMS + ("day",)
NULL_TOKEN = "<null>"
BACKFILL_START, BACKFILL_END = "2024-01-10", "2024-01-20"


def _sql_list(items) -> str:
    return ", ".join(f"'{x}'" for x in items)


_SQL_IMPS = "list_filter(events, lambda e: e.imp IS NOT NULL)"
_SQL_CLIS = "list_filter(events, lambda e: e.cli IS NOT NULL)"
_SQL_COUNTS = f"""counts AS (
SELECT {', '.join(COUNT_DIMS)},
  hour(struct_extract(struct_extract(events[1], 'req'), 'ts'))::INTEGER AS hour,
  array_to_string(list_transform({_SQL_IMPS}, lambda e: coalesce(e.imp.ip, '{NULL_TOKEN}')), ',') AS imp_ips,
  array_to_string(list_transform({_SQL_CLIS}, lambda e: coalesce(e.cli.ip, '{NULL_TOKEN}')), ',') AS cli_ips,
  sum(len(events))::BIGINT AS requests, sum(len({_SQL_IMPS}))::BIGINT AS impressions,
  sum(len({_SQL_CLIS}))::BIGINT AS clicks
FROM sessions GROUP BY ALL)"""


def _render_lists(df: DataFrame) -> DataFrame:
    return df.withColumn("imp_ips", F.array_join("imp_ips", ",", NULL_TOKEN)).withColumn(
        "cli_ips", F.array_join("cli_ips", ",", NULL_TOKEN)
    )


@register("session_counts", with_views(f"WITH {_SQL_COUNTS}\nSELECT * FROM counts", "sessions"))
def q_session_counts(spark, sf_dir):
    return _render_lists(sessions_ops.session_counts(_v(spark, sf_dir, "sessions"), COUNT_DIMS))


@register(
    "watchlist_ip_events",
    with_views(
        f"""
SELECT CASE WHEN e.imp.ip IN ({_sql_list(WATCH_IPS)}) THEN 'imp'
            WHEN e.cli.ip IN ({_sql_list(WATCH_IPS)}) THEN 'cli' ELSE 'Other' END AS kind,
       CASE WHEN e.imp.ip IN ({_sql_list(WATCH_IPS)}) THEN e.imp.ip
            WHEN e.cli.ip IN ({_sql_list(WATCH_IPS)}) THEN e.cli.ip ELSE 'Other' END AS ip,
       count(*) AS n
FROM (SELECT unnest(events) AS e FROM sessions WHERE media_key IN ({_sql_list(WATCH_MEDIA)}))
GROUP BY 1, 2""",
        "sessions",
    ),
)
def q_watchlist_ip_events(spark, sf_dir):
    return sessions_ops.watchlist_ip_events(_v(spark, sf_dir, "sessions"), WATCH_IPS, WATCH_MEDIA)


@register(
    "watchlist_table_events",
    with_views(
        """WITH w AS (SELECT DISTINCT ip FROM visits WHERE app_id = 'purchase' AND k % 5 = 0 AND ip IS NOT NULL),
ev AS (SELECT e.imp.ip AS imp_ip, e.cli.ip AS cli_ip FROM (SELECT unnest(events) AS e FROM sessions)),
hit AS (SELECT *, imp_ip IS NOT NULL AND imp_ip IN (SELECT ip FROM w) AS i, cli_ip IS NOT NULL AND cli_ip IN (SELECT ip FROM w) AS c FROM ev)
SELECT CASE WHEN i THEN 'imp' WHEN c THEN 'cli' ELSE 'Other' END AS kind,
  CASE WHEN i THEN imp_ip WHEN c THEN cli_ip ELSE 'Other' END AS ip, count(*) AS n
FROM hit GROUP BY 1, 2""",
        "visits",
        "sessions",
    ),
)
def q_watchlist_table_events(spark, sf_dir):
    bought = (F.col("app_id") == "purchase") & (F.col("k") % 5 == 0)
    return sessions_ops.watchlist_ip_events(_v(spark, sf_dir, "sessions"), _v(spark, sf_dir, "visits").where(bought).select("ip"))


SESSION_GAP = 12 * 3600  # the given tables have an event a user every few hours


@register(
    "gap_session_counts",
    with_views(
        f"""WITH e AS (SELECT uid, exchange_id, ts, event_id, (app_id IN ('view', 'click', 'purchase'))::BIGINT AS impressions,
    (app_id IN ('click', 'purchase'))::BIGINT AS clicks FROM visits WHERE ts IS NOT NULL),
m AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER o) <= {SESSION_GAP * 1_000_000} THEN 0 ELSE 1 END AS s
      FROM e WINDOW o AS (PARTITION BY uid, exchange_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(s) OVER (PARTITION BY uid, exchange_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS nr FROM m)
SELECT uid, exchange_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
  sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks
FROM g GROUP BY uid, exchange_id, nr""",
        "visits",
    ),
)
def q_gap_session_counts(spark, sf_dir):
    flag = lambda *apps: F.col("app_id").isin(*apps).cast("int").cast("long")
    events = _v(spark, sf_dir, "visits").select(
        "uid", "exchange_id", "ts", "event_id",
        flag("view", "click", "purchase").alias("impressions"), flag("click", "purchase").alias("clicks"),
    )
    return gap_sessions.gap_sessions(events, ["uid", "exchange_id"], ["impressions", "clicks"], gap_seconds=SESSION_GAP)


_SQL_NEW_USERS = """new_users AS (
SELECT media_key, uid, day, row_number() OVER (PARTITION BY day ORDER BY media_key, uid) AS idx
FROM (SELECT media_key, uid, min(day) AS day FROM sessions GROUP BY 1, 2))"""


@register("user_new_index", with_views(f"WITH {_SQL_NEW_USERS}\nSELECT * FROM new_users", "sessions"))
def q_user_new_index(spark, sf_dir):
    return sessions_ops.new_user_index(_v(spark, sf_dir, "sessions"))


@register(
    "session_counts_new_users",
    with_views(
        f"""WITH {_SQL_NEW_USERS},
counts AS (
  SELECT media_key, uid, day, sum(len(coalesce(events, [])))::BIGINT AS requests,
    sum(len(list_filter(coalesce(events, []), lambda e: e.imp IS NOT NULL)))::BIGINT AS impressions,
    sum(len(list_filter(coalesce(events, []), lambda e: e.cli IS NOT NULL)))::BIGINT AS clicks
  FROM sessions GROUP BY 1, 2, 3)
SELECT c.*, u.idx, u.idx IS NOT NULL AS is_new FROM counts c
LEFT JOIN new_users u ON c.media_key IS NOT DISTINCT FROM u.media_key
  AND c.uid IS NOT DISTINCT FROM u.uid AND c.day IS NOT DISTINCT FROM u.day""",
        "sessions",
    ),
)
def q_session_counts_new_users(spark, sf_dir):
    sessions = _v(spark, sf_dir, "sessions")
    return sessions_ops.user_new_index(reports.user_day_counts(sessions, ["day"]), sessions_ops.new_user_index(sessions))


@register(
    "user_bitmap_weeks",
    with_views(
        """WITH seen AS (
  SELECT DISTINCT media_key, uid, date_trunc('week', day)::DATE AS week FROM sessions WHERE uid IS NOT NULL AND day IS NOT NULL),
f AS (SELECT *, min(week) OVER (PARTITION BY media_key, uid) AS first FROM seen)
SELECT week, media_key, count(DISTINCT uid) AS users, count(DISTINCT uid) FILTER (WHERE first < week) AS returning_users,
  count(DISTINCT uid) FILTER (WHERE first = week) AS new_users
FROM f GROUP BY week, media_key""",
        "sessions",
    ),
)
def q_user_bitmap_weeks(spark, sf_dir):
    sessions = _v(spark, sf_dir, "sessions")
    stored = materialize(user_bitmaps.day_bitmaps(sessions, user_bitmaps.user_numbers(sessions)))
    return user_bitmaps.weekly_users(stored)


_SQL_RANGE = (
    "CASE WHEN pv = 1 THEN '1' WHEN pv <= 5 THEN '2-5' WHEN pv <= 20 THEN '6-20' "
    "WHEN pv <= 100 THEN '21-100' ELSE '>100' END"
)


def _sql_members(by: str) -> str:
    sel = f"{by}, " if by else ""
    return f"""ev AS (SELECT {sel}uid, unnest(events) AS e FROM sessions),
members AS (
  SELECT {sel}'REQ' AS kind, e.req.ip AS ip, uid FROM ev WHERE e.req IS NOT NULL
  UNION ALL SELECT {sel}'IMP', e.imp.ip, uid FROM ev WHERE e.imp IS NOT NULL
  UNION ALL SELECT {sel}'CLI', e.cli.ip, uid FROM ev WHERE e.cli IS NOT NULL)"""


def _sql_pv_hist(key: str, by: str = "") -> str:
    sel = f"{by}, " if by else ""
    return f"""SELECT {sel}kind, {_SQL_RANGE} AS pv_range, count(*) AS n
FROM (SELECT {sel}kind, {key}, count(*) AS pv FROM members GROUP BY ALL) GROUP BY ALL"""


@register("ip_pv_range", with_views(f"WITH {_sql_members('')}\n{_sql_pv_hist('ip')}", "sessions"))
def q_ip_pv_range(spark, sf_dir):
    return sessions_ops.ip_pv_range(_v(spark, sf_dir, "sessions"))


@register("user_pv_range", with_views(f"WITH {_sql_members('')}\n{_sql_pv_hist('uid')}", "sessions"))
def q_user_pv_range(spark, sf_dir):
    return sessions_ops.user_pv_range(_v(spark, sf_dir, "sessions"))


def _sql_report_long(where: str = "") -> str:
    """Report rows; ``where`` restricts the reported days (history stays whole)."""
    members = _sql_members("day").replace("FROM sessions)", f"FROM sessions {where})", 1)
    counts = _SQL_COUNTS.replace("FROM sessions GROUP BY ALL)", f"FROM sessions {where} GROUP BY ALL)", 1)
    return f"""WITH {members},
iph AS ({_sql_pv_hist('ip', 'day')}),
uph AS ({_sql_pv_hist('uid', 'day')}),
{counts},
first_day AS (SELECT media_key, uid, min(day) AS fday, true AS hit FROM sessions GROUP BY 1, 2),
np AS (SELECT c.day, c.media_key, CASE WHEN f.hit THEN 'new' ELSE 'known' END AS user_kind,
         count(DISTINCT c.uid) AS users, sum(requests)::BIGINT AS requests,
         sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks
       FROM counts c LEFT JOIN first_day f ON c.media_key IS NOT DISTINCT FROM f.media_key
         AND c.uid IS NOT DISTINCT FROM f.uid AND c.day IS NOT DISTINCT FROM f.fday
       GROUP BY 1, 2, 3)
SELECT 'AD_IP_PVRANGE_' || kind AS report, day, pv_range AS bucket, 'n' AS metric, n AS value FROM iph
UNION ALL SELECT 'AD_USER_PVRANGE_' || kind, day, pv_range, 'n', n FROM uph
UNION ALL SELECT 'AD_NEW_USER_PV', day, media_key || '|' || user_kind, 'users', users FROM np
UNION ALL SELECT 'AD_NEW_USER_PV', day, media_key || '|' || user_kind, 'requests', requests FROM np
UNION ALL SELECT 'AD_NEW_USER_PV', day, media_key || '|' || user_kind, 'impressions', impressions FROM np
UNION ALL SELECT 'AD_NEW_USER_PV', day, media_key || '|' || user_kind, 'clicks', clicks FROM np"""


@register("report_suite", with_views(_sql_report_long(), "sessions"))
def q_report_suite(spark, sf_dir):
    return reports.report_rows(_v(spark, sf_dir, "sessions"))


_SQL_BACKFILL = with_views(
    _sql_report_long(f"WHERE day >= DATE '{BACKFILL_START}' AND day < DATE '{BACKFILL_END}'").replace(
        "first_day AS (SELECT media_key, uid, min(day) AS fday, true AS hit FROM sessions GROUP BY 1, 2)",
        f"first_day AS (SELECT media_key, uid, min(day) AS fday, true AS hit FROM sessions WHERE day < DATE '{BACKFILL_END}'"
        " GROUP BY 1, 2)",
    ),
    "sessions",
)


@register("daily_backfill", _SQL_BACKFILL)
def q_daily_backfill(spark, sf_dir):
    return reports.daily_backfill(_v(spark, sf_dir, "sessions"), BACKFILL_START, BACKFILL_END)


@register(
    "third_party_normalize",
    with_views(
        """
SELECT plat AS platform, media AS media_key, user_ref AS uid, slot AS ad_unit,
  cast(epoch_ms(at_ms) AS DATE) AS day, 1 AS n_events, epoch_ms(at_ms) AS req_ts, addr AS req_ip,
  action IN ('view', 'click', 'purchase') AS has_imp, action IN ('click', 'purchase') AS has_cli
FROM third_party_log
WHERE user_ref IS NOT NULL AND action IN ('view', 'click', 'purchase', 'signup')""",
        "third_party_log",
    ),
)
def q_third_party_normalize(spark, sf_dir):
    s = sessions_ops.third_party_normalize(_v(spark, sf_dir, "third_party_log"))
    first = F.get(F.col("events"), 0)
    return s.select(
        "platform", "media_key", "uid", "ad_unit", "day",
        F.size("events").alias("n_events"),
        first["req"]["ts"].alias("req_ts"),
        first["req"]["ip"].alias("req_ip"),
        first["imp"].isNotNull().alias("has_imp"),
        first["cli"].isNotNull().alias("has_cli"),
    )


# --------------------------------------------------------------------------
# A-22, A-23: cheater rules

TRIAL_RULES = ("many_carriers", "many_hardware", "blacklisted_ip")
TRIAL_DAY = "2024-01-31"

_SQL_TRIALS = f"""{_SQL_CANDIDATES},
sq AS (SELECT {_sql_xquantile('candidates', 'coef', fences.SCORE_LOW_P)} AS ql,
              {_sql_xquantile('candidates', 'coef', fences.SCORE_HIGH_P)} AS qh),
blacklist AS (SELECT ip FROM candidates CROSS JOIN sq WHERE coef > qh + {fences.SCORE_K} * (qh - ql)),
hits AS (
  SELECT uid, 'many_carriers' AS rule, list_sort(list_distinct(operators)) AS v
  FROM profiles WHERE len(list_distinct(operators)) > {rules.MAX_CARRIERS}
  UNION ALL
  SELECT uid, 'many_hardware', list_sort(list_distinct(hardware))
  FROM profiles WHERE len(list_distinct(hardware)) > {rules.MAX_HARDWARE}
  UNION ALL
  SELECT uid, 'blacklisted_ip', list_sort(list_distinct(list(ip)))
  FROM (SELECT uid, unnest(list_distinct(locations)) AS ip FROM profiles)
  WHERE ip IN (SELECT ip FROM blacklist) GROUP BY uid),
trials AS (SELECT uid, DATE '{TRIAL_DAY}' AS day, rule, len(v)::BIGINT AS n FROM hits)"""


_SQL_WHOLE = f"uid, DATE '{TRIAL_DAY}' AS day, rule, len(v)::BIGINT AS n, array_to_string(v, ',') AS evidence"


def _trials(spark, sf_dir, run=rules.cheater_trials, **more):
    black = build_blacklist(_v(spark, sf_dir, "visits")).blacklist
    facts = rules.facts_from_events(_v(spark, sf_dir, "profile_events"))
    return run(facts, TRIAL_RULES, day=TRIAL_DAY, blacklist=black, **more)


@register("cheater_trials", with_views(f"{_SQL_TRIALS}\nSELECT {_SQL_WHOLE} FROM hits", "visits", "profiles"))
def q_cheater_trials(spark, sf_dir):
    return _trials(spark, sf_dir, evidence=True)


@register(
    "cheater_evidence",
    with_views(f"{_SQL_TRIALS}\nSELECT uid, DATE '{TRIAL_DAY}' AS day, rule, unnest(v) AS value FROM hits", "visits", "profiles"),
)
def q_cheater_evidence(spark, sf_dir):
    return _trials(spark, sf_dir, rules.cheater_evidence)


ROAMER_LIMIT = 40


@register(
    "cheater_trials_sql_rule",
    with_views(
        f"""SELECT uid, DATE '{TRIAL_DAY}' AS day, 'many_places' AS rule, count(DISTINCT location) AS n
FROM profile_events GROUP BY uid HAVING count(DISTINCT location) > {ROAMER_LIMIT}
UNION ALL SELECT uid, DATE '{TRIAL_DAY}', 'many_carriers', count(DISTINCT operator)
FROM profile_events GROUP BY uid HAVING count(DISTINCT operator) > {rules.MAX_CARRIERS}""",
        "profile_events",
    ),
)
def q_cheater_trials_sql_rule(spark, sf_dir):
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION many_places(kind STRING, n BIGINT) RETURNS BOOLEAN "
        f"RETURN kind = 'location' AND n > {ROAMER_LIMIT}"
    )
    facts = rules.facts_from_events(_v(spark, sf_dir, "profile_events"))
    return rules.cheater_trials(facts, ("many_places", "many_carriers"), day=TRIAL_DAY)


@register("cheater_summary", with_views(f"{_SQL_TRIALS}\nSELECT DISTINCT {_SQL_WHOLE} FROM hits", "visits", "profiles"))
def q_cheater_summary(spark, sf_dir):
    return rules.cheater_summary(_trials(spark, sf_dir, evidence=True))


@register(
    "cheater_users",
    with_views(
        f"""{_SQL_TRIALS}
SELECT uid, array_to_string(list_sort(list_distinct(list(rule))), ',') AS rules
FROM trials WHERE uid IS NOT NULL GROUP BY uid""",
        "visits",
        "profiles",
    ),
)
def q_cheater_users(spark, sf_dir):
    return rules.cheater_users(rules.cheater_summary(_trials(spark, sf_dir)))


# --------------------------------------------------------------------------
# A-24 .. A-29: hardware

_SQL_PAIRS = """pairs AS (SELECT DISTINCT manufacturer, model, resolution, device_id FROM devices_raw
  WHERE manufacturer IS NOT NULL AND model IS NOT NULL AND resolution IS NOT NULL AND device_id IS NOT NULL)"""
_SQL_DEV_COUNT = "dev AS (SELECT sha256(device_id) AS device_id, count(*) AS n_hardware FROM pairs GROUP BY device_id)"


@register(
    "hardware_uv",
    with_views(
        f"""WITH {_SQL_PAIRS}
SELECT manufacturer, model, resolution, count(*) AS uv FROM pairs GROUP BY 1, 2, 3 HAVING count(*) > 1""",
        "devices_raw",
    ),
)
def q_hardware_uv(spark, sf_dir):
    return hardware.hardware_uv(hardware.hardware_pairs(_v(spark, sf_dir, "devices_raw")))


@register("device_hardware_count", with_views(f"WITH {_SQL_PAIRS}, {_SQL_DEV_COUNT}\nSELECT * FROM dev", "devices_raw"))
def q_device_hardware_count(spark, sf_dir):
    return hardware.device_hardware_count(hardware.hardware_pairs(_v(spark, sf_dir, "devices_raw")))


@register(
    "hardware_count_histogram",
    with_views(
        f"""WITH {_SQL_PAIRS}, {_SQL_DEV_COUNT}
SELECT n_hardware, count(*) AS n_devices FROM dev GROUP BY 1""",
        "devices_raw",
    ),
)
def q_hardware_count_histogram(spark, sf_dir):
    pairs = hardware.hardware_pairs(_v(spark, sf_dir, "devices_raw"))
    return hardware.hardware_count_histogram(hardware.device_hardware_count(pairs)).orderBy("n_devices", "n_hardware")


TAC_KEY = ("manufacturer", "model", "resolution", "tac")


def _sql_tac(pred: str) -> str:
    return with_views(
        f"""
SELECT coalesce(manufacturer, 'empty') AS manufacturer, coalesce(model, 'empty') AS model,
  coalesce(resolution, 'empty') AS resolution,
  CASE WHEN length(imei) >= 15 THEN substr(imei, 1, 5) ELSE 'unknow' END AS tac, count(*) AS uv
FROM (SELECT DISTINCT manufacturer, model, resolution, imei, android_id, mac, openudid FROM devices_ext WHERE {pred})
GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""",
        "devices_ext",
    )


@register("hardware_tac_uv_unidentified", _sql_tac("manufacturer IS NULL AND model IS NULL"))
def q_hardware_tac_uv_unidentified(spark, sf_dir):
    return hardware.hardware_tac_uv_unidentified(_v(spark, sf_dir, "devices_ext")).orderBy(F.desc("uv"), *TAC_KEY)


@register("hardware_tac_uv", _sql_tac("manufacturer IS NOT NULL AND model IS NOT NULL"))
def q_hardware_tac_uv(spark, sf_dir):
    return hardware.hardware_tac_uv(_v(spark, sf_dir, "devices_ext")).orderBy(F.desc("uv"), *TAC_KEY)


def _sql_part(i: int) -> str:
    return (
        f"CASE WHEN contains(f1, '|') THEN string_split(f1, '|')[{i}] "
        f"WHEN contains(f2, '|') THEN string_split(f2, '|')[{i}] ELSE f{i} END"
    )


_BLANK = hardware.IDEOGRAPHIC_BLANK


@register(
    "hardware_clean",
    with_views(
        f"""
SELECT * FROM (SELECT {_sql_part(1)} AS manufacturer, {_sql_part(2)} AS model, f3 AS resolution FROM hardware_rows)
WHERE NOT contains(manufacturer || model || resolution, 'empty')
  AND NOT contains(manufacturer || model || resolution, 'unknow')
  AND manufacturer <> '' AND model <> '' AND resolution <> ''
  AND manufacturer <> '{_BLANK}' AND model <> '{_BLANK}' AND resolution <> '{_BLANK}'""",
        "hardware_rows",
    ),
)
def q_hardware_clean(spark, sf_dir):
    return hardware.hardware_clean(_v(spark, sf_dir, "hardware_rows"))


# --------------------------------------------------------------------------
# A-30 .. A-34: profiles


@register(
    "operator_count_histogram",
    with_views(
        "SELECT len(list_distinct(operators))::INTEGER AS n_operators, count(*) AS n_profiles FROM profiles GROUP BY 1",
        "profiles",
    ),
)
def q_operator_count_histogram(spark, sf_dir):
    return profiles_ops.operator_count_histogram_flat(_v(spark, sf_dir, "profile_events")).orderBy("n_operators")


@register(
    "interest_pv",
    with_views("SELECT interest, count(*) AS pv FROM (SELECT unnest(interests) AS interest FROM profiles) GROUP BY 1",
               "profiles"),
)
def q_interest_pv(spark, sf_dir):
    return profiles_ops.interest_pv_flat(_v(spark, sf_dir, "profile_events"))


@register(
    "interest_uv",
    with_views(
        "SELECT interest, count(*) AS uv FROM (SELECT unnest(list_distinct(interests)) AS interest FROM profiles) "
        "GROUP BY 1",
        "profiles",
    ),
)
def q_interest_uv(spark, sf_dir):
    return profiles_ops.interest_uv_flat(_v(spark, sf_dir, "profile_events"))


def _sql_same24(a: str, b: str) -> str:
    return (
        f"({a} <> '' AND {b} <> '' AND {SQL_QUAD.format(x=a)} AND {SQL_QUAD.format(x=b)} "
        f"AND {SQL_SUBNET.format(x=a)} = {SQL_SUBNET.format(x=b)})"
    )


@register(
    "adjacent_subnet_histogram",
    with_views(
        f"""
SELECT len(list_filter(range(1, len(locations)),
                       lambda i: {_sql_same24('locations[i]', 'locations[i + 1]')}))::INTEGER AS n_pairs,
       count(*) AS n_profiles
FROM profiles GROUP BY 1""",
        "profiles",
    ),
)
def q_adjacent_subnet_histogram(spark, sf_dir):
    return subnet.adjacent_subnet_histogram_flat(_v(spark, sf_dir, "profile_events")).orderBy("n_pairs")


@register("profile_uids", with_views("SELECT uid FROM profiles", "profiles"))
def q_profile_uids(spark, sf_dir):
    return profiles_ops.profile_uids_flat(_v(spark, sf_dir, "profile_events"))
