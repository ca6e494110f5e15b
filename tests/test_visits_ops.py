import datetime as dt

import pytest
from pyspark.sql import functions as F

from adsentry.operators import fences, hour_profile, subnet, target_ip
from adsentry.operators.correlation import pearson_score
from adsentry.plans.blacklist import build_blacklist
from adsentry.sources import fixtures as fx

from conftest import SF_MID, rows

VISITS = (
    "event_id BIGINT, uid STRING, app_id STRING, exchange_id STRING, ts TIMESTAMP_NTZ, ip STRING, "
    "orders ARRAY<STRUCT<view_ip: STRING, view_ts: TIMESTAMP_NTZ>>"
)


def make_visits(spark, recs):
    """recs: (uid, app, exchange, hour, ip, [view ips])"""
    out = []
    for i, (uid, app, ex, hour, ip, views) in enumerate(recs):
        ts = dt.datetime(2024, 1, 1, hour, 0, 0)
        out.append((i, uid, app, ex, ts, ip, [(v, ts) for v in views]))
    return spark.createDataFrame(out, VISITS)


def test_subnet_counts_and_histogram(spark):
    v = make_visits(
        spark,
        [
            ("u1", "a", "x", 1, "1.2.3.4", ["1.2.3.4", "1.2.3.5.", "9.9.9"]),
            ("u2", "a", "x", 2, "1.2.3.4", ["1.2.3.9", None]),
            ("u3", "b", "y", 3, None, []),
            ("u4", "b", "y", 3, None, ["5.6.7.8"]),
        ],
    )
    pv = subnet.subnet24_pv(v)
    assert rows(pv) == [("1.2.3", 3), ("5.6.7", 1)]
    assert rows(subnet.subnet24_pv_histogram(pv)) == [(1, 1), (3, 1)]
    assert rows(subnet.top_subnet24(v, threshold=2)) == [("1.2.3", 3)]
    assert rows(subnet.top_subnet24(v, threshold=3)) == []


def test_histogram_metamorphic(spark):
    v = fx.visits(spark, SF_MID)
    pv = subnet.subnet24_pv(v)
    hist = subnet.subnet24_pv_histogram(pv)
    total = pv.agg(F.sum("pv")).first()[0]
    assert hist.agg(F.sum(F.col("pv") * F.col("n_subnets"))).first()[0] == total


def test_target_ip(spark):
    v = make_visits(
        spark,
        [
            ("u1", "a", "x", 1, "106.2.230.7", ["106.2.230.7", "106.2.230.8"]),
            ("u1", "a", "x", 1, "6.2.230.1", ["6.2.230.1"]),
            ("u2", "b", "y", 5, "6.2.230.1.", []),
            ("u3", "b", "y", 5, "6.2.230", ["6.2.230"]),
        ],
    )
    assert rows(target_ip.ip_hour_counts(v, "6.2.230")) == [("01", 2), ("05", 1)]
    assert rows(target_ip.ip_hour_counts(v, "6.2.230", match="prefix")) == [("01", 1), ("05", 1)]
    # a record with two hitting view ips counts once
    assert rows(target_ip.target_ip_uid_freq(v, "6.2.230")) == [("u1", 2)]
    assert rows(target_ip.target_ip_app_freq(v, "6.2.230")) == [("a", 2)]
    assert rows(target_ip.target_ip_exchange_freq(v, "6.2.230")) == [("x", 2)]


def test_population_share_sums_to_one(spark):
    v = fx.visits(spark, SF_MID)
    share = hour_profile.population_hour_share(v)
    got = share.collect()
    assert len(got) == 24
    assert abs(sum(r.share for r in got) - 1.0) < 1e-12


def test_population_zero_fill(spark):
    v = make_visits(spark, [("u", "a", "x", 3, "1.1.1.1", []), ("u", "a", "x", 3, "1.1.1.1", [])])
    got = {r.hh: r.share for r in hour_profile.population_hour_share(v).collect()}
    assert got["03"] == 1.0 and got["04"] == 0.0 and len(got) == 24


def _brute_mse(counts, size, pop):
    return sum((counts.get(h, 0) / size - pop[h]) ** 2 for h in range(24)) / 24.0


def test_ip_hour_deviation_brute(spark):
    recs = [("u", "a", "x", h, ip, []) for ip, hours in {"1.1.1.1": [1, 1, 2], "2.2.2.2": [5], None: [1, 23]}.items() for h in hours]
    v = make_visits(spark, recs)
    got = {r.ip: (r.size, r.flag, r.coef) for r in hour_profile.ip_hour_deviation(v).collect()}
    pop = [0.0] * 24
    for r in recs:
        pop[r[3]] += 1 / len(recs)
    assert got["1.1.1.1"][0] == 3 and got["1.1.1.1"][1] is True
    assert abs(got["1.1.1.1"][2] - _brute_mse({1: 2, 2: 1}, 3, pop)) < 1e-12
    assert abs(got["2.2.2.2"][2] - _brute_mse({5: 1}, 1, pop)) < 1e-12
    assert None in got  # a NULL address is its own group by default
    dropped = hour_profile.ip_hour_deviation(v, drop_null_ip=True)
    assert None not in {r.ip for r in dropped.collect()}


@pytest.mark.parametrize("metric", ["mse", "rmse", "sse", "pearson"])
def test_metrics_run(spark, metric):
    v = make_visits(spark, [("u", "a", "x", h % 24, f"1.1.1.{h % 3}", []) for h in range(40)])
    out = hour_profile.ip_hour_deviation(v, metric=metric).collect()
    assert len(out) == 3 and all(r.coef is not None for r in out)


def test_fence_chain_subsets(spark):
    out = build_blacklist(fx.visits(spark, SF_MID))
    scores = {r.ip for r in out.scores.collect()}
    cands = {r.ip for r in out.candidates.collect()}
    black = {r.ip for r in out.blacklist.collect()}
    assert black <= cands <= scores
    assert len(black) == 1 and len(cands) == 21 and len(scores) == 822


def test_fences_empty_input(spark):
    empty = spark.createDataFrame([], "ip string, size bigint, flag boolean, coef double")
    assert fences.ip_volume_candidates(empty).count() == 0
    assert fences.ip_blacklist(empty.select("ip", "size", "coef")).count() == 0


def test_fence_zero_quantile_lets_everything_pass(spark):
    # the top value holds > 5 % of rows: q95 falls to 0, bound = -k q50 < 0, all pass
    sizes = [1] * 7 + [2] + [9] * 4
    df = spark.createDataFrame([(f"ip{i}", s, 0.1) for i, s in enumerate(sizes)], "ip string, size bigint, coef double")
    assert fences.ip_volume_candidates(df).count() == 12
    assert fences.ip_volume_candidates(df, empty="max").count() == 0


def test_pearson_edges(spark):
    a = spark.createDataFrame([("h1", 1.0), ("h2", 2.0), ("h3", 3.0)], "k string, v double")
    b = spark.createDataFrame([("h1", 2.0), ("h2", 4.0), ("h3", 6.0)], "k string, v double")
    c = spark.createDataFrame([("h1", 5.0), ("h2", 5.0), ("h3", 5.0)], "k string, v double")
    d = spark.createDataFrame([("z", 1.0)], "k string, v double")
    assert abs(pearson_score(a, b, "k", "v").first().score - 1.0) < 1e-12
    assert pearson_score(a, c, "k", "v").first().score == 0.0
    r = pearson_score(a, d, "k", "v").first()
    assert r.n == 0 and r.score != r.score  # NaN


def test_fence_diagnostics(spark):
    from adsentry.plans.blacklist import fence_diagnostics

    out = build_blacklist(fx.visits(spark, SF_MID))
    d = fence_diagnostics(out.scores, out.candidates, out.blacklist).first()
    assert (d.addresses, d.candidates, d.blacklisted) == (822, 21, 1)
    assert d.volume_q_low <= d.volume_q_high and d.score_q_low <= d.score_q_high
    big = out.candidates.agg(F.min("size")).first()[0]
    assert big > d.volume_upper_bound  # every candidate is above the volume fence


def test_target_strict_quad(spark):
    v = make_visits(
        spark,
        [("u1", "a", "x", 1, "6.2.230.1.", ["6.2.230.1."]), ("u2", "a", "x", 2, "6.2.230.9", ["6.2.230.9"])],
    )
    assert rows(target_ip.ip_hour_counts(v, "6.2.230")) == [("01", 1), ("02", 1)]
    assert rows(target_ip.ip_hour_counts(v, "6.2.230", strict=True)) == [("02", 1)]
    assert rows(target_ip.target_ip_uid_freq(v, "6.2.230", strict=True)) == [("u2", 1)]


def test_target_filter_reaches_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "visits")
    fx.visits(spark, SF_MID).write.parquet(path)
    stored = spark.read.parquet(path)
    for match, pushed in (("prefix", "StringStartsWith(ip,198.51.100.1)"), ("contains", "StringContains(ip,198.51.100.1)")):
        df = target_ip.ip_hour_counts(stored, "198.51.100.1", match=match)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        assert pushed in plan
        assert rows(df) == rows(target_ip.ip_hour_counts(fx.visits(spark, SF_MID), "198.51.100.1", match=match))


def test_pearson_grouped_keeps_one_sided_groups(spark):
    a = spark.createDataFrame([("g1", "h1", 1.0), ("g1", "h2", 2.0), ("g2", "h1", 1.0)], "g string, k string, v double")
    b = spark.createDataFrame([("g1", "h1", 2.0), ("g1", "h2", 4.0), ("g3", "h1", 1.0)], "g string, k string, v double")
    got = {r.g: (r.n, r.score) for r in pearson_score(a, b, "k", "v", by=["g"]).collect()}
    assert got["g1"][0] == 2 and abs(got["g1"][1] - 1.0) < 1e-12
    assert got["g2"][0] == 0 and got["g2"][1] != got["g2"][1]
    assert got["g3"][0] == 0 and got["g3"][1] != got["g3"][1]
