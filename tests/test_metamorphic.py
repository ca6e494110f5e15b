"""Row order and partitioning must not change any result (SURVEY §5 (3))."""

from pyspark.sql import functions as F

from adsentry.operators import hardware as hw
from adsentry.operators import hour_profile, sessions, subnet
from adsentry.plans.blacklist import build_blacklist
from adsentry.sources import fixtures as fx

from conftest import SF_MID, rows


def _variants(df):
    yield df
    yield df.repartition(1)
    yield df.repartition(7, F.rand(3))
    yield df.orderBy(F.desc(df.columns[0]))


def _same(results):
    first = results[0]
    assert all(r == first for r in results[1:])


def test_visits_operators_invariant(spark):
    v = fx.visits(spark, SF_MID).persist()
    _same([rows(subnet.subnet24_pv(x)) for x in _variants(v)])
    _same([rows(hour_profile.ip_hour_deviation(x)) for x in _variants(v)])  # integer inputs: bit-identical
    _same([rows(build_blacklist(x, materialize_how="persist").blacklist) for x in _variants(v)])
    v.unpersist()
    spark.catalog.clearCache()


def test_session_and_device_operators_invariant(spark):
    s = fx.sessions(spark, SF_MID).persist()
    dims = ["platform", "media_key", "uid", "ad_unit", "day"]
    _same([rows(sessions.session_counts(x, dims)) for x in _variants(s)])
    _same([rows(sessions.ip_pv_range(x)) for x in _variants(s)])
    d = fx.devices_raw(spark, SF_MID).persist()
    _same([rows(hw.hardware_uv(hw.hardware_pairs(x))) for x in _variants(d)])
    p = fx.profiles(spark, SF_MID).persist()
    _same([rows(subnet.adjacent_subnet_histogram(x)) for x in _variants(p)])
    for f in (s, d, p):
        f.unpersist()
