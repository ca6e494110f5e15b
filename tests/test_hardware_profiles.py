import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from adsentry.catalog import QUERIES
from adsentry.operators import hardware as hw
from adsentry.operators import profiles as po
from adsentry.operators import rules
from adsentry.operators.subnet import adjacent_subnet_histogram, adjacent_subnet_histogram_flat
from adsentry.sources import fixtures as fx

from conftest import SF_SMALL, rows

B = hw.IDEOGRAPHIC_BLANK


def test_hardware_clean_edges(spark):
    df = spark.createDataFrame(
        [
            ("a|b", "x", "c"),  # combined maker|model in f1 -> (a, b, c)
            ("Unknow", "m", "r"),  # case-sensitive: kept
            ("emp", "ty", "r"),  # the test is on the concatenation: dropped
            ("", "m", "r"),  # blank: dropped
            (B, "m", "r"),  # double ideographic space: dropped
            ("a", "p|q", "r"),  # combined in f2 -> (p, q, r)
            ("a|", "x", "r"),  # empty model after the split: dropped
            ("a", "unknow", "r"),
        ],
        "f1 string, f2 string, f3 string",
    )
    assert rows(hw.hardware_clean(df)) == [("Unknow", "m", "r"), ("a", "b", "c"), ("p", "q", "r")]


def test_tac_rule(spark):
    base = ("M", "X", "5")
    df = spark.createDataFrame(
        [(*base, "12345678901234", "a", None, None), (*base, "12345678901234", "b", None, None),
         (*base, "123456789012345", "c", None, None), (*base, "123459999999999", "d", None, None)],
        "manufacturer string, model string, resolution string, imei string, android_id string, mac string, openudid string",
    )
    assert rows(hw.hardware_tac_uv(df)) == [("M", "X", "5", "12345", 2), ("M", "X", "5", "unknow", 2)]
    assert rows(hw.hardware_tac_uv_unidentified(df)) == []


def test_hardware_library_drops_and_counts_nulls(spark):
    df = spark.createDataFrame(
        [("A", "X", "1", "d1"), ("A", "X", "1", "d2"), ("A", "X", "1", "d2"), ("B", "Y", "2", "d1"), (None, "Y", "2", "d3")],
        "manufacturer string, model string, resolution string, device_id string",
    )
    obs = Observation("nulls")
    pairs = hw.hardware_pairs(df, observation=obs)
    assert rows(hw.hardware_uv(pairs)) == [("A", "X", "1", 2)]
    assert obs.get["dropped_null_rows"] == 1
    dev = hw.device_hardware_count(pairs, hash_ids=False)
    assert rows(dev) == [("d1", 2), ("d2", 1)]
    import hashlib

    hashed = dict(rows(hw.device_hardware_count(pairs)))
    assert hashed == {hashlib.sha256(b"d1").hexdigest(): 2, hashlib.sha256(b"d2").hexdigest(): 1}
    assert rows(hw.hardware_count_histogram(dev)) == [(1, 1), (2, 1)]


def test_adjacent_subnet_edges(spark):
    df = spark.createDataFrame(
        [
            (["1.2.3.4", "1.2.3.5", "1.2.4.1"],),
            (["1.2.3.4", "", "1.2.3.4"],),
            (["1.2.3.4"],),
            ([],),
            (["1.23.4.5", "12.3.4.5"],),
            (["1.2.3.4", "1.2.3.4", "1.2.3.4"],),
        ],
        "locations array<string>",
    )
    assert rows(adjacent_subnet_histogram(df)) == [(0, 4), (1, 1), (2, 1)]


def test_profile_histograms(spark):
    df = spark.createDataFrame(
        [("u1", ["a", "a", "b"], ["op1", "op1"]), ("u2", ["a"], ["op1", "op2"]), ("u3", [], [])],
        "uid string, interests array<string>, operators array<string>",
    )
    assert rows(po.interest_pv(df)) == [("a", 3), ("b", 1)]
    assert rows(po.interest_uv(df)) == [("a", 2), ("b", 1)]
    assert rows(po.operator_count_histogram(df)) == [(0, 1), (1, 1), (2, 1)]
    assert rows(po.profile_uids(df)) == [("u1",), ("u2",), ("u3",)]


def test_interest_uv_le_pv(spark):
    p = fx.profiles(spark, SF_SMALL)
    pv = {r.interest: r.pv for r in po.interest_pv(p).collect()}
    uv = {r.interest: r.uv for r in po.interest_uv(p).collect()}
    assert set(uv) == set(pv) and all(uv[k] <= pv[k] for k in pv)


def test_rules_and_summary(spark):
    prof = spark.createDataFrame(
        [
            ("u1", 0, ["1.1.1.1", "6.6.6.6"], ["op0", "op1", "op2", "op3"]),
            ("u2", 0, ["6.6.6.6", "6.6.6.6"], ["op0"]),
            ("u3", 0, ["2.2.2.2"], ["op0", "op1"]),
            ("u1", 1, ["3.3.3.3"], ["op0"]),
        ],
        "uid string, epoch bigint, locations array<string>, operators array<string>",
    )
    black = spark.createDataFrame([("6.6.6.6",)], "ip string")
    facts = rules.facts_from_profiles(prof)
    trials = rules.cheater_trials(facts, ["many_carriers", "blacklisted_ip"], day="2024-01-02", blacklist=black)
    day = datetime.date(2024, 1, 2)
    expected = [
        ("u1", day, "blacklisted_ip", 1),
        ("u1", day, "many_carriers", 4),
        ("u2", day, "blacklisted_ip", 1),
    ]
    assert rows(trials) == expected
    assert rows(rules.cheater_summary([trials, trials])) == expected
    assert rows(rules.cheater_users(trials)) == [("u1", "blacklisted_ip,many_carriers"), ("u2", "blacklisted_ip")]


def test_whole_evidence_of_a_user_with_many_values(spark):
    ips, carriers = [f"6.6.6.{i}" for i in range(25)], [f"op{i}" for i in range(14)]
    prof = spark.createDataFrame(
        [("u1", ips + ips[:3], carriers), (None, ips[:2], carriers[:4]), ("u2", ["1.1.1.1"], carriers[:3])],
        "uid string, locations array<string>, operators array<string>",
    )
    facts = rules.facts_from_profiles(prof)
    black = spark.createDataFrame([(ip,) for ip in ips], "ip string")
    got = rules.cheater_evidence(facts, ["many_carriers", "blacklisted_ip"], day="2024-01-02", blacklist=black)
    assert got.columns == ["uid", "day", "rule", "value"]
    day = datetime.date(2024, 1, 2)
    expected = [("u1", day, "blacklisted_ip", ip) for ip in ips] + [("u1", day, "many_carriers", c) for c in carriers]
    expected += [(None, day, "blacklisted_ip", ip) for ip in ips[:2]] + [(None, day, "many_carriers", c) for c in carriers[:4]]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, expected))
    trials = rules.cheater_trials(facts, ["many_carriers", "blacklisted_ip"], day="2024-01-02", blacklist=black)
    counts = {(r.uid, r.rule): r.n for r in trials.collect()}
    assert counts == {
        ("u1", "blacklisted_ip"): 25, ("u1", "many_carriers"): 14, (None, "blacklisted_ip"): 2, (None, "many_carriers"): 4,
    }


def test_trials_carry_the_whole_evidence(spark):
    ips, carriers = [f"6.6.6.{i}" for i in range(25)], [f"op{i}" for i in range(14)]
    prof = spark.createDataFrame(
        [("u1", ips + ips[:3], carriers), (None, ips[:2], carriers[:4]), ("u2", ["1.1.1.1"], carriers[:3])],
        "uid string, locations array<string>, operators array<string>",
    )
    black = spark.createDataFrame([(ip,) for ip in ips], "ip string")
    facts = rules.facts_from_profiles(prof)
    day, names = datetime.date(2024, 1, 2), ["many_carriers", "blacklisted_ip"]
    trials = rules.cheater_trials(facts, names, day="2024-01-02", evidence=True, blacklist=black)
    joined = lambda values: ",".join(sorted(values))
    expected = [
        (None, day, "blacklisted_ip", 2, joined(ips[:2])),
        (None, day, "many_carriers", 4, joined(carriers[:4])),
        ("u1", day, "blacklisted_ip", 25, joined(ips)),
        ("u1", day, "many_carriers", 14, joined(carriers)),
    ]
    assert rows(trials) == sorted(expected, key=repr)
    assert rows(rules.cheater_summary([trials, trials])) == sorted(expected, key=repr)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION over_four(kind STRING, n BIGINT) RETURNS BOOLEAN RETURN n > 4")
    several = rules.cheater_trials(facts, ["over_four"], evidence=True)
    assert rows(several, "uid", "n", "evidence") == [("u1", 39, joined(ips + carriers))]


@pytest.mark.parametrize("name", ["cheater_trials", "cheater_summary"])
def test_queries_return_the_evidence_of_their_trials(spark, name):
    want = {}
    for r in QUERIES["cheater_evidence"](spark, SF_SMALL).collect():
        want.setdefault((r.uid, r.day, r.rule), []).append(r.value)
    got = QUERIES[name](spark, SF_SMALL)
    assert got.columns == ["uid", "day", "rule", "n", "evidence"]
    assert want and rows(got) == sorted(((*k, len(v), ",".join(sorted(v))) for k, v in want.items()), key=repr)


def test_flat_profile_forms_match_stored_ones(spark):
    """One user holds a third of all rows; flat and array forms agree, and nothing is cut by id."""
    ev = fx.profile_events(spark, SF_SMALL)
    hot = ev.unionByName(ev.where("event_id % 2 = 0").withColumn("uid", F.lit("hot")))
    e = F.array_sort(F.collect_list(F.struct("ts", "event_id", "location", "interest", "operator")))
    said = lambda c: F.filter(F.transform("e", lambda x: x[c]), lambda v: v.isNotNull())
    stored = hot.groupBy("uid").agg(e.alias("e")).select(
        "uid", said("location").alias("locations"), said("interest").alias("interests"), said("operator").alias("operators")
    )
    assert rows(adjacent_subnet_histogram_flat(hot)) == rows(adjacent_subnet_histogram(stored))
    assert rows(po.operator_count_histogram_flat(hot)) == rows(po.operator_count_histogram(stored))
    assert rows(po.interest_pv_flat(hot)) == rows(po.interest_pv(stored))
    assert rows(po.interest_uv_flat(hot)) == rows(po.interest_uv(stored))
    assert rows(po.profile_uids_flat(hot)) == rows(po.profile_uids(stored))


def test_hardware_library_plan(spark):
    from adsentry.plans.hardware import build_hardware_library

    lib = build_hardware_library(fx.devices_raw(spark, SF_SMALL))
    uv = lib.hardware_uv.count()
    assert uv > 0 and lib.clean_library.count() <= uv
    dev = lib.device_hardware_count.agg({"n_hardware": "sum"}).first()[0]
    hist = lib.hardware_count_histogram.selectExpr("sum(n_hardware * n_devices)").first()[0]
    assert dev == hist
    assert lib.dropped.get["dropped_null_rows"] == 0
    spark.catalog.clearCache()


def test_ingest_field_maps(spark):
    from adsentry.sources import ingest

    raw = spark.createDataFrame(
        [({"manufact": "A", "dvc_model": "X", "resolution": "1", "dvc": "d1"},),
         ({"manufact": "A", "dvc_model": "X", "resolution": "1", "dvc": "d2"},),
         ({"manufact": "B", "dvc": "d3"},)],
        "fields map<string,string>",
    )
    flat = ingest.devices_from_fields(raw)
    assert rows(flat)[2] == ("B", None, None, "d3")  # missing keys are NULL
    assert rows(hw.hardware_uv(hw.hardware_pairs(flat))) == [("A", "X", "1", 2)]
    ext = spark.createDataFrame(
        [({"imei": "123456789012345", "android_id": "a"}, None, "720"),
         ({"imei": "123459999999999", "android_id": "b"}, None, "720")],
        "fields map<string,string>, os_model string, os_resolution string",
    )
    out = hw.hardware_tac_uv_unidentified(ingest.devices_ext_from_fields(ext))
    assert rows(out) == [("empty", "empty", "720", "12345", 2)]


def test_ingest_with_a_salt_hides_identifiers_and_keeps_the_tables(spark):
    from adsentry.sources import ingest

    ids = [("123456789012345", "a"), ("123459999999999", "b"), ("123459999999999", "b"), ("99", "c"), (None, "d"), ("99", None)]
    ext = spark.createDataFrame(
        [({"manufact": "M", **{k: v for k, v in (("imei", i), ("android_id", a)) if v}}, "X", "720") for i, a in ids],
        "fields map<string,string>, os_model string, os_resolution string",
    )
    plain, hidden = ingest.devices_ext_from_fields(ext), ingest.devices_ext_from_fields(ext, salt="s3")
    assert rows(hw.hardware_tac_uv(plain)) == rows(hw.hardware_tac_uv(hidden)) == [("M", "X", "720", "12345", 2), ("M", "X", "720", "unknow", 3)]
    shown = {v for r in hidden.select("imei", "android_id").collect() for v in r if v}
    assert not shown & {v for pair in ids for v in pair}
    assert hidden.where("android_id IS NULL").count() == plain.where("android_id IS NULL").count() == 1
    flat = spark.createDataFrame([({"dvc": "d1"},), ({"dvc": "d1"},), ({},)], "fields map<string,string>")
    one = [r.device_id for r in ingest.devices_from_fields(flat, salt="x").collect()]
    two = [r.device_id for r in ingest.devices_from_fields(flat, salt="y").collect()]
    assert one[0] == one[1] != two[0] and one[2] is None and "d1" not in one
