"""Sessions that end by a pause, neighbours in blocks, watchlist tables, rules by name, correlations of maps."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from adsentry.operators import correlation, rules, sessions, subnet
from adsentry.operators.gap_sessions import gap_sessions

from conftest import rows

START = dt.datetime(2024, 1, 1)
SCHEMA = "uid string, ts timestamp_ntz, event_id bigint, clicks bigint"


def made(seed, n=600, hot=False):
    rng = random.Random(seed)
    users = [None, "a", "b", "c"] + ["hot"] * (12 if hot else 0)
    out = []
    for i in range(n):
        at = None if rng.random() < 0.02 else START + dt.timedelta(seconds=rng.choice([0, 30, 60, 61, 1800]) * rng.randrange(400))
        out.append((rng.choice(users), at, rng.randrange(n), rng.randrange(3)))
    return out


def expected(data, gap):
    by, out = {}, []
    for uid, at, tie, clicks in data:
        if at is not None:
            by.setdefault(uid, []).append((at, tie, clicks))
    for uid, events in by.items():
        run = []
        for e in sorted(events):
            if run and (e[0] - run[-1][0]).total_seconds() > gap:
                out.append((uid, run[0][0], run[-1][0], len(run), sum(c for *_, c in run)))
                run = []
            run.append(e)
        out.append((uid, run[0][0], run[-1][0], len(run), sum(c for *_, c in run)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 7, 65_536])
@pytest.mark.parametrize("gap", [60, 1800])
def test_sessions_equal_a_plain_walk(spark, block, gap):
    data = made(block + gap, hot=True)  # three quarters of the rows are one user's
    got = gap_sessions(spark.createDataFrame(data, SCHEMA), ["uid"], ["clicks"], gap_seconds=gap, block=block)
    assert rows(got, "uid", "session_start", "session_end", "n_events", "clicks") == expected(data, gap)


def test_a_session_runs_over_many_blocks_and_the_clock_hour(spark):
    data = [("u", START + dt.timedelta(minutes=i), i, 1) for i in range(50, 200)]
    got = gap_sessions(spark.createDataFrame(data, SCHEMA), ["uid"], ["clicks"], gap_seconds=60, block=4).collect()
    assert len(got) == 1 and (got[0].n_events, got[0].clicks) == (150, 150)
    assert gap_sessions(spark.createDataFrame([], SCHEMA), ["uid"]).collect() == []


@pytest.mark.parametrize("block", [1, 5, 64])
def test_neighbours_of_one_hot_hour(spark, block):
    rng = random.Random(block)
    data = []
    for i in range(600):
        hot = i % 3 == 0  # a third of all rows is one user's, in one hour
        at = START + dt.timedelta(seconds=rng.randrange(3600 if hot else 90_000))
        data.append(("hot" if hot else f"u{rng.randrange(9)}", at, i, rng.choice(["1.2.3.4", "1.2.3.9", "1.2.4.4", "", "1.2.3"])))
    df = spark.createDataFrame(data, "uid string, ts timestamp_ntz, event_id bigint, location string")
    lists = df.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "location"))).alias("e"))
    want = subnet.adjacent_subnet_histogram(lists.select("uid", F.col("e.location").alias("locations")))
    got = subnet.adjacent_subnet_histogram_flat(df, block=block)
    assert rows(got, "n_pairs", "n_profiles") == rows(want, "n_pairs", "n_profiles")


def test_watchlist_table_with_a_hot_address(spark):
    rng = random.Random(4)
    member = lambda ip: None if ip is None else (START, ip)
    data = []
    for i in range(900):
        imp = "9.9.9.9" if i % 3 == 0 else rng.choice([None, *[f"1.1.1.{j}" for j in range(9)]])
        data.append(("m", [(member("8.8.8.8"), member(imp), member(rng.choice([None, *[f"2.2.2.{j}" for j in range(60)]])))]))
    at = "struct<ts:timestamp_ntz,ip:string>"
    df = spark.createDataFrame([*data, ("m", []), ("m", None)], f"media_key string, events array<struct<req:{at},imp:{at},cli:{at}>>")
    for listed in ([], ["9.9.9.9", "1.1.1.3", "2.2.2.5", "2.2.2.6", "7.7.7.7"]):
        table = spark.createDataFrame([(x,) for x in [*listed, *listed, None]], "ip string")
        want = rows(sessions.watchlist_ip_events(df, listed), "kind", "ip", "n")
        for salts in (1, 8):
            assert rows(sessions.watchlist_ip_events(df, table, salts=salts), "kind", "ip", "n") == want


def test_rule_from_the_catalog(spark):
    facts = spark.createDataFrame(
        [("a", "location", str(i)) for i in range(5)] + [("b", "location", "1"), ("b", "carrier", "x"), ("a", "carrier", "x")],
        "uid string, kind string, value string",
    )
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION roams(kind STRING, n BIGINT) RETURNS BOOLEAN RETURN kind = 'location' AND n > 4")
    assert rows(rules.cheater_trials(facts, ["roams", "many_carriers"]), "uid", "rule", "n") == [("a", "roams", 5)]
    evidence = rules.cheater_evidence(facts, ["roams"])
    assert rows(evidence, "uid", "value") == [("a", str(i)) for i in range(5)]
    with pytest.raises(KeyError):
        rules.cheater_trials(facts, ["no_such_rule"])


def test_pearson_of_maps(spark):
    data = [
        (1, {1: 1.0, 2: 2.0, 3: 4.0}, {1: 2.0, 2: 4.0, 3: 8.0, 9: 1.0}),
        (2, {1: 1.0, 2: 2.0}, {1: 5.0, 2: 5.0}),
        (3, {1: 1.0}, {2: 1.0}),
        (4, {}, {}),
        (5, None, {1: 1.0}),
        (6, {1: None, 2: 1.0, 3: 2.0}, {1: 3.0, 2: 2.0, 3: 1.0}),
    ]
    df = spark.createDataFrame(data, "id int, x map<int,double>, y map<int,double>")
    got = {r.id: (r.s.n, r.s.score) for r in df.select("id", correlation.pearson_of_maps("x", "y").alias("s")).collect()}
    assert got[1][0] == 3 and math.isclose(got[1][1], 1.0) and got[2] == (2, 0.0)
    assert all(got[i][0] == 0 and math.isnan(got[i][1]) for i in (3, 4, 5))
    assert got[6][0] == 2 and math.isclose(got[6][1], -1.0)
