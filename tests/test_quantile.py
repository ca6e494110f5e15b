import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adsentry.functions.quantile import exclusive_quantiles_frame


def brute(values, p, empty="zero"):
    """The fence rule, walked literally over the sorted distinct values."""
    n = len(values)
    below = 0
    for v in sorted(set(values)):
        if below >= p * n:
            return float(v)
        below += values.count(v)
    return 0.0 if empty == "zero" else (float(max(values)) if values else 0.0)


def q(spark, values, probs, **kw):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    r = exclusive_quantiles_frame(df, "v", probs, **kw).collect()[0]
    return [r[f"q{i}"] for i in range(len(probs))]


def test_one_to_hundred(spark):
    assert q(spark, list(range(1, 101)), [0.5, 0.95]) == [51.0, 96.0]


def test_top_value_holds_too_much(spark):
    assert q(spark, [1, 2] + [9] * 6, [0.5, 0.95]) == [0.0, 0.0]
    assert q(spark, [1, 2] + [9] * 6, [0.5, 0.95], empty="max") == [9.0, 9.0]


def test_empty_input(spark):
    assert q(spark, [], [0.5]) == [0.0]


def test_useless_sketch_is_exact(spark):
    # accuracy=1 gives a useless sketch: the band is as wide as it has to be
    values = [float(x % 37) for x in range(500)]
    assert q(spark, values, [0.25, 0.75], accuracy=1) == [brute(values, 0.25), brute(values, 0.75)]


def test_zero_and_one(spark):
    values = [3.0, 3.0, 5.0, 8.0]
    assert q(spark, values, [0.0, 1.0]) == [brute(values, 0.0), brute(values, 1.0)] == [3.0, 0.0]
    assert q(spark, [], [0.0]) == [0.0]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=80),
    st.sampled_from([0.25, 0.5, 0.75, 0.95]),
)
def test_matches_brute_force(spark, values, p):
    got = q(spark, [float(v) for v in values], [p])[0]
    assert math.isclose(got, brute(values, p))


@pytest.mark.parametrize("p", [0.5, 0.95])
def test_heavy_duplicates(spark, p):
    values = [1.0] * 800 + [float(x) for x in range(2, 202)]
    assert q(spark, values, [p]) == [brute(values, p)]
