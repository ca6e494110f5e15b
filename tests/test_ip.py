from pyspark.sql import functions as F

from adsentry.functions.ip import is_quad, matches_target, same_subnet24, subnet24


def test_quad_rule(spark):
    cases = {
        "1.2.3.4": True,
        "1.2.3.4.": True,
        "...4": True,
        "999.a.b.c": True,
        "1.2.3.": False,
        "1.2.3.4.5": False,
        "": False,
        None: False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "ip string")
    got = {r.ip: r.q for r in df.select("ip", is_quad("ip").alias("q")).collect()}
    assert got == cases


def test_strict_quad(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("999.a.b.c",), ("1.2.3.4.",), ("255.255.255.255",), ("256.1.1.1",)], "ip string")
    got = {r.ip: r.q for r in df.select("ip", is_quad("ip", strict=True).alias("q")).collect()}
    assert got == {"1.2.3.4": True, "999.a.b.c": False, "1.2.3.4.": False, "255.255.255.255": True, "256.1.1.1": False}


def test_subnet_and_target(spark):
    df = spark.createDataFrame([("106.2.230.7",), ("6.2.230.1",), ("1.2.3.4.",)], "ip string")
    out = df.select(
        "ip",
        subnet24("ip").alias("s"),
        matches_target("ip", "6.2.230").alias("c"),
        matches_target("ip", "6.2.230", "prefix").alias("p"),
    ).collect()
    got = {r.ip: (r.s, r.c, r.p) for r in out}
    assert got["106.2.230.7"] == ("106.2.230", True, False)
    assert got["6.2.230.1"] == ("6.2.230", True, True)
    assert got["1.2.3.4."] == ("1.2.3", False, False)


def test_same_subnet_uses_separators(spark):
    df = spark.createDataFrame([("1.23.4.5", "12.3.4.5"), ("1.2.3.4", "1.2.3.9"), ("", "1.2.3.4")], "a string, b string")
    got = [r.x for r in df.select(same_subnet24(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [False, True, False]
