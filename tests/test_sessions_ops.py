import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from adsentry.functions.ranking import dense_index
from adsentry.operators import sessions as so
from adsentry.sources import fixtures as fx

from conftest import SF_SMALL, rows

SESSIONS = (
    "platform STRING, media_key STRING, uid STRING, ad_unit STRING, day DATE, "
    "events ARRAY<STRUCT<req: STRUCT<ts: TIMESTAMP_NTZ, ip: STRING>, imp: STRUCT<ts: TIMESTAMP_NTZ, ip: STRING>, "
    "cli: STRUCT<ts: TIMESTAMP_NTZ, ip: STRING>>>"
)
T = dt.datetime(2024, 1, 1, 7, 30)
D = dt.date(2024, 1, 1)


def ev(req=None, imp=None, cli=None):
    m = lambda ip: (T, ip) if ip is not None else None
    return (m(req), m(imp), m(cli))


def test_watchlist_precedence(spark):
    s = spark.createDataFrame(
        [
            ("p", "m0", "u1", "a", D, [ev("1.1.1.1", "9.9.9.9", "8.8.8.8"), ev("1.1.1.1", "1.1.1.1", "8.8.8.8"), ev("1.1.1.1")]),
            ("p", "m5", "u2", "a", D, [ev("1.1.1.1", "9.9.9.9")]),
        ],
        SESSIONS,
    )
    out = so.watchlist_ip_events(s, ["9.9.9.9", "8.8.8.8"], ["m0"])
    assert rows(out) == [("Other", "Other", 1), ("cli", "8.8.8.8", 1), ("imp", "9.9.9.9", 1)]
    wl = spark.createDataFrame([("9.9.9.9",), ("8.8.8.8",)], "ip string")
    assert rows(so.watchlist_ip_events(s, wl, ["m0"])) == rows(out)


def test_session_counts_key_and_sums(spark):
    s = spark.createDataFrame(
        [
            ("p", "m0", "u1", "a", D, [ev("1.1.1.1", "1.1.1.1"), ev("1.1.1.2", "1.1.1.2", "3.3.3.3")]),
            ("p", "m0", "u1", "a", D, [ev("1.1.1.1", "1.1.1.1"), ev("1.1.1.2", "1.1.1.2", "3.3.3.3")]),
            ("p", "m0", "u1", "a", D, []),
        ],
        SESSIONS,
    )
    got = rows(so.session_counts(s, ["platform", "media_key", "uid"]))
    assert (("p", "m0", "u1", 7, ["1.1.1.1", "1.1.1.2"], ["3.3.3.3"], 4, 4, 2)) in got
    assert ("p", "m0", "u1", None, [], [], 0, 0, 0) in got


def test_pv_ranges(spark):
    evs = [ev(f"1.1.1.{i % 3}", "2.2.2.2" if i < 7 else None) for i in range(10)]
    s = spark.createDataFrame([("p", "m0", "u1", "a", D, evs)], SESSIONS)
    got = rows(so.ip_pv_range(s))
    # REQ: .0 x4, .1 x3, .2 x3 -> 2-5 three times; IMP: 2.2.2.2 x7 -> 6-20
    assert got == [("IMP", "6-20", 1), ("REQ", "2-5", 3)]
    assert rows(so.user_pv_range(s)) == [("IMP", "6-20", 1), ("REQ", "6-20", 1)]


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 500).select(
        (F.col("id") % 7).cast("string").alias("g"), F.format_string("k%04d", (F.col("id") * 37) % 500).alias("k")
    )
    got = dense_index(df, ["k"], group_col="g", num_partitions=5)
    want = df.withColumn("idx", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert rows(got, "g", "k", "idx") == rows(want, "g", "k", "idx")


def test_new_user_index_contiguous(spark):
    idx = so.new_user_index(fx.sessions(spark, SF_SMALL))
    per_day = idx.groupBy("day").agg(F.count("*").alias("n"), F.max("idx").alias("m"), F.min("idx").alias("lo"))
    assert all(r.n == r.m and r.lo == 1 for r in per_day.collect())


def test_user_new_index_join(spark):
    s = fx.sessions(spark, SF_SMALL)
    counts = so.session_counts(s, ["platform", "media_key", "uid", "ad_unit", "day"])
    out = so.user_new_index(counts, so.new_user_index(s))
    assert out.count() == counts.count()
    assert out.where("is_new").select("media_key", "uid").distinct().count() == so.new_user_index(s).count()


def test_third_party_normalize_drops_failures(spark):
    log = fx.third_party_log(spark, SF_SMALL)
    out = so.third_party_normalize(log)
    want = log.where(F.col("user_ref").isNotNull() & (F.col("action") != "error")).count()
    assert out.count() == want
    assert out.where(F.size("events") != 1).count() == 0
    assert set(out.columns) == {"platform", "media_key", "uid", "ad_unit", "day", "events"}


def test_scans_read_only_used_nested_fields(spark, tmp_path):
    import re

    from adsentry.operators import subnet

    fx.visits(spark, SF_SMALL).write.parquet(str(tmp_path / "v"))
    fx.sessions(spark, SF_SMALL).write.parquet(str(tmp_path / "s"))

    def read_schema(df):
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return re.findall(r"ReadSchema: ([^\n]*)", plan)

    assert read_schema(subnet.subnet24_pv(spark.read.parquet(str(tmp_path / "v")))) == [
        "struct<orders:array<struct<view_ip:string>>>"
    ]
    from adsentry.operators import target_ip

    assert read_schema(target_ip.target_ip_app_freq(spark.read.parquet(str(tmp_path / "v")), "203.0.113")) == [
        "struct<app_id:string,orders:array<struct<view_ip:string>>>"
    ]
    watch = so.watchlist_ip_events(spark.read.parquet(str(tmp_path / "s")), ["203.0.113.9"], ["m0"])
    assert read_schema(watch) == [
        "struct<media_key:string,events:array<struct<imp:struct<ip:string>,cli:struct<ip:string>>>>"
    ]


def test_third_party_rejects_counted(spark):
    from pyspark.sql import Observation

    log = fx.third_party_log(spark, SF_SMALL)
    seen = Observation("tp")
    n = so.third_party_normalize(log, observation=seen).count()
    got = seen.get
    assert got["records"] == log.count() and got["records"] - got["rejected"] == n
    assert got["rejected"] == log.where(F.col("action") == "error").count()
