import datetime as dt
import os

from pyspark.sql import functions as F

from adsentry.operators import hardware as hw
from adsentry.plans import reports
from adsentry.sources import fixtures as fx
from adsentry.sources import readers, sinks
from adsentry.operators import hour_profile

from conftest import SF_SMALL, rows


def test_score_tuples(spark):
    lines = spark.createDataFrame(
        [("(1.2.3.4,10,true,0.5)",), ("(1.2.3.4, 5.6.7.8,12,true,0.25)",), ("(bad,x,true,0.1)",)], "value string"
    )
    assert rows(readers.parse_score_tuples(lines)) == [("1.2.3.4", 10, 0.5), ("1.2.3.4", 12, 0.25)]
    assert readers.parse_score_tuples(lines, keep_rejects=True).where("reject").count() == 1


def test_hardware_tuples_and_clean(spark):
    lines = spark.createDataFrame([("((A|B,x,720),3)",), ("(A,B)",), ("((C,D,1080),5)",)], "value string")
    parsed = readers.parse_hardware_tuples(lines)
    assert rows(parsed) == [("A|B", "x", "720"), ("C", "D", "1080")]
    assert rows(hw.hardware_clean(parsed)) == [("A", "B", "720"), ("C", "D", "1080")]


def test_text_round_trip(spark, scratch):
    scores = hour_profile.ip_hour_deviation(fx.visits(spark, SF_SMALL)).where(F.col("ip").isNotNull())
    path = os.path.join(scratch, "scores")
    sinks.write_text(scores, path, ["ip", "size", "flag", "coef"])
    back = readers.read_score_tuples(spark, path)
    assert rows(back) == rows(scores, "ip", "size", "coef")


def test_single_file_and_delimited(spark, scratch):
    share = hour_profile.population_hour_share(fx.visits(spark, SF_SMALL))
    path = os.path.join(scratch, "pop")
    sinks.write_single_file(share, path)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(path, parts[0])) as fh:
        assert len(fh.read().splitlines()) == 24


def test_parquet_modes(spark, scratch):
    df = spark.range(3)
    path = os.path.join(scratch, "p")
    sinks.write_parquet(df, path, mode="errorifexists")
    try:
        sinks.write_parquet(df, path, mode="errorifexists")
        raise AssertionError("second append-once write must fail")
    except Exception as exc:  # AnalysisException: path already exists
        assert "already exists" in str(exc).lower() or "PATH_ALREADY_EXISTS" in str(exc)
    sinks.write_parquet(df, path)  # overwrite replaces
    assert readers.read_records(spark, path).count() == 3


def test_backfill_range_and_idempotent(spark, scratch):
    s = fx.sessions(spark, SF_SMALL)
    assert reports.daily_backfill(s, "2024-01-05", "2024-01-05").count() == 0
    out = reports.daily_backfill(s, "2024-01-03", "2024-01-05")
    days = {r.day for r in out.select("day").distinct().collect()}
    assert days == {dt.date(2024, 1, 3), dt.date(2024, 1, 4)}  # end day excluded
    path = os.path.join(scratch, "reports")
    reports.write_backfill(out, path, "2024-01-03", "2024-01-05")
    first = rows(spark.read.parquet(path))
    again = reports.daily_backfill(s, "2024-01-04", "2024-01-05")  # re-run one day
    reports.write_backfill(again, path, "2024-01-04", "2024-01-05")
    assert rows(spark.read.parquet(path)) == first


def test_report_suite_outputs(spark):
    outs = reports.report_suite(fx.sessions(spark, SF_SMALL))
    assert set(outs) == {
        *(f"AD_IP_PVRANGE_{k}" for k in ("REQ", "IMP", "CLI")),
        *(f"AD_USER_PVRANGE_{k}" for k in ("REQ", "IMP", "CLI")),
        "AD_NEW_USER_PV",
    }


def test_emptied_day_loses_its_rows_and_platforms_stay_apart(spark, scratch):
    s = fx.sessions(spark, SF_SMALL).where(F.col("day") < F.lit("2024-01-06").cast("date"))
    span, path, by = ("2024-01-03", "2024-01-06"), os.path.join(scratch, "days"), ("platform", "day")
    reports.write_backfill(reports.daily_backfill(s, *span, by=by), path, *span)
    full = spark.read.parquet(path)
    before = rows(full, "platform", "day", "report", "bucket", "metric", "value")
    plats = sorted(r[0] for r in full.select("platform").distinct().collect())
    gone = F.col("day") == F.lit("2024-01-04").cast("date")
    mine = F.col("platform") == plats[0]
    reports.write_backfill(
        reports.daily_backfill(s.where(~gone & mine), *span, by=by), path, *span, platforms=[plats[0]]
    )
    after = spark.read.parquet(path)
    assert after.where(gone & mine).count() == 0 and after.where(~gone & mine).count() > 0
    others = rows(after.where(~mine), "platform", "day", "report", "bucket", "metric", "value")
    assert others == [r for r in before if r[0] != plats[0]] and len(plats) > 1


def test_stored_first_seen_gives_the_same_reports(spark, scratch):
    s = fx.sessions(spark, SF_SMALL).where(F.col("day") < F.lit("2024-01-08").cast("date"))
    path, stored = os.path.join(scratch, "first"), os.path.join(scratch, "sessions_by_day")
    s.write.partitionBy("day").parquet(stored)
    for a, b in (("2024-01-01", "2024-01-05"), ("2024-01-06", "2024-01-08"), ("2024-01-05", "2024-01-06")):
        reports.update_first_seen(s, path, a, b)  # a day filled in late
    assert rows(reports.read_first_seen(spark, path)) == rows(reports.first_seen(s))
    span = ("2024-01-06", "2024-01-07")
    kept = spark.read.schema(s.schema).parquet(stored)
    got = reports.daily_backfill(kept, *span, new_users=reports.read_first_seen(spark, path, span[1]))
    assert rows(got, "report", "day", "bucket", "metric", "value") == rows(
        reports.daily_backfill(s, *span), "report", "day", "bucket", "metric", "value"
    )
    # every scan of the sessions is cut to the one day by its partition filter
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    scans = [x for x in plan.split("\n\n") if "Scan parquet" in x and stored in x]
    assert scans and all("PartitionFilters" in x and "2024-01-06" in x for x in scans)


def test_report_rows_shuffle_count(spark):
    plan = reports.report_rows(spark.createDataFrame([], fx.sessions(spark, SF_SMALL).schema))
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert text.count("Exchange hashpartitioning") <= 4


def test_all_reports_share_one_scan(spark, scratch):
    stored = os.path.join(scratch, "sessions")
    s = fx.sessions(spark, SF_SMALL)
    s.write.parquet(stored)
    plan = reports.report_rows(spark.read.schema(s.schema).parquet(stored))
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") <= 3


def test_reports_of_sessions_without_events_users_or_days(spark):
    at = "struct<ts:timestamp_ntz,ip:string>"
    schema = f"platform string, media_key string, uid string, day date, events array<struct<req:{at},imp:{at},cli:{at}>>"
    made = spark.sql("SELECT timestamp_ntz'2024-01-01 01:00:00' AS ts, '1.1.1.1' AS ip").collect()[0]
    hit = ((made.ts, made.ip), (made.ts, None), None)
    day = made.ts.date()
    s = spark.createDataFrame([("p", "m", "u", day, None), ("p", "m", None, day, [hit, hit]), ("p", None, "u", None, [hit])], schema)
    got = {(r.report, r.day, r.bucket, r.metric): r.value for r in reports.report_rows(s).collect()}
    assert got == {
        ("AD_IP_PVRANGE_REQ", day, "2-5", "n"): 1, ("AD_IP_PVRANGE_IMP", day, "2-5", "n"): 1,
        ("AD_USER_PVRANGE_REQ", day, "2-5", "n"): 1, ("AD_USER_PVRANGE_IMP", day, "2-5", "n"): 1,
        ("AD_IP_PVRANGE_REQ", None, "1", "n"): 1, ("AD_IP_PVRANGE_IMP", None, "1", "n"): 1,
        ("AD_USER_PVRANGE_REQ", None, "1", "n"): 1, ("AD_USER_PVRANGE_IMP", None, "1", "n"): 1,
        **{("AD_NEW_USER_PV", day, "m|new", m): v for m, v in (("users", 1), ("requests", 2), ("impressions", 2), ("clicks", 0))},
        **{("AD_NEW_USER_PV", None, "new", m): v for m, v in (("users", 1), ("requests", 1), ("impressions", 1), ("clicks", 0))},
    }


def test_partition_overwrite(spark, scratch):
    path = os.path.join(scratch, "daily")
    a = spark.createDataFrame([("p0", dt.date(2024, 1, 1), 1), ("p0", dt.date(2024, 1, 2), 2)], "platform string, day date, v int")
    sinks.write_partitions(a, path)
    b = spark.createDataFrame([("p0", dt.date(2024, 1, 2), 20)], "platform string, day date, v int")
    sinks.write_partitions(b, path)
    assert rows(spark.read.parquet(path), "v", "day") == [(1, dt.date(2024, 1, 1)), (20, dt.date(2024, 1, 2))]


def test_scale_conf():
    from adsentry.session import scale_conf

    conf = scale_conf(100e12, executors=1000, cores_per_executor=8)
    assert 30_000 < int(conf["spark.sql.shuffle.partitions"]) < 50_000
    small = scale_conf(1e9, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_read_pairs_flattens_value(spark, scratch):
    path = os.path.join(scratch, "pairs")
    spark.createDataFrame(
        [("k1", ("1.2.3.4", 5)), ("k2", ("5.6.7.8", 7))], "key string, value struct<ip: string, n: int>"
    ).write.parquet(path)
    got = readers.read_pairs(spark, path + "/*.parquet", value_col="value")
    assert got.columns == ["ip", "n"] and rows(got) == [("1.2.3.4", 5), ("5.6.7.8", 7)]


def test_write_delimited(spark, scratch):
    path = os.path.join(scratch, "hh")
    sinks.write_delimited(spark.createDataFrame([("03", 2), ("04", 1)], "hh string, n long"), path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["03|2", "04|1"]


def test_ingest_visit_and_session_records(spark):
    from adsentry.operators import sessions as so
    from adsentry.operators import subnet
    from adsentry.sources import ingest

    visits_raw = spark.createDataFrame(
        [("u1", "a", "x", "1.2.3.4", 1704078000, {"o1": ("1.2.3.4", 1704078000), "o2": ("1.2.3.9", 1704078001)}),
         ("u2", "b", "y", None, 1704081600, {})],
        "uid string, appid string, adx string, ip string, timestamp bigint, "
        "orders map<string, struct<viewip: string, viewts: bigint>>",
    )
    v = ingest.visits_from_records(visits_raw)
    assert rows(v, "uid", "ts")[0] == ("u1", dt.datetime(2024, 1, 1, 3, 0))
    assert rows(subnet.subnet24_pv(v)) == [("1.2.3", 2)]
    device = {k: f"{k}-v" for k in ingest.DEVICE_FIELDS.values()}
    device["uid"] = "u1"
    sess_raw = spark.createDataFrame(
        [("p0", "m0", "ad1", device,
          [{"req": (1704078000000, "1.1.1.1"), "imp": (1704078000500, "1.1.1.1")},
           {"req": (1704078001000, "1.1.1.2"), "imp": (1704078001100, "1.1.1.2"), "cli": (1704078002000, "9.9.9.9")}])],
        "platId string, mediaKey string, adunitId string, deviceInfo struct<"
        + ", ".join(f"{k}: string" for k in ingest.DEVICE_FIELDS.values())
        + ">, events array<map<string, struct<ts: bigint, ip: string>>>",
    )
    s = ingest.sessions_from_records(sess_raw)
    assert s.first().day == dt.date(2024, 1, 1)
    got = so.session_counts(s).collect()[0]
    assert (got.hour, got.imp_ips, got.cli_ips, got.requests, got.impressions, got.clicks) == (
        3, ["1.1.1.1", "1.1.1.2"], ["9.9.9.9"], 2, 2, 1)
    assert got.province == "provice-v" and got.uid == "u1"
    assert ingest.sessions_from_records(sess_raw, salt="s").first().imei not in (None, "imei-v")
    # without a request in the first event the day comes from the first time there is
    late = [
        [{"imp": (1704164400000, "1.1.1.1")}, {"req": (1704078000000, "1.1.1.1")}],
        [{}, {"cli": (1704078000000, None)}],
        [{"req": (None, "1.1.1.1"), "imp": (1704164400000, None)}],
        [{"req": (None, "1.1.1.1")}],
        [],
        None,
    ]
    odd = spark.createDataFrame([("p0", f"m{i}", "ad1", device, events) for i, events in enumerate(late)], sess_raw.schema)
    days = [r.day for r in ingest.sessions_from_records(odd).orderBy("media_key").collect()]
    assert days == [dt.date(2024, 1, 2), dt.date(2024, 1, 1), dt.date(2024, 1, 2), None, None, None]
