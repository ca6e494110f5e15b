import os

import pytest

from adsentry import jobs
from adsentry.sources import fixtures as fx
from adsentry.sources import sinks

from conftest import SF_MID, rows


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("job-inputs"))
    for name in ("visits", "profiles", "sessions", "devices_raw", "devices_ext", "third_party_log"):
        fx.view(spark, SF_MID, name).write.parquet(os.path.join(base, name))
    sinks.write_text(fx.hardware_rows(spark, SF_MID), os.path.join(base, "hw_text"))
    return base


def run(spark, *argv):
    jobs.main(list(argv), spark=spark)


def test_blacklist_jobs(spark, inputs, scratch):
    o = lambda n: os.path.join(scratch, n)
    run(spark, "ip-time-coef", "--visits", f"{inputs}/visits", "--scores-out", o("scores"),
        "--ranked-out", o("ranked"), "--population-out", o("pop"))
    run(spark, "--format", "text", "ip-time-coef", "--visits", f"{inputs}/visits", "--scores-out", o("scores_txt"),
        "--ranked-out", o("ranked_txt"), "--population-out", o("pop2"))
    run(spark, "suspicious-ip", "--scores", o("scores"), "--out", o("black"), "--candidates-out", o("cands"))
    run(spark, "suspicious-ip", "--score-text", o("scores_txt"), "--out", o("black_txt"))
    assert rows(spark.read.parquet(o("black"))) == rows(spark.read.parquet(o("black_txt")))
    assert spark.read.parquet(o("cands")).count() == 21
    assert len(spark.read.csv(o("pop"), sep="|").collect()) == 24


def test_count_jobs(spark, inputs, scratch):
    o = lambda n: os.path.join(scratch, n)
    run(spark, "subnet-monitor", "--visits", f"{inputs}/visits", "--subnets-out", o("s"), "--histogram-out", o("h"))
    run(spark, "top-subnets", "--visits", f"{inputs}/visits", "--out", o("t"), "--threshold", "100")
    run(spark, "ip-time", "--visits", f"{inputs}/visits", "--out", o("it"), "--target", "198.51.100.1")
    run(spark, "target-ip", "--visits", f"{inputs}/visits", "--uid-out", o("u"), "--app-out", o("a"),
        "--exchange-out", o("x"), "--target", "203.0.113")
    run(spark, "ip-count", "--sessions", f"{inputs}/sessions", "--out", o("ipc"), "--ips", "203.0.113.9,10.9.9.9",
        "--media", "m0,m1")
    for job, out in (("ip-analysis", "ia"), ("provider", "pr"), ("load-profiles", "lp")):
        run(spark, job, "--profiles", f"{inputs}/profiles", "--out", o(out))
    run(spark, "interest", "--profiles", f"{inputs}/profiles", "--pv-out", o("ipv"), "--uv-out", o("iuv"))
    assert spark.read.parquet(o("s")).count() == 104 and spark.read.parquet(o("ipc")).count() == 3
    with pytest.raises(Exception):  # append-once output refuses to overwrite
        run(spark, "load-profiles", "--profiles", f"{inputs}/profiles", "--out", o("lp"))


def test_hardware_and_report_jobs(spark, inputs, scratch):
    o = lambda n: os.path.join(scratch, n)
    run(spark, "hardware-lib", "--devices", f"{inputs}/devices_raw", "--uv-out", o("uv"), "--device-out", o("d"),
        "--histogram-out", o("hh"))
    run(spark, "hardware-wash", "--text", f"{inputs}/hw_text", "--out", o("w"))
    run(spark, "new-hardware", "--devices", f"{inputs}/devices_ext", "--out", o("nh"), "--identified")
    run(spark, "cheater-hunter", "--profiles", f"{inputs}/profiles", "--rules", "many_carriers", "--out", o("ch"),
        "--summary-out", o("cs"))
    run(spark, "ad-hunter", "--sessions", f"{inputs}/sessions", "--start", "2024-01-01", "--end", "2024-01-03",
        "--out", o("rep"))
    run(spark, "ad-hunter", "--sessions", f"{inputs}/sessions", "--start", "2024-01-01", "--end", "2024-01-03",
        "--first-seen", o("seen"), "--out", o("rep2"))
    cols = ("platform", "report", "day", "bucket", "metric", "value")
    assert sorted(map(repr, spark.read.parquet(o("rep")).select(*cols).collect())) == sorted(
        map(repr, spark.read.parquet(o("rep2")).select(*cols).collect()))
    run(spark, "third-party", "--log", f"{inputs}/third_party_log", "--out", o("tp"), "--start", "2024-01-01",
        "--end", "2024-01-04", "--reports-out", o("tprep"))
    assert {r.day.day for r in spark.read.parquet(o("tprep")).select("day").distinct().collect()} == {1, 2, 3}
    assert spark.read.parquet(o("uv")).count() == 1745
    assert spark.read.parquet(o("w")).count() == 40315
    assert {r.day.day for r in spark.read.parquet(o("rep")).select("day").distinct().collect()} == {1, 2}
    assert spark.read.parquet(o("tp")).count() > 0
    spark.catalog.clearCache()


def test_raw_field_map_job(spark, inputs, scratch):
    from pyspark.sql import functions as F

    flat = spark.read.parquet(f"{inputs}/devices_raw")
    raw = flat.select(
        F.create_map(
            F.lit("manufact"), "manufacturer", F.lit("dvc_model"), "model",
            F.lit("resolution"), "resolution", F.lit("dvc"), "device_id",
        ).alias("fields")
    )
    raw.write.parquet(os.path.join(scratch, "raw"))
    o = lambda n: os.path.join(scratch, n)
    run(spark, "hardware-lib", "--raw", "--devices", o("raw"), "--uv-out", o("uv"), "--device-out", o("d"),
        "--histogram-out", o("h"))
    assert spark.read.parquet(o("uv")).count() == 1745
