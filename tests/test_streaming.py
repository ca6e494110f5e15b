import os
import shutil

from pyspark.sql import functions as F

from adsentry.operators import subnet
from adsentry.sources import fixtures as fx
from adsentry.streaming import monitor

from conftest import SF_SMALL


def test_subnet_monitor_matches_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    shutil.copy(os.path.join(SF_SMALL, "events.parquet"), os.path.join(src, "part-0.parquet"))
    sink = os.path.join(scratch, "out")
    q = monitor.start_subnet_monitor(
        spark, src, sink, checkpoint=os.path.join(scratch, "ckpt"), watermark="0 seconds", available_now=True
    )
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink).groupBy("subnet").agg(F.sum("pv").alias("pv"))
    batch = subnet.subnet24_pv(fx.visits(spark, SF_SMALL))
    # every window but the last is final once the watermark passes it
    last = spark.read.parquet(sink).agg(F.max("window_end")).first()[0]
    assert last is not None
    s = {r.subnet: r.pv for r in streamed.collect()}
    b = {r.subnet: r.pv for r in batch.collect()}
    assert set(s) <= set(b)
    assert sum(s.values()) <= sum(b.values()) and sum(s.values()) > 0.9 * sum(b.values())


def test_ip_hour_windows_match_batch(spark, scratch):
    from adsentry.operators import target_ip

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    shutil.copy(os.path.join(SF_SMALL, "events.parquet"), os.path.join(src, "part-0.parquet"))
    stream = monitor.ip_hour_windows(monitor.read_event_stream(spark, src), "198.51.100.1", watermark="0 seconds")
    got = []
    q = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(lambda df, _: got.extend(df.collect()))
        .option("checkpointLocation", os.path.join(scratch, "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    latest = {}
    for r in got:  # complete mode: the last batch holds every window
        latest[r.window_start] = r.n
    by_hour = {}
    for start, n in latest.items():
        by_hour[f"{start.hour:02d}"] = by_hour.get(f"{start.hour:02d}", 0) + n
    batch = {r.hh: r.n for r in target_ip.ip_hour_counts(fx.visits(spark, SF_SMALL), "198.51.100.1").collect()}
    assert by_hour == batch
