"""Benchmark every registered query.

Runs each query of ``adsentry.catalog`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``: one warm-up, then the
median of ``$BENCH_RUNS`` (default 3) runs into a ``noop`` sink, so the whole
plan executes and no output is timed. Shuffle bytes written and task counts
per query come from Spark's event log in a scratch folder. Prints one JSON
line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adsentry.session import build_session  # noqa: E402


def _event_stats(log_dir: str) -> dict[str, dict[str, int]]:
    """Shuffle bytes written and tasks per job group, from the event log."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    if not group:
                        continue
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    rec = out.setdefault(group, {"shuffle_bytes": 0, "tasks": 0})
                    rec["shuffle_bytes"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
                    rec["tasks"] += int(info.get("Number of Tasks", 0))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    log_dir = tempfile.mkdtemp(prefix="bench-events-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="adsentry-bench",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": "file://" + log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from adsentry.catalog import QUERIES

    names = only or list(QUERIES)
    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    sc = spark.sparkContext
    for name in names:
        try:
            samples = []
            for i in range(runs + 1):
                sc.setJobGroup(name if i else f"{name}#warmup", name)
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t0)
                spark.catalog.clearCache()  # runs are independent: drop what one persisted
            timings[name] = round(statistics.median(samples), 3)
        except Exception as exc:  # keep benchmarking the rest
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    spark.catalog.clearCache()
    spark.stop()
    stats = _event_stats(log_dir)
    result = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": runs,
        "shuffle_bytes": {k: v["shuffle_bytes"] // runs for k, v in stats.items() if "#" not in k},
        "tasks": {k: v["tasks"] // runs for k, v in stats.items() if "#" not in k},
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
