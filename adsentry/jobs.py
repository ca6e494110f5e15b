"""Command-line jobs: one subcommand per batch job of the original system.

Each job reads its inputs (Parquet in the schemas of ``sources.fixtures``, or
the original text-tuple layouts), runs the operators as one Spark plan and
writes every output with the sinks (``--format parquet`` by default, or
``text`` for the original ``(a,b,...)`` lines). Example::

    spark-submit -m adsentry.jobs ip-time-coef --visits s3://.../visits \\
        --scores-out .../scores --ranked-out .../ranked --population-out .../pop
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsentry.operators import fences, hardware, hour_profile, profiles, rules, sessions, subnet, target_ip
from adsentry.plans import reports
from adsentry.plans.blacklist import fence_diagnostics
from adsentry.plans.hardware import build_hardware_library
from adsentry.session import build_session
from adsentry.sources import ingest, readers, sinks

JOBS: dict[str, tuple[Callable[[SparkSession, argparse.Namespace], None], Callable[[argparse.ArgumentParser], None]]] = {}


def job(name: str, *args: tuple[str, dict]):
    def deco(fn):
        def add(p: argparse.ArgumentParser) -> None:
            for flag, kw in args:
                p.add_argument(flag, **kw)

        JOBS[name] = (fn, add)
        return fn

    return deco


def _req(help_: str) -> dict:
    return {"required": True, "help": help_}


def _visits(spark: SparkSession, ns: argparse.Namespace) -> DataFrame:
    df = readers.read_records(spark, ns.visits)
    return ingest.visits_from_records(df) if ns.raw_records else df


def _salt(ns: argparse.Namespace) -> str | None:
    return None if ns.id_salt_env is None else os.environ[ns.id_salt_env]


def _sessions(spark: SparkSession, ns: argparse.Namespace) -> DataFrame:
    df = readers.read_records(spark, ns.sessions)
    return ingest.sessions_from_records(df, salt=_salt(ns)) if ns.raw_records else df


def _write(df: DataFrame, path: str, ns: argparse.Namespace, mode: str = "overwrite") -> None:
    if ns.format == "text":
        sinks.write_text(df, path, mode=mode)
    else:
        sinks.write_parquet(df, path, mode=mode)


@job("subnet-monitor", ("--visits", _req("visits")), ("--subnets-out", _req("A-01")), ("--histogram-out", _req("A-02")))
def _subnet_monitor(spark, ns):
    pv = subnet.subnet24_pv(_visits(spark, ns))
    _write(pv.orderBy(F.desc("pv"), "subnet"), ns.subnets_out, ns)
    _write(subnet.subnet24_pv_histogram(pv).orderBy(F.desc("pv")), ns.histogram_out, ns)


@job(
    "top-subnets",
    ("--visits", _req("visits")),
    ("--out", _req("A-03")),
    ("--threshold", {"type": int, "default": subnet.TOP_SUBNET_THRESHOLD}),
)
def _top_subnets(spark, ns):
    out = subnet.top_subnet24(_visits(spark, ns), ns.threshold)
    _write(out.orderBy(F.desc("pv"), "subnet"), ns.out, ns)


_TARGET = (("--target", _req("address or range")), ("--match", {"default": "contains", "choices": ["contains", "prefix"]}))


@job("ip-time", ("--visits", _req("visits")), ("--out", _req("A-04 HH|n lines")), *_TARGET)
def _ip_time(spark, ns):
    out = target_ip.ip_hour_counts(_visits(spark, ns), ns.target, ns.match).orderBy("hh")
    sinks.write_single_file(out, ns.out)  # at most 24 rows


@job(
    "target-ip",
    ("--visits", _req("visits")),
    ("--uid-out", _req("A-05")),
    ("--app-out", _req("A-06")),
    ("--exchange-out", _req("A-07")),
    *_TARGET,
)
def _target_ip(spark, ns):
    from pyspark import StorageLevel

    hits = target_ip.target_ip_visits(_visits(spark, ns), ns.target, ns.match)
    hits = hits.select("uid", "app_id", "exchange_id").persist(StorageLevel.MEMORY_AND_DISK)  # three outputs
    for col, path in (("uid", ns.uid_out), ("app_id", ns.app_out), ("exchange_id", ns.exchange_out)):
        _write(hits.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col), path, ns)
    hits.unpersist()


@job(
    "ip-time-coef",
    ("--visits", _req("visits")),
    ("--scores-out", _req("A-09")),
    ("--ranked-out", _req("A-10")),
    ("--population-out", _req("A-08 HH|share lines")),
    ("--metric", {"default": "mse", "choices": list(hour_profile.METRICS)}),
)
def _ip_time_coef(spark, ns):
    from adsentry.plans.common import materialize

    # one pass over the visits: scores and population come from the counts
    counts = materialize(hour_profile.address_hour_counts(_visits(spark, ns)))
    scores = hour_profile.deviation_of_counts(counts, metric=ns.metric)
    _write(scores, ns.scores_out, ns)
    _write(hour_profile.ip_hour_deviation_ranked(scores), ns.ranked_out, ns)
    sinks.write_single_file(hour_profile.share_of_counts(counts).orderBy("hh"), ns.population_out)


@job(
    "suspicious-ip",
    ("--scores", {"help": "A-09 output (parquet)"}),
    ("--score-text", {"help": "A-09 output as (ip,size,flag,coef) text"}),
    ("--candidates-out", {"help": "A-11 (optional)"}),
    ("--out", _req("A-12")),
    ("--k", {"type": float, "default": fences.VOLUME_K}),
    ("--k2", {"type": float, "default": fences.SCORE_K}),
    ("--empty", {"default": "zero", "choices": ["zero", "max"]}),
)
def _suspicious_ip(spark, ns):
    from adsentry.plans.common import materialize

    if ns.score_text:
        scores = readers.read_score_tuples(spark, ns.score_text)
    else:
        scores = readers.read_records(spark, ns.scores)
    cands = materialize(fences.ip_volume_candidates(scores, k=ns.k, empty=ns.empty))
    if ns.candidates_out:
        _write(cands.orderBy(F.desc("coef")), ns.candidates_out, ns)
    black = fences.ip_blacklist(cands, k=ns.k2, empty=ns.empty)
    _write(black, ns.out, ns)
    # the figures the original job printed: bounds and sizes (small aggregates)
    fence_diagnostics(scores, cands, readers.read_records(spark, ns.out) if ns.format == "parquet" else black,
                      ns.k, ns.k2, ns.empty).show(truncate=False, vertical=True)


@job(
    "ip-count",
    ("--sessions", _req("sessions")),
    ("--out", _req("A-15")),
    ("--ips", _req("comma-separated watchlist")),
    ("--media", {"help": "comma-separated media keys"}),
)
def _ip_count(spark, ns):
    media = ns.media.split(",") if ns.media else None
    out = sessions.watchlist_ip_events(_sessions(spark, ns), ns.ips.split(","), media)
    _write(out, ns.out, ns, mode="errorifexists")


@job("ip-analysis", ("--profiles", _req("profiles")), ("--out", _req("A-33")))
def _ip_analysis(spark, ns):
    _write(subnet.adjacent_subnet_histogram(readers.read_records(spark, ns.profiles)), ns.out, ns)


@job("interest", ("--profiles", _req("profiles")), ("--pv-out", _req("A-31")), ("--uv-out", _req("A-32")))
def _interest(spark, ns):
    p = readers.read_records(spark, ns.profiles)
    _write(profiles.interest_pv(p), ns.pv_out, ns)
    _write(profiles.interest_uv(p), ns.uv_out, ns)


@job("provider", ("--profiles", _req("profiles")), ("--out", _req("A-30")))
def _provider(spark, ns):
    _write(profiles.operator_count_histogram(readers.read_records(spark, ns.profiles)), ns.out, ns)


@job("load-profiles", ("--profiles", _req("profiles")), ("--out", _req("A-34")))
def _load_profiles(spark, ns):
    _write(profiles.profile_uids(readers.read_records(spark, ns.profiles)), ns.out, ns, mode="errorifexists")


_RAW = ("--raw", {"action": "store_true", "help": "input records carry a `fields` map (raw device log)"})


@job(
    "hardware-lib",
    ("--devices", _req("device log")),
    ("--uv-out", _req("A-24")),
    ("--device-out", _req("A-25")),
    ("--histogram-out", _req("A-26")),
    _RAW,
)
def _hardware_lib(spark, ns):
    devices = readers.read_records(spark, ns.devices)
    lib = build_hardware_library(ingest.devices_from_fields(devices, salt=_salt(ns)) if ns.raw else devices)
    _write(lib.hardware_uv, ns.uv_out, ns)
    _write(lib.device_hardware_count, ns.device_out, ns)
    _write(lib.hardware_count_histogram.orderBy("n_devices", "n_hardware"), ns.histogram_out, ns)
    print("rows dropped for a NULL part:", lib.dropped.get.get("dropped_null_rows"))


@job("hardware-wash", ("--text", _req("((maker,model,resolution),n) lines")), ("--out", _req("A-29")))
def _hardware_wash(spark, ns):
    _write(hardware.hardware_clean(readers.read_hardware_tuples(spark, ns.text)), ns.out, ns)


@job(
    "new-hardware",
    ("--devices", _req("third-party device log")),
    ("--out", _req("A-27 / A-28")),
    ("--identified", {"action": "store_true", "help": "rows with maker and model (A-28)"}),
    _RAW,
)
def _new_hardware(spark, ns):
    devices = readers.read_records(spark, ns.devices)
    devices = ingest.devices_ext_from_fields(devices, salt=_salt(ns)) if ns.raw else devices
    out = hardware.hardware_tac_uv(devices, identified=ns.identified)
    _write(out.orderBy(F.desc("uv"), "manufacturer", "model", "resolution", "tac"), ns.out, ns)


@job(
    "cheater-hunter",
    ("--profiles", _req("profiles")),
    ("--rules", {"default": ",".join(rules.RULES)}),
    ("--day", {"help": "day of the trial, yyyy-MM-dd"}),
    ("--blacklist", {"help": "A-12 output (parquet) for the blacklisted_ip rule"}),
    ("--out", _req("A-22 trials")),
    ("--summary-out", {"help": "A-23"}),
    ("--evidence-out", {"help": "every value that broke a rule, one row each"}),
)
def _cheater_hunter(spark, ns):
    context = {"blacklist": readers.read_records(spark, ns.blacklist)} if ns.blacklist else {}
    facts = rules.facts_from_profiles(readers.read_records(spark, ns.profiles))
    trials = rules.cheater_trials(facts, ns.rules.split(","), day=ns.day, evidence=True, **context)
    _write(trials, ns.out, ns)
    if ns.summary_out:
        _write(rules.cheater_summary(readers.read_records(spark, ns.out) if ns.format == "parquet" else trials),
               ns.summary_out, ns)
    if ns.evidence_out:
        _write(rules.cheater_evidence(facts, ns.rules.split(","), day=ns.day, **context), ns.evidence_out, ns)


_REPORT_ARGS = (
    ("--start", {"help": "first day, yyyy-MM-dd"}),
    ("--end", {"help": "end day, excluded"}),
    ("--reports", {"default": ",".join(reports.REPORTS)}),
    ("--platform", {"action": "append", "help": "only this platform (repeat for more)"}),
    ("--first-seen", {"help": "stored first days of users; brought up to date for the range, so that no history is read"}),
    ("--jdbc-url", {"help": "publish the written rows to this database as well"}),
    ("--jdbc-table", {"default": "ad_reports"}),
    ("--jdbc-option", {"action": "append", "default": [], "help": "key=value (user, password, driver, ...)"}),
)


def _report_days(spark: SparkSession, rows: DataFrame, out: str, ns: argparse.Namespace) -> None:
    """Reports of ``[start, end)`` per platform and day, written and published."""
    if not ns.start or not ns.end:
        raise SystemExit("reports need --start and --end")
    names = ns.reports.split(",")
    new_users = None
    if ns.first_seen:  # of all platforms: a user is new once per media key
        reports.update_first_seen(rows, ns.first_seen, ns.start, ns.end)
        new_users = reports.read_first_seen(spark, ns.first_seen, ns.end)
    elif any(reports.REPORTS[n].kind == "count" for n in names):
        new_users = reports.first_seen(rows.where(F.col("day") < F.to_date(F.lit(ns.end))))
    chosen = rows.where(F.col("platform").isin(ns.platform)) if ns.platform else rows
    long_rows = reports.daily_backfill(chosen, ns.start, ns.end, names, new_users, by=("platform", "day"))
    reports.write_backfill(long_rows, out, ns.start, ns.end, names, ns.platform)
    if ns.jdbc_url:
        # Publish what was written (re-read: the report is computed once).
        day = F.col("day")
        written = readers.read_records(spark, out).where(
            (day >= F.to_date(F.lit(ns.start))) & (day < F.to_date(F.lit(ns.end)))
        )
        written = written.where(F.col("platform").isin(ns.platform)) if ns.platform else written
        options = dict(kv.split("=", 1) for kv in ns.jdbc_option)
        sinks.write_jdbc(written, ns.jdbc_url, ns.jdbc_table, options)


@job(
    "ad-hunter",
    ("--sessions", _req("sessions (ideally stored partitioned by day)")),
    ("--out", _req("report table, partitioned by (platform, report, day)")),
    *_REPORT_ARGS,
)
def _ad_hunter(spark, ns):
    _report_days(spark, _sessions(spark, ns), ns.out, ns)


@job(
    "third-party",
    ("--log", _req("foreign monitor log")),
    ("--out", _req("sessions, partitioned by platform and day")),
    ("--reports-out", {"help": "report table of the days from --start to --end"}),
    *_REPORT_ARGS,
)
def _third_party(spark, ns):
    from pyspark.sql import Observation

    seen = Observation("third_party")
    out = sessions.third_party_normalize(readers.read_records(spark, ns.log), observation=seen)
    if ns.start and ns.end:
        out = out.where((F.col("day") >= F.to_date(F.lit(ns.start))) & (F.col("day") < F.to_date(F.lit(ns.end))))
    sinks.write_partitions(out, ns.out, partition_by=("platform", "day"))
    print("records read / rejected:", seen.get.get("records"), "/", seen.get.get("rejected"))
    if ns.reports_out:
        _report_days(spark, readers.read_records(spark, ns.out), ns.reports_out, ns)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="adsentry.jobs")
    parser.add_argument("--format", default="parquet", choices=["parquet", "text"])
    parser.add_argument(
        "--raw-records",
        action="store_true",
        help="visit / session inputs are in the original record layout (see sources.ingest)",
    )
    parser.add_argument(
        "--id-salt-env",
        metavar="NAME",
        help="with raw input: device identifiers become salted hashes; NAME is the environment variable that holds the salt",
    )
    sub = parser.add_subparsers(dest="job", required=True)
    for name, (_, add) in JOBS.items():
        add(sub.add_parser(name))
    ns = parser.parse_args(argv)
    session = spark or build_session(app_name=f"adsentry-{ns.job}")
    JOBS[ns.job][0](session, ns)


if __name__ == "__main__":
    main()
