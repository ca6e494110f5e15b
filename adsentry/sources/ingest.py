"""Ingest projections: raw device records (field maps) to the flat device tables.

The device logs carry their attributes in a ``MAP<STRING, STRING>``; the
hardware operators read flat columns. These projections are map lookups
(``try_element_at``: a missing key is NULL, never an error, under ANSI) in one
``select``, so they fuse into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsentry.operators.hardware import IDENTIFIERS, IMEI_MIN_LEN, TAC_LEN

# Field names of the raw device records.
EXTRACT_KEYS = {"manufacturer": "manufact", "model": "dvc_model", "resolution": "resolution", "device_id": "dvc"}
MONITOR_KEYS = {"manufacturer": "manufact", "imei": "imei", "android_id": "android_id", "mac": "mac",
                "openudid": "openudid"}


def _get(m: Column, key: str) -> Column:
    return F.try_element_at(m, F.lit(key))


def pseudonym(identifier: Column, salt: str | None) -> Column:
    """The identifier, or with a salt its SHA-256 with the salt in front, in lowercase hex.

    Equal identifiers stay equal under one salt, so distinct counts and joins
    hold; without the salt they cannot be found again by hashing all possible
    identifiers (an IMEI has 15 digits). NULL stays NULL.
    """
    return identifier if salt is None else F.sha2(F.concat(F.lit(salt), identifier), 256)


def devices_from_fields(raw: DataFrame, fields: str = "fields", salt: str | None = None) -> DataFrame:
    """``(manufacturer, model, resolution, device_id)`` from a field map (A-24..A-26 input).

    With ``salt`` the device id is a pseudonym from here on.
    """
    m = F.col(fields)
    out = raw.select(*[_get(m, key).alias(name) for name, key in EXTRACT_KEYS.items()])
    return out.withColumn("device_id", pseudonym(F.col("device_id"), salt))


def devices_ext_from_fields(
    raw: DataFrame, fields: str = "fields", model: str = "os_model", resolution: str = "os_resolution", salt: str | None = None
) -> DataFrame:
    """``(manufacturer, model, resolution, imei, android_id, mac, openudid)`` (A-27/A-28 input).

    Maker and identifiers come from the field map; model and resolution are
    plain columns of the record. With ``salt`` the identifiers are pseudonyms
    from here on; an IMEI long enough to hold one keeps its type allocation code
    in front, which names a model and not a device, so A-27 / A-28 are the same.
    """
    m = F.col(fields)
    hidden = {k: pseudonym(_get(m, MONITOR_KEYS[k]), salt) for k in IDENTIFIERS}
    if salt is not None:
        imei = _get(m, MONITOR_KEYS["imei"])
        # a short one stays short of the length from which a code is read
        hidden["imei"] = F.when(F.length(imei) >= IMEI_MIN_LEN, F.concat(F.substring(imei, 1, TAC_LEN), hidden["imei"])).otherwise(
            F.substring(hidden["imei"], 1, IMEI_MIN_LEN - 1)
        )
    return raw.select(
        _get(m, MONITOR_KEYS["manufacturer"]).alias("manufacturer"),
        F.col(model).alias("model"),
        F.col(resolution).alias("resolution"),
        *[c.alias(k) for k, c in hidden.items()],
    )


# Field names of the original visit and session records.
VISIT_FIELDS = {"uid": "uid", "app_id": "appid", "exchange_id": "adx", "ip": "ip", "ts": "timestamp",
                "orders": "orders", "view_ip": "viewip", "view_ts": "viewts"}
SESSION_FIELDS = {"platform": "platId", "media_key": "mediaKey", "ad_unit": "adunitId", "device": "deviceInfo",
                  "events": "events"}
DEVICE_FIELDS = {"uid": "uid", "province": "provice", "device_model": "devModel", "network": "ntt",
                 "device_ip": "ip", "carrier": "operator", "user_agent": "userAgent", "os": "osSystem",
                 "os_version": "osVersion", "imei": "imei", "vendor": "vendor", "resolution": "devResolution"}
EVENT_KINDS = ("req", "imp", "cli")


def _seconds(c: Column) -> Column:
    """Epoch seconds -> wall-clock timestamp (visit records count in seconds)."""
    return F.timestamp_seconds(c).cast("timestamp_ntz")


def _millis(c: Column) -> Column:
    """Epoch milliseconds -> wall-clock timestamp (session events count in milliseconds)."""
    return F.timestamp_millis(c).cast("timestamp_ntz")


def visits_from_records(raw: DataFrame) -> DataFrame:
    """Visit records -> the ``visits`` layout the operators read.

    ``orders`` is a map whose keys are never read; its values become an
    ``ARRAY<STRUCT<view_ip, view_ts>>``. Record times are epoch seconds.
    """
    f = VISIT_FIELDS
    orders = F.transform(
        F.map_values(F.col(f["orders"])),
        lambda o: F.struct(o[f["view_ip"]].alias("view_ip"), _seconds(o[f["view_ts"]]).alias("view_ts")),
    )
    return raw.select(
        F.col(f["uid"]).alias("uid"),
        F.col(f["app_id"]).alias("app_id"),
        F.col(f["exchange_id"]).alias("exchange_id"),
        _seconds(F.col(f["ts"])).alias("ts"),
        F.col(f["ip"]).alias("ip"),
        orders.alias("orders"),
    )


def sessions_from_records(raw: DataFrame, salt: str | None = None) -> DataFrame:
    """Ad-session records -> the ``sessions`` layout.

    Each event is a map from ``req``/``imp``/``cli`` to ``{ts (epoch ms), ip}``;
    it becomes a struct with one nullable member per kind (the key set is
    closed). Device attributes are flattened; with ``salt`` the IMEI is a
    pseudonym from here on. ``day`` is the day of the first event's request;
    where that has no time, of the first time there is in the order of events
    (request, impression, click), and NULL only if no event has one.
    """
    s, d = SESSION_FIELDS, DEVICE_FIELDS

    def member(e: Column, kind: str) -> Column:
        m = F.try_element_at(e, F.lit(kind))
        return F.when(m.isNotNull(), F.struct(_millis(m["ts"]).alias("ts"), m["ip"].alias("ip")))

    events = F.transform(F.col(s["events"]), lambda e: F.struct(*[member(e, k).alias(k) for k in EVENT_KINDS]))
    dev = F.col(s["device"])
    out = raw.select(
        F.col(s["platform"]).alias("platform"),
        F.col(s["media_key"]).alias("media_key"),
        F.col(s["ad_unit"]).alias("ad_unit"),
        *[dev[src].alias(name) for name, src in d.items()],
        events.alias("events"),
    )
    times = F.flatten(F.transform(F.col("events"), lambda e: F.array(*[e[k]["ts"] for k in EVENT_KINDS])))
    first = F.get(F.filter(times, lambda t: t.isNotNull()), 0)
    return out.withColumn("imei", pseudonym(F.col("imei"), salt)).withColumn(
        "day", F.to_date(F.coalesce(F.get(F.col("events"), 0)["req"]["ts"], first))
    )
