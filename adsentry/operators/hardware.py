"""Device-hardware plausibility tables (A-24..A-29).

A hardware triple is ``(manufacturer, model, resolution)``. The library of
plausible triples is built from distinct (triple, device) pairs: a triple
seen on several devices is plausible, a device claiming many triples is not.
``distinct`` is a partial + final aggregation, so a triple or device that
holds a third of all rows still moves as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

HARDWARE = ("manufacturer", "model", "resolution")
IDENTIFIERS = ("imei", "android_id", "mac", "openudid")

# Fixed values of the original jobs: placeholders for missing parts, the
# TAC length and the minimum IMEI length, and the blank part that is dropped
# (two ideographic spaces, U+3000 U+3000).
EMPTY = "empty"
UNKNOWN = "unknow"
TAC_LEN = 5
IMEI_MIN_LEN = 15
IDEOGRAPHIC_BLANK = "　　"


def hardware_pairs(devices: DataFrame, device: str = "device_id", observation: Observation | None = None) -> DataFrame:
    """Distinct ``(manufacturer, model, resolution, device_id)``.

    Rows with a NULL part are dropped; pass an ``Observation`` to learn how
    many (``dropped_null_rows``, available after the first action).
    """
    cols = [*HARDWARE, device]
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    src = devices
    if observation is not None:
        src = src.observe(observation, F.count(F.when(~complete, F.lit(1))).alias("dropped_null_rows"))
    return src.where(complete).select(*cols).distinct()


def hardware_uv(pairs: DataFrame) -> DataFrame:
    """A-24: ``(manufacturer, model, resolution, uv)``: triples seen on more than one device."""
    return pairs.groupBy(*HARDWARE).agg(F.count(F.lit(1)).alias("uv")).where(F.col("uv") > 1)


def device_hardware_count(pairs: DataFrame, device: str = "device_id", hash_ids: bool = True) -> DataFrame:
    """A-25: ``(device_id, n_hardware)``: distinct triples claimed by each device.

    Device ids are personal data: by default the output carries their SHA-256
    hex digest (hashed after the aggregation, once per device).
    """
    out = pairs.groupBy(device).agg(F.count(F.lit(1)).alias("n_hardware"))
    return out.withColumn(device, F.sha2(F.col(device), 256)) if hash_ids else out


def hardware_count_histogram(device_counts: DataFrame) -> DataFrame:
    """A-26: ``(n_hardware, n_devices)``."""
    return device_counts.groupBy("n_hardware").agg(F.count(F.lit(1)).alias("n_devices"))


def tac(imei: Column) -> Column:
    """Type allocation code: first 5 characters of an IMEI of 15+ characters, else ``unknow``."""
    return F.when(F.length(imei) >= IMEI_MIN_LEN, F.substring(imei, 1, TAC_LEN)).otherwise(F.lit(UNKNOWN))


def hardware_tac_uv(devices_ext: DataFrame, identified: bool = True) -> DataFrame:
    """A-28 (``identified``) / A-27: ``(manufacturer, model, resolution, tac, uv)`` with uv > 1.

    A-27 keeps rows where manufacturer and model are both NULL, A-28 rows
    where both are present. Rows are made distinct over hardware and the
    four identifiers, NULL parts become ``empty``, and distinct identifier
    sets are counted per (hardware, TAC).
    """
    maker, model = F.col("manufacturer"), F.col("model")
    keep = (maker.isNotNull() & model.isNotNull()) if identified else (maker.isNull() & model.isNull())
    pairs = devices_ext.where(keep).select(*HARDWARE, *IDENTIFIERS).distinct()
    keyed = pairs.select(
        *[F.coalesce(F.col(c), F.lit(EMPTY)).alias(c) for c in HARDWARE],
        tac(F.col("imei")).alias("tac"),
    )
    return keyed.groupBy(*HARDWARE, "tac").agg(F.count(F.lit(1)).alias("uv")).where(F.col("uv") > 1)


def hardware_tac_uv_unidentified(devices_ext: DataFrame) -> DataFrame:
    """A-27: the TAC table for rows with neither manufacturer nor model."""
    return hardware_tac_uv(devices_ext, identified=False)


def hardware_clean(rows: DataFrame, f1: str = "f1", f2: str = "f2", f3: str = "f3") -> DataFrame:
    """A-29: ``(manufacturer, model, resolution)`` from dirty hardware fields.

    A ``maker|model`` value in the first (else the second) field is split on
    the literal bar and supplies maker and model; the third field is the
    resolution. Rows whose three parts together contain ``empty`` or
    ``unknow`` (case-sensitive), or with a blank or double-ideographic-space
    part, are dropped.
    """
    a, b, c = F.col(f1), F.col(f2), F.col(f3)
    pa, pb = F.split(a, r"\|"), F.split(b, r"\|")
    in_a, in_b = a.contains("|"), b.contains("|")
    maker = F.when(in_a, F.get(pa, 0)).when(in_b, F.get(pb, 0)).otherwise(a)
    model = F.when(in_a, F.get(pa, 1)).when(in_b, F.get(pb, 1)).otherwise(b)
    parts = rows.select(maker.alias("manufacturer"), model.alias("model"), c.alias("resolution"))
    joined = F.concat(*[F.col(x) for x in HARDWARE])
    keep = ~joined.contains(EMPTY) & ~joined.contains(UNKNOWN)
    for x in HARDWARE:
        keep = keep & (F.col(x) != F.lit("")) & (F.col(x) != F.lit(IDEOGRAPHIC_BLANK))
    return parts.where(F.coalesce(keep, F.lit(False)))
