"""T3: the hardware library from one device log.

The original wrote three text outputs from one cached distinct frame and
cleaned one of them in a separate local job. Here the distinct (triple,
device) frame is computed once (persisted: three aggregations read it) and
cleaning is a function on the library frame itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from adsentry.operators import hardware as hw


@dataclass
class HardwareLibrary:
    hardware_uv: DataFrame  # A-24
    device_hardware_count: DataFrame  # A-25
    hardware_count_histogram: DataFrame  # A-26
    clean_library: DataFrame  # A-29 applied to A-24's triples
    dropped: Observation  # rows with a NULL part (available after the first action)


def build_hardware_library(devices: DataFrame, device: str = "device_id") -> HardwareLibrary:
    obs = Observation("hardware_null_rows")
    pairs = hw.hardware_pairs(devices, device=device, observation=obs).persist(StorageLevel.MEMORY_AND_DISK)
    uv = hw.hardware_uv(pairs)
    per_device = hw.device_hardware_count(pairs, device=device)
    hist = hw.hardware_count_histogram(per_device)
    clean = hw.hardware_clean(
        uv.select(F.col("manufacturer").alias("f1"), F.col("model").alias("f2"), F.col("resolution").alias("f3"))
    )
    return HardwareLibrary(uv, per_device, hist, clean, obs)
