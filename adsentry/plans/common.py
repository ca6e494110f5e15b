"""Helpers shared by the multi-operator jobs."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from adsentry.session import ensure_checkpoint_dir


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Compute ``df`` once for several downstream passes.

    ``checkpoint`` writes it to the shared folder named by
    ``spark.checkpoint.dir`` and cuts the lineage, so a lost executor costs a
    re-read, not a re-run of the upstream shuffle; ``persist`` keeps it in
    memory and disk (recomputed from lineage if lost); ``none`` leaves the
    plan as is. Never a machine-local checkpoint.
    """
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "none":
        return df
    raise ValueError("how must be 'checkpoint', 'persist' or 'none'")
