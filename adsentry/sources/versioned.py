"""Partitioned tables whose days are replaced in one step.

A table is a folder of immutable versions (each a Parquet folder, partitioned)
and numbered manifests. A manifest lists the partitions that make up the table
and the version each lies in. A replacement writes its rows as a new version
first; only then the next manifest appears under its name, by a rename, which
either happens or doesn't. Readers take the highest manifest: whatever fails
before the rename leaves the table as it was, and so does a second writer that
comes first (the later one fails, as the name is taken).

Manifests hold a line per partition, never rows, and are the only thing that
the driver reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"


class ReplaceConflict(RuntimeError):
    """Another writer replaced days of the table in the meantime."""


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *parts[1:]])


def _latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest manifest; 0 and an empty table where there is none."""
    folder, fs = _hadoop(spark, _join(path, MANIFESTS))
    if not fs.exists(folder):
        return 0, {"schema": None, "partition_by": [], "partitions": []}
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
    if not numbers:
        return 0, {"schema": None, "partition_by": [], "partitions": []}
    file, _ = _hadoop(spark, _join(path, MANIFESTS, f"{max(numbers):012d}.json"))
    stream = fs.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return max(numbers), json.loads(text)


def _commit(spark: SparkSession, path: str, number: int, manifest: dict) -> None:
    """The manifest under its number, all of it or none."""
    draft, fs = _hadoop(spark, _join(path, MANIFESTS, f"_draft-{uuid.uuid4().hex}"))
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    final, _ = _hadoop(spark, _join(path, MANIFESTS, f"{number:012d}.json"))
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ReplaceConflict(f"{path}: version {number} is taken")


def _partitions(spark: SparkSession, version: str, partition_by: Sequence[str]) -> list[dict]:
    glob, fs = _hadoop(spark, _join(version, *[f"{c}=*" for c in partition_by]))
    name = version.rsplit("/", 1)[1]
    out = []
    for status in fs.globStatus(glob) or ():
        folders = status.getPath().toString().split("/")[-len(partition_by) :]
        out.append({"version": name, "folder": "/".join(folders), "values": [unquote(f.split("=", 1)[1]) for f in folders]})
    return out


def replace_days(
    rows: DataFrame, path: str, partition_by: Sequence[str], start: str, end: str, scope: dict[str, Sequence[str]] | None = None
) -> int:
    """Replace the partitions of the days ``[start, end)`` (``day`` among ``partition_by``) by ``rows``, in one step.

    ``scope`` limits the other partition columns to the given values. Days of
    the range without rows lose those they had; other partitions are left
    alone. Rows outside the range or the scope are refused. ``rows`` may be
    read from the table itself: no file of it is touched. Returns the number
    of the new manifest.
    """
    spark, columns = rows.sparkSession, list(partition_by)
    before, manifest = _latest(spark, path)
    if manifest["partition_by"] not in ([], columns):
        raise ValueError(f"the table is partitioned by {manifest['partition_by']}")
    place = columns.index("day")

    def replaced(values: Sequence[str]) -> bool:
        named = dict(zip(columns, values, strict=True))
        return start <= values[place] < end and all(named[c] in allowed for c, allowed in (scope or {}).items() if c in named)

    version = _join(path, f"version-{uuid.uuid4().hex}")
    rows.hint("rebalance", *columns).write.partitionBy(*columns).parquet(version)
    new = _partitions(spark, version, columns)
    outside = [p["values"] for p in new if not replaced(p["values"])]
    if outside:
        raise ValueError(f"rows outside the days replaced: {outside[:3]}")
    kept = [p for p in manifest["partitions"] if not replaced(p["values"])]
    _commit(spark, path, before + 1, {"schema": rows.schema.jsonValue(), "partition_by": columns, "partitions": kept + new})
    return before + 1


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as its newest manifest has it: one scan per version that still holds partitions."""
    _, manifest = _latest(spark, path)
    if manifest["schema"] is None:
        raise FileNotFoundError(path)
    schema = StructType.fromJson(manifest["schema"])
    by_version: dict[str, list[str]] = {}
    for p in manifest["partitions"]:
        by_version.setdefault(p["version"], []).append(p["folder"])
    frames = [
        spark.read.schema(schema)
        .option("basePath", _join(path, version))
        .parquet(*[_join(path, version, f) for f in folders])
        .select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        for version, folders in by_version.items()
    ]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove versions that the newest manifest does not name; run when no reader holds an older one. Returns how many."""
    _, manifest = _latest(spark, path)
    used = {p["version"] for p in manifest["partitions"]}
    folder, fs = _hadoop(spark, path)
    gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("version-") and s.getPath().getName() not in used]
    for version in gone:
        fs.delete(version, True)
    return len(gone)
