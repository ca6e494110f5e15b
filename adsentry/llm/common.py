"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

import adsentry
from adsentry.session import shared_path

# A word is a maximal run of characters that are not ASCII white space. On
# UTF-8 bytes this is exactly what ``bytes.split()`` cuts at.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Rows of one numbering bucket (see ``numbered``): what a single task sorts.
ROWS_PER_BUCKET = 200_000

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

_KEPT: dict[str, Callable[[], None]] = {}  # operators that keep something in this process between tasks: how to drop it


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared checkpoint folder and reread.

    Cuts the lineage with files that every executor sees, so a lost executor
    costs no recomputation. The folder is removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).deleteOnExit(target)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables made by ``staged`` whose last reader has run."""
    for table in tables:
        spark = table.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(table._staged_path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_adsentry_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(adsentry.__file__))
    if os.path.isdir(home):  # else it came as a package file itself
        made = tempfile.mkdtemp(prefix="adsentry-code-")
        sc.addPyFile(shutil.make_archive(os.path.join(made, "adsentry"), "zip", os.path.dirname(home), os.path.basename(home)))
    sc._adsentry_shipped = True


def keep_in_worker(owner: str, drop: Callable[[], None]) -> None:
    """Say that tasks of ``owner`` leave something in this Python worker that its next tasks take up."""
    _KEPT[owner] = drop


def take_worker(owner: str) -> None:
    """To be called where a task of ``owner`` begins: what others keep in this Python worker goes.

    A worker outlives its stage and serves the next; without this it would hold
    the caches of every stage before, and what Arrow has freed, to the end.
    """
    for other in [x for x in _KEPT if x != owner]:
        _KEPT.pop(other)()
    pa.default_memory_pool().release_unused()


def columns_of(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, under private names: ``columns_of(df, _id="doc_id")``.

    Whatever else ``df`` carries, clashing names included, stays outside.
    """
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in wanted.items()])


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}_{i}"
    return name


def tie_order(df: DataFrame, without: tuple[str, ...]) -> list[Column]:
    """An order over all columns but some, for rows that tie in those; maps, which have none, by their JSON."""
    has_map = {f.name: "map<" in f.dataType.simpleString() for f in df.schema.fields}
    columns = [(c, F.col(f"`{c}`")) for c in df.columns if c not in without]
    return [F.to_json(F.struct(c.alias("c"))) if has_map[name] else c for name, c in columns] or [F.lit(1)]


def word_count(text: Column) -> Column:
    """Number of words as BIGINT; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def numbered(df: DataFrame, keys: list[str], ties: list[str], out: str, n_rows: int) -> DataFrame:
    """``df`` with ``out``: a gapless number from 0 within each key, as BIGINT.

    A key may hold any share of all rows, so no task ever sorts a whole key:
    rows are dealt by a hash of ``ties`` into buckets of about
    ``ROWS_PER_BUCKET`` rows, numbered there in the order of ``ties``, and
    moved up by the rows of the key's earlier buckets, whose counts come from
    one pre-aggregated pass. Rows equal in all of ``ties`` are
    interchangeable. ``df`` is read twice: stage it first. Keys must not be
    null.
    """
    buckets = max(16, -(-n_rows // ROWS_PER_BUCKET))
    bucket, before = fresh_name(df, "_bucket"), fresh_name(df, "_before")
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*ties), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    within = Window.partitionBy(*keys, bucket).orderBy(*ties)
    return (
        dealt.join(starts, [*keys, bucket])
        .withColumn(out, F.col(before) + F.row_number().over(within) - 1)
        .select(*df.columns, out)
    )


def empty_frame(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)
