"""Writers (P-SNK-1 .. P-SNK-6).

Every writer takes a DataFrame and a path and relies on Spark's own commit
protocol: output appears atomically per job (or per partition with dynamic
overwrite), so a re-run after a lost executor or a failed job does not leave
half-written days behind.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the original jobs replace an existing output, except two that
# refuse to (their outputs are append-once).
DEFAULT_MODE = "overwrite"


def tuple_line(*cols: Column | str) -> Column:
    """``(a,b,c)`` text form of a row, as the original text outputs."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("null")) for c in cols]
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


def write_text(df: DataFrame, path: str, cols: Sequence[str] | None = None, mode: str = DEFAULT_MODE) -> None:
    """P-SNK-1: one ``(a,b,...)`` line per row."""
    cols = list(cols or df.columns)
    df.select(tuple_line(*cols).alias("value")).write.mode(mode).text(path)


def write_delimited(df: DataFrame, path: str, sep: str = "|", mode: str = DEFAULT_MODE) -> None:
    """P-SNK-1: ``a|b`` lines (the ``HH|n`` form), no header."""
    df.write.mode(mode).option("sep", sep).option("header", "false").csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = DEFAULT_MODE,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
) -> None:
    """P-SNK-2 / P-SNK-4: Parquet (snappy); ``mode="errorifexists"`` for append-once outputs."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("platform", "day")) -> None:
    """P-SNK-5: replace exactly the partitions present in ``df`` (dynamic overwrite).

    The write of the original's "clean one day, then write it", idempotent on
    re-run; partitions without rows are left to :func:`drop_partitions`. Rows
    are gathered by partition first, so that files do not multiply with the
    tasks; ``REBALANCE`` splits a large partition again.
    """
    (
        df.hint("rebalance", *partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_partitions(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    within: tuple[str, str, str],
    scope: dict[str, Sequence[str]] | None = None,
    keep: Collection[tuple[str, ...]] = (),
) -> None:
    """P-SNK-5: remove stored partitions whose ``within = (column, start, end)`` lies in ``[start, end)``.

    ``scope`` limits the other partition columns to the given values; the
    partitions in ``keep`` (values in the order of ``partition_by``) stay.
    Dates compare as ``yyyy-MM-dd`` text. Only folder names are looked at.
    """
    column, start, end = within
    glob = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *[f"{c}=*" for c in partition_by]]))
    fs = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(glob) or ():
        parts = status.getPath().toString().split("/")[-len(partition_by):]
        values = tuple(unquote(p.split("=", 1)[1]) for p in parts)
        named = dict(zip(partition_by, values))
        scoped = all(named[c] in allowed for c, allowed in (scope or {}).items() if c in named)
        if start <= named[column] < end and scoped and values not in keep:
            fs.delete(status.getPath(), True)


def write_jdbc(df: DataFrame, url: str, table: str, options: dict[str, str] | None = None, writers: int = 80) -> None:
    """P-SNK-3: append to a relational table with ``writers`` parallel connections.

    Credentials and driver come from the caller's ``options``; none are kept here.
    An append repeats rows when a load is run again, so load into a table of
    the caller's own for each run (a staging table, say) and swap it in there.
    No database may be started where this was written: untested.
    """
    df.repartition(writers).write.mode("append").jdbc(url, table, properties=dict(options or {}))


def write_single_file(df: DataFrame, path: str, fmt: str = "csv", sep: str = "|", mode: str = DEFAULT_MODE) -> None:
    """P-SNK-6: a small result (e.g. 24 hour shares) as one file.

    ``coalesce(1)`` is only for outputs of bounded size such as the 24-row
    population profile; large outputs keep their partitions.
    """
    w = df.coalesce(1).write.mode(mode)
    if fmt == "csv":
        w.option("sep", sep).option("header", "false").csv(path)
    else:
        w.format(fmt).save(path)
