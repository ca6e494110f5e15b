"""Readers (P-SRC-1 .. P-SRC-3).

* ``read_records``: columnar records with an explicit schema, so the scan
  reads exactly the declared (and, after pruning, the used) columns;
* ``read_pairs``: a pluggable format for key/value record files (Avro in the
  original; ``spark-avro`` is an external package, so the format is a
  parameter and Parquet is the default);
* ``parse_score_tuples`` / ``parse_hardware_tuples``: the parenthesised
  text-tuple layouts written by the original jobs, parsed with native string
  functions. Lines that do not parse are dropped (``keep_rejects=True`` keeps
  them with a ``reject`` flag instead).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_records(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """P-SRC-1: Parquet records, with the read schema pushed when given."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_pairs(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    value_col: str | None = None,
) -> DataFrame:
    """P-SRC-2: key/value record files by glob (``fmt="avro"`` needs spark-avro on the classpath).

    With ``value_col`` the value struct is flattened (the key is never read).
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.select(f"{value_col}.*") if value_col else df


def _fields(line: Column) -> Column:
    return F.split(F.trim(F.replace(F.replace(line, F.lit("("), F.lit("")), F.lit(")"), F.lit(""))), ",")


def parse_score_tuples(lines: DataFrame, col: str = "value", keep_rejects: bool = False) -> DataFrame:
    """``(ip,size,flag,coef)`` -> ``(ip, size, coef)``.

    The address field may hold two comma-separated addresses (``a, b``):
    when the second field contains a dot the fields shift by one and the
    first address is kept.
    """
    f = _fields(F.col(col))
    shifted = F.coalesce(F.get(f, 1).contains("."), F.lit(False))
    size = F.when(shifted, F.get(f, 2)).otherwise(F.get(f, 1))
    coef = F.when(shifted, F.get(f, 4)).otherwise(F.get(f, 3))
    out = lines.select(
        F.get(f, 0).alias("ip"),
        F.trim(size).try_cast("long").alias("size"),
        F.trim(coef).try_cast("double").alias("coef"),
    )
    reject = F.col("size").isNull() | F.col("coef").isNull()
    return out.withColumn("reject", reject) if keep_rejects else out.where(~reject)


def parse_hardware_tuples(lines: DataFrame, col: str = "value", keep_rejects: bool = False) -> DataFrame:
    """``((maker,model,resolution),n)`` -> ``(f1, f2, f3)``; fewer than three fields is a reject."""
    f = _fields(F.col(col))
    reject = F.size(f) < 3
    out = lines.select(F.get(f, 0).alias("f1"), F.get(f, 1).alias("f2"), F.get(f, 2).alias("f3"), reject.alias("reject"))
    return out if keep_rejects else out.where(~F.col("reject")).drop("reject")


def read_score_tuples(spark: SparkSession, path: str, keep_rejects: bool = False) -> DataFrame:
    """P-SRC-3: score tuple text files."""
    return parse_score_tuples(spark.read.text(path), keep_rejects=keep_rejects)


def read_hardware_tuples(spark: SparkSession, path: str, keep_rejects: bool = False) -> DataFrame:
    """P-SRC-3: hardware tuple text files."""
    return parse_hardware_tuples(spark.read.text(path), keep_rejects=keep_rejects)
