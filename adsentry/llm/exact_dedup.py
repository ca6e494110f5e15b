"""Exact deduplication by a tree-merge of sorted digest runs.

Every scan task yields a run sorted by digest: an entry per distinct text with
the identifier to keep and the number of rows. Runs then merge in binomial
rounds: in round ``k`` the runs whose numbers agree above the lowest ``k``
groups of bits meet (``FAN_IN`` at a time: a multiway merge), equal digests
become neighbours and then one entry that retains the identifier to keep. After
the last round one run is left and each of its entries stands for one distinct
text.

A round is a sort-based aggregation, on both sides of its exchange: the
identifier to keep travels as a struct, which Spark aggregates along a sorted
input and never in a hash table. A task sorts its part of a run, makes equal
neighbours one and sends them on dealt by digest; the receiver merges the parts
by a sort and makes neighbours one again. So a sort may spill but nothing else
grows, a text that a third of all rows repeat leaves every task as one entry,
and no run is ever held in one place.

An entry is verified at every level: two entries become one only if their
SHA-256, their length in bytes and an independent 64-bit hash all agree.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adsentry.llm.common import columns_of, fresh_name, staged, tie_order

RUNS = 64  # runs before the first round: scan partitions are dealt onto them
FAN_IN = 8  # runs merged together in one round

_ENTRY = ["_sha", "_len", "_check"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col("_text"), F.lit(""))
    return columns_of(docs, _id=id_col, _text=text_col).select(
        F.col("_id"),
        F.unhex(F.sha2(text, 256)).alias("_sha"),
        F.octet_length(text).alias("_len"),
        F.xxhash64(text).alias("_check"),
    )


def _claim(keep: str) -> Column:
    """A row's claim to stay, as a struct: a row without an identifier stays
    only where no row of its group has one."""
    named = F.col("_id").isNotNull() if keep == "largest" else F.col("_id").isNull()
    return F.struct(named.alias("named"), F.col("_id").alias("id"))


def _meet(runs: DataFrame, keep: str) -> DataFrame:
    """Runs of equal number as one sorted run, whose equal entries are one (sort-based: see above)."""
    best = (F.max if keep == "largest" else F.min)("_best").alias("_best")
    return runs.groupBy("_run", *_ENTRY).agg(best, F.sum("_rows").alias("_rows"))


def merge_runs(runs: DataFrame, keep: str = "largest", n_runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """Binomial rounds over ``_run, <entry>, _best, _rows``: one entry per distinct text."""
    left = n_runs
    while left > 1:
        left = -(-left // fan_in)
        runs = _meet(runs.withColumn("_run", F.floor(F.col("_run") / F.lit(fan_in)).cast("int")), keep)
    return runs.select(*_ENTRY, F.col("_best.id").alias("_best"), "_rows")


def digest_groups(keyed: DataFrame, keep: str = "largest") -> DataFrame:
    """``<entry>, _best, _rows``: the groups of equal texts of a keyed table."""
    first = keyed.select(
        F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("_run"),
        *_ENTRY,
        _claim(keep).alias("_best"),
        F.lit(1).cast("long").alias("_rows"),
    )
    return merge_runs(_meet(first, keep), keep)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their UTF-8 bytes are; null counts as empty. Of equal
    texts the row with the largest (or smallest) identifier stays. Rows that
    repeat an identifier and its text are one document several times:
    ``group_size`` counts each, exactly one of them is ``kept``. Rows without
    an identifier rank below all others; if a group has no identifier at all,
    one of its rows stays and ``keep_id`` is null. An empty table gives none.
    """
    keyed = staged(_keyed(docs, id_col, text_col), "dedup-keys")
    groups = digest_groups(keyed, keep)
    same = keyed.groupBy("_id", *_ENTRY).agg(F.count(F.lit(1)).alias("_copies"))
    rows = same.join(groups, _ENTRY).withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select(
        F.col("_id").alias("doc_id"),
        F.col("_best").alias("keep_id"),
        F.col("_rows").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_best")) & (F.col("_nth") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that repeat both identifier and text, the first in the order of
    the remaining columns (nulls first; maps by their JSON) stays.
    """
    keyed = _keyed(docs, id_col, text_col)
    winners = digest_groups(staged(keyed, "dedup-keys"), keep).select("_best", *_ENTRY)
    id_k, sha_k, len_k, check_k, nth = (fresh_name(docs, f"_dd_{x}") for x in ("id", "sha", "len", "check", "nth"))
    best_w, *entry_w = (fresh_name(docs, f"_win{x}") for x in ("_best", *_ENTRY))
    winners = winners.select(F.col("_best").alias(best_w), *[F.col(x).alias(w) for x, w in zip(_ENTRY, entry_w, strict=True)])
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    marked = docs.withColumns(
        {id_k: F.col(f"`{id_col}`"), sha_k: F.unhex(F.sha2(text, 256)), len_k: F.octet_length(text), check_k: F.xxhash64(text)}
    )
    mine = {"_sha": sha_k, "_len": len_k, "_check": check_k}
    on = F.col(id_k).eqNullSafe(F.col(best_w))
    for x, w in zip(_ENTRY, entry_w, strict=True):
        on = on & (F.col(mine[x]) == F.col(w))
    kept = marked.join(winners, on, "left_semi")
    order = Window.partitionBy(sha_k, id_k).orderBy(*tie_order(docs, (id_col, text_col)))
    return kept.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
