"""Mixing sources to target weights by Pareto order sampling.

A source of ``S`` words with target ``T`` takes ``T // S`` certain copies of
every document; what is left of the target is drawn from its documents
without replacement by Pareto order sampling: a document with inclusion
probability p and a uniform random number u ranks by the odds of u over the
odds of p, and the lowest ranks are taken. Inclusion probabilities are unequal:
in proportion to a column or, by default, to the square root of the document's
words, as far as they stay below 1 (longer ones are certain), at the scale where
the expected words of the sample are what is left of the target; that scale
comes from sums over all documents. u is a hash of the document and the seed, so
reruns agree. The sample's fixed size is counted in words: documents are taken
in rank order as long as they fit into the rest of the target;
from the point where it is used up, a document that does not fit is passed
over for the next that does, to the source's end; then one of the last may be
exchanged.

No source is ever sorted as a whole: ranks fall into ``BINS`` bins per source,
pre-aggregated sums find the bin where the target is used up, all documents
below it are taken, and only those in and just behind it are sorted. With what
they leave, the same is done again on the documents behind that are not too
long for it, until there are none.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adsentry.llm.common import columns_of, fresh_name, release, ship_code, staged, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3.0  # a target stops at so many times its source's size
BANDS = 16  # weight bands per power of two, in which the scale of the probabilities is found
BINS = 1 << 16  # rank bins of a source
RANGE = 1 << 8  # bins whose running sums are worked out together
BEHIND = 256  # documents around the last bin that a round sorts


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, cap: float = MAX_COPIES) -> DataFrame:
    """``_source, _source_size, _target`` of a table ``_source, _source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn. The
    targets share ``share`` of all words by weight; a target stops at ``cap``
    times its source's size and the excess is shared again by weight until
    none is above. That fixed point is ``min(cap * size, level * weight)``:
    with the sources ordered by size over weight, the capped ones are a
    prefix, so running sums give it in one pass over one row per source. If
    ``share`` exceeds ``cap``, every source gets ``cap`` times its size.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    pick = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    w = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (pick + 1).cast("int")))
    order = [F.col("_source_size") / F.col("_w"), F.col("_source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.sum("_source_size").over(whole) * F.lit(float(share))
    capped_before = F.coalesce(F.sum(F.col("_source_size") * F.lit(float(cap))).over(before), F.lit(0.0))
    # the level if this source and all behind it were not capped
    level = (total - capped_before) / F.sum("_w").over(onward)
    ranked = w.withColumn("_level", level).withColumn("_limit", F.col("_source_size") * F.lit(float(cap)))
    # the first source that stays under its limit sets the level for all behind it
    ranked = ranked.withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_limit"))
    final = F.min(F.when(F.col("_open"), F.struct(F.col("_source_size") / F.col("_w"), "_level"))).over(whole)["_level"]
    return ranked.withColumn("_final", final).select(
        "_source",
        "_source_size",
        F.least(F.col("_limit"), F.coalesce(F.col("_final") * F.col("_w"), F.col("_limit"))).alias("_target"),
    )


def _uniform(*cols: Column, seed: int) -> Column:
    """A number in (0, 1) from a hash of the columns."""
    return (F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def _scaled(bands: DataFrame, rests: DataFrame) -> DataFrame:
    """``_ps, _scale`` per source: with p = min(1, _scale * weight), the
    expected words of its documents are ``_rest``.

    The documents at 1 are those of the heaviest bands. With the first k bands
    there, the others' scale is what they leave over the others' weighted words;
    the first k at which no weight behind passes 1 is taken. One row per source
    and band (``_source, _band, _words, _mass, _top``).
    """
    same = F.col("_source").eqNullSafe(F.col("_ps"))
    down = Window.partitionBy("_source").orderBy(F.col("_band").desc())
    certain = F.coalesce(F.sum("_words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    others = F.sum("_mass").over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    tried = bands.withColumns({"_certain": certain, "_others": others}).join(rests, same)
    scale = F.when(F.col("_others") > 0, (F.col("_rest") - F.col("_certain")) / F.col("_others"))
    tried = tried.withColumn("_scale", F.when(scale > 0, scale))
    # within one band weights differ by a few percent: if none fits, the last
    # that leaves words at all; p is held below 1 where it is used
    fits = F.max(F.when(F.col("_scale") * F.col("_top") <= 1, F.struct("_band", "_scale")))["_scale"]
    last = F.min(F.when(F.col("_scale").isNotNull(), F.struct("_band", "_scale")))["_scale"]
    return tried.groupBy("_ps").agg(F.coalesce(fits, last, F.lit(0.0)).alias("_scale"))


def _copies(rows: DataFrame, weights, share, cap, seed, bins, behind) -> DataFrame:
    """``rows`` (``_row, _id, _source, _size, _p``) with targets and ``_copies``."""
    band = F.when(F.col("_p") > 0, F.floor(F.log2("_p") * BANDS)).otherwise(F.lit(-(1 << 20))).cast("int")
    bands = rows.groupBy("_source", band.alias("_band")).agg(
        F.sum("_size").alias("_words"), F.sum(F.col("_size") * F.col("_p")).alias("_mass"), F.max("_p").alias("_top")
    )
    bands = staged(bands, "mix-bands")
    plan = source_targets(bands.groupBy("_source").agg(F.sum("_words").alias("_source_size")), weights, share, cap)
    plan = plan.withColumn(
        "_whole", F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0).cast("long")
    ).withColumn("_rest", F.greatest(F.lit(0.0), F.col("_target") - F.col("_whole") * F.col("_source_size")))
    scales = _scaled(bands, plan.select(F.col("_source").alias("_ps"), "_rest"))
    plan = plan.join(scales, F.col("_source").eqNullSafe(F.col("_ps"))).drop("_ps")
    plan = staged(plan, "mix-plan")
    same = F.col("_source").eqNullSafe(F.col("_ps"))
    of = lambda *cols: plan.select(F.col("_source").alias("_ps"), *cols)

    # odds of u over odds of the inclusion probability, as a rank in (0, 1)
    u = _uniform("_id", "_size", "_source", seed=seed)
    p = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-12), F.col("_p") * F.col("_scale")))
    odds = (u / (1 - u)) / (p / (1 - p))
    ranked = rows.join(of("_source_size", "_target", "_whole", "_rest", "_scale"), same).drop("_ps")
    ranked = ranked.withColumn("_rank", F.when(F.col("_size") > 0, odds / (1 + odds)).otherwise(1.0))
    ranked = ranked.withColumn("_bin", F.least(F.lit(bins - 1), F.floor(F.col("_rank") * bins)).cast("int")).drop("_scale")
    ranked = staged(ranked, "mix-ranks")
    ship_code(rows.sparkSession)

    segments, windows, ends = [], [], []
    state = of(F.lit(0).alias("_from"), F.col("_rest").alias("_left"))
    for k in itertools.count():
        # what may still be taken: beyond the first round, documents that are
        # too long for what is left are aside (the rest only shrinks)
        open_rows = ranked.join(state, same).drop("_ps").where("_size > 0 and _bin >= _from" + (" and _size <= _left" if k else ""))
        settled = _edges(open_rows, bins, behind)
        if settled.isEmpty():
            break
        segments.append(settled.select("_ps", "_from", "_edge", F.when(F.lit(k > 0), F.col("_limit")).alias("_limit")))
        near = open_rows.drop("_left").join(settled.select("_ps", "_edge", "_last", F.col("_need").alias("_left")), same)
        near = near.where("_bin >= _edge and _bin <= _last").select("_row", "_source", "_left", "_rank", "_id", "_size")
        kind = ranked.schema["_source"].dataType.simpleString()
        filled = near.groupBy("_source").applyInPandas(_fill, f"_source {kind}, _row long, _size long, _take boolean, _nth long")
        windows.append(staged(filled.withColumn("_k", F.lit(k)), "mix-window"))
        used = windows[-1].where("_take").groupBy("_source").agg(F.sum("_size").alias("_used"))
        after = settled.join(used, same, "left").select(
            "_ps", F.lit(k).alias("_k"), (F.col("_last") + 1).alias("_from"), (F.col("_need") - F.coalesce("_used", F.lit(0))).alias("_left")
        )
        ends.append(staged(after, "mix-left"))
        state = ends[-1].where(F.col("_left") > 0).where(F.col("_from") < bins).drop("_k")
        if state.isEmpty():
            break

    if not segments:  # no document has words
        return ranked.withColumn("_copies", F.col("_whole"))
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    # the exchange comes when nothing more fits anywhere in the source
    end = union(ends).groupBy("_ps").agg(F.max(F.struct("_k", "_left"))["_left"].alias("_left"))
    swapped = union(windows).join(end, same).drop("_ps").groupBy("_source").applyInPandas(_exchange, "_t long")
    runs = union(segments).groupBy("_ps").agg(F.collect_list(F.struct("_from", "_edge", "_limit")).alias("_runs"))  # one a round
    out = ranked.join(runs, same, "left").drop("_ps").join(swapped, F.col("_row") == F.col("_t"), "left")
    whole_bins = F.exists(
        "_runs",
        lambda r: (F.col("_bin") >= r["_from"]) & (F.col("_bin") < r["_edge"]) & (r["_limit"].isNull() | (F.col("_size") <= r["_limit"])),
    )
    drawn = (F.col("_size") > 0) & ((F.col("_rest") > 0) & whole_bins | F.col("_t").isNotNull())
    return out.withColumn("_copies", F.when(F.coalesce(drawn, F.lit(False)), F.col("_whole") + 1).otherwise(F.col("_whole")))


def _edges(open_rows: DataFrame, bins: int, behind: int) -> DataFrame:
    """Per source ``_ps, _from, _limit, _edge, _last, _need``: from bin
    ``_from`` on, all of ``open_rows`` below bin ``_edge`` fit into ``_limit``
    words; the bins up to ``_last`` are filled one by one with ``_need`` left.
    If everything fits, ``_edge`` and ``_last`` are ``bins``.

    Each step is written out: every one is read twice by the next, and as one
    plan it would hold the documents four times over."""
    same = F.col("_source").eqNullSafe(F.col("_ps"))
    held = open_rows.groupBy("_source", "_bin").agg(
        F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_n"), F.first("_from").alias("_from"), F.first("_left").alias("_limit")
    )
    # running sums within ranges of bins, moved up by those of the ranges before:
    # no task holds all bins of a source
    held = staged(held.withColumn("_range", F.floor(F.col("_bin") / F.lit(RANGE)).cast("int")), "mix-bins")
    ranges = held.groupBy(F.col("_source").alias("_rs"), F.col("_range").alias("_r")).agg(
        F.sum("_words").alias("_range_words"), F.sum("_n").alias("_range_n")
    )
    earlier = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    lower = earlier(["_rs"], "_r")
    ranges = ranges.select("_rs", "_r", before("_range_words", lower).alias("_words0"), before("_range_n", lower).alias("_n0"))
    inside = earlier(["_source", "_range"], "_bin")
    sums = (
        held.join(ranges, F.col("_source").eqNullSafe(F.col("_rs")) & (F.col("_range") == F.col("_r")))
        .withColumns(
            {"_before": F.col("_words0") + before("_words", inside), "_n_before": F.col("_n0") + before("_n", inside)}
        )
        .drop("_rs", "_r", "_words0", "_n0", "_range")
    )
    sums = staged(sums, "mix-sums")
    # per source: the first bin that does not fit as a whole, and around it
    # the bins of the ``behind`` documents before and behind that may settle
    # the rest, with what is left where they begin
    over = F.when(F.col("_before") + F.col("_words") > F.col("_limit"), F.struct("_bin", "_n_before"))
    edge = sums.groupBy("_source").agg(
        F.min(over).alias("e"), F.sum("_words").alias("_all"), F.first("_from").alias("_from"), F.first("_limit").alias("_limit")
    )
    edge = edge.select(F.col("_source").alias("_ps"), F.col("e._bin").alias("_at"), F.col("e._n_before").alias("_n_at"), "_all", "_from", "_limit")
    around = sums.select("_source", "_bin", "_before", "_n_before").join(edge.select("_ps", "_at", "_n_at"), same).where(
        ((F.col("_bin") <= F.col("_at")) & (F.col("_n_before") >= F.col("_n_at") - F.lit(behind)))
        | ((F.col("_bin") > F.col("_at")) & (F.col("_n_before") < F.col("_n_at") + F.lit(behind)))
    )
    around = around.groupBy("_source").agg(F.min(F.struct("_bin", "_before")).alias("a"), F.max("_bin").alias("_to"))
    settled = edge.join(around, same, "left").select(
        "_ps",
        "_from",
        "_limit",
        F.coalesce("a._bin", F.lit(bins)).alias("_edge"),
        F.coalesce("_to", F.lit(bins)).alias("_last"),
        (F.col("_limit") - F.coalesce("a._before", "_all")).alias("_need"),
    )
    settled = staged(settled, "mix-edges")
    release(held, sums)
    return settled


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of a window in rank order, and which of them fit."""
    pdf = pdf.sort_values(["_rank", "_id", "_size", "_row"], kind="stable")
    left, sizes = float(pdf["_left"].iloc[0]), pdf["_size"].to_numpy()
    take = np.zeros(len(sizes), bool)
    for i, size in enumerate(sizes):
        if size <= left:
            take[i] = True
            left -= size
    return pdf[["_source", "_row", "_size"]].assign(_take=take, _nth=np.arange(len(sizes)))


def _exchange(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows of the windows that are taken, after one exchange of them if it
    brings the words nearer: a document more, or one in place of another
    (row 0: of none)."""
    pdf = pdf.sort_values(["_k", "_nth"], kind="stable")
    left, sizes, take = float(pdf["_left"].iloc[0]), pdf["_size"].to_numpy(), pdf["_take"].to_numpy(bool).copy()
    out = np.flatnonzero(~take)
    if left > 0 and len(out):
        out = out[np.argsort(sizes[out], kind="stable")]
        held = np.flatnonzero(take)
        base = np.concatenate([[0], sizes[held]])
        at = np.clip(np.searchsorted(sizes[out], base + left), 1, len(out)) - 1
        at = np.stack([at, np.minimum(at + 1, len(out) - 1)])
        gap = np.abs(left + base - sizes[out][at])
        best = np.unravel_index(np.argmin(gap), gap.shape)
        if gap[best] < left:
            take[out[at[best]]] = True
            if best[1]:
                take[held[best[1] - 1]] = False
    return pd.DataFrame({"_t": pdf["_row"].to_numpy()[take]})


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    cap: float = MAX_COPIES,
    seed: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    importance_col: str | None = None,
    bins: int = BINS,
    behind: int = BEHIND,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, copies, taken``.

    ``size`` is the text's words (null: 0), ``taken`` the words the mix takes
    of the document, repeats counted: never more than ``cap`` times its size.
    ``importance_col`` makes the inclusion probabilities within a source
    proportional to it (null: 0; default: to the square root of ``size``), none
    above 1. Null sources are one source, the last. Documents without words have ``copies`` of the certain part and take
    nothing. Rows that tie in rank are ordered by identifier and size;
    repeated rows are drawn each. An empty table gives none.
    """
    return _mixed(docs, weights, share, cap, seed, id_col, text_col, source_col, importance_col, bins, behind)[0].select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def _mixed(docs, weights, share, cap, seed, id_col, text_col, source_col, importance_col, bins, behind, keep_row=None):
    wanted = {"_id": id_col, "_text": text_col, "_source": source_col}
    if importance_col:
        wanted["_p"] = importance_col
    if keep_row:
        wanted["_row"] = keep_row
    rows = columns_of(docs, **wanted).withColumn("_size", word_count(F.col("_text"))).drop("_text")
    if not importance_col:
        rows = rows.withColumn("_p", F.sqrt("_size"))
    if not keep_row:
        rows = rows.withColumn("_row", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("_p", F.greatest(F.lit(0.0), F.coalesce(F.col("_p").cast("double"), F.lit(0.0)))), "mix-sizes")
    return _copies(rows, weights, share, cap, seed, bins, behind), rows


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, cap: float = MAX_COPIES, seed: int = 20) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: a row per copy, same columns.

    ``docs`` is read twice and its rows are matched by position: pass a stored
    table. Documents without words are left out.
    """
    row = fresh_name(docs, "_mix_row")
    numbered_docs = staged(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    mixed, _ = _mixed(numbered_docs, weights, share, cap, seed, "doc_id", "text", "source", None, BINS, BEHIND, keep_row=row)
    n, at, times = (fresh_name(docs, f"_mix_{x}") for x in ("n", "at", "copies"))
    copies = mixed.where("_copies > 0 and _size > 0").select(F.col("_row").alias(at), F.col("_copies").alias(times))
    return (
        numbered_docs.join(copies, F.col(row) == F.col(at))
        .withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
