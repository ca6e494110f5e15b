"""Quality classifier learned from preference pairs (Bradley-Terry).

A document's score is linear in measures of its whole text. The weights are
learned from pairs of a preferred (label 1) and a rejected (label 0) document:
the preferred one wins with probability sigmoid(w * (x_i - x_j)), so the loss
is logistic on feature differences, without an intercept. Which documents are
good enough is a quantile of the scores: of a fixed grid, the one that
separates the training labels best.

The weights are learned once on the driver, from a bounded sample of the
labelled rows (``max_labelled``, drawn per label by a hash of the identifier).
The threshold is chosen over all labelled rows that are not held out, from
counts per score bin and label; scoring is one pass over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of, fresh_name, ship_code, staged, take_worker
from adsentry.llm.quality_rules import TextMeasures, _batches

MAX_LABELLED = 8_000  # labelled rows that the weights are learned from
PAIRS_PER_DOC = 20  # opponents of each training document
SCORE_BINS = 1 << 16  # bins of the scores' whole range that the threshold is chosen from
QUANTILES = 1_000  # grid of score quantiles that may become the threshold
ACCEPT = 0.7  # the threshold's place on the 0..1 scale
RIDGE = 1e-2

FEATURES = (
    "symbols",
    "duplicate_lines",
    "repeated_windows",
    "repeated_neighbours",
    "shouted",
    "without_letters",
    "symbol_per_char",
    "type_share",
    "short",
    "digits",
    "word_length",
)


def features(text: str | None) -> list[float]:
    """Measures of a whole text, each within 0..1 (a text without words: its share of 'short' only)."""
    m = TextMeasures(text)
    n = max(1, m.n_words)
    chars = max(1, m.word_chars)
    return [
        min(1.0, m.n_symbols / n),
        m.n_dup_lines / max(1, len(m.lines)),
        min(1.0, m.n_repeat_words / n),
        m.n_same_as_previous / n,
        m.n_shouted / n,
        1.0 - m.n_lettered / n if m.n_words else 0.0,
        min(1.0, 4.0 * m.n_symbols / chars),
        len(set(m.words)) / n,
        10.0 / (10.0 + m.n_words),
        min(1.0, 4.0 * sum(map(m.text.count, "0123456789")) / chars),
        min(1.0, chars / n / 40.0),
    ]


@dataclass(frozen=True)
class PairwiseModel:
    """``score = sigmoid(w * (x - mean) / scale - threshold)``, moved so that the threshold scores ``ACCEPT``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    quantile: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6.0, 6.0)
        return z @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        lift = np.log(ACCEPT / (1 - ACCEPT))
        return 1.0 / (1.0 + np.exp(-np.clip(self.strength(x) - self.threshold + lift, -60, 60)))


def fit_pairs(x: np.ndarray, label: np.ndarray, pairs_per_doc: int = PAIRS_PER_DOC, seed: int = 7) -> PairwiseModel:
    """Bradley-Terry weights by Newton steps on the logistic loss of feature differences.

    Without both labels there is no pair to learn from: the model then scores
    every text ``ACCEPT``, which keeps it.
    """
    dims = x.shape[1] if x.ndim == 2 else len(FEATURES)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return PairwiseModel(np.zeros(dims), np.ones(dims), np.zeros(dims), 0.0, 0.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.clip((x - mean) / scale, -6.0, 6.0)
    rng = np.random.default_rng(seed)
    winners = np.concatenate([np.repeat(good, pairs_per_doc), rng.choice(good, len(bad) * pairs_per_doc)])
    losers = np.concatenate([rng.choice(bad, len(good) * pairs_per_doc), np.repeat(bad, pairs_per_doc)])
    d = z[winners] - z[losers]
    w = np.zeros(dims)

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0.0, -(d @ w)).mean() + RIDGE / 2 * w @ w)

    for _ in range(50):
        miss = 1.0 / (1.0 + np.exp(np.clip(d @ w, -60, 60)))
        grad = -(d * miss[:, None]).mean(0) + RIDGE * w
        hess = (d * (miss * (1 - miss))[:, None]).T @ d / len(d) + RIDGE * np.eye(dims)
        step, size, at = np.linalg.solve(hess, grad), 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > at:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    strength = z @ w
    # the threshold is a score quantile: the one with fewest wrong training labels
    grid = np.arange(1, QUANTILES) / QUANTILES
    cuts = np.quantile(strength, grid, method="midpoint")
    wrong = [int(((strength >= c) != (label == 1)).sum()) for c in cuts]
    best = np.flatnonzero(np.array(wrong) == min(wrong))
    at = best[len(best) // 2]
    return PairwiseModel(mean, scale, w, float(cuts[at]), float(grid[at]))


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the identifier's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> PairwiseModel:
    """A model from the labels of rows that are not held out (null labels and identifiers are left out)."""
    ship_code(docs.sparkSession)
    known = (
        columns_of(labels, _lid=id_col, _label=label_col)
        .where(F.col("_label").isin(0, 1) & F.col("_lid").isNotNull() & ~held_out(F.col("_lid")))
        .distinct()
    )
    texts = columns_of(docs, _id=id_col, _text=text_col).where(F.col("_id").isNotNull() & ~held_out(F.col("_id")))

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("classifier")
        for batch in _batches(it):
            x = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["id", "x"])

    kind = texts.schema["_id"].dataType.simpleString()
    measured = texts.mapInArrow(measure, f"id {kind}, x array<double>")
    # the measures move to their labels, not the texts
    labelled = staged(
        measured.join(known, F.col("id") == F.col("_lid")).select("id", F.col("_label").cast("int").alias("label"), "x"), "quality-labelled"
    )
    drawn = [_drawn(labelled.where(F.col("label") == v), max_labelled) for v in (0, 1)]
    # half of the sample to each label; what one does not fill is the other's
    n_bad = min(len(drawn[0]), max(max_labelled // 2, max_labelled - len(drawn[1])))
    rows = drawn[0][:n_bad] + drawn[1][: max_labelled - n_bad]
    rows.sort(key=lambda r: (r["id"], r["label"], r["x"]))
    model = fit_pairs(np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), -1) if rows else np.zeros((0, len(FEATURES))), np.array([r["label"] for r in rows], dtype=int))
    return _threshold(labelled, model) if all(drawn) else model


def _drawn(labelled: DataFrame, n: int) -> list:
    """The ``n`` rows first by a hash of their identifier.

    Only rows under a bound of the hash that about twice as many pass are
    sorted, so tasks send some ``2 n`` rows in all, however many tasks.
    """
    place = F.xxhash64("id", F.lit(11))
    rows = labelled.count()
    under = labelled if rows <= 2 * n else labelled.where(place < int(-(2**63) + 2**64 * (2 * n / rows)))
    found = under.orderBy(place, "id", "x").limit(n).collect()
    return found if rows <= 2 * n or len(found) == n else labelled.orderBy(place, "id", "x").limit(n).collect()


def _threshold(labelled: DataFrame, model: PairwiseModel) -> PairwiseModel:
    """The model with the score quantile of all ``labelled`` rows that has fewest wrong labels."""
    reach = 6.0 * float(np.abs(model.weights).sum()) + 1e-9  # no score lies beyond
    width = 2 * reach / SCORE_BINS

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                at = np.floor((model.strength(np.array(batch.column(1).to_pylist(), dtype=float)) + reach) / width)
                cell = np.clip(at, 0, SCORE_BINS - 1).astype(np.int64) * 2 + batch.column(0).to_numpy()
                cells, n = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])

    counted = labelled.select("label", "x").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    held = np.zeros(2 * SCORE_BINS, np.int64)
    for r in counted:
        held[r["cell"]] = r["n"]
    bad, good = held[0::2], held[1::2]
    upto = np.cumsum(bad + good)
    # bins of the rows on both sides of each quantile; the cut lies midway
    grid = np.arange(1, QUANTILES) / QUANTILES
    place = grid * (upto[-1] - 1)
    below, above = (np.searchsorted(upto, f(place), side="right") for f in (np.floor, np.ceil))
    cuts = (below + above + 1) // 2
    wrong = (bad.sum() - np.concatenate([[0], np.cumsum(bad)])[cuts]) + np.concatenate([[0], np.cumsum(good)])[cuts]
    best = np.flatnonzero(wrong == wrong.min())
    at = best[len(best) // 2]
    return replace(model, threshold=float(cuts[at] * width - reach), quantile=float(grid[at]))


def score_documents(docs: DataFrame, model: PairwiseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, score``; null texts count as empty, repeated rows are scored each."""
    ship_code(docs.sparkSession)
    rows = columns_of(docs, _id=id_col, _text=text_col)

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("classifier")
        for batch in _batches(it):
            if batch.num_rows:
                x = np.array([features(t) for t in batch.column(1).to_pylist()], dtype=float)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, score double")


def quality_classifier(docs: DataFrame, labels: DataFrame, **train_options) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted`` (1 from ``ACCEPT`` on)."""
    scored = score_documents(docs, train(docs, labels, **train_options))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", **train_options) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns unchanged."""
    from pyspark.sql.pandas.functions import pandas_udf

    model = train(docs, labels, text_col=text_col, **train_options)

    @pandas_udf("double")
    def score(texts):
        import pandas as pd

        take_worker("classifier")
        return pd.Series(model.score(np.array([features(t) for t in texts], dtype=float).reshape(len(texts), -1)) if len(texts) else [], dtype="float64")

    name = fresh_name(docs, "_quality")
    return docs.withColumn(name, score(F.col(f"`{text_col}`"))).where(F.col(name) >= ACCEPT).select(*[F.col(f"`{c}`") for c in docs.columns])
