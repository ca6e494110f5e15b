"""Quality rules as a short-circuit cascade.

A rule says whether a text is rejected. The verdict, "no rule rejects it",
does not depend on their order, but the work does: a text is done as soon as
one rule rejects it. So every rule is first timed on a sample, together with
which sampled texts it rejects, and the cascade is ordered greedily: next
comes the rule that rejects most of the texts still left per second it costs.
Measures that several rules share are computed once per text; a rule's cost is
what it adds to the measures that the report and the base rules have computed
already, and its share of rejections that among texts which pass the base rules.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of, ship_code

SAMPLE_ROWS = 2_000  # texts, on average, that the rules are timed on
REPEAT_WINDOW = 5

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_ASCII_SPACE = " \t\n\v\f\r"
_SHOUT = re.compile(rb"[^\x20\x09-\x0Da-z]*[A-Z][^\x20\x09-\x0Da-z]*[A-Z][^\x20\x09-\x0Da-z]*")
_LETTERED = re.compile(r"[^\x20\x09-\x0D]*[^\W\d_][^\x20\x09-\x0D]*")


class TextMeasures:
    """Measures of one text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    def copy(self) -> TextMeasures:
        """The same text with what has been measured so far."""
        other = TextMeasures(None)
        other.__dict__.update(self.__dict__)
        return other

    @cached_property
    def words(self) -> list[bytes]:
        # bytes.split() cuts at exactly space and \t to \r
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, _ASCII_SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return len(_SYMBOLS.findall(self.text))

    @cached_property
    def lines(self) -> list[str]:
        """Lines that hold a word."""
        return [x for x in self.text.split("\n") if x.strip(_ASCII_SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of five words that occur twice or more, the first included."""
        w = self.words
        windows = list(zip(*(w[i:] for i in range(REPEAT_WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        seen, covered, until = Counter(windows), 0, 0
        for i, window in enumerate(windows):
            if seen[window] > 1:
                covered += i + REPEAT_WINDOW - max(until, i)
                until = i + REPEAT_WINDOW
        return covered

    @cached_property
    def n_same_as_previous(self) -> int:
        return sum(map(bytes.__eq__, self.words, self.words[1:]))

    @cached_property
    def n_shouted(self) -> int:
        """Words with two or more of A-Z and none of a-z."""
        return sum(1 for w in self.words if _SHOUT.fullmatch(w))

    @cached_property
    def n_lettered(self) -> int:
        """Words that hold a letter of any script."""
        return len(_LETTERED.findall(self.text))


@dataclass(frozen=True)
class Rule:
    """``rejects(measures)``: true if the text is to go."""

    name: str
    rejects: Callable[[TextMeasures], bool]


BASE_RULES = (
    Rule("few_words", lambda m: m.n_words < 10),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
)

METHOD_RULES = (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("duplicate_lines", lambda m: 10 * m.n_dup_lines > 4 * len(m.lines)),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words),
    Rule("repeated_neighbours", lambda m: 10 * m.n_same_as_previous > 2 * m.n_words),
    Rule("shouting", lambda m: 10 * m.n_shouted > 3 * m.n_words),
    Rule("few_letters", lambda m: 2 * m.n_lettered < m.n_words),
)


def _batches(it: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices, so that few texts are Python objects at a time."""
    for batch in it:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def cascade_order(
    docs: DataFrame,
    rules: Sequence[Rule],
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    report: Sequence[str] = (),
    base: Sequence[Rule] = (),
) -> list[int]:
    """Positions of ``rules`` in the order the cascade runs them.

    Rules are timed on a random sample over all partitions, ``sample_rows``
    texts on average (all, if there are fewer), as the cascade meets them:
    the measures of ``report`` are known and the ``base`` rules passed. As the
    verdict does not depend on the order, the sample needs no more. A sample
    without such a text keeps the given order.
    """
    rules, report, base = tuple(rules), tuple(report), tuple(base)
    ship_code(docs.sparkSession)

    def time_rules(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, spent = Counter(), [0.0] * len(rules)
        for batch in _batches(it):
            for text in batch.column(0).to_pylist():
                known = TextMeasures(text)
                for name in report:
                    getattr(known, name)
                if any(r.rejects(known) for r in base):
                    continue
                mask = 0
                for i, rule in enumerate(rules):
                    measures = known.copy()
                    began = time.perf_counter()
                    mask |= rule.rejects(measures) << i
                    spent[i] += time.perf_counter() - began
                masks[mask] += 1
        keys = [*masks, *(-1 - i for i in range(len(rules)))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array([*map(float, masks.values()), *spent], pa.float64())], ["k", "v"]
        )

    texts = columns_of(docs, _text=text_col)
    n = texts.count()
    sample = texts.sample(sample_rows / n, seed=7) if n > sample_rows else texts
    seen = sample.mapInArrow(time_rules, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    left = {r["k"]: r["v"] for r in seen if r["k"] >= 0}
    cost = {-1 - r["k"]: r["v"] for r in seen if r["k"] < 0}
    order: list[int] = []
    while len(order) < len(rules):
        rest = [i for i in range(len(rules)) if i not in order]
        gain = {i: sum(n for mask, n in left.items() if mask >> i & 1) / max(cost.get(i, 0.0), 1e-9) for i in rest}
        best = max(rest, key=lambda i: (gain[i], -i))
        order.append(best)
        left = {mask: n for mask, n in left.items() if not mask >> best & 1}
    return order


def quality_cascade(
    docs: DataFrame,
    rules: Sequence[Rule] = BASE_RULES + METHOD_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    report: Sequence[str] = (),
    base: Sequence[Rule] = (),
    order: Sequence[int] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, the measures named in ``report``,
    ``base_failed``, ``kept`` and ``rejected_by``.

    ``base`` rules are judged for every document; ``rules`` in cascade order
    for those that pass them. ``rejected_by`` names the first rule that
    rejected the text (null if kept); which one of several that is depends on
    the measured order, ``kept`` does not. A null text counts as empty, an
    empty text has no words; repeated rows are judged each; an empty table
    gives none.
    """
    rows = columns_of(docs, _id=id_col, _text=text_col)
    rules, base, report = tuple(rules), tuple(base), tuple(report)
    ship_code(docs.sparkSession)
    order = cascade_order(docs, rules, text_col, report=report, base=base) if order is None else list(order)
    cascade = tuple(rules[i] for i in order)

    def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(it):
            measured: list[list[int]] = [[] for _ in report]
            failed, kept, by = [], [], []
            for text in batch.column(1).to_pylist():
                m = TextMeasures(text)
                for out, name in zip(measured, report):
                    out.append(getattr(m, name))
                first = next((r.name for r in base if r.rejects(m)), None)
                failed.append(first is not None)
                if first is None:
                    first = next((r.name for r in cascade if r.rejects(m)), None)
                kept.append(first is None)
                by.append(first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(x, pa.int64()) for x in measured),
                    pa.array(failed, pa.bool_()),
                    pa.array(kept, pa.bool_()),
                    pa.array(by, pa.string()),
                ],
                ["doc_id", *report, "base_failed", "kept", "rejected_by"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    named = "".join(f"{x} long, " for x in report)
    return rows.mapInArrow(judge, f"doc_id {kind}, {named}base_failed boolean, kept boolean, rejected_by string")
