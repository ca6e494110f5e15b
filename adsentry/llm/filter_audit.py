"""Audit of how filters interact, over every order they could run in.

A document fails a set of the filters, its mask. What happens to it at each
step of each order hangs on the mask alone (and on its two labels), so every
(mask, labels) class is mapped to one big integer whose fields of
``FIELD_BYTES`` bytes hold all outcomes of all steps: with five filters 120
orders of 5 steps, 6 counters each. The integers of a part's documents are
summed, equal ones as one product with their number, which Spark counts
beforehand. A field never exceeds the number of documents, a BIGINT, so no
field carries into the next, and one pass unpacks the sum into the counters of
all steps.

The filters look at one text each, but for the last: a text is a repeat if a
row of a smaller identifier holds the same text, wherever that row ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of, ship_code, staged

FIELD_BYTES = 8
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
BLOCK = 1 << 20  # bytes of a text whose words are Python objects at a time

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that start no code point
_MARKS = b"#$%&*|"


class TextFacts(NamedTuple):
    """What the filters on single texts look at."""

    words: int
    distinct_words: int
    upper: int
    chars: int
    marks: int


Rule = Callable[[TextFacts], bool]

# Failure conditions of the audited filters, in the order of their mask bits;
# the repeat filter, which looks at the whole table, comes last.
RULES: tuple[tuple[str, Rule], ...] = (
    ("A", lambda f: f.words < 50),
    ("B", lambda f: 100 * f.distinct_words < 65 * f.words),
    ("C", lambda f: 100 * f.upper > 5 * f.chars),
    ("D", lambda f: f.marks > 0),
)
REPEAT = "E"


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    at = 0
    while len(text) - at > BLOCK:
        end = at + BLOCK
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def text_facts(text: bytes) -> TextFacts:
    words, seen = 0, set()
    for block in _word_blocks(text):
        words += len(block)
        seen.update(block)
    size = len(text)
    return TextFacts(
        words,
        len(seen),
        size - len(text.translate(None, _UPPER)),
        len(text.translate(None, _CONTINUED)),
        size - len(text.translate(None, _MARKS)),
    )


def step_outcomes(mask: int, good: bool, toxic: bool, n_filters: int) -> list[int]:
    """0 or 1 per order, step and outcome for one document of this class."""
    fields = []
    for order in permutations(range(n_filters)):
        here = True
        for f in order:
            fails = bool(mask >> f & 1)
            removed = here and fails
            fields += [here and not fails, removed, fails and not here, mask == 1 << f, removed and good, removed and toxic]
            here = here and not fails
    return [int(x) for x in fields]


@cache
def packed_outcomes(mask: int, good: bool, toxic: bool, n_filters: int) -> int:
    """``step_outcomes`` as one integer, the first field lowest."""
    raw = np.array(step_outcomes(mask, good, toxic, n_filters), f"<u{FIELD_BYTES}")
    return int.from_bytes(raw.tobytes(), "little")


def unpacked(total: int, n_fields: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(n_fields * FIELD_BYTES, "little"), f"<u{FIELD_BYTES}").astype(np.int64)


def document_masks(docs: DataFrame, rules: Sequence[tuple[str, Rule]], id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``_id, part, mask`` per row, the repeat filter's bit the last.

    The narrow rows (identifier, part, mask, digest of the text) are staged
    once. Repeats are found without gathering a text's copies: the smallest
    identifier per digest is a map-side combined aggregate, and rows meet it
    by (digest, identifier), which spreads a large group over all tasks.
    """
    tests = [rule for _, rule in rules]

    def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                masks, digests = [], []
                for text in some.column(1).cast(pa.binary()).to_pylist():
                    text = text or b""
                    facts = text_facts(text)
                    masks.append(sum(bool(t(facts)) << i for i, t in enumerate(tests)))
                    digests.append(hashlib.blake2b(text, digest_size=16).digest())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                    ["_id", "part", "mask", "digest"],
                )

    rows = columns_of(docs, _id=id_col, _text=text_col, _part=part_col).select(
        "_id", "_text", F.coalesce(F.col("_part").cast("string"), F.lit("")).alias("part")
    )
    kind = rows.schema["_id"].dataType.simpleString()
    judged = staged(rows.mapInArrow(judge, f"_id {kind}, part string, mask int, digest binary"), "audit-rows")
    first = judged.groupBy(F.col("digest").alias("same")).agg(F.min("_id").alias("first")).where("first is not null")
    repeat = F.col("_id").isNotNull() & F.col("first").isNull()
    return judged.join(first, (F.col("digest") == F.col("same")) & (F.col("_id") == F.col("first")), "left").select(
        "_id", "part", (F.col("mask") + F.when(repeat, 1 << len(tests)).otherwise(0)).alias("mask")
    )


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, Rule]] = RULES,
    repeat: str = REPEAT,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step: ``part, filter_order,
    step`` and the counts of documents ``kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    Null parts are the part of the empty string; a null text is the empty
    text. A row of null identifier repeats none and has no labels. Rows that
    share an identifier are rows of their own and don't repeat each other. An
    identifier with several labels counts as good (toxic) if any of them says
    so; null labels say nothing. An empty table gives no rows. Columns beyond
    the named ones are ignored, whatever their names.
    """
    ship_code(docs.sparkSession)
    names = [name for name, _ in rules] + [repeat]
    n = len(names)
    orders = ["".join(o) for o in permutations(names)]
    steps = [(order, i + 1, order[i]) for order in orders for i in range(n)]
    width = len(steps) * len(OUTCOMES)

    def unpack(classes: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for mask, good, toxic, count in zip(classes["mask"], classes["good"], classes["toxic"], classes["n"], strict=True):
            total += int(count) * packed_outcomes(int(mask), bool(good), bool(toxic), n)
        fields = unpacked(total, width).reshape(len(steps), len(OUTCOMES))
        out = pd.DataFrame(fields, columns=list(OUTCOMES))
        out.insert(0, "part", classes["part"].iloc[0])
        out.insert(1, "filter_order", [s[0] for s in steps])
        out.insert(2, "step", np.array([s[1] for s in steps], np.int32))
        out["shapley"] = out["removed"].groupby([s[2] for s in steps]).transform("sum")
        return out

    marks = columns_of(labels, lab_id="doc_id", quality="quality", toxic="toxic").groupBy("lab_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    flag = lambda c: (F.coalesce(F.col(c), F.lit(0)) == 1).alias(c)
    classes = (
        document_masks(docs, rules, id_col, text_col, part_col)
        .join(marks, F.col("_id") == F.col("lab_id"), "left")
        .select("part", "mask", flag("good"), flag("toxic"))
        .groupBy("part", "mask", "good", "toxic")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))
    return classes.groupBy("part").applyInPandas(unpack, f"part string, filter_order string, step int, {counts}")
