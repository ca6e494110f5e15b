"""Near duplicates by a set similarity join on word n-grams.

Two documents link when the Jaccard similarity of their sets of word n-grams
reaches a threshold. The join is exact. Every document's n-grams are ordered
rare first, by corpus counts taken over all documents; two linked documents
then share one of the first ``n - ceil(t n) + 1`` of them (the prefix), so only
prefixes are joined. A pair met there has to pass, in this order:

* length filter: the smaller set has at least t times the larger's size;
* positional filter: what can still follow the shared n-gram is enough.
  Postings that no other set's size and place let pass go out beforehand;
* suffix filter: at the first n-gram that a pair shares, all n-grams before it
  differ, which leaves the rest of the allowed difference for the two suffixes
  behind it. The suffixes' hashed parities may differ in no more places than
  that, a lower bound of their distance (256 bits, more for larger sets);

and is then verified once, on the full sets.

Nothing works on a whole group of look-alikes at once. Equal sets are one
class before the join. Classes that share a prefix n-gram are first compared
with two pivots (two pairs a posting), again as long as that at least
halves the pairs left: one that has few n-grams of its own, which near copies
with more edits link with although they don't link with each other, and one at
random. Only where an n-gram still joins several components are the remaining
pairs across them formed, which keeps large groups of near copies from being
paired out and loses no link between components.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adsentry.llm.common import columns_of, fresh_name, ship_code, staged, take_worker, tie_order
from adsentry.llm.components import components

WORDS = 5
THRESHOLD = (80, 100)  # as a fraction, so that all bounds are integers
SKETCH_BITS = 18  # corpus counts are kept for 2**18 hash ranges of n-grams
SKETCH_CHUNKS = 16
CHUNK_WORDS = 200_000  # words that are Python objects at a time
MAX_BITMAP_BITS = 1 << 28
STAR_ROUNDS = 4
MAX_PARITY_BITS = 2048  # of a set of 4,096 n-grams and more
LOOK_BACK = 4  # earlier n-grams of a posting that are compared to meet a pair once
PAIRS_PER_POSTING = 32  # with fewer pairs across components, no further star round is tried

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.uint64(0xD1B54A32D192ED03)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    """Per text the 64-bit hashes of its word n-grams, in order, repeats included.

    Words are runs without ASCII white space, A-Z lowered. A text with fewer
    words has its whole sequence as one; a text without words has none.
    """
    at = 0
    while at < len(texts):
        words, held = [], 0
        while at < len(texts) and held < CHUNK_WORDS:
            words.append((texts[at] or "").encode("utf-8", "surrogatepass").lower().split())
            held += len(words[-1])
            at += 1
        flat = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, held)
        grams = flat[: max(0, held - n + 1)].copy()
        for k in range(1, n):
            grams *= _STEP
            grams += flat[k : k + len(grams)]
        grams = _scramble(grams)
        start = 0
        for w in words:
            if len(w) >= n:
                yield grams[start : start + len(w) - n + 1]
            elif w:
                whole = np.array([len(w)], np.uint64) * _SHORT
                for k in range(start, start + len(w)):
                    whole = whole * _STEP + flat[k : k + 1]
                yield _scramble(whole)
            else:
                yield flat[:0]
            start += len(w)


def _texts(it: Iterator[pa.RecordBatch], column: int, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in it:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).to_pylist()


def corpus_counts(texts: DataFrame, n: int) -> np.ndarray:
    """N-gram occurrences over all documents in ``2**SKETCH_BITS`` hash ranges.

    Of fixed size whatever the corpus. Tasks count on their own; their counts
    are added up in two levels of groups.
    """
    width = 1 << SKETCH_BITS
    spark = texts.sparkSession
    tasks = max(64, 4 * spark.sparkContext.defaultParallelism)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("ngram")
        total = np.zeros(width, np.int64)
        for _, some in _texts(it, 0):
            for grams in _joined(ngram_hashes(some, n)):
                total += np.bincount((grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=width)
        if total.any():
            # a task's counts travel as 32 bits; only the order of n-grams hangs on them
            some = np.minimum(total, 2**32 - 1).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SKETCH_CHUNKS), pa.int32()), pa.array([c.tobytes() for c in np.split(some, SKETCH_CHUNKS)], pa.binary())],
                ["chunk", "counts"],
            )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width // SKETCH_CHUNKS, np.int64)
        for raw in pdf["counts"]:
            total += np.frombuffer(raw, np.uint32 if len(raw) == 4 * len(total) else np.int64)
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1].to_numpy(), "counts": [total.tobytes()]})

    kind = "chunk int, counts binary"
    parts = texts.coalesce(tasks).mapInArrow(count, kind)
    level = parts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("chunk", "part").applyInPandas(add, kind)
    total = np.zeros(width, np.int64)
    for row in level.groupBy("chunk").applyInPandas(add, kind).collect():
        size = width // SKETCH_CHUNKS
        total[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["counts"], np.int64)
    return total


def _joined(grams: Iterator[np.ndarray], at_least: int = 100_000) -> Iterator[np.ndarray]:
    held, size = [], 0
    for g in grams:
        held.append(g)
        size += len(g)
        if size >= at_least:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def _class_key(grams: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(grams.tobytes())
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def parity(grams: np.ndarray, bits: int) -> np.ndarray:
    """Of each of ``bits`` ranges of hashes, a power of two, whether it holds an odd number of n-grams."""
    return (np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)


def parity_bits(n: int) -> int:
    bits = 256
    while 2 * bits < n and bits < MAX_PARITY_BITS:
        bits *= 2
    return bits


def _folded(odd: np.ndarray, bits: int) -> np.ndarray:
    """The parity in fewer bits."""
    return np.bitwise_xor.reduce(odd.reshape(-1, bits), axis=0)


def _longs(odd: np.ndarray) -> np.ndarray:
    return np.packbits(odd).view(np.int64)


def signatures(rows: DataFrame, n: int, threshold: tuple[int, int], counts: np.ndarray) -> DataFrame:
    """``doc_id, th, n, c1, c2, p0 .. p3, wide, grams`` of ``_id, _text, _th``: set size, set digest, parity in 256
    and in more bits, prefix."""
    num, den = threshold
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("ngram")
        rarity = shared.value
        for part, texts in _texts(it, 1):
            sizes, keys, parities, wide, prefixes = [], [], [], [], []
            for grams in ngram_hashes(texts, n):
                g = np.unique(grams)
                sizes.append(len(g))
                keys.append(_class_key(g))
                odd = parity(g, parity_bits(len(g)))
                parities.append(_longs(_folded(odd, 256)))
                wide.append(np.packbits(odd).tobytes())
                # stable over sorted hashes: by count, then by hash
                order = np.argsort(rarity[(g >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                prefixes.append(g[order[: len(g) - -(-num * len(g) // den) + 1]].view(np.int64) if len(g) else g.view(np.int64))
            p = np.array(parities, np.int64).reshape(len(texts), 4)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    *(pa.array(p[:, i], pa.int64()) for i in range(4)),
                    pa.array(wide, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                ["doc_id", "th", "n", "c1", "c2", "p0", "p1", "p2", "p3", "wide", "grams"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"doc_id {kind}, th long, n long, c1 long, c2 long, p0 long, p1 long, p2 long, p3 long, wide binary, grams array<long>"
    return rows.mapInArrow(sign, schema)


def _needed(na: Column, nb: Column, threshold: tuple[int, int]) -> Column:
    """Smallest overlap of two sets that reaches the threshold."""
    num, den = threshold
    return F.floor((F.lit(num) * (na + nb) + (num + den - 1)) / F.lit(num + den)).cast("long")


def _may_link(na: Column, pa_: Column, nb: Column, pb: Column, threshold: tuple[int, int]) -> Column:
    """Length and positional filter for a shared n-gram at places ``pa_`` and ``pb``."""
    num, den = threshold
    length = F.least(na, nb) * den >= F.greatest(na, nb) * num
    return length & (F.least(na - pa_, nb - pb) >= _needed(na, nb, threshold))


def _suffix(a: str, b: str, na: Column, nb: Column, threshold: tuple[int, int], before: Column | None = None) -> Column:
    """The parities differ in no more places than the sets may, less the n-grams ``before`` that differ already."""
    differ = sum((F.bit_count(F.col(f"{a}p{i}").bitwiseXOR(F.col(f"{b}p{i}"))) for i in range(4)), F.lit(0))
    return differ <= na + nb - 2 * _needed(na, nb, threshold) - (F.lit(0) if before is None else before)


def _wide_suffix(na: Column, nb: Column, threshold: tuple[int, int], before: Column) -> Column:
    """The same in the bits of the smaller set's parity, where that has more than 256."""
    size = F.least(F.size("xwide"), F.size("ywide"))

    def fold(name: str) -> Column:
        half = F.zip_with(F.slice(name, F.lit(1), size), F.slice(name, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(name) > size, half).otherwise(F.col(name))

    places = F.zip_with(fold("xwide"), fold("ywide"), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differ = F.aggregate(places, F.lit(0), lambda total, one: total + one)
    return (size <= 4) | (F.abs(F.size("xwide") - F.size("ywide")) > size) | (
        differ <= na + nb - 2 * _needed(na, nb, threshold) - before
    )


def _postings(grams: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The rows of ``gram, pos, n, rid`` whose n-gram other sets have too, with ``usable``: one of these may link.

    The smaller of two linked sets has their first shared n-gram among the
    places that suffice for its own size (the positional filter against a set
    as small as itself; equal sizes: both have). So a posting meets either a
    smaller set with such a place or, if its own place is one, a larger set,
    the nearest of each being within the length filter.
    """
    num, den = threshold
    n, by_size = F.col("n"), Window.partitionBy("gram").orderBy("n")
    early = F.col("pos") <= n - _needed(n, n, threshold)
    below = F.max(F.when(early, n)).over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    above, before = F.lead("n").over(by_size), F.lag("n").over(by_size)
    usable = (below * den >= n * num) | (early & (above * num <= n * den))
    marked = grams.withColumns({"usable": F.coalesce(usable, F.lit(False)), "_shared": above.isNotNull() | before.isNotNull()})
    return marked.where("_shared").drop("_shared")


def _with_suffixes(live: DataFrame, sig: DataFrame) -> DataFrame:
    """``gram, rid, n, pos, lab, prev, p0 .. p3, wide``: postings with the parity of what stands behind their place,
    and the few of their document's postings before them. ``wide`` is empty where 256 bits are all there are; of
    n-grams before a place only the bits that name their parity's place move."""

    def expand(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("ngram")
        for batch in it:
            for at in range(0, batch.num_rows, 64):
                out: list[tuple] = []
                for row in batch.slice(at, 64).to_pylist():
                    odd = np.unpackbits(np.frombuffer(row["wide"], np.uint8))
                    bits, low = len(odd), np.array(row["low"], np.uint64)
                    at_place = {p["pos"]: p["gram"] for p in row["at"]}
                    places = sorted(at_place)
                    names, done = [at_place[pos] for pos in places], 0
                    for i, pos in enumerate(places):
                        odd = odd ^ parity(low[done : pos + 1], bits)
                        done = pos + 1
                        near, wide = _longs(_folded(odd, 256)).tolist(), _longs(odd).tolist() if bits > 256 else []
                        out.append((names[i], row["rid"], row["n"], pos, row["lab"], names[max(0, i - LOOK_BACK) : i], *near, wide))
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] + [pa.int64()] * 4 + [pa.list_(pa.int64())]
                names = ["gram", "rid", "n", "pos", "lab", "prev", "p0", "p1", "p2", "p3", "wide"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "gram long, rid long, n long, pos long, lab long, prev array<long>, p0 long, p1 long, p2 long, p3 long, wide array<long>"
    by_row = live.groupBy("rid").agg(F.collect_list(F.struct("pos", "gram")).alias("at"), F.first("lab").alias("lab"))
    low = F.transform("grams", lambda g: g.bitwiseAND(F.lit(MAX_PARITY_BITS - 1)).cast("short"))
    return by_row.join(sig.select("rid", "n", "wide", low.alias("low")), "rid").mapInArrow(expand, schema)


def _parities(sig: DataFrame, prefix: str, key: str) -> DataFrame:
    return sig.select(F.col("rid").alias(key), *[F.col(f"p{i}").alias(f"{prefix}p{i}") for i in range(4)])


def _id_bitmap(ids: DataFrame) -> tuple[np.ndarray, int]:
    """Packed bitmap of two hashes of each identifier ``id``, and its bits.

    About 64 bits an identifier, ``MAX_BITMAP_BITS`` at most: a fuller bitmap
    only lets more texts through, none is lost.
    """
    n = ids.count()
    bits = 1 << 16
    while bits < min(64 * n, MAX_BITMAP_BITS):
        bits *= 2

    def mark(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits // 8, np.uint8)
        for batch in it:
            for column in batch.columns:
                at = column.to_numpy(zero_copy_only=False)
                np.bitwise_or.at(seen, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        if seen.any():
            yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()], pa.binary())], ["bits"])

    marks = ids.select(*_slots("id", bits)).coalesce(16).mapInArrow(mark, "bits binary").collect()  # 16 rows
    total = np.zeros(bits // 8, np.uint8)
    for row in marks:
        total |= np.frombuffer(row["bits"], np.uint8)
    return total, bits


def _slots(column: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(column, F.lit(k)), F.lit(bits)).cast("long").alias(f"s{k}") for k in (1, 2)]


def _verify(pairs: DataFrame, sig: DataFrame, rows: DataFrame, n: int, threshold: tuple[int, int]) -> DataFrame:
    """The linked pairs ``a, b`` of candidate pairs ``a, b, na, nb``.

    The texts of the documents that occur in a pair (a bitmap of their
    identifiers picks them) move packed to their pairs, found by their set's
    digest; both sets are built there again and compared in full. Packed text
    takes about a third of the room of its set of hashes.
    """
    ends = pairs.select(F.col("a").alias("rid")).union(pairs.select(F.col("b").alias("rid"))).distinct()
    wanted = staged(sig.join(ends, "rid", "left_semi").select("rid", F.col("doc_id").alias("id"), "c1", "c2"), "ngram-wanted")
    packed, bits = _id_bitmap(wanted.select("id"))
    shared = rows.sparkSession.sparkContext.broadcast(packed)

    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("ngram")
        chosen = shared.value
        for batch in it:
            mine = np.ones(batch.num_rows, np.uint8)
            for column in batch.columns[1:]:
                at = column.to_numpy(zero_copy_only=False)
                mine &= chosen[at >> 3] >> (at & 7).astype(np.uint8)
            mine = pa.array((mine & 1).astype(bool))
            for _, texts in _texts(iter([batch.filter(mine)]), 0, 128):
                keys = [_class_key(np.unique(g)) for g in ngram_hashes(texts, n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.array([_pack(t) for t in texts], pa.binary()),
                    ],
                    ["c1", "c2", "t"],
                )

    num, den = threshold

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("ngram")
        last = {}  # sets of the slice before: neighbours share a text
        for batch in it:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                a, b, ta, tb = (part.column(i).to_pylist() for i in range(4))
                new = [t for t in dict.fromkeys(ta + tb) if t not in last]
                sets = dict(zip(new, map(np.unique, ngram_hashes([_unpack(t) for t in new], n)), strict=True))
                sets |= {t: last[t] for t in {*ta, *tb} if t in last}
                linked = []
                for x, y in zip(ta, tb, strict=True):
                    shared_grams = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    linked.append(den * shared_grams >= num * (len(sets[x]) + len(sets[y]) - shared_grams))
                last = sets
                hits = pa.array(linked, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(hits), part.column(1).filter(hits)], ["a", "b"])

    texts = rows.select("_text", *_slots("_id", bits)).mapInArrow(build, "c1 long, c2 long, t binary")
    digest = lambda p: wanted.select(F.col("rid").alias(p), F.col("c1").alias(f"{p}1"), F.col("c2").alias(f"{p}2"))
    side = lambda p: texts.select(F.col("c1").alias(f"{p}1"), F.col("c2").alias(f"{p}2"), F.col("t").alias(f"t{p}"))
    return (
        pairs.join(digest("a"), "a")
        .join(digest("b"), "b")
        .join(side("a"), ["a1", "a2"])
        .join(side("b"), ["b1", "b2"])
        .select("a", "b", "ta", "tb")
        .mapInArrow(compare, "a long, b long")
        .distinct()
    )


def _pack(text: str | None) -> bytes:
    return zlib.compress((text or "").encode("utf-8", "surrogatepass"), 1)


def _unpack(raw: bytes) -> str:
    return zlib.decompress(raw).decode("utf-8", "surrogatepass")


def _ordered(df: DataFrame, x: str, nx: str, y: str, ny: str) -> DataFrame:
    """Each unordered pair once: ``a < b`` with their sizes."""
    first = F.col(x) < F.col(y)
    return (
        df.select(
            F.least(x, y).alias("a"),
            F.greatest(x, y).alias("b"),
            F.when(first, F.col(nx)).otherwise(F.col(ny)).alias("na"),
            F.when(first, F.col(ny)).otherwise(F.col(nx)).alias("nb"),
        )
        .groupBy("a", "b")
        .agg(F.first("na").alias("na"), F.first("nb").alias("nb"))
    )


def _linked_classes(sig: DataFrame, classes: DataFrame, rows: DataFrame, n: int, threshold: tuple[int, int]) -> DataFrame:
    """``node, label``: the component of every class that is not the smallest of its own."""
    heads = classes.select(F.col("rep").alias("rid"))
    mine = sig.select("rid", "n", "grams").join(heads, "rid", "left_semi")
    # in this order of columns a posting is smallest on its way
    grams = mine.select("rid", "n", F.posexplode("grams").alias("pos", "gram")).select("gram", "pos", "n", "rid")
    postings = staged(_postings(grams, threshold), "ngram-postings")
    # by powers of two, how many n-grams of its prefix a class has to itself: the fewer, the more of its like it links with
    held = postings.groupBy("rid").agg(F.count(F.lit(1)).alias("held"))
    sizes = sig.select("rid", F.size("grams").alias("prefix"))
    alone = sizes.join(held, "rid").select("rid", F.floor(F.log2(1 + F.col("prefix") - F.col("held"))).cast("int").alias("own"))
    alone = staged(alone, "ngram-own")
    postings = postings.where("usable").drop("usable")
    size = postings.count()

    tested, labels, before = None, None, 0
    for turn in range(STAR_ROUNDS + 1):
        live = postings.withColumn("lab", F.col("rid")) if labels is None else (
            postings.join(labels, F.col("rid") == F.col("node"), "left").withColumn("lab", F.coalesce("label", "rid")).drop("node", "label")
        )
        per = live.groupBy("gram", "lab").agg(F.count(F.lit(1)).alias("k"))
        open_grams = per.groupBy("gram").agg(
            (F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))).alias("cross"), F.count(F.lit(1)).alias("labs")
        ).where("labs > 1")
        open_grams = staged(open_grams.select("gram", "cross"), "ngram-open")
        cross = (open_grams.agg(F.sum("cross")).first()[0] or 0) / 2
        if not cross:
            break
        live = live.join(open_grams.select("gram"), "gram")
        last = turn == STAR_ROUNDS or (turn > 0 and (cross <= PAIRS_PER_POSTING * size or 2 * cross > before))
        before = cross
        if last:
            # Every pair across components that shares a prefix n-gram, met at
            # the first of them: later ones are passed over where one of the
            # few n-grams before is shared too.
            live = _with_suffixes(live, sig)
            named = lambda p: live.select(*[F.col(c).alias(f"{p}{c}") for c in live.columns])
            x, y = named("x"), named("y")
            sizes, before = (F.col("xn"), F.col("yn")), F.col("xpos") + F.col("ypos")
            met = x.join(
                y,
                (F.col("xgram") == F.col("ygram"))
                & (F.col("xrid") < F.col("yrid"))
                & (F.col("xlab") != F.col("ylab"))
                & _may_link(F.col("xn"), F.col("xpos"), F.col("yn"), F.col("ypos"), threshold)
                & _suffix("x", "y", *sizes, threshold, before)
                & ~F.arrays_overlap("xprev", "yprev")
                & _wide_suffix(*sizes, threshold, before),
            )
            pairs = _ordered(met, "xrid", "xn", "yrid", "yn")
        else:
            live = live.join(alone, "rid").withColumn("key", F.xxhash64("rid", F.lit(turn)))
            who = F.struct("rid", "n", "pos", "lab")
            pivots = live.groupBy("gram").agg(
                F.min_by(who, F.struct("own", "key")).alias("v1"), F.max_by(who, "key").alias("v2")
            )
            met = live.join(pivots.select("gram", F.explode(F.array_distinct(F.array("v1", "v2"))).alias("v")), "gram").where(
                (F.col("rid") != F.col("v.rid"))
                & (F.col("lab") != F.col("v.lab"))
                & _may_link(F.col("n"), F.col("pos"), F.col("v.n"), F.col("v.pos"), threshold)
            )
            met = met.select("rid", "n", F.col("v.rid").alias("vrid"), F.col("v.n").alias("vn"))
            pairs = (
                _ordered(met, "rid", "n", "vrid", "vn")
                .join(_parities(sig, "x", "a"), "a")
                .join(_parities(sig, "y", "b"), "b")
                .where(_suffix("x", "y", F.col("na"), F.col("nb"), threshold))
                .select("a", "b", "na", "nb")
            )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "ngram-pairs")
        found = staged(_verify(pairs, sig, rows, n, threshold), "ngram-links")
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        # what is known of the components stands in for the links it came from
        labels = components(found if labels is None else found.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
        if last:
            break
    if labels is None:
        return sig.sparkSession.createDataFrame([], "node long, label long")
    return labels


def ngram_join(
    docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest identifier reachable by links, the
    document's own included. Texts without a word (null, empty, white space)
    have an empty set and link with nothing; texts with fewer than ``words``
    words have their whole sequence as only n-gram. Rows that repeat text or
    identifier are rows of their own with the same component. Null identifiers
    are passed over for ``component_id`` where the component has others. An
    empty table gives none.
    """
    return _joined_rows(docs, words, threshold, id_col, text_col, hashed=False).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )


def _joined_rows(
    docs: DataFrame, words: int, threshold: tuple[int, int], id_col: str, text_col: str, hashed: bool = True
) -> DataFrame:
    """``doc_id, th, rid, n, component_id, comp`` per row; ``th`` is the text's hash, if asked for."""
    num, den = threshold
    if not 0 < num <= den or words < 1:
        raise ValueError("the threshold must lie in (0, 1] and an n-gram needs a word")
    ship_code(docs.sparkSession)
    rows = columns_of(docs, _id=id_col, _text=text_col).withColumn(
        "_th", F.xxhash64("_text") if hashed else F.lit(0).cast("long")
    )
    counts = corpus_counts(rows.select("_text"), words)
    sig = staged(
        signatures(rows.select("_id", "_text", "_th"), words, threshold, counts).withColumn("rid", F.monotonically_increasing_id()),
        "ngram-signatures",
    )
    classes = staged(
        sig.where("n > 0").groupBy("c1", "c2", "n").agg(F.min("rid").alias("rep"), F.min("doc_id").alias("least_doc")), "ngram-classes"
    )
    labels = _linked_classes(sig, classes, rows, words, threshold)
    placed = classes.join(labels, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("label", "rep"))
    least = placed.groupBy("comp").agg(F.min("least_doc").alias("component"))
    named = placed.join(least, "comp").select("c1", "c2", F.col("n").alias("m"), "comp", "component")
    return (
        sig.select("doc_id", "th", "rid", "n", F.col("c1").alias("k1"), F.col("c2").alias("k2"))
        .join(named, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n") == F.col("m")), "left")
        .select(
            "doc_id", "th", "rid", "n",
            F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(F.col("n") > 0, F.col("comp")).alias("comp"),
        )
    )


def drop_near_copies(
    docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged: of each component
    the one with the smallest identifier (nulls last; ties by text hash, then
    by the remaining columns, maps by their JSON). Texts without a word all stay."""
    rows = _joined_rows(docs, words, threshold, id_col, text_col)
    first = rows.where("comp is not null").groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("f")
    )
    kid, kth = fresh_name(docs, "_nd_kept_id"), fresh_name(docs, "_nd_kept_th")
    keep = first.select(F.col("f.doc_id").alias(kid), F.col("f.th").alias(kth))
    empty = ~F.coalesce(F.col(f"`{text_col}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    id_k, th_k, nth = (fresh_name(docs, f"_nd_{x}") for x in ("id", "th", "nth"))
    out = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.where(~empty).withColumns({id_k: F.col(f"`{id_col}`"), th_k: F.xxhash64(F.col(f"`{text_col}`"))})
    kept = marked.join(keep, F.col(id_k).eqNullSafe(F.col(kid)) & (F.col(th_k) == F.col(kth)), "left_semi")
    order = Window.partitionBy(th_k, id_k).orderBy(*tie_order(docs, (id_col, text_col)))
    return kept.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*out).union(docs.where(empty).select(*out))
