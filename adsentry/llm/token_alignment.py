"""Alignment of two tokenizers' tokens, with corpus-wide pair counts by external spill counting.

A text's two token rows cover the same bytes; where tokens of both end, they
are cut into groups, and a group links each of its A tokens with each of its B
tokens. A pair of identifiers counts once per document that holds it linked.

1. Spill. Tasks work on chunks of ``CHUNK_BYTES`` of text. A chunk's distinct
   (pair, document) records are sorted side-major (A identifier, then B
   identifier, then document) and radix-partitioned by the A identifier into
   ``BUCKETS`` zstd-compressed runs: a head (pairs and their number of
   documents) and a body (documents and their number of links).
2. Merge. Heads are merged per bucket, ``FAN_IN`` runs at a time, by a k-way
   heap merge; equal pairs add up. Only heads travel here, so a pair that every
   document holds is one entry a run. In side-major order an A identifier's
   pairs are neighbours: the last round yields its highest count as it passes.
3. Back. Bodies stream past their bucket's merged counts and give every
   document its sums. The bodies of a bucket are dealt over salts of about
   ``RUNS_PER_SALT`` runs, each of which gets the counts once, so a bucket of
   frequent identifiers is no single task. A bucket's counts are bounded by the
   two vocabularies, whatever the corpus.

Tokens never cross white space between two words: a text is cut there into
units, whose tokens and groups are worked out once and kept. The cuts are those
where both tokenizers provably end a token (checked against the vocabulary of
B); texts with other white space are cut less, in the end not at all.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of, empty_frame, release, ship_code, staged

BUCKET_BITS = 6
BUCKETS = 1 << BUCKET_BITS
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 1 << 16
FAN_IN = 64
RUNS_PER_SALT = 256
BLOCK = 1 << 15  # entries of a run that a merge looks at together
UNIT_BYTES_HELD = 64 << 20
LARGE_GROUP = 4096  # links of a group from which its pairs are formed by distinct identifiers

COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
DOCS_BUCKET = -1  # the row of a chunk that holds its documents

_OTHER_CUTS = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _loaded(raw: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays of ``_packed``, all of one length."""
    data = zstandard.ZstdDecompressor().decompress(raw)
    size, at, out = len(data) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.frombuffer(data, k, size, at))
        at += out[-1].nbytes
    return out


def byte_level_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes in
    ascending order for the characters from U+0100 on.
    """
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ..`` with ``counts[i]`` places each, one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of neighbouring runs of ``counts[i]`` rows."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Aligner:
    """Both tokenizers, their token bytes and the units seen so far."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        table = byte_level_bytes()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            plain = all(c in table for c in piece)
            self.bytes_a[i] = bytes(table[c] for c in piece) if plain else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # a token of B that went on over a space or a line end would forbid the cuts there
        self.cuts = not any(
            re.search("[^▁]▁", p) or ("\n" in p and len(p) > 1) for i, p in enumerate(pieces) if not self.b.is_byte(i)
        )
        self.shift = max(1, (len(self.bytes_b) - 1).bit_length())
        self.bits_a = max(BUCKET_BITS, (len(self.bytes_a) - 1).bit_length())
        if self.bits_a + self.shift + (CHUNK_DOCS - 1).bit_length() > 63:
            raise ValueError("the vocabularies are too large for one sort key")
        # a token's identifier as text, with what may follow it
        size = max(len(self.bytes_a), len(self.bytes_b))
        self.shown = [f"{t}{mark}".encode() for mark in (",", "|", ";", "") for t in range(size)]
        self.lengths_a, self.lengths_b, self.shown_lengths = (
            np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b, self.shown)
        )
        self.forget()

    def forget(self) -> None:
        """Drop all units. Of each are known: its tokens, groups and links by
        number (``stats``), whether both tokenizers give back its bytes
        (``same``), its groups as text and its pairs with their links."""
        self.index: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.stats, self.same = np.zeros((0, 4), np.int64), np.zeros(0, bool)
        self.pair_start, self.pair_count = np.zeros((2, 0), np.int64)
        self.pairs, self.times = np.zeros((2, 0), np.int64)

    def cut(self, text: str) -> list[str]:
        """Pieces of a space and the text, joined again the whole of it."""
        whole = " " + text
        if not self.cuts:
            return [whole]
        if "\0" not in text and text.replace("\n", " ").split(" ") == text.split():
            return whole.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")[1:]
        return _OTHER_CUTS.split(whole)

    def _ids_b(self, texts: list[str]) -> list[list[int]]:
        """Pieces of B; B itself adds the space before a text, so where there is
        none a line end takes it and both are dropped."""
        out = self.b.encode([t[1:] if t.startswith(" ") else "\n" + t for t in texts], num_threads=1)
        return [ids if t.startswith(" ") else ids[2:] for t, ids in zip(texts, out, strict=True)]

    def learn(self, texts: list[str]) -> None:
        """Work out the units among ``texts`` that are new."""
        new = [t for t in dict.fromkeys(texts) if t not in self.index]
        if not new:
            return
        self.index.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
        a, b = [], []
        for at in range(0, len(new), 4096):  # an encoding is much larger than its identifiers
            some = new[at : at + 4096]
            a += [e.ids for e in self.a.encode_batch(some, add_special_tokens=False)]
            b += self._ids_b(some)
        same = np.array([
            b"".join(map(self.bytes_a.__getitem__, x)) == (raw := t.encode()) and b"".join(map(self.bytes_b.__getitem__, y)) == raw
            for t, x, y in zip(new, a, b, strict=True)
        ])
        # a unit of other bytes keeps no tokens
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(new)) * same for ids in (a, b))
        a, b = (
            np.fromiter(chain.from_iterable(x for x, ok in zip(ids, same, strict=True) if ok), np.int64, int(n.sum()))
            for ids, n in ((a, n_a), (b, n_b))
        )
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        cuts = np.intersect1d(ends_a, ends_b)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        unit = np.repeat(np.arange(len(new)), n_a)[first_a] if len(cuts) else np.zeros(0, np.int64)

        # text of the groups: tokens by group, A first, each with its mark
        side = np.r_[2 * group_a, 2 * group_b + 1]
        order = np.argsort(side, kind="stable")
        side, last = side[order], np.r_[np.cumsum(n_a + n_b)[n_a > 0] - 1].astype(np.int64)
        mark = np.where(np.diff(side, append=-2) == 0, 0, np.where(side & 1 == 0, 1, 2))
        mark[last] = 3
        code = np.r_[a, b][order] + mark * (len(self.shown) // 4)
        text = b"".join(map(self.shown.__getitem__, code.tolist()))
        ends = np.r_[0, np.cumsum(self.shown_lengths[code])][np.cumsum(n_a + n_b)].tolist()
        self.groups += [text[x:y] for x, y in zip([0, *ends], ends, strict=False)]

        # pairs: every A token with all B tokens of its group; large groups by their distinct identifiers
        large = in_a * in_b > LARGE_GROUP
        fit = ~large[group_a]
        n = in_b[group_a] * fit
        pairs = np.repeat(a, n) << self.shift | b[_ragged(first_b[group_a], n)]
        of, times = np.repeat(unit[group_a], n), np.ones(len(pairs), np.int64)
        for g in np.flatnonzero(large):
            x, nx = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            y, ny = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            pairs = np.r_[pairs, (x[:, None] << self.shift | y).ravel()]
            times = np.r_[times, (nx[:, None] * ny).ravel()]
            of = np.r_[of, np.full(len(x) * len(y), unit[g])]
        if large.any():
            order = np.argsort(of, kind="stable")
            pairs, times, of = pairs[order], times[order], of[order]
        count = np.bincount(of, minlength=len(new))
        n_groups, links = np.bincount(unit, minlength=len(new)), np.zeros(len(new), np.int64)
        np.add.at(links, unit, in_a * in_b)

        self.same = np.r_[self.same, same]
        self.stats = np.r_[self.stats, np.stack([n_a, n_b, n_groups, links], axis=1)]
        self.pair_start = np.r_[self.pair_start, len(self.pairs) + np.cumsum(count) - count]
        self.pair_count = np.r_[self.pair_count, count]
        self.pairs, self.times = np.r_[self.pairs, pairs], np.r_[self.times, times]

    @property
    def held(self) -> int:
        """About the bytes that units take."""
        return 200 * len(self.groups) + 16 * len(self.pairs)

    def places(self, texts: list[str | None]) -> list[list[int]]:
        """Per text the numbers of its units, none if it has no tokens."""
        cuts = [self.cut(t) if t else [] for t in texts]
        self.learn(list(chain.from_iterable(cuts)))
        out = [list(map(self.index.__getitem__, cut)) for cut in cuts]
        if not self.same.all():
            # units that differ could still join to the same bytes: such a text is looked at as a whole
            odd = [i for i, mine in enumerate(out) if not self.same[mine].all()]
            self.learn([" " + texts[i] for i in odd])
            for i in odd:
                whole = self.index[" " + texts[i]]
                out[i] = [whole] if self.same[whole] else []
        return out

    def side_major(self, pairs: np.ndarray) -> np.ndarray:
        """Pairs with the bucket, the low bits of the A identifier, moved to the front."""
        a, b = pairs >> self.shift, pairs & ((1 << self.shift) - 1)
        return ((a & (BUCKETS - 1)) << (self.bits_a - BUCKET_BITS) | a >> BUCKET_BITS) << self.shift | b


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _chunk(al: Aligner, ids: pa.Array, texts: list[str | None], keep_groups: bool = False) -> tuple[bytes, list[tuple[int, bytes, bytes]]]:
    """A chunk's documents as Arrow data, and its runs ``(bucket, head, body)``."""
    places = al.places(texts)
    sizes = np.fromiter(map(len, places), np.int64, len(places))
    flat = np.fromiter(chain.from_iterable(places), np.int64, int(sizes.sum()))
    stats = _sums(al.stats[flat], sizes)
    groups = [b";".join(map(al.groups.__getitem__, mine)) for mine in places]
    sha = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
    names = ["doc_id", *COUNTS[:4], "groups_sha256"]
    docs = pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in stats.T.copy()), pa.array(sha, pa.string())], names)
    if keep_groups:
        docs = docs.append_column("groups", pa.array([g.decode() for g in groups], pa.string()))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(docs)

    entry, times = np.unique(np.repeat(np.arange(len(places)), sizes) << 32 | flat, return_counts=True)
    unit = entry & 0xFFFFFFFF
    n = al.pair_count[unit]
    if not n.sum():
        return sink.getvalue().to_pybytes(), []
    place = _ragged(al.pair_start[unit], n)
    pairs, links = al.side_major(al.pairs[place]), al.times[place] * np.repeat(times, n)
    bits = (CHUNK_DOCS - 1).bit_length()
    key = pairs << bits | np.repeat(entry >> 32, n)
    order = np.argsort(key)
    key, links = key[order], links[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    key, links = key[first], np.add.reduceat(links, first)

    runs, pair = [], key >> bits
    bucket = pair >> (al.shift + al.bits_a - BUCKET_BITS)
    edges = np.searchsorted(bucket, np.arange(BUCKETS + 1))
    for k in range(BUCKETS):
        lo, hi = edges[k], edges[k + 1]
        if lo < hi:
            here = np.flatnonzero(np.r_[True, pair[lo + 1 : hi] != pair[lo : hi - 1]])
            head = _packed(np.diff(pair[lo + here], prepend=0), np.diff(np.r_[here, hi - lo]))
            body = _packed((key[lo:hi] & ((1 << bits) - 1)).astype(np.uint32), links[lo:hi].astype(np.uint32))
            runs.append((k, head, body))
    return sink.getvalue().to_pybytes(), runs


def _spill(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool) -> DataFrame:
    """``run, bucket, head, body`` of all chunks."""

    def spill(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        run = TaskContext.get().partitionId() << 32
        for ids, texts in _chunks(it):
            rows, runs = _chunk(al, ids, texts, keep_groups)
            out = [(DOCS_BUCKET, None, rows), *runs]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([run] * len(out), pa.int64()),
                    pa.array([r[0] for r in out], pa.int32()),
                    pa.array([r[1] for r in out], pa.binary()),
                    pa.array([r[2] for r in out], pa.binary()),
                ],
                ["run", "bucket", "head", "body"],
            )
            run += 1
            if al.held > UNIT_BYTES_HELD:
                al.forget()

    return docs.mapInArrow(spill, "run long, bucket int, head binary, body binary")


def _chunks(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    ids, texts, held = [], [], 0
    for batch in it:
        for at in range(0, batch.num_rows, 64):
            some = batch.slice(at, 64)
            ids.append(some.column(0))
            texts += some.column(1).to_pylist()
            held += some.column(1).nbytes
            if held >= CHUNK_BYTES or len(texts) > CHUNK_DOCS - 64:
                yield pa.concat_arrays(ids), texts
                ids, texts, held = [], [], 0
    if texts:
        yield pa.concat_arrays(ids), texts


def merge_heads(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way heap merge of sorted (pairs, counts), block by block; equal pairs add up.

    The heap holds the last pair of each run's block at hand. Up to the least
    of these every run has its pairs at hand, so they leave together.
    """
    blocks = [iter([(k[at : at + BLOCK], n[at : at + BLOCK]) for at in range(0, len(k), BLOCK)]) for k, n in runs]
    hand = [next(b, None) for b in blocks]
    heap = [(int(h[0][-1]), i) for i, h in enumerate(hand) if h]
    heapq.heapify(heap)
    while heap:
        cut, keys, counts = heap[0][0], [], []
        for i, h in enumerate(hand):
            if h:
                end = int(np.searchsorted(h[0], cut, "right"))
                keys.append(h[0][:end])
                counts.append(h[1][:end])
                hand[i] = (h[0][end:], h[1][end:])
        while heap and heap[0][0] == cut:
            _, i = heapq.heappop(heap)
            hand[i] = next(blocks[i], None)
            if hand[i]:
                heapq.heappush(heap, (int(hand[i][0][-1]), i))
        merged, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(merged), np.int64)
        np.add.at(total, where, np.concatenate(counts))
        yield merged, total


def with_best(merged: Iterator[tuple[np.ndarray, np.ndarray]], shift: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Adds whether a pair's count is the highest of its A identifier.

    Pairs come side-major, so only the last A identifier of a block waits for
    the next one.
    """
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for more in chain(merged, [None]):
        if more is None:
            done = len(keys)
        else:
            keys, counts = np.concatenate([keys, more[0]]), np.concatenate([counts, more[1]])
            done = int(np.searchsorted(keys >> shift, keys[-1] >> shift, "left"))
        if done:
            side = keys[:done] >> shift
            first = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
            best = np.maximum.reduceat(counts[:done], first)
            yield keys[:done], counts[:done], counts[:done] == np.repeat(best, np.diff(np.r_[first, done]))
            keys, counts = keys[done:], counts[done:]


def _merged_counts(heads: DataFrame, n_runs: int, shift: int) -> DataFrame:
    """``bucket, counts``: per bucket its pairs, their numbers of documents and whether they are best."""

    def runs_of(group: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        loaded = (_loaded(raw, "<i8", "<i8") for raw in group["head"])
        return [(np.cumsum(steps), n) for steps, n in loaded]

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        parts = list(merge_heads(runs_of(group)))
        keys, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        head = _packed(np.diff(keys, prepend=0), n)
        return pd.DataFrame({"run": group["turn"].iloc[:1], "bucket": group["bucket"].iloc[:1], "head": [head]})

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        parts = list(with_best(merge_heads(runs_of(group)), shift))
        keys, n, best = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
        counts = _packed(np.diff(keys, prepend=0), n, best.astype(np.uint8))
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1], "counts": [counts]})

    groups = -(-n_runs // FAN_IN)
    while groups > 1:
        turn = F.pmod(F.xxhash64("run"), F.lit(groups)).alias("turn")
        heads = heads.select("bucket", turn, "head").groupBy("bucket", "turn").applyInPandas(merge, "run long, bucket int, head binary")
        groups = -(-groups // FAN_IN)
    return heads.select("bucket", "head").groupBy("bucket").applyInPandas(finish, "bucket int, counts binary")


def _contributions(bodies: DataFrame, counts: DataFrame, salts: int) -> DataFrame:
    """``run, sums``: per run and bucket the documents' ``n_best`` and ``count_sum`` so far, by their place in the run."""
    salt = F.pmod(F.xxhash64("run"), F.lit(salts)).cast("int").alias("salt")
    ahead = counts.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(None).cast("long").alias("run"),
        F.lit(None).cast("binary").alias("head"), F.col("counts").alias("body"),
    )
    both = ahead.union(bodies.select("bucket", salt, "run", "head", "body"))
    dealt = both.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", F.col("run").asc_nulls_first())

    def back(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = n = best = None
        for batch in it:
            for row in chain.from_iterable(batch.slice(at, 64).to_pylist() for at in range(0, batch.num_rows, 64)):
                if row["run"] is None:
                    steps, n, best = _loaded(row["body"], "<i8", "<i8", "u1")
                    keys = np.cumsum(steps)
                    continue
                steps, times = _loaded(row["head"], "<i8", "<i8")
                docs, links = _loaded(row["body"], "<u4", "<u4")
                at = np.searchsorted(keys, np.cumsum(steps))
                links = links.astype(np.int64)
                n_best, count_sum = np.zeros((2, int(docs.max()) + 1), np.int64)
                np.add.at(n_best, docs, links * np.repeat(best[at].astype(np.int64), times))
                np.add.at(count_sum, docs, links * np.repeat(n[at], times))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["run"]], pa.int64()), pa.array([_packed(n_best, count_sum)], pa.binary())], ["run", "sums"]
                )

    return dealt.mapInArrow(back, "run long, sums binary")


def align_tokens(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256``, and with ``keep_groups`` the groups themselves
    as ``groups``: ``a1,a2|b1;a3|b2,b3``.

    ``path_a`` is a byte-level BPE of the tokenizers library, ``path_b`` a
    sentencepiece model; both files lie at these paths on every executor.
    Null and empty texts, and texts that one of the tokenizers does not give
    back byte for byte, have no tokens: zeros and ''. Rows that repeat a text
    or an identifier are documents of their own and count as such. Null
    identifiers are kept. An empty table gives none. Columns beyond the named
    ones are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ship_code(spark)
    shift = aligner(path_a, path_b).shift
    rows = columns_of(docs, _id=id_col, _text=text_col)
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string" + ", groups string" * keep_groups
    spilled = staged(_spill(rows, path_a, path_b, keep_groups), "align-runs")
    chunks, runs = spilled.where(F.col("bucket") == DOCS_BUCKET), spilled.where(F.col("bucket") >= 0)
    n_runs = chunks.count()
    if not n_runs:
        return empty_frame(spark, schema)
    counts = staged(_merged_counts(runs.select("run", "bucket", "head"), n_runs, shift), "align-counts")
    sums = staged(_contributions(runs, counts, -(-n_runs // RUNS_PER_SALT)), "align-sums")
    release(counts)

    def total(chunk: pd.DataFrame) -> pd.DataFrame:
        own = chunk["docs"].notna()
        out = pa.ipc.open_stream(chunk["docs"][own].iloc[0]).read_pandas()
        n_best, count_sum = np.zeros((2, len(out)), np.int64)
        for raw in chunk["sums"][~own]:
            some_best, some_sum = _loaded(raw, "<i8", "<i8")
            n_best[: len(some_best)] += some_best
            count_sum[: len(some_sum)] += some_sum
        out["n_best"], out["count_sum"] = n_best, count_sum
        return out[["doc_id", *COUNTS, "groups_sha256", *["groups"] * keep_groups]]

    nothing = F.lit(None).cast("binary")
    parts = chunks.select("run", F.col("body").alias("docs"), nothing.alias("sums")).union(
        sums.select("run", nothing.alias("docs"), "sums")
    )
    return parts.groupBy("run").applyInPandas(total, schema)
