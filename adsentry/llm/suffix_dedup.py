"""Repeated passages: every byte under a string of ``length`` bytes that also starts elsewhere.

The suffixes of all texts are sorted bucket by bucket to depth ``length``; two
neighbours that agree to that depth are a repeat. What keeps this in bounds is
a difference cover sample:

1. Chunks. Rows are packed into chunks of a few megabytes, each with its
   distinct texts once.
2. Cover sample. Positions whose offset modulo the period lies in a difference
   cover are about 9 % of all. For any two positions there is a shift below the
   period that brings both into the sample, so two equal strings of ``length``
   bytes contain, at the same place, two equal sample strings of ``length -
   period + 1`` bytes. The sample strings are ranked one bucket at a time; a
   sample position learns whether its rank is shared. Copies of whole texts are
   found in the same pass.
3. Suffixes. A suffix with no shared sample rank within one period ties with no
   other suffix to that depth and never moves. The rest, and of whole copies
   only the first one's, go to their buckets and are sorted there; keys that
   meet again are repeats, and a bit per key goes back to the chunk.
4. Spans. A chunk marks the bytes under its repeated strings.

The order of strings is that of their fingerprints, not the alphabet's: equal
strings are neighbours either way, and a key has 8 bytes instead of ``length``.
Buckets grow in number with the corpus, so that one holds about
``BUCKET_KEYS`` keys; a key that many chunks share is sent once by each. The
fingerprint has 64 bits beside the bits of the bucket: a string that isn't
repeated is taken for one with odds of about BUCKET_KEYS / 2**64, 2e-13.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of, empty_frame, ship_code, staged

LENGTH = 400
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 1 << 15
SEGMENT = 4 << 20  # positions of a chunk that are keys at a time
BLOCK = 1 << 18  # bytes that are hashed at a time
BUCKET_KEYS = 4 << 20
LEAST_BUCKETS = 64

TEXT, SAMPLE, SUFFIX = 0, 1, 2  # kinds of keys
ALONE, FIRST, LATER = 0, 1, 2  # what a text is among its copies

_U = np.uint64


def difference_cover(length: int) -> tuple[int, np.ndarray]:
    """Period and elements of a difference cover, the period at most half of ``length``.

    The steps between its elements follow the rule of Colbourn and Ling:
    6r + 4 elements cover the period 24r^2 + 36r + 13.
    """
    r = -1
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= length // 2:
        r += 1
    if r < 0:
        return 1, np.zeros(1, np.int64)
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.cumsum([0, *steps])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


@cache
def _powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes, powers of a random odd base and of its inverse."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2**64, 256, dtype=np.uint64)
    base = int(rng.integers(0, 2**63)) * 2 + 1
    up, down = (np.full(size, b, np.uint64) for b in (base % 2**64, pow(base, -1, 2**64)))
    up[0] = down[0] = 1
    return values, np.multiply.accumulate(up), np.multiply.accumulate(down)


def fingerprints(data: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """64-bit fingerprints of the strings of ``length`` bytes that start at the ascending places ``at``."""
    values, up, down = _powers(seed, BLOCK + length + 1)
    out = np.empty(len(at), np.uint64)
    lo = 0
    while lo < len(at):
        start = int(at[lo])
        hi = int(np.searchsorted(at, start + BLOCK))
        part = data[start : int(at[hi - 1]) + length]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * up[: len(part)], out=sums[1:])
        here = at[lo:hi] - start
        out[lo:hi] = (sums[here + length] - sums[here]) * down[here]
        lo = hi
    return _mixed(out)


def _ragged(starts: np.ndarray, counts: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """``starts[i] + values[:counts[i]]`` of all i, one after the other."""
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(starts, counts) + (inner if values is None else values[inner])


def _squeezed(keys: np.ndarray) -> bytes:
    """Ascending keys: steps between them, byte planes apart, compressed."""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(len(keys), keys.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _restored(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


class Chunk:
    """The distinct texts of a few megabytes of rows as one byte array."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, copies: np.ndarray):
        self.data, self.sizes, self.copies = data, sizes, copies
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    @classmethod
    def load(cls, data: bytes, layout: bytes) -> Chunk:
        sizes, copies = np.frombuffer(layout, np.int64).reshape(2, -1)
        raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, int(sizes.sum())))
        return cls(np.frombuffer(raw, np.uint8), sizes, copies)

    def digests(self) -> list[bytes]:
        return [hashlib.blake2b(self.data[a:b], digest_size=16).digest() for a, b in zip(self.starts, self.ends, strict=True)]

    def sample(self, length: int) -> np.ndarray:
        """Places of the cover sample, each with a whole sample string before its text's end."""
        period, cover = difference_cover(length)
        room = np.maximum(0, self.sizes - (length - period))  # offsets with a whole sample string
        room[self.sizes < length] = 0
        most = int(room.max(initial=0))
        offsets = (np.arange(0, most + period, period)[:, None] + cover).ravel()
        return _ragged(self.starts, np.searchsorted(offsets, room), offsets)

    def candidates(self, length: int, shared: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Places of whole strings with a shared sample place less than a period ahead; none in texts to ``skip``."""
        period, _ = difference_cover(length)
        n = len(self.data)
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, np.maximum(shared - (period - 1), 0), 1)
        np.add.at(edge, shared + 1, -1)
        near = np.cumsum(edge[:n]) > 0
        whole = np.zeros(n + 1, np.int8)
        use = (self.sizes >= length) & ~skip
        np.add.at(whole, self.starts[use], 1)
        np.add.at(whole, self.ends[use] - length + 1, -1)
        return np.flatnonzero(near & (np.cumsum(whole[:n], dtype=np.int8) > 0))

    def copied(self, at: np.ndarray, often: np.ndarray) -> np.ndarray:
        """Whether the text of a place is one of ``often``."""
        return often[np.searchsorted(self.ends, at, "right")]


class Keys(NamedTuple):
    """Keys of places by bucket: ``order`` sorts the places by (bucket, key)."""

    order: np.ndarray
    bucket: np.ndarray
    key: np.ndarray
    first: np.ndarray  # where a new (bucket, key) begins, in sorted order


def _sorted_keys(bucket: np.ndarray, key: np.ndarray) -> Keys:
    order = np.argsort(key)
    order = order[np.argsort(bucket[order], kind="stable")]
    b, k = bucket[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (b[1:] != b[:-1]) | (k[1:] != k[:-1])
    return Keys(order, b, k, np.flatnonzero(new))


def sample_keys(chunk: Chunk, at: np.ndarray, length: int, bits: int) -> Keys:
    """Ranks of sample strings: 32 bits within the bucket, as they only let suffixes pass."""
    period, _ = difference_cover(length)
    h = fingerprints(chunk.data, at, length - period + 1, 1)
    return _sorted_keys((h >> _U(64 - bits)).astype(np.uint32), h.astype(np.uint32))


def suffix_keys(chunk: Chunk, at: np.ndarray, length: int, bits: int) -> Keys:
    bucket = fingerprints(chunk.data, at, length, 2) >> _U(64 - bits)
    return _sorted_keys(bucket.astype(np.uint32), fingerprints(chunk.data, at, length, 3))


def _segments(at: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for i in range(0, len(at), size):
        yield i // size, at[i : i + size]


def _sent(keys: Keys, often: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """``(bucket, keys, twice)`` of each bucket: its distinct keys and whether one stands for several places."""
    counts = np.diff(np.r_[keys.first, len(keys.order)])
    many = (counts > 1) | np.logical_or.reduceat(often[keys.order], keys.first) if len(counts) else counts > 1
    bucket, key = keys.bucket[keys.first], keys.key[keys.first]
    edges = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)] if len(bucket) else [0]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield int(bucket[lo]), _squeezed(key[lo:hi]), np.packbits(many[lo:hi]).tobytes()


def _told(keys: Keys, answers: dict[int, bytes]) -> np.ndarray:
    """Per place whether its key is repeated, from the answers of the buckets."""
    bucket = keys.bucket[keys.first]
    edges = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)] if len(bucket) else [0]
    hits = np.zeros(len(bucket), bool)
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        hits[lo:hi] = np.unpackbits(np.frombuffer(answers[int(bucket[lo])], np.uint8), count=hi - lo).astype(bool)
    out = np.zeros(len(keys.order), bool)
    out[keys.order] = np.repeat(hits, np.diff(np.r_[keys.first, len(keys.order)]))
    return out


_ASKED = "chunk long, segment int, kind int, bucket int, keys binary, twice binary"
_ANSWERED = "chunk long, segment int, kind int, bucket int, bits binary"


def _asked(chunk: int, segment: int, kind: int, rows: list[tuple[int, bytes, bytes]]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["bucket", "keys", "twice"])
    out.insert(0, "kind", np.int32(kind))
    out.insert(0, "segment", np.int32(segment))
    out.insert(0, "chunk", np.int64(chunk))
    return out.astype({"bucket": np.int32})


def _answer_texts(rows: pd.DataFrame) -> list[bytes]:
    held = [[raw[i : i + 16] for i in range(0, len(raw), 16)] for raw in rows["keys"]]
    first, several = {}, set()
    for chunk, digests in sorted(zip(rows["chunk"], held, strict=True), key=lambda x: x[0]):
        for d in digests:
            if d in first:
                several.add(d)
            else:
                first[d] = chunk
    return [
        bytes(ALONE if d not in several else FIRST if first[d] == chunk else LATER for d in digests)
        for chunk, digests in zip(rows["chunk"], held, strict=True)
    ]


def _answer_keys(rows: pd.DataFrame, kind: str) -> list[bytes]:
    """Sorts the bucket's keys; those met again, or sent as standing for several places, are repeats."""
    held = [_restored(raw, kind) for raw in rows["keys"]]
    twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(k)).astype(bool) for k, t in zip(held, rows["twice"], strict=True)]
    everything = np.sort(np.concatenate(held))
    known = np.unique(np.concatenate([everything[1:][everything[1:] == everything[:-1]], *(k[t] for k, t in zip(held, twice, strict=True))]))
    del everything
    return [np.packbits(np.isin(k, known, assume_unique=True, kind="sort")).tobytes() for k in held]


def _answers(asked: DataFrame) -> DataFrame:
    """Every (kind, bucket) sorted on its own; one answer per question."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        kind = int(rows["kind"].iloc[0])
        bits = _answer_texts(rows) if kind == TEXT else _answer_keys(rows, "<u4" if kind == SAMPLE else "<u8")
        return rows[["chunk", "segment", "kind", "bucket"]].assign(bits=bits)

    return asked.groupBy("kind", "bucket").applyInPandas(answer, _ANSWERED)


def _chunked(rows: DataFrame) -> DataFrame:
    """``chunk, n_bytes, rows, layout, data``: identifiers and texts' places as Arrow data, sizes and copies, bytes."""

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        zstd = zstandard.ZstdCompressor(level=6)
        ids, places, seen, texts, copies, held = [], [], {}, [], [], 0

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array(places, pa.int64())], ["doc_id", "place"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            layout = np.array([[len(t) for t in texts], copies], np.int64).tobytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    pa.array([layout], pa.binary()),
                    pa.array([zstd.compress(b"".join(texts))], pa.binary()),
                ],
                ["chunk", "n_bytes", "rows", "layout", "data"],
            )

        for batch in it:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                ids.append(some.column(0))
                for text in some.column(1).cast(pa.binary()).to_pylist():
                    text = text or b""
                    place = seen.setdefault(text, len(texts))
                    if place == len(texts):
                        texts.append(text)
                        copies.append(0)
                        held += len(text)
                    copies[place] += 1
                    places.append(place)
                if held >= CHUNK_BYTES or len(places) >= CHUNK_DOCS:
                    yield flush()
                    number += 1
                    ids, places, seen, texts, copies, held = [], [], {}, [], [], 0
        if places:
            yield flush()

    return rows.mapInArrow(pack, "chunk long, n_bytes long, rows binary, layout binary, data binary")


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans, kept``.

    ``spans`` are the maximal runs ``(start, end)`` of bytes under a string of
    ``length`` bytes that also starts elsewhere, in this text or any other;
    ``kept`` is the rest of the bytes. Strings are judged on the texts as they
    are, and never cross two texts. Null texts are empty; texts shorter than
    ``length`` keep everything. Rows that repeat a text or an identifier are
    rows of their own, so a text of ``length`` bytes that two rows hold is
    removed in both. Null identifiers are kept. An empty table gives none.
    Columns beyond the named ones are ignored, whatever their names.
    """
    if length < 1:
        raise ValueError("a string needs a byte")
    spark = docs.sparkSession
    ship_code(spark)
    rows = columns_of(docs, _id=id_col, _text=text_col)
    id_type = rows.schema["_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    chunks = staged(_chunked(rows), "suffix-chunks")
    total, n_chunks = chunks.agg(F.sum("n_bytes"), F.count(F.lit(1))).first()
    if not n_chunks:
        return empty_frame(spark, schema)
    period, cover = difference_cover(length)

    def bits_for(n_keys: float) -> int:
        bits = (LEAST_BUCKETS - 1).bit_length()
        while n_keys / 2**bits > BUCKET_KEYS:
            bits += 1
        return bits

    sample_bits, suffix_bits = bits_for(total * len(cover) / period), bits_for(total)

    def ask_sample(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk.load(row["data"], row["layout"])
                digests = {}
                for d in chunk.digests():
                    digests.setdefault(d[0] % LEAST_BUCKETS, []).append(d)
                texts = [(b, b"".join(some), b"") for b, some in digests.items()]
                yield pa.RecordBatch.from_pandas(_asked(row["chunk"], 0, TEXT, texts), _schema_of_asked(), preserve_index=False)
                for segment, at in _segments(chunk.sample(length), SEGMENT):
                    keys = sample_keys(chunk, at, length, sample_bits)
                    asked = _asked(row["chunk"], segment, SAMPLE, list(_sent(keys, np.zeros(len(at), bool))))
                    yield pa.RecordBatch.from_pandas(asked, _schema_of_asked(), preserve_index=False)

    def known(group: pd.DataFrame) -> tuple[int, pd.DataFrame, Chunk, np.ndarray, np.ndarray, dict]:
        """A chunk with what its texts are among their copies and its candidates."""
        own = group["data"].notna()
        row = group[own].iloc[0]
        chunk = Chunk.load(row["data"], row["layout"])
        answers = {}
        for kind, segment, bucket, bits in group.loc[~own, ["kind", "segment", "bucket", "bits"]].itertuples(index=False):
            answers.setdefault((int(kind), int(segment)), {})[int(bucket)] = bits
        told, status = {b: iter(s) for b, s in answers[TEXT, 0].items()}, np.zeros(len(chunk.sizes), np.int8)
        for i, d in enumerate(chunk.digests()):
            status[i] = next(told[d[0] % LEAST_BUCKETS])
        shared = [np.zeros(0, np.int64)]
        for segment, at in _segments(chunk.sample(length), SEGMENT):
            shared.append(at[_told(sample_keys(chunk, at, length, sample_bits), answers[SAMPLE, segment])])
        at = chunk.candidates(length, np.concatenate(shared), status == LATER)
        return int(row["chunk"]), row, chunk, status, at, answers

    def ask_suffixes(group: pd.DataFrame) -> pd.DataFrame:
        number, _, chunk, status, at, _ = known(group)
        often = (status == FIRST) | (chunk.copies > 1)
        parts = [_asked(number, 0, SUFFIX, [])]
        for segment, some in _segments(at, SEGMENT):
            sent = _sent(suffix_keys(chunk, some, length, suffix_bits), chunk.copied(some, often))
            parts.append(_asked(number, segment, SUFFIX, list(sent)))
        return pd.concat(parts, ignore_index=True)

    def spans(group: pd.DataFrame) -> pd.DataFrame:
        _, row, chunk, status, at, answers = known(group)
        n = len(chunk.data)
        edge = np.zeros(n + 1, np.int32)
        for segment, some in _segments(at, SEGMENT):
            hit = some[_told(suffix_keys(chunk, some, length, suffix_bits), answers.get((SUFFIX, segment), {}))]
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + length, -1)
        gone = np.cumsum(edge[:n]) > 0
        out = []
        for i, (a, b) in enumerate(zip(chunk.starts, chunk.ends, strict=True)):
            mask = gone[a:b]
            if b - a >= length and (status[i] != ALONE or chunk.copies[i] > 1):
                mask = np.ones(b - a, bool)
            steps = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
            runs = [{"start": int(x), "end": int(y)} for x, y in steps.reshape(-1, 2)]
            out.append((int(b - a), runs, chunk.data[a:b][~mask].tobytes()))
        where = pa.ipc.open_stream(row["rows"]).read_pandas()
        return pd.DataFrame(
            {
                "doc_id": where["doc_id"],
                "n_bytes": [out[p][0] for p in where["place"]],
                "spans": [out[p][1] for p in where["place"]],
                "kept": [out[p][2] for p in where["place"]],
            }
        )

    columns = {"rows": "binary", "layout": "binary", "data": "binary", "segment": "int", "kind": "int", "bucket": "int", "bits": "binary"}
    missing = lambda names: [F.lit(None).cast(columns[c]).alias(c) for c in names]
    mine = chunks.select("chunk", "rows", "layout", "data", *missing(["segment", "kind", "bucket", "bits"]))
    back = lambda a: a.select("chunk", *missing(["rows", "layout", "data"]), "segment", "kind", "bucket", "bits")

    ranks = staged(_answers(chunks.select("chunk", "layout", "data").mapInArrow(ask_sample, _ASKED)), "suffix-ranks")
    asked = mine.union(back(ranks)).groupBy("chunk").applyInPandas(ask_suffixes, _ASKED)
    repeats = staged(_answers(asked), "suffix-repeats")
    return mine.union(back(ranks)).union(back(repeats)).groupBy("chunk").applyInPandas(spans, schema)


def _schema_of_asked() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _ASKED.split(", "))])
