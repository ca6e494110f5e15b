"""Best-fit packing into fixed-length sequences, planned on the length histogram.

Documents are tokenised and cut into pieces of at most ``capacity`` ids. The
plan sees only the histogram of piece lengths, at most ``capacity`` counts:

1. Lengths are grouped into ``GRID`` classes, rounded up. All patterns of up
   to ``DEPTH`` classes that fill a sequence to the last class are enumerated,
   from classes over ``SMALL`` of them: shorter pieces are kept to close the
   gaps that rounding leaves.
2. Non-negative least squares fits the patterns' repeat counts to the
   histogram; a class left over weighs more the longer it is, as short pieces
   still find a place. Counts are rounded down.
3. The patterns are realised with the longest pieces of each class, in the
   last place with the longest piece that really fits. What they leave is
   packed by best fit, longest first, into the room left, still a length with
   its count at a time.

The plan is a list of slots: so many pieces of one length go to a run of
sequences at one offset. A piece takes the slot that its number within its
length falls into. Both the histogram and the plan are bounded by
``capacity``, not by the number of documents.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of, keep_in_worker, numbered, ship_code, staged, take_worker

CAPACITY = 4096
GRID = 64  # length classes of the pattern fit
DEPTH = 3  # pieces in a pattern
SMALL = 1 / 8  # pieces up to this share of the capacity stay out of the patterns
CACHED_WORDS = 600_000  # words whose ids a worker remembers
WORD_END = "</w>"  # ends the last id of a run of letters or of signs
# Latin-1 letters, then ASCII signs (no apostrophe): one run of each
PLAIN_WORD = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:-@\[-`{-~]*)")


_TOKENIZERS: dict[str, tuple] = {}


class WordTokenizer:
    """Ids of whole texts through a bounded cache of words.

    Only for tokenizers that drop white space and never join across it: the
    ids of a text are then those of its words one after the other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[bytes, bytes] = {}  # words
        self.runs: dict[str, bytes] = {}  # runs of lower-case letters, runs of signs
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True

    def _one(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_runs(self, runs: list[str]) -> None:
        """Runs of letters are encoded many in a text and told apart by their last ids."""
        for at in range(0, len(runs), 4096):
            some = runs[at : at + 4096]
            ids = np.asarray(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) != len(some) or ends[-1] != len(ids):
                self.runs.update((run, self._one(run)) for run in some)
                continue
            raw = ids.tobytes()
            self.runs.update((run, raw[4 * i : 4 * k]) for run, i, k in zip(some, [0, *ends], ends))

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each word: a plain word is a run of letters and a run of signs."""
        texts = b" ".join(words).decode("utf-8", "replace").split(" ")
        found = list(map(PLAIN_WORD.fullmatch, texts))
        parts = [m and (m[1].lower(), m[2]) for m in found]
        runs = self.runs
        if len(runs) > CACHED_WORDS:
            runs.clear()
        self._learn_runs(list({p[0] for p in parts if p}.difference(runs)))
        for signs in {p[1] for p in parts if p}.difference(runs):
            runs[signs] = self._one(signs)
        return {
            word: runs[p[0]] + runs[p[1]] if p else self._one(text) for word, text, p in zip(words, texts, parts)
        }

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        words = [(text or "").encode("utf-8", "replace").split() for text in texts]
        codes = [list(map(self.ids.get, w)) for w in words]
        gaps = []
        for w, found in zip(words, codes):
            i = -1
            for _ in range(found.count(None)):
                i = found.index(None, i + 1)
                gaps.append((found, i, w[i]))
        if gaps:
            fresh = self._encode_words(list({word for _, _, word in gaps}))
            for found, i, word in gaps:
                found[i] = fresh[word]
            if len(self.ids) + len(fresh) > CACHED_WORDS:
                # keep the words at hand, the frequent ones among them
                self.ids = {word: code for w, found in zip(words, codes) for word, code in zip(w, found)}
            else:
                self.ids.update(fresh)
        return [b"".join(found) for found in codes]


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
        keep_in_worker("packing", _TOKENIZERS.clear)
    return _TOKENIZERS[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document's ids, ``end_id`` last, cut at ``capacity``."""
    ship_code(docs.sparkSession)
    rows = columns_of(docs, _id=id_col, _text=text_col)
    end = int(end_id).to_bytes(4, "little")

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("packing")
        tokenizer = _tokenizer(tokenizer_path)
        for batch in it:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for i, ids in enumerate(tokenizer.encode_batch(part.column(1).to_pylist())):
                    ids += end
                    for n, start in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[start : start + 4 * capacity]
                        out.append((i, n, start // 4, len(piece) // 4, zlib.crc32(piece)))
                i, n, start, length, crc = zip(*out) if out else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(i, pa.int64())),
                        pa.array(n, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def patterns(grid: int = GRID, depth: int = DEPTH, small: float = SMALL) -> list[tuple[int, ...]]:
    """All multisets of up to ``depth`` classes over ``small * grid`` that add up to ``grid``, longest first."""
    least = int(small * grid) + 1
    found: list[tuple[int, ...]] = []

    def extend(sofar: tuple[int, ...], left: int) -> None:
        if not left:
            found.append(sofar)
        elif len(sofar) < depth:
            for c in range(min(left, sofar[-1] if sofar else left), least - 1, -1):
                extend((*sofar, c), left - c)

    extend((), grid)
    return found


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``x >= 0`` that minimises ``|a x - b|`` (active sets; Lawson and Hanson)."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    gradient = a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(gradient).max(initial=0.0)))
    for _ in range(3 * a.shape[1]):
        if free.all() or gradient[~free].max() <= tolerance:
            break
        free[np.argmax(np.where(free, -np.inf, gradient))] = True
        while True:
            s = np.zeros_like(x)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if not free.any() or s[free].min() > 0:
                break
            low = free & (s <= 0)
            step = np.min(x[low] / np.maximum(x[low] - s[low], 1e-300))
            x = x + step * (s - x)
            free &= x > 1e-12
            x[~free] = 0.0
        x = s
        gradient = a.T @ (b - a @ x)
    return x


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, grid: int = GRID, depth: int = DEPTH, small: float = SMALL) -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first, end, sequence, offset)``: the pieces ``first .. end - 1`` of a length
    go to the sequences from ``sequence`` on, one each, at ``offset``."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 1 <= n <= capacity for n in left):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    used: dict[int, int] = defaultdict(int)
    slots: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> [(first sequence, count)]
    n_sequences = 0

    def place(length: int, count: int, sequence: int, offset: int) -> None:
        slots.append((length, used[length], used[length] + count, sequence, offset))
        used[length] += count
        left[length] -= count
        if not left[length]:
            del left[length]

    # 2. repeat counts of the patterns
    class_of = lambda n: -(-n * grid // capacity)
    by_class = np.zeros(grid + 1)
    for n, c in left.items():
        by_class[class_of(n)] += c
    by_class[: int(small * grid) + 1] = 0
    kinds = patterns(grid, depth, small)
    a = np.zeros((grid, len(kinds)))
    for j, pattern in enumerate(kinds):
        for c in pattern:
            a[c - 1, j] += 1
    weight = np.arange(1, grid + 1) / grid
    repeats = np.floor(nnls(a * weight[:, None], by_class[1:] * weight) + 1e-6).astype(int)

    # 3. the patterns with real lengths: the longest of each class, and in the
    # last place the longest that fits into what the others really leave
    stock = sorted(left)

    def longest(upto: int) -> int | None:
        at = bisect.bisect_right(stock, upto)
        while at and stock[at - 1] not in left:
            stock.pop(at - 1)
            at -= 1
        return stock[at - 1] if at else None

    for j in sorted(np.flatnonzero(repeats), key=lambda j: kinds[j], reverse=True):
        todo = int(repeats[j])
        while todo and left:
            chosen: list[int] = []
            for k, c in enumerate(kinds[j]):
                full = capacity - sum(chosen)
                n = longest(full if k and k == len(kinds[j]) - 1 else min(full, c * capacity // grid))
                if n is not None and chosen.count(n) < left[n]:
                    chosen.append(n)
            if not chosen:
                break
            count = min(todo, *(left[n] // chosen.count(n) for n in set(chosen)))
            offset = 0
            for n in chosen:
                place(n, count, n_sequences, offset)
                offset += n
            if offset < capacity:
                room[capacity - offset].append((n_sequences, count))
            n_sequences += count
            todo -= count

    # what is left: best fit, longest first
    free = sorted(room)
    for n in sorted(left, reverse=True):
        while n in left:
            at = bisect.bisect_left(free, n)
            if at < len(free):
                space = free[at]
                first, count = room[space].pop()
                if not room[space]:
                    del room[space]
                    free.pop(at)
                fits = 1
            else:  # no room: open new sequences with as many of this length as fit
                space, first, fits = capacity, n_sequences, max(1, min(capacity // n, left[n]))
                count = max(1, left[n] // fits)
                n_sequences += count
            take = min(count, left[n])
            for k in range(fits):
                place(n, take, first, capacity - space + k * n)
            for rest, start, many in ((space - fits * n, first, take), (space, first + take, count - take)):
                if rest > 0 and many > 0:
                    if rest not in room:
                        bisect.insort(free, rest)
                    room[rest].append((start, many))
    return slots


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    grid: int = GRID,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is the single id ``end_id``. Only documents longer
    than ``capacity`` are cut, into pieces of ``capacity`` ids; the last may be
    shorter. Repeated rows are packed each, an empty table gives none. Which
    of several pieces of one length takes which slot is fixed by a hash.
    """
    pieces = staged(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = pack_histogram(histogram, capacity, grid, depth)
    by_length: dict[int, list] = defaultdict(list)
    for length, first, end, sequence, offset in sorted(slots):
        by_length[length].append((end, sequence - first, offset))
    table = docs.sparkSession.createDataFrame(
        [(n, [e for e, _, _ in s], [d for _, d, _ in s], [o for _, _, o in s]) for n, s in by_length.items()],
        "length long, _ends array<long>, _shift array<long>, _offsets array<long>",
    )
    # one row per length: bounded by the capacity, so it may be broadcast
    slot = F.size(F.filter("_ends", lambda e: e <= F.col("_nth")))
    return (
        numbered(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "_nth", sum(histogram.values()))
        .join(F.broadcast(table), "length")
        .withColumn("_slot", slot)
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_nth") + F.get("_shift", F.col("_slot"))).alias("sequence_id"),
            F.get("_offsets", F.col("_slot")).alias("offset"),
        )
    )
