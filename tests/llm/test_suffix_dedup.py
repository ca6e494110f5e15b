"""Op 13 against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from adsentry.llm import suffix_dedup
from adsentry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def spans_by_brute_force(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.r_[False, gone[:-1], False].astype(int)))
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), [tuple(x) for x in edges.reshape(-1, 2).tolist()], kept))
    return out


def result(df, length):
    rows = suffix_dedup.repeated_spans(df, length).collect()
    return sorted(repr((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept))) for r in rows)


def expected(rows, length):
    return sorted(repr((i, *x)) for (i, _), x in zip(rows, spans_by_brute_force([t for _, t in rows], length), strict=True))


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = [
        (i, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest())
        for (i, _), (n, s, k) in zip(rows, spans_by_brute_force([t for _, t in rows], 400), strict=True)
    ]
    df = QUERIES["op13_suffix_dedup"](spark, SF)
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)
    assert sum(w[2] for w in want) > 0


@pytest.mark.parametrize("length", [1, 5, 30, 90, 400])
def test_cover(length):
    period, cover = suffix_dedup.difference_cover(length)
    assert period <= max(1, length // 2)
    assert {int(a - b) % period for a in cover for b in cover} == set(range(period))


def corpus(rng, length):
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(length // 3), prose(length // 2)
    texts = [None, "", "a", passage, passage, passage, "x" + passage, passage + "y"]
    texts += [prose(rng.randint(0, 40)) + passage + prose(rng.randint(0, 40)) for _ in range(8)]
    texts += [prose(9) + other + prose(3) + other, other[:-1], other * 3, "z" * (3 * length), prose(400)]
    texts += [passage[: length - 1], passage[:length], passage[1 : length + 1]]
    return texts


@pytest.mark.parametrize("length", [1, 7, 30, 64, 150])
def test_odd_texts(spark, length, monkeypatch):
    texts = corpus(random.Random(length), length)
    rows = [(i // 2 if i % 9 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("chunk", "data", "_id", "_text", "kind", "bucket", "spans", "place")}
    )
    want = expected(rows, length)
    assert result(df.coalesce(1), length) == want
    # many chunks, segments, blocks and buckets
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 300)
    assert result(df.repartition(5), length) == want


def test_long_texts_in_segments(spark, monkeypatch):
    rng = random.Random(5)
    long = " ".join(str(rng.random()) for _ in range(3000))
    rows = [(1, long), (2, long[1000:9000] + "!" + long[12_000:20_003]), (3, "q" + long[5:700])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1009)  # travels with the functions that read it
    assert result(df, 400) == expected(rows, 400)


def test_pieces_in_process(monkeypatch):
    """Segments, blocks and the answers of the buckets, without workers that would not see changed constants."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", 37)
    data = np.frombuffer(b"abcabcabcabcabdabcabcabcabcabc" * 9, np.uint8)
    at = np.arange(len(data) - 20)
    h = suffix_dedup.fingerprints(data, at, 20, 2)
    strings = [data[i : i + 20].tobytes() for i in at]
    assert len(set(h.tolist())) == len(set(strings))
    assert len(set(zip(h.tolist(), strings, strict=True))) == len(set(strings))
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 99, dtype=np.uint64))
    assert (suffix_dedup._restored(suffix_dedup._squeezed(keys), "<u8") == keys).all()


def test_no_rows(spark):
    assert suffix_dedup.repeated_spans(spark.createDataFrame([], "doc_id long, text string")).collect() == []
