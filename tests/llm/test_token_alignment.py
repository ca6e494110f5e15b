"""Op 12 against a plain reading of its contract: whole-text tokenization, all pairs, a counter."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adsentry.llm import token_alignment
from adsentry.llm.queries import ALIGNED, QUERIES

PATHS = tuple(map(public_tokenizers.path, ALIGNED))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), token_alignment.byte_level_bytes()


def groups_of(text, tools):
    a, b, table = tools
    if not text:
        return []
    want = (" " + text).encode()
    one, two = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    raw_a = [bytes(table[c] for c in t) for t in one.tokens]
    raw_b = [bytes([b.id_to_piece(i)[3:5] and int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in two]
    if b"".join(raw_a) != want or b"".join(raw_b) != want:
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in raw_a]), np.cumsum([len(x) for x in raw_b])
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        n, m = int(np.searchsorted(ends_a, end, "right")), int(np.searchsorted(ends_b, end, "right"))
        out.append((one.ids[i:n], two[j:m]))
        i, j = n, m
    return out


def by_brute_force(rows, tools):
    groups = [groups_of(t, tools) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, _), g, c in zip(rows, groups, links, strict=True):
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
            sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
            hashlib.sha256(shown.encode()).hexdigest() if g else "",
        ))
    return sorted(map(repr, out))


def result(df):
    assert df.columns == COLUMNS
    return sorted(repr(tuple(r)) for r in df.collect())


def test_query_equals_brute_force(spark, tools):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert result(QUERIES["op12_token_alignment"](spark, sf)) == by_brute_force(rows, tools)


ODD = [
    None, "", " ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\nb\n", "\n\na", "x\ty z", "x y z w", "it's we'll 12345 1.5e9",
    "<|endoftext|> a <s> b </s> <unk> <0x41>", "▁ a", "a▁b", "日本語のテキスト と 空白", "😀😀 é é ö", "\x00 a b\x00c", "\x1c a b",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "a" * 3000, "same text", "same text", "ﬁ ½ Å", "word " * 500, "　全角 空白",
]


def test_odd_texts_many_chunks_and_merge_rounds(spark, tools, monkeypatch):
    rng = random.Random(3)
    alphabet = ["a", "the", " ", "  ", "\n", "é", "日", "0x", "'s", ".", "\t", "▁", "word", "<", "-"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("run", "bucket", "_id", "_text", "n_a", "salt")}
    )
    want = by_brute_force(rows, tools)
    assert result(token_alignment.align_tokens(df, *PATHS)) == want
    # several salts and rounds of the merge
    monkeypatch.setattr(token_alignment, "FAN_IN", 3)
    monkeypatch.setattr(token_alignment, "RUNS_PER_SALT", 2)
    assert result(token_alignment.align_tokens(df.repartition(13), *PATHS)) == want


def test_units_cut_where_both_tokenizers_end_a_token(tools):
    al = token_alignment.aligner(*PATHS)
    assert al.cuts
    for text in filter(None, ODD):
        assert "".join(al.cut(text)) == " " + text


def test_groups_as_text(spark, tools):
    df = spark.createDataFrame([(1, "two words"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.groups for r in token_alignment.align_tokens(df, *PATHS, keep_groups=True).collect()}
    shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups_of("two words", tools))
    assert got == {1: shown, 2: ""}


def test_large_groups_by_distinct_identifiers(tools, monkeypatch):
    texts = list(dict.fromkeys(t for t in ODD if t))
    small, large = (token_alignment.Aligner(*PATHS) for _ in range(2))
    small.learn([" " + t for t in texts])
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", 1)
    large.learn([" " + t for t in texts])
    for u in range(len(texts)):
        one, two = Counter(), Counter()
        for got, al in ((one, small), (two, large)):
            at = slice(al.pair_start[u], al.pair_start[u] + al.pair_count[u])
            for p, n in zip(al.pairs[at].tolist(), al.times[at].tolist(), strict=True):
                got[p] += n
        assert one == two and small.groups[u] == large.groups[u]


def test_heap_merge_in_small_blocks(monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK", 3)
    rng = np.random.default_rng(1)
    runs, total = [], Counter()
    for _ in range(7):
        keys = np.unique(rng.integers(0, 60, rng.integers(0, 30)))
        n = rng.integers(1, 9, len(keys))
        runs.append((keys, n))
        total.update(dict(zip(keys.tolist(), n.tolist(), strict=True)))
    parts = list(token_alignment.with_best(token_alignment.merge_heads(runs), 3))
    keys, n, best = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == total and (np.diff(keys) > 0).all()
    top = {k >> 3: max(v for q, v in total.items() if q >> 3 == k >> 3) for k in keys.tolist()}
    assert best.tolist() == [total[k] == top[k >> 3] for k in keys.tolist()]


def test_no_rows_and_no_tokens(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.align_tokens(empty, *PATHS).collect() == []
    none = spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string")
    assert result(token_alignment.align_tokens(none, *PATHS)) == [repr((1, 0, 0, 0, 0, 0, 0, ""))] * 2


def test_byte_level_table_is_that_of_the_vocabulary():
    with open(PATHS[0]) as f:
        pieces = json.load(f)["model"]["vocab"]
    table = token_alignment.byte_level_bytes()
    assert len(table) == 256 and all(c in table for p in pieces if not p.startswith("<|") for c in p)
