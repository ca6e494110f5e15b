"""Operators that SQL cannot state, against brute force on small fixtures."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adsentry.llm import mixing, ngram_join, packing, quality_classifier, sharding
from adsentry.llm.components import components
from adsentry.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(repr, res.fetchall()))


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def shingles(text, n):
    w = text.encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(zip(*(w[i:] for i in range(n)))) if len(w) >= n else frozenset([tuple(w)])


def by_brute_force(texts, n, num, den):
    sets = {d: shingles(t, n) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in texts}


def test_ngram_join_on_the_table(spark, texts):
    got = {r[0]: (r[1], r[2]) for r in QUERIES["op3_ngram_join"](spark, SF).collect()}
    assert got == by_brute_force(texts, 4, 85, 100)


def test_ngram_join_in_a_group_of_near_copies(spark):
    """Copies of one text with random edits: chains, near misses and exact repeats around the threshold."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for d in range(140):
        words = list(base if d % 3 else base[:90])
        for _ in range(rng.choice((0, 1, 2, 3, 5, 8))):
            words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
        texts[d] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r[0]: (r[1], r[2]) for r in ngram_join.ngram_join(df, 5, (80, 100)).collect()}
    assert got == by_brute_force(texts, 5, 80, 100)


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1040)] + [(2001, 2000), (2000, 2001), (5, 5)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 1000 for i in range(1001, 1040)}, 2001: 2000}


def test_no_plan_of_a_round_reads_its_tables_over_and_over(spark, monkeypatch):
    reads = defaultdict(int)

    def counted(df, name, put=mixing.staged):
        reads[name] = max(reads[name], df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return put(df, name)

    monkeypatch.setattr("adsentry.llm.components.staged", counted)
    monkeypatch.setattr(mixing, "staged", counted)
    components(spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")).collect()
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(60)], "doc_id long, text string, source string")
    assert mixing.mix_sources(df).count() == 60
    assert reads["cc-edges"] and reads["mix-edges"]
    assert max(reads.values()) <= 3, dict(reads)


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = QUERIES["op7_quality_classifier"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    seen = [(r["score"], r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert sum(p == y for _, p, y in seen) >= 0.95 * len(seen)
    wins = [(a > b) + (a == b) / 2 for a, _, x in seen if x == 1 for b, _, y in seen if y == 0]
    assert sum(wins) >= 0.98 * len(wins)


def test_classifier_learns_a_rare_label_from_all_rows(spark):
    """Far more labelled rows than the sample holds; few of them are rejected."""
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(1200):
        bad = i % 60 == 0
        words = ["###" if bad and rng.random() < 0.6 else f"word{rng.randrange(500)}" for _ in range(60)]
        texts.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1))
    docs, known = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality_classifier.train(docs, known, max_labelled=12)
    x = np.array([quality_classifier.features(t) for _, t in texts])
    learned = np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in texts])
    label = np.array([y for _, y in labels])
    wrong = (model.score(x) >= quality_classifier.ACCEPT) != (label == 1)
    assert wrong[learned].sum() == 0 and wrong.sum() <= 2


def test_mix_reaches_its_targets(spark):
    sf = "/root/testdata/sf0.01"
    source = dict(duckdb.sql(f"SELECT doc_id, source FROM '{sf}/documents.parquet'").fetchall())
    rows = QUERIES["op8_mix_sources"](spark, sf).collect()
    assert sorted(rows) == sorted(QUERIES["op8_mix_sources"](spark, sf).collect())
    taken, target, size = Counter(), {}, {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]], size[source[r["doc_id"]]] = r["target"], r["source_size"]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    fixed, total = {}, sum(size.values())
    while True:  # the contract's rule, step by step
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in size if s not in fixed)
        over = [s for s in size if s not in fixed and rest * weight[s] / w > 3 * size[s]]
        if not over:
            break
        fixed.update({s: 3 * size[s] for s in over})
    for s in size:
        assert target[s] == pytest.approx(fixed.get(s, rest * weight[s] / w))
        assert abs(taken[s] - target[s]) <= 0.02 * target[s]


def test_inclusion_follows_the_importance(spark):
    df = spark.createDataFrame([(i, "one two", "s", 4.0 if i % 2 else 1.0) for i in range(2000)] + [(9999, "x " * 4000, "t", 1.0)],
                               "doc_id long, text string, source string, w double")
    rows = mixing.mix_sources(df, weights=(1.0, 7.0), importance_col="w").where("doc_id < 2000").collect()
    odd = sum(r["taken"] for r in rows if r["doc_id"] % 2)
    assert 0.7 < odd / sum(r["taken"] for r in rows) < 0.9


def test_mix_goes_on_behind_a_long_document(spark):
    """A document of a third of its source's words is passed over; the rest comes from far behind the edge."""
    missed = {}
    for seed in (1, 3):
        rows = [(i, "w " * 30, "s") for i in range(3000)] + [(9999, "w " * 45_000, "s")]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
        got = mixing.mix_sources(df, share=0.62, seed=seed).collect()
        missed[seed] = abs(sum(r["taken"] for r in got) - got[0]["target"])
    assert max(missed.values()) <= 30, missed


def test_mix_passes_over_a_long_document_of_equal_odds(spark):
    """As above with equal odds, by which the long document is at the edge for some seeds."""
    rows = [(i, "w " * 30, "s", 1.0) for i in range(3000)] + [(9999, "w " * 45_000, "s", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, one double").repartition(4)
    got = mixing.mix_sources(df, share=0.62, seed=3, importance_col="one").collect()
    assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 30


def test_inclusion_follows_the_words(spark):
    """Without a column, odds are unequal: at 4 and 64 words the probabilities are as 2 to 8; those that would pass 1 are certain."""
    lengths = [4] * 1500 + [64] * 300 + [4096] * 2
    df = spark.createDataFrame([(i, "w " * n, "s") for i, n in enumerate(lengths)], "doc_id long, text string, source string")
    rows = mixing.mix_sources(df, share=0.5).collect()
    got = Counter(r["size"] for r in rows if r["copies"])
    # plain solution: the two long ones certain, the rest by the root of their words
    target = 0.5 * sum(lengths) - 2 * 4096
    scale = target / sum(n * n**0.5 for n in lengths if n < 4096)
    assert got[4096] == 2
    assert abs(got[4] - 1500 * 2 * scale) < 5 * (1500 * 2 * scale) ** 0.5
    assert abs(got[64] - 300 * 8 * scale) < 5 * (300 * 8 * scale) ** 0.5
    assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 4


def test_scale_of_the_probabilities_equals_a_plain_solution(spark):
    rng = np.random.default_rng(3)
    weights, sizes = rng.pareto(1.0, 800) + 0.01, rng.integers(1, 500, 800)
    rows = [(int(n), float(w)) for n, w in zip(sizes, weights)]
    df = spark.createDataFrame(rows, "n long, w double").selectExpr(
        "CAST(NULL AS STRING) AS _source", "CAST(floor(log2(w) * 16) AS INT) AS _band", "n", "w"
    )
    bands = df.groupBy("_source", "_band").agg(
        F.sum("n").alias("_words"), F.sum(F.col("n") * F.col("w")).alias("_mass"), F.max("w").alias("_top")
    )
    for share in (0.05, 0.5, 0.9, 0.99):
        rest = share * float(sizes.sum())
        rests = spark.createDataFrame([(None, rest)], "_ps string, _rest double")
        (got,) = mixing._scaled(bands, rests).collect()
        expected = float((sizes * np.minimum(1, got["_scale"] * weights)).sum())
        assert abs(expected - rest) <= 0.03 * rest


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(dict), defaultdict(list)
    for r in QUERIES["op9_best_fit_packing"](spark, SF).collect():
        pieces[r["doc_id"]][r["piece"]] = r
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for d, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        total += len(ids)
        assert len(pieces[d]) == -(-len(ids) // 4096)
        for k, start in enumerate(range(0, len(ids), 4096)):
            part, r = ids[start : start + 4096], pieces[d][k]
            assert (r["start"], r["length"], r["ids_crc32"]) == (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= 1.02 * -(-total // 4096) + 1


def test_word_cache_gives_the_tokenizers_ids():
    words = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["don't it's we'll", "İstanbul ŉ ſ", "e\u0301 ﬁ", "<|endoftext|> x<|startoftext|>y", "٣ ½ x² 12ab", "日本語 テスト", "\x85a b\x1cc", "__a__ 'a", "", None, "ß ẞ ΑΣ"]
    for text, ids in zip(odd, words.encode_batch(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == words.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_go_when_a_worker_takes_up_other_work(spark, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = spark.createDataFrame([(1, "a b c d e f", 0)], "_id long, _text string, _th long")
    model = quality_classifier.fit_pairs(np.zeros((0, len(quality_classifier.FEATURES))), np.zeros(0, int))
    tasks = []
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, task, schema: tasks.append(task) or self)
    packing.token_pieces(rows, path, id_col="_id", text_col="_text")
    ngram_join.signatures(rows, 5, (80, 100), np.zeros(1 << ngram_join.SKETCH_BITS, np.int64))
    quality_classifier.score_documents(rows, model, id_col="_id", text_col="_text")
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b c d e f"]), pa.array([0])], ["_id", "_text", "_th"])
    pack, *others = tasks
    for other in others:
        list(pack(iter([batch])))
        held = packing._TOKENIZERS[path]
        list(pack(iter([batch])))
        assert packing._TOKENIZERS[path] is held and held.ids
        list(other(iter([batch])))
        assert not packing._TOKENIZERS


def test_pack_histogram_places_every_piece_once():
    rng = random.Random(3)
    for _ in range(20):
        counts = {rng.randrange(1, 257): rng.randrange(1, 50) for _ in range(rng.randrange(1, 60))}
        slots = packing.pack_histogram(counts, 256, grid=16, depth=3)
        used, sequences = Counter(), defaultdict(list)
        for length, first, end, sequence, offset in slots:
            used[length] += end - first
            for k in range(end - first):
                sequences[sequence + k].append((offset, length))
        assert used == counts
        for held in sequences.values():
            assert sum(n for _, n in held) <= 256
            assert [o for o, _ in sorted(held)] == [0, *itertools.accumulate(n for _, n in sorted(held))][:-1]


def test_shards_hold_whole_groups_and_near_equal_bytes(spark, texts):
    rows = QUERIES["op10_sharding"](spark, SF).collect()
    loads, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[raw].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(h) == 1 for h in homes.values())
    groups = Counter()
    for t in texts.values():
        groups[t] += len(t.encode()) + 16
    assert max(loads.values()) <= max(max(groups.values()), sum(loads.values()) / 40) * 4 / 3


def test_deal_is_the_heap_in_one_step():
    rng = random.Random(1)
    for _ in range(50):
        loads = [float(rng.randrange(1000)) for _ in range(5)]
        n, size = rng.randrange(1, 200), rng.randrange(1, 60)
        slow = list(loads)
        for _ in range(n):
            slow[slow.index(min(slow))] += size
        fast = list(loads)
        got = sharding.deal(fast, n, size)
        assert sum(got) == n and sorted(fast) == sorted(slow)


def near_misses(n, words=1500, edits=24, seed=2):
    """Texts that share most 5-word n-grams, each with its own edits; none links with another."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for i in rng.sample(range(words), edits):
            own[i] = f"e{k}_{i}"
        out.append((k, " ".join(own)))
    return out


def test_near_misses_are_not_paired_out(spark, monkeypatch):
    staged, pairs = ngram_join.staged, []

    def counting(df, name):
        table = staged(df, name)
        if name == "ngram-pairs":
            pairs[-1] += table.count()
        return table

    monkeypatch.setattr(ngram_join, "staged", counting)
    sizes = (40, 80, 160)
    for n in sizes:
        pairs.append(0)
        df = spark.createDataFrame(near_misses(n), "doc_id long, text string")
        rows = ngram_join.ngram_join(df, 5, (85, 100)).collect()
        assert all(r.component_id == r.doc_id for r in rows)
    # all pairs are 780, 3,160 and 12,720
    assert all(p <= 4 * n for p, n in zip(pairs, sizes, strict=True)), pairs


def test_suffix_parities_lose_no_link(spark):
    """Sets of all sizes, near and far, so that parities of different widths meet."""
    rng = random.Random(4)
    rows = []
    for words, edits in ((300, 3), (520, 8), (700, 14), (1100, 20), (1500, 30)):
        base = [f"{words}_{i}" for i in range(words)]
        for _ in range(6):
            own = list(base)
            for i in rng.sample(range(words), rng.randint(0, edits)):
                own[i] = f"e{rng.random()}"
            rows.append((len(rows), " ".join(own[: words - rng.randint(0, words // 12)])))
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 5, (80, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_brute_force(dict(rows), 5, 80, 100)


def test_links_of_a_large_group_are_not_paired_out(spark, monkeypatch):
    """Near copies of one text of which few link with each other, but nearly all with the few that have hardly an edit."""
    staged, pairs = ngram_join.staged, []

    def counting(df, name):
        table = staged(df, name)
        if name == "ngram-pairs":
            pairs.append(table.count())
        return table

    monkeypatch.setattr(ngram_join, "staged", counting)
    rng = random.Random(8)
    rows = []
    for i in range(400):
        own = [f"w{k}" for k in range(400)]
        for k in rng.sample(range(400), rng.choice((0, 1, 2)) if i % 40 == 0 else rng.randint(4, 9)):
            own[k] = f"e{rng.random()}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.ngram_join(df, 5, (80, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_brute_force(dict(rows), 5, 80, 100)
    # all pairs are 79,800
    assert sum(pairs) <= 10 * len(rows), pairs


def test_postings_that_cannot_link_do_not_move(spark, monkeypatch):
    """Short texts inside long ones share their rarest n-grams, but no two sizes that may link."""
    inner, moved = ngram_join._with_suffixes, []

    def counting(live, sig):
        moved.append(live.count())
        return inner(live, sig)

    monkeypatch.setattr(ngram_join, "_with_suffixes", counting)
    rng = random.Random(9)
    rows = []
    for i in range(60):
        short = [f"s{i}.{k}" for k in range(40)]
        at = rng.randrange(600)
        rows.append((2 * i, " ".join(short)))
        rows.append((2 * i + 1, " ".join([f"w{k}" for k in range(at)] + short + [f"w{k}" for k in range(at, 600)])))
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 5, (80, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_brute_force(dict(rows), 5, 80, 100)
    assert sum(moved) <= len(rows), moved


def test_postings_keep_all_that_may_link(spark):
    rng = random.Random(10)
    rows, rid = [], 0
    for gram in range(300):
        for _ in range(rng.choice((1, 2, 2, 3, 8))):
            n = rng.randint(1, 60) if gram % 3 else rng.randint(40, 60)
            rows.append((gram, rng.randrange(n - -(-80 * n // 100) + 1), n, rid))
            rid += 1
    table = spark.createDataFrame(rows, "gram long, pos int, n long, rid long")
    got = {r.rid: r.usable for r in ngram_join._postings(table, (80, 100)).collect()}
    shared, link = set(), set()
    for g, p, n, x in rows:
        for h, q, m, y in rows:
            if g == h and x != y:
                shared.add(x)
                if 100 * min(n, m) >= 80 * max(n, m) and 180 * min(n - p, m - q) >= 80 * (n + m):
                    link.add(x)
    kept = {x for x, usable in got.items() if usable}
    assert set(got) == shared and link <= kept
    # of those that may not link most go
    assert len(kept - link) < len(shared - link) / 2
