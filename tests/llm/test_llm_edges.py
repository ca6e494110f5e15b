"""Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables, for every operator and stage."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adsentry.llm import (
    chat_format, exact_dedup, license_scan, mixing, ngram_join, packing, quality_classifier, quality_rules, sharding, url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i}" for i in range(30_000))
PLAIN = " ".join(f"some{i} plain{i} prose" for i in range(20))
ROWS = [
    (1, PLAIN, "en", "a", 1),
    (1, PLAIN, "en", "a", 1),  # a repeated row
    (2, PLAIN, "en", "a", 2),  # a copy
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "en", None, 4),
    (6, LONG, "en", "b", len(LONG)),
    (7, PLAIN + " more", "en", "b", 3),
    (None, "no identifier at all here, but enough words to count as a text", "de", "b", 5),
    (8, "é" * 40 + " ### <+> </turn> \\", "fr", "b", 6),
]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    clash = {c: F.lit("x") for c in ("size", "kept", "shard", "copies", "_row", "_id", "_text", "rid", "_bucket", "keep_id", "n", "label")}
    return df.withColumns(clash)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(8)] + [(None, 1, 0), (2, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def operators(labels):
    return {
        "rules": lambda d: quality_rules.quality_cascade(d, report=("n_words",), base=quality_rules.BASE_RULES),
        "license": license_scan.license_scan,
        "ngram": ngram_join.ngram_join,
        "dedup": exact_dedup.exact_dedup,
        "classifier": lambda d: quality_classifier.quality_classifier(d, labels),
        "mix": mixing.mix_sources,
        "pack": lambda d: packing.pack_documents(d, TOKENIZER),
        "shard": sharding.shard_documents,
    }


NAMES = ["rules", "license", "ngram", "dedup", "classifier", "mix", "pack", "shard"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_of_odd_documents_has_a_result(docs, labels, name):
    out = operators(labels)[name](docs).collect()
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out if name != "pack" or r["piece"] == 0)
    assert ids == sorted((r[0] is None, r[0] or 0) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table_gives_none(spark, labels, name):
    assert operators(labels)[name](spark.createDataFrame([], DOCS)).collect() == []


def test_exact_dedup_keeps_one_row_of_each_text(docs):
    out = exact_dedup.exact_dedup(docs).collect()
    assert sum(r["kept"] for r in out) == len({r[1] or "" for r in ROWS})
    copies = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in out if r["doc_id"] in (1, 2)]
    assert sorted(copies) == [(1, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True)]
    empty = [(r["doc_id"], r["keep_id"], r["kept"]) for r in out if r["doc_id"] in (3, 4)]
    assert sorted(empty) == [(3, 4, False), (4, 4, True)]
    small = exact_dedup.exact_dedup(docs, keep="smallest").where("doc_id <= 2").collect()
    assert sorted((r["doc_id"], r["keep_id"]) for r in small) == [(1, 1), (1, 1), (2, 1)]
    assert sum(r["kept"] for r in small) == 1


def test_exact_dedup_rounds_give_one_run_in_any_number(spark):
    rows = [(i, f"text {i % 7}") for i in range(400)] + [(None, "text 3"), (None, "alone"), (900, "text 0")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    keyed = exact_dedup._keyed(df, "doc_id", "text")
    for keep, pick in (("largest", max), ("smallest", min)):
        ids = {}
        for i, t in rows:
            ids.setdefault(t, []).append(i)
        want = sorted((len(v), str(pick((i for i in v if i is not None), default=None))) for v in ids.values())
        first = keyed.selectExpr("pmod(spark_partition_id(), 16) AS _run", *exact_dedup._ENTRY, "1L AS _rows", "_id").select(
            "_run", *exact_dedup._ENTRY, exact_dedup._claim(keep).alias("_best"), "_rows"
        )
        for fan_in in (2, 4, 16):
            one = exact_dedup.merge_runs(first, keep, n_runs=16, fan_in=fan_in)
            assert sorted((r["_rows"], str(r["_best"])) for r in one.collect()) == want
        assert sorted((r["_rows"], str(r["_best"])) for r in exact_dedup.digest_groups(keyed, keep).collect()) == want


def test_exact_dedup_merges_sorted_runs(docs):
    groups = exact_dedup.digest_groups(exact_dedup._keyed(docs, "doc_id", "text"))
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("SortAggregate(") == 6  # the runs and two rounds, on both sides of an exchange


def test_ngram_join_links_copies_only(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(docs).collect()}
    assert got[1] == got[2] == (56, 1) and got[7] == (57, 1)
    assert got[3] == (0, 3) and got[4] == (0, 4) and got[5] == (0, 5)
    assert got[6] == (30_000 - 4, 6)


def test_license_runs(spark):
    texts = [
        "Intro.\nLicensed under the Apache License, Version 2.0.\nEnd.",
        "# Licensed under the Apache License, Version 2.0 (the\n# \"License\"); you may not use this file except in compliance\n"
        "# with the License. You may obtain a copy of the License at\n#\n",
        "Released under the MIT License. Licensed under CC BY-NC 4.0.",
        "All rights reserved.",
        "We talked about a licence.",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["licenses"], r["license_class"]) for r in license_scan.license_scan(df).collect()}
    assert got == {
        0: ("Apache-2.0", "permissive"),
        1: ("Apache-2.0", "permissive"),
        2: ("MIT,CC-BY-NC-4.0", "noncommercial"),
        3: ("", "unknown"),
        4: ("", "none"),
    }


def test_licenses_that_the_tables_do_not_hold(spark):
    bsd = (
        "Redistribution and use are permitted provided that the following conditions are met:\n\n"
        "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n"
        "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n"
    )
    gnu = (
        " * This {what} is free software; you can redistribute it and/or\n * modify it under the terms of the GNU {name}General Public\n"
        " * License as published by the Free Software Foundation; either\n * version {v} of the License, or (at your option) any later version.\n"
    )
    cases = [
        (bsd, "BSD-2-Clause", "permissive"),
        (bsd + "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n", "BSD-3-Clause", "permissive"),
        (gnu.format(what="program", name="", v="2"), "GPL-2.0-or-later", "copyleft"),
        (gnu.format(what="library", name="Lesser ", v="2.1"), "LGPL-2.1-or-later", "copyleft"),
        ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public License as published by\n"
         "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n", "AGPL-3.0-or-later", "copyleft"),
        ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.", "GPL-2.0-only", "copyleft"),
        ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", "ISC", "permissive"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:", "MIT", "permissive"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense", "permissive"),
        ("To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.", "CC0-1.0", "permissive"),
        ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "EPL-2.0", "copyleft"),
        ("Readme.\nThis project is licensed under the MIT License.\n", "MIT", "permissive"),
        ("This file is released under the GNU Lesser General Public License v3.0.", "LGPL-3.0-only", "copyleft"),
        ("This work is licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0", "noncommercial"),
        ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT", "permissive"),
        ("# SPDX-License-Identifier:  GPL-2.0-or-later", "GPL-2.0-or-later", "copyleft"),
        ("/* SPDX-License-Identifier: Apache-2.0 */", "Apache-2.0", "permissive"),
        ("SPDX-License-Identifier: Nobody-1.0", "", "none"),
    ]
    clauses = [next(t for i, t in license_scan.KNOWN_SENTENCES if i == c) for c in ("bsdRetain", "bsdReproduce", "bsdNeither")]
    two, third = "\n".join(clauses[:2]), clauses[2]
    wrapped = third.replace(" may be used ", " may be\nused ")
    google = "Neither the name of Google Inc. nor the names of its contributors" + third.split(" contributors", 1)[1]
    cases += [
        (f"{two}\n{third}", "BSD-3-Clause", "permissive"),
        (f"{two}\n{wrapped}", "BSD-3-Clause", "permissive"),  # the lines alone would be two clauses
        (f"{two}\n{google}", "BSD-3-Clause", "permissive"),
        (two, "BSD-2-Clause", "permissive"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: (r["licenses"], r["license_class"]) for r in license_scan.license_scan(df).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}


def test_chat_round_trip(spark):
    odd = ["", None, "\\", "\\b", "#<", "</turn>\n", "<+>", "### user: x", "\\c:\\l\\h", "plain", "a\nb"]
    rows = [(1, i, ("user", "assistant", "assistant", "a:b\\c", None)[i % 5], t) for i, t in enumerate(odd)]
    rows += [(2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, None, "user", "y"), (3, 5, "user", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    out = chat_format.format_conversations(turns)
    back = out.select("conv_id", "formatted", "segments", chat_format.read_back(F.col("formatted")).alias("turns")).collect()
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    for r in back:
        turns_of = [x[1:] for x in sorted(want[r["conv_id"]])]
        assert [(x["role"], x["text"]) for x in r["turns"]] == turns_of
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        loss = [t for role, t in turns_of if role == "assistant"]
        assert sum(s["loss"] for s in r["segments"]) == len(loss)
    assert len(back) == 4
    assert chat_format.format_conversations(turns.limit(0)).collect() == []


def test_url_rules(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "x.org/a/b"), ("allow", "x.org/a/b"), ("block", "/bad")]
    urls = {
        "http://A.com/": ("com/", "allow"),
        "http://a.com": (None, "allow"),
        "https://sub.Example.com/en/1?q=/x": ("example.com/en/", "block"),
        "https://m.www.example.com/en/#t": ("www.example.com/en/", "allow"),
        "https://notexample.com/en/": ("com/", "allow"),
        "https://x.org/a/bc/d": ("x.org/a/b", "block"),
        "https://x.org/bad/x": ("/bad", "block"),
        "https://x.org/a?/b": (None, "allow"),
        "no url": (None, "allow"),
        None: (None, "allow"),
        "http://": (None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    for limit in (url_filter.MAX_TRIE_BYTES, 0):  # trie, then the join
        got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.url_filter(df, rules, max_trie_bytes=limit).collect()}
        assert got == dict(enumerate(urls.values()))
    trie = sorted(url_filter.url_filter(df, rules).collect())
    assert trie == sorted(url_filter.url_filter(df, rules, max_trie_bytes=0).collect())
    assert url_filter.url_filter(df.limit(0), rules).collect() == []


def test_cascade_order_does_not_change_the_verdict(docs):
    n = len(quality_rules.BASE_RULES + quality_rules.METHOD_RULES)
    verdicts = [
        sorted((str(r["doc_id"]), r["kept"]) for r in quality_rules.quality_cascade(docs, order=order).collect())
        for order in (range(n), list(reversed(range(n))), None)
    ]
    assert verdicts[0] == verdicts[1] == verdicts[2]


def test_cascade_order_counts_what_the_report_has_measured(spark):
    """Of two rules that reject the same texts the one whose measure is known is first; texts that base rules reject do not count."""
    text = " ".join(f"word{i} Some{i} plain{i}" for i in range(400))
    df = spark.createDataFrame([(i, text + " #" * (i % 2)) for i in range(60)] + [(99, "tiny")], "doc_id long, text string")
    dear = quality_rules.Rule("windows", lambda m: m.n_repeat_words >= 0 and m.text.endswith("#"))
    cheap = quality_rules.Rule("neighbours", lambda m: m.n_same_as_previous >= 0 and m.text.endswith("#"))
    tiny = quality_rules.Rule("tiny", lambda m: m.n_words < 5)
    assert quality_rules.cascade_order(df, (dear, cheap)) == [1, 0]
    assert quality_rules.cascade_order(df, (dear, cheap), report=("n_repeat_words",)) == [0, 1]
    few = quality_rules.Rule("few", lambda m: m.n_words < 10)
    assert quality_rules.cascade_order(df, (few, dear), base=(tiny,)) == [1, 0]
    assert quality_rules.cascade_order(df.limit(0), (dear, cheap)) == [0, 1]


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_and_empty_documents(spark, docs, labels, tmp_path, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    name, run = corpus_pipeline.STAGES[stage]
    for given in (docs, docs.limit(0)):
        given.write.mode("overwrite").parquet(f"{tmp_path}/docs-{stage}")
        out = run(spark, spark.read.parquet(f"{tmp_path}/docs-{stage}"), str(tmp_path))
        rows = out.collect()
        if name != "pack":
            assert out.columns == docs.columns
        if name == "exact_dedup" and rows:
            assert len(rows) == len({r[1] or "" for r in ROWS})
        if name == "near_dedup" and rows:
            # the copies and the near copy leave one; texts without words all stay
            assert sorted(str(r["doc_id"]) for r in rows) == ["1", "3", "4", "5", "6", "8", "None"]


HELPERS = (
    "_sha", "_len", "_check", "_best", "_rows", "_id", "_kid", "_kth", "_mr", "_copies", "_row", "_size", "_source", "_dd_id", "_win_best",
    "_nd_id", "_nd_kept_id", "_mix_row", "_mix_n", "_mix_at", "_mix_copies", "_quality", "rid", "comp", "th", "gram", "a", "b", "node", "label",
)


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_take_columns_named_like_their_helpers_and_maps(spark, docs, labels, stage, tmp_path):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    given = plain.withColumns({c: F.lit("x") for c in HELPERS}).withColumn("extra", F.create_map(F.lit("k"), F.col("lang")))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = dict(corpus_pipeline.STAGES)[stage](spark, given, str(tmp_path))
    assert got.columns == given.columns
    # the same rows stay as without the extra columns
    want = dict(corpus_pipeline.STAGES)[stage](spark, plain, str(tmp_path))
    shown = lambda df: sorted(map(repr, df.select("doc_id", "text", "lang", "source").collect()))
    assert shown(got) == shown(want)
