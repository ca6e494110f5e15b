"""Registered queries of the training-data operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsentry.llm import (
    chat_format, exact_dedup, filter_audit, license_scan, mixing, ngram_join, packing, quality_classifier, quality_rules, sharding,
    suffix_dedup, token_alignment, url_filter,
)
from adsentry.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered queries.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
CONTROL_TEXT = "\\### Assistant: </turn> ok"
TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
SHINGLE_WORDS, SHINGLE_THRESHOLD = 4, (85, 100)


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@register(
    "op1_quality_rules",
    rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents),
l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
g AS (SELECT *, CASE WHEN len(w) < 5 THEN [] ELSE list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' ')) END AS g FROM l),
r AS (SELECT doc_id, sum(least(5, nxt - i)) AS n_repeat_words FROM (
        SELECT doc_id, i, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), 1000000000000) AS nxt FROM (
          SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS c FROM (
            SELECT doc_id, unnest(g) AS h, unnest(range(1, len(g) + 1)) AS i FROM g)) WHERE c > 1)
      GROUP BY doc_id),
m AS (SELECT g.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
        coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_same,
        len(list_filter(w, lambda x: regexp_matches(x, '[A-Z][^a-z]*[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_shout,
        len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) AS n_letter
      FROM g LEFT JOIN r ON g.doc_id = r.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * n_lines
       OR NOT (word_chars BETWEEN 2 * n_words AND 20 * n_words) OR 10 * n_same > 2 * n_words
       OR 10 * n_shout > 3 * n_words OR 2 * n_letter < n_words) AS kept
FROM b""",
)
def op1_quality_rules(spark, sf_dir):
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_rules.quality_cascade(
        read_table(spark, sf_dir, "documents"), quality_rules.METHOD_RULES, report=base, base=quality_rules.BASE_RULES
    )
    return judged.drop("rejected_by")


def _license_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    table = license_scan.sentence_table()
    pairs = ", ".join(f"{quote(k)}: {quote(v)}" for k, v in table.items())
    low = f"translate(coalesce(text, ''), '{license_scan._UPPER}', '{license_scan._LOWER}')"
    def slots(t: str) -> str:
        for pattern, form in license_scan.SLOTS:
            t = f"regexp_replace({t}, {quote(pattern)}, {quote(form)}, 'g')"
        return t

    cut = lambda t: (
        f"list_filter(list_transform(string_split(regexp_replace({slots(t)}, '{license_scan.SENTENCE_END}', '\\1' || chr(10), 'g'), chr(10)), "
        "lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: map_contains(k, s))"
    )
    ids = lambda t: f"list_transform({cut(t)}, lambda s: k[s])"
    wrap = lambda t: f"array_to_string(list_transform({t}, lambda i: '|' || i || '|'), '')"
    steps, prev = [], "s"
    runs = license_scan.rule_runs()
    for i, (_, _, run) in enumerate(runs):
        steps.append(f"r{i} AS (SELECT *, contains(q{i}, {quote(run)}) AS h{i}, replace(q{i}, {quote(run)}, '~') AS q{i + 1} FROM {prev})")
        prev = f"r{i}"
    order = list(dict.fromkeys(n for n, _, _ in runs))
    hit = {n: " OR ".join(f"h{i}" for i, r in enumerate(runs) if r[0] == n) for n in order}
    # licenses in the order of the first rule that hit
    first = {n: "least(" + ", ".join(f"CASE WHEN h{i} THEN {i} ELSE 999 END" for i, r in enumerate(runs) if r[0] == n) + ", 999)" for n in order}
    names = "[" + ", ".join(f"CASE WHEN {hit[n]} THEN {{'o': {first[n]}, 'n': {quote(n)}}} END" for n in order) + "]"
    kind = lambda k: " OR ".join(f"h{i}" for i, r in enumerate(runs) if r[1] == k)
    return f"""
WITH k AS (SELECT MAP {{{pairs}}} AS k),
t AS (SELECT doc_id, {low} AS low, k FROM documents CROSS JOIN k),
f AS (SELECT doc_id, {ids('low')} AS a, {ids("replace(low, chr(10), ' ')")} AS b FROM t),
s AS (SELECT doc_id, array_to_string(a, ',') AS sentence_ids, CASE WHEN contains({wrap('b')}, {wrap('a')}) THEN '' ELSE {wrap('a')} END || '~' || {wrap('b')} AS q0 FROM f),
{', '.join(steps)}
SELECT doc_id, sentence_ids,
  array_to_string(list_transform(list_sort(list_filter({names}, lambda x: x IS NOT NULL)), lambda x: x.n), ',') AS licenses,
  CASE WHEN {kind('noncommercial')} THEN 'noncommercial' WHEN {kind('copyleft')} THEN 'copyleft'
       WHEN {kind('permissive')} THEN 'permissive' WHEN q0 <> '~' THEN 'unknown' ELSE 'none' END AS license_class
FROM {prev}"""


@register("op2_license_scan", _license_sql())
def op2_license_scan(spark, sf_dir):
    return license_scan.license_scan(read_table(spark, sf_dir, "documents"))


@register("op3_ngram_join")
def op3_ngram_join(spark, sf_dir):
    return ngram_join.ngram_join(read_table(spark, sf_dir, "documents"), SHINGLE_WORDS, SHINGLE_THRESHOLD)


_SQL_ESCAPED = "replace(replace(replace({x}, '\\', '\\b'), '#', '\\h'), '<', '\\l')"


@register(
    "op4_chat_format",
    f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'),
p AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, length({_SQL_ESCAPED.format(x='text')}) AS n,
  length(replace({_SQL_ESCAPED.format(x='role')}, ':', '\\c')) AS r FROM p)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n + CASE WHEN before IS DISTINCT FROM role THEN {len(chat_format.HEAD) + len(chat_format.COLON)} + r
               ELSE {len(chat_format.JOIN)} END
        + CASE WHEN after IS DISTINCT FROM role THEN {len(chat_format.END)} ELSE 0 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
)
def op4_chat_format(spark, sf_dir):
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string"
    )
    return chat_format.format_digest(chat_format.format_conversations(given.unionByName(extra)))


@register(
    "op5_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)""",
)
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def _url_sql() -> str:
    cases = []
    for verdict, rule in URL_RULES:
        host, path = url_filter.split_rule(rule)
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        cases.append(f"CASE WHEN {fits} THEN {{'h': {len(host)}, 'p': {len(path)}, 'b': {verdict == 'block'}, 'r': '{rule}', 'v': '{verdict}'}} END")
    after = r"regexp_extract(rest, '^[^?#]*')"
    return f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
c AS (SELECT page_id, {after} AS rest FROM u),
s AS (SELECT page_id, string_split(rest, '/')[1] AS raw, rest FROM c),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        substr(rest, length(raw) + 1) AS path FROM s),
m AS (SELECT *, list_max(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)) AS best FROM p)
SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict FROM m"""


@register("op6_url_filter", _url_sql())
def op6_url_filter(spark, sf_dir):
    return url_filter.url_filter(read_table(spark, sf_dir, "pages"), URL_RULES)


@register("op7_quality_classifier")
def op7_quality_classifier(spark, sf_dir):
    return quality_classifier.quality_classifier(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op8_mix_sources")
def op8_mix_sources(spark, sf_dir):
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).drop("copies")


@register("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@register("op10_sharding")
def op10_sharding(spark, sf_dir):
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


@register(
    "op11_filter_audit",
    rf"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents),
t AS (SELECT doc_id, part, len(w) < 50 AS A, 100 * len(list_distinct(w)) < 65 * len(w) AS B,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS C,
        regexp_matches(text, '[#$%&*|]') AS D,
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY sha256(text)), false) AS E FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, [A, B, C, D, E] AS f, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM t LEFT JOIN l ON t.doc_id = l.doc_id),
c AS (SELECT part, f, good, toxic, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, x.i AS step FROM o, x),
m AS (SELECT part, filter_order, step, o[step] AS k, n, good, toxic, f[o[step]] AS fails,
        len(list_filter(o[1:step - 1], lambda i: f[i])) = 0 AS here, len(list_filter(f, lambda b: b)) = 1 AS single
      FROM c, s),
r AS (SELECT part, filter_order, step, k, coalesce(sum(n) FILTER (WHERE here AND NOT fails), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE here AND fails), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE NOT here AND fails), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE fails AND single), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (WHERE here AND fails AND good), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (WHERE here AND fails AND toxic), 0)::BIGINT AS toxic_lost
      FROM m GROUP BY part, filter_order, step, k)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM r""",
)
def op11_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    return token_alignment.align_tokens(read_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED))


@register("op13_suffix_dedup")
def op13_suffix_dedup(spark, sf_dir):
    spans = suffix_dedup.repeated_spans(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return spans.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
