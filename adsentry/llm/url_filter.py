"""URL allow and block lists by a trie over reversed host labels and path segments.

A rule is ``(verdict, "host/path")``. It fits its host and every subdomain,
if the URL's path starts with the rule's. The trie is keyed first by the host
labels from right to left (``com``, ``example``, ``www``) and, at the node of
the rule's host, by whole path segments; what follows the last ``/`` of a
rule's path is compared as a prefix. Walking down a URL meets exactly the
rules that fit it, and the deepest wins: the longest host, then the longest
path; on identical rules block wins over allow.

The trie is broadcast only while the rule list is within ``MAX_TRIE_BYTES``;
a larger list is joined to the pages by (host suffix, path prefix) instead,
with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adsentry.llm.common import columns_of, ship_code

MAX_TRIE_BYTES = 32 << 20

Rule = tuple[str, str]  # (verdict, "host/path")

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lowered) and path of a URL; both empty without ``://``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    if slash < 0:
        return rest.translate(_LOWER), ""
    return rest[:slash].translate(_LOWER), rest[slash:]


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(_LOWER), slash + path


class UrlTrie:
    """Nodes are dicts: label -> node; ``None`` -> the path trie of the host that ends here."""

    def __init__(self, rules: Sequence[Rule]):
        self.root: dict = {}
        # block before allow: on identical rules the first entry stays
        for verdict, rule in sorted(rules, key=lambda r: r[0] != "block"):
            host, path = split_rule(rule)
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            node.setdefault(None, {}).setdefault(last, (rule, verdict))

    @staticmethod
    def _deepest_path(node: dict, path: str) -> tuple[str, str] | None:
        segments, best, at = path.split("/"), None, 0
        while True:
            # rules whose last, partial segment is a prefix of this one
            for prefix, hit in sorted(node.get(None, {}).items(), key=lambda kv: len(kv[0])):
                if segments[at].startswith(prefix):
                    best = hit
            if at + 1 >= len(segments) or segments[at] not in node:
                return best
            node, at = node[segments[at]], at + 1

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """``(rule, verdict)`` of the longest rule that fits, or None."""
        node, best = self.root, None
        for label in [None, *reversed(host.split("."))] if host else [None]:
            if label is not None:
                if label not in node:
                    break
                node = node[label]
            if None in node:
                best = self._deepest_path(node[None], path) or best
        return best


def _match_broadcast(pages: DataFrame, rules: Sequence[Rule], default: str) -> DataFrame:
    ship_code(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for batch in batches:
            out = []
            for url in batch["_url"]:
                host, path = split_url(url)
                rule, verdict = trie.match(host, path) or (None, default)
                out.append((host, path, rule, verdict))
            frame = pd.DataFrame(out, columns=["host", "path", "rule", "verdict"], dtype=object)
            frame.insert(0, "page_id", batch["_id"].to_numpy())
            yield frame

    kind = pages.schema["_id"].dataType.simpleString()
    return pages.mapInPandas(judge, f"page_id {kind}, host string, path string, rule string, verdict string")


def _match_joined(pages: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same by equi-join: rules keyed by host and whole leading segments."""
    at = F.instr("url", "://")
    rest = F.regexp_extract(F.expr("substr(url, at + 3)"), r"^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = (
        pages.select(F.col("_id").alias("page_id"), F.coalesce("_url", F.lit("")).alias("url"))
        .withColumn("at", at)
        .withColumn("rest", F.when(F.col("at") > 0, rest).otherwise(""))
        .withColumn("host", F.translate(F.substring_index("rest", "/", 1), upper, lower))
        .withColumn("path", F.expr("substr(rest, length(host) + 1)"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.sequence(F.lit(0), F.size(segments) - 1), lambda i: F.array_join(F.transform(F.slice(segments, 1, i), lambda s: F.concat(s, F.lit("/"))), ""))
    keys = parts.select("*", F.explode(F.array_union(suffixes, F.array(F.lit("")))).alias("k_host")).select("*", F.explode(prefixes).alias("k_path"))
    spot = F.instr("rule", "/")
    r_host = F.translate(F.substring_index("rule", "/", 1), upper, lower)
    r_path = F.when(spot > 0, F.expr("substr(rule, instr(rule, '/'))")).otherwise("")
    keyed_rules = rules.select(
        "verdict", "rule", r_host.alias("k_host"), r_path.alias("r_path"), F.regexp_extract(r_path, r"^(.*/)?", 0).alias("k_path")
    )
    fits = keys.join(keyed_rules, ["k_host", "k_path"]).where(F.expr("startswith(path, r_path)"))
    rank = F.struct(F.length("k_host").alias("h"), F.length("r_path").alias("p"), (F.col("verdict") == "block").alias("b"), "rule", "verdict")
    best = fits.groupBy("row").agg(F.max(rank).alias("best"))
    return parts.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def url_filter(
    pages: DataFrame,
    rules: Sequence[Rule],
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    max_trie_bytes: int = MAX_TRIE_BYTES,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``rule`` is null and ``verdict`` the default where no rule fits. A null
    URL, or one without ``://``, has an empty host and path and can only meet
    rules with both empty. Repeated rows are judged each; an empty table gives
    none; a rule listed both ways blocks.
    """
    rows = columns_of(pages, _id=id_col, _url=url_col)
    if sum(len(r.encode()) + 200 for _, r in rules) <= max_trie_bytes:
        return _match_broadcast(rows, rules, default)
    table = pages.sparkSession.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")
    return _match_joined(rows, table.distinct(), default)
