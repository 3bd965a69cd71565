"""URL filters: a trie over reversed host labels and path segments.

Rules are (host, path, verdict). A rule fits its host and every subdomain when the URL's path starts with the
rule's path. Of the rules that fit, the one with the most host labels wins, then the one with the longest path; of
two rules with the same host and path, `block` wins. Rule sets that are too large for a broadcast are joined on host
suffixes, with the same checks, lower-casing and precedence.

Defined cases: a rule without a host, with a path that doesn't begin with `/` or with another verdict raises; a null path
of a rule is the empty one; a null URL, or one without `://`, has the empty host and path and fits no rule; an empty path fits
only rules without a path; repeated rows are judged alike; an empty table gives an empty table; columns of the input
named like the output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, cut, hot_join

#: The trie is broadcast only up to so many rules (about 1 kB each at most); beyond, rules are joined.
MAX_TRIE_RULES = 200_000
MAX_RULE_CHARS = 4_096
JUDGEMENT = "struct<host:string,path:string,rule:string,verdict:string>"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first `://` up to `/`, `?`, `#`; then up to `?`, `#`. A-Z of the host are lower-cased."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(65, 91)}


class Trie:
    """Host labels from the last to the first; below each, path segments; at each path node the rules that end there."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.translate(_LOWER).split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            if not rule.path:
                node["any"] = self._better(node.get("any"), ("", rule))
                continue
            node = node.setdefault("paths", {})
            *whole, rest = rule.path.removeprefix("/").split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            ends = node.setdefault("ends", {})
            ends[rest] = self._better(ends.get(rest), (rest, rule))
            node.setdefault("lengths", set()).add(len(rest))

    @staticmethod
    def _better(old, new):
        return new if old is None or new[1].verdict == "block" else old

    @staticmethod
    def _path(node: dict, path: str) -> Rule | None:
        """The rule with the longest path that `path` starts with."""
        found = None
        if path.startswith("/") and (at := node.get("paths")) is not None:
            segments = path[1:].split("/")
            for i, segment in enumerate(segments):
                # a lookup for each length that rules end with here, however many rules there are
                for size in sorted(at.get("lengths", ()), reverse=True):
                    if size <= len(segment) and (hit := at["ends"].get(segment[:size])) is not None:
                        found = hit[1]
                        break
                if i + 1 == len(segments) or (at := at.get("segments", {}).get(segment)) is None:
                    break
        return found or node.get("any", (None, None))[1]

    def match(self, host: str, path: str) -> Rule | None:
        """The longest match, or None."""
        if not host:
            return None
        node, found = self.root, None
        for label in reversed(host.split(".")):
            if (node := node.get("labels", {}).get(label)) is None:
                break
            found = self._path(node, path) or found
        return found


def _judge(urls: pd.Series, trie: Trie, default: str) -> pd.DataFrame:
    out = []
    for url in urls:
        host, path = split_url(url if isinstance(url, str) else None)
        rule = trie.match(host, path)
        out.append((host, path, rule and rule.name, rule.verdict if rule else default))
    return pd.DataFrame(out, columns=["host", "path", "rule", "verdict"])


def _check(rules: Iterable[Rule]) -> list[Rule]:
    rules = [Rule(host, path or "", verdict) for host, path, verdict in rules]
    for r in rules:
        if r.verdict not in ("allow", "block") or not r.host or (r.path and r.path[0] != "/"):
            raise ValueError(f"not a rule: {r}")
    return rules


def _lowered(host: Column) -> Column:
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judge(df: DataFrame, rules: Iterable[Rule] | DataFrame, url: str = "url", out: str = "judgement", default: str = "allow", max_trie_rules: int = MAX_TRIE_RULES) -> DataFrame:
    """`df` with a struct column `out` (host, path, rule, verdict); verdict is `default` where no rule fits.

    `rules`: a list, or a DataFrame (host, path, verdict). A DataFrame of more than `max_trie_rules` rules, or with
    longer rules than the trie takes, is joined on host suffixes instead of broadcast.
    """
    if isinstance(rules, DataFrame):
        size = rules.agg(F.count("*").alias("n"), F.max(F.length(F.concat("host", "path"))).alias("most")).first()
        if size.n > max_trie_rules or (size.most or 0) > MAX_RULE_CHARS:
            return judge_by_join(df, rules, url, out, default)
        rules = rules.select("host", "path", "verdict").collect()
    rules = _check(rules)
    if len(rules) > max_trie_rules:
        return judge_by_join(df, rules_frame(df.sparkSession, rules), url, out, default)
    trie = Shared(df.sparkSession, Trie(rules))

    @F.pandas_udf(JUDGEMENT)
    def apply(urls: pd.Series) -> pd.DataFrame:
        return _judge(urls, trie.value, default)

    return df.withColumn(out, apply(F.col(url).cast("string")))


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def url_parts(url: Column) -> tuple[Column, Column]:
    """split_url() in Spark's functions."""
    at = F.instr(url, "://")
    rest = F.regexp_replace(F.when(at > 0, F.substr(url, at + 3)), r"(?s)[?#].*", "")
    slash = F.instr(rest, "/")
    host = F.when(slash > 0, F.substr(rest, F.lit(1), slash - 1)).otherwise(rest)
    path = F.when(slash > 0, F.substr(rest, slash)).otherwise("")
    return F.coalesce(_lowered(host), F.lit("")), F.coalesce(path, F.lit(""))


def judge_by_join(df: DataFrame, rules: DataFrame, url: str = "url", out: str = "judgement", default: str = "allow") -> DataFrame:
    """The same judgements for rule sets of any size: distinct (host, path) pairs meet the rules on host suffixes.

    The work per URL is its number of host labels times the rules of one host. URLs without a host meet nothing, and the
    judgements of pairs that many rows have are broadcast, a bounded number.
    """
    rules = cut(rules.select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict"))
    valid = F.coalesce(F.col("verdict").isin("allow", "block") & (F.col("host") != "") & ((F.col("path") == "") | F.startswith("path", F.lit("/"))), F.lit(False))
    if (wrong := rules.where(~valid).first()) is not None:
        raise ValueError(f"not a rule: {Rule(*wrong)}")
    names = [f"__{i}" for i in range(len(df.columns))]
    host, path = url_parts(F.col(names[df.columns.index(url)]).cast("string"))
    rows = df.toDF(*names).withColumns({"__host": host, "__path": path})
    seen = rows.where("__host <> ''").groupBy("__host", "__path").agg(F.count("*").alias("__copies"))
    labels = F.split("__host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = seen.select("__host", "__path", "__copies", F.explode(suffixes).alias("suffix"))
    own = rules.select(_lowered(F.col("host")).alias("suffix"), F.col("path").alias("rule_path"), F.concat("host", "path").alias("rule"), "verdict")
    best = F.struct(F.length("suffix"), F.length("rule_path"), (F.col("verdict") == "block").cast("int"))
    won = (
        tried.join(own, "suffix")
        .where(F.col("__path").startswith(F.col("rule_path")))
        .groupBy("__host", "__path")
        .agg(F.max("__copies").alias("__copies"), F.max_by(F.struct("rule", "verdict"), best).alias("__won"))
    )
    judged = hot_join(rows, cut(won), ["__host", "__path"], "__copies")
    verdict = F.struct(F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__won.rule").alias("rule"), F.coalesce("__won.verdict", F.lit(default)).alias("verdict"))
    return judged.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True) if c != out], verdict.alias(out))


#: Fixed values of the contract.
CONTRACT_RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the contract's rules."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, CONTRACT_RULES).select("page_id", "judgement.*")


OP7_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_replace(substr(url, instr(url, '://') + 3), '[?#](.|\\n)*$', '') ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    translate(CASE WHEN contains(rest, '/') THEN substr(rest, 1, instr(rest, '/') - 1) ELSE rest END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN contains(rest, '/') THEN substr(rest, instr(rest, '/')) ELSE '' END AS path
  FROM cut
), rules(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), hits AS (
  SELECT page_id, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.rverdict, 'allow') AS verdict
FROM parts p LEFT JOIN (SELECT * FROM hits WHERE k = 1) h ON p.page_id = h.page_id
"""
