"""URL filtering by pattern rules that are indexed by their rarest literal token. DataFrame functions only.

Every rule is a Java regular expression over the canonical string host + path, with the tokens (runs of ASCII letters
and digits) that any matching string must contain whole. The index holds each rule once, under the one of its tokens
that is rarest in the table's URLs. A URL's own tokens fetch candidate rules, and only those run their expressions.

Nulls: a null URL, or one without ``://``, has empty host and path, meets no rule and gets the default verdict.
Extra columns pass through untouched, unless they bear the name of an output column, which then replaces them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules the index is a constant in the plan and a URL is judged in its own row; beyond, it is joined.
INLINE_RULES = 256
#: A larger index is broadcast only up to this many rules.
BROADCAST_RULES = 200_000
_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}])")


@dataclass(frozen=True)
class Rule:
    """name: what is reported; pattern: over host + path; tokens: literals every match holds as whole tokens; the rule of
    the highest rank among those that match wins."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int
    reported: bool = True


def prefix_rule(verdict: str, text: str) -> Rule:
    """A rule `host/path`: the host and all its subdomains, where the URL's path starts with the rule's. Longest wins."""
    host, slash, path = text.partition("/")
    literal = host + slash + path
    tokens = re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", literal)  # the last is whole only if something follows it
    return Rule(literal, r"^(?:[^/]*\.)?" + _SPECIAL.sub(r"\\\1", literal), tuple(tokens), verdict, 1000 + len(literal))


def token_rule(verdict: str, token: str, pattern: str, rank: int = 1) -> Rule:
    """A pattern that needs `token`; its verdict counts where no prefix rule fits, and no rule name is reported."""
    return Rule(f"pattern:{token}", pattern, (token,), verdict, rank, reported=False)


#: The prefix rules of the query.
PREFIX_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Tokens of host labels that mark link farms and unwanted content.
BLOCKED_LABELS = ("spam", "casino", "porn", "xxx", "viagra", "malware", "phishing", "warez")


def default_rules() -> list[Rule]:
    return [prefix_rule(*x) for x in PREFIX_RULES] + [token_rule("block", t, rf"^(?:[^/]*[.-])?{t}[.-]") for t in BLOCKED_LABELS]


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z lower-cased; empty where there is none."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rarest_tokens(urls: DataFrame, canonical: Column, rules: list[Rule]) -> dict[str, str]:
    """rule name -> its token that the fewest URLs contain. Reads all URLs; the answer has a row for each token of the rules."""
    vocabulary = sorted({t for r in rules for t in r.tokens})
    if not vocabulary:
        return {}
    own = F.array_distinct(F.array_intersect(F.split(canonical, "[^A-Za-z0-9]+"), F.array(*map(F.lit, vocabulary))))
    counts = {x["t"]: x["n"] for x in urls.select(F.explode(own).alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
    return {r.name: min(r.tokens, key=lambda t: (counts.get(t, 0), t)) for r in rules if r.tokens}


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict."""
    names = [r.name for r in rules]
    if len(set(names)) < len(names):
        raise ValueError("rule names must be distinct")
    source = F.col(f"`{url}`")
    canonical = F.concat(host_of(source), path_of(source))
    under = rarest_tokens(pages, canonical, rules)
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    if len(rules) <= INLINE_RULES:
        best = _best_inline(canonical, rules, under)
        out = pages.select(*kept, host_of(source).alias("host"), path_of(source).alias("path"), best.alias("__best"))
    else:
        best = _best_joined(pages.select(canonical.alias("c")).distinct(), rules, under)
        out = pages.select(*kept, host_of(source).alias("host"), path_of(source).alias("path"), canonical.alias("__c"))
        out = out.join(best.withColumnRenamed("c", "__c"), "__c", "left").drop("__c")
    return out.select(
        *[F.col(f"`{c}`") for c in out.columns if c != "__best"],
        F.when(F.col("__best.reported"), F.col("__best.name")).alias("rule"),
        F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict"),
    )


def _entry(r: Rule) -> Column:
    return F.struct(F.lit(r.rank).alias("rank"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.reported).alias("reported"), F.lit(r.pattern).alias("pattern"))


def _best_inline(canonical: Column, rules: list[Rule], under: dict[str, str]) -> Column:
    index: dict[str, list[Rule]] = {}
    for r in rules:
        index.setdefault(under.get(r.name, ""), []).append(r)
    keys = [t for t in index if t]
    always = F.array(*map(_entry, index.get("", []))) if "" in index else None
    found = None
    if keys:
        lookup = F.create_map(*[x for t in keys for x in (F.lit(t), F.array(*map(_entry, index[t])))])
        own = F.array_intersect(F.split(canonical, "[^A-Za-z0-9]+"), F.array(*map(F.lit, keys)))
        found = F.flatten(F.transform(own, lambda t: F.element_at(lookup, t)))
    candidates = found if always is None else always if found is None else F.concat(always, found)
    if candidates is None:
        candidates = F.array().cast("array<struct<rank:int,name:string,verdict:string,reported:boolean,pattern:string>>")
    return F.array_max(F.filter(candidates, lambda r: F.rlike(canonical, r["pattern"])))


def _best_joined(urls: DataFrame, rules: list[Rule], under: dict[str, str]) -> DataFrame:
    """c -> its best rule, by a join of distinct canonical URLs and the index."""
    spark = urls.sparkSession
    rows = [(under.get(r.name, ""), r.rank, r.name, r.verdict, r.reported, r.pattern) for r in rules]
    index = spark.createDataFrame(rows, "t string, rank int, name string, verdict string, reported boolean, pattern string")
    index = F.broadcast(index) if len(rows) <= BROADCAST_RULES else index
    tokens = F.array_distinct(F.concat(F.split("c", "[^A-Za-z0-9]+"), F.array(F.lit(""))))
    hits = urls.select("c", F.explode(tokens).alias("t")).join(index, "t").where(F.rlike("c", F.col("pattern")))
    return hits.groupBy("c").agg(F.max(F.struct("rank", "name", "verdict", "reported", "pattern")).alias("__best"))
