"""URL filter: pattern rules indexed by their rarest literal token, DataFrame functions only.

Every rule is compiled to a regular expression and to the literal tokens
(runs of ``[a-z0-9]``) that any matching URL must hold as whole tokens. The
rarest of them, counted over all URLs, is the rule's index key. A distinct
URL's tokens fetch candidate rules by an equi-join; regular expressions run on those
candidates alone. Rules without a usable token stand under the empty token,
which every URL then also carries: the exact way for the rest.

Two kinds of rules:

* site rules (host, path): fit the host and its subdomains when the path
  starts with the rule's; the longest text wins (ties: by text);
* pattern rules: literal text between token boundaries, ``*`` is any run of
  characters, compared with the lower-cased host and path; the first in list
  order wins. They decide where no site rule fits; else the verdict is ``default``.

Defined cases: a null URL or one without ``://`` has empty host and path and
gets the default verdict; repeated rows are judged alike and all returned;
empty tables give empty results; the output has the fixed columns below, so
clashing extra input columns do no harm.
"""

from __future__ import annotations

import json
import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_RULES = 100_000       # more rules are joined without the broadcast hint
# a site rule sees the path as it is, a pattern rule in lower case
SUBJECT = f"CASE WHEN site THEN concat(host, path) ELSE translate(concat(host, path), '{string.ascii_uppercase}', '{string.ascii_lowercase}') END"
UPPER, LOW = string.ascii_uppercase, string.ascii_lowercase


@dataclass(frozen=True)
class Rule:
    text: str           # site rule: host/path; pattern rule: literal with *
    action: str         # allow or block
    site: bool = True

    def regex(self) -> str:
        if self.site:
            return r"^(?:[^/]*\.)?" + re.escape(self.text)
        body = ".*".join(re.escape(p) for p in self.text.lower().split("*"))
        left, right = ("" if self.text.startswith("*") else "(?<![a-z0-9])"), ("" if self.text.endswith("*") else "(?![a-z0-9])")
        return "(?s)" + left + body + right

    def tokens(self) -> list[str]:
        """Literal tokens that a matching URL has as whole tokens."""
        text = self.text.lower()
        found = []
        for m in re.finditer("[a-z0-9]+", text):
            before, after = text[:m.start()][-1:], text[m.end():][:1]
            open_end = self.site and not after          # a path prefix may go on inside a token
            if "*" not in (before, after) and not open_end:
                found.append(m.group())
        return sorted(set(found))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOW)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): between the first ``://`` and ``/ ? #``, then up to ``? #``; both empty without ``://``."""
    rest = F.when(F.locate("://", F.coalesce(url, F.lit(""))) > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def url_tokens(subject: Column) -> Column:
    return F.array_distinct(F.filter(F.split(lower_ascii(subject), "[^a-z0-9]+"), lambda t: t != ""))


def rule_index(spark: SparkSession, rules: list[Rule], tokens: DataFrame) -> DataFrame:
    """(token, rank, site, text, regex, action) under the rarest token of each rule."""
    listed = [dict(rank=i, site=r.site, text=r.text, regex=r.regex(), action=r.action, token=t)
              for i, r in enumerate(rules) for t in (r.tokens() or [""])]
    # as a literal: the rule list is a parameter, and no Python runs on the executors
    rows = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(listed)),
        "array<struct<rank:int,site:boolean,text:string,regex:string,action:string,token:string>>")))
    df = tokens.join(_small(rows.select("token").distinct(), len(rules)), "token", "left_semi").groupBy("token").count()
    counted = rows.join(_small(df, len(rules)), "token", "left").fillna(0, ["count"])
    return (counted.groupBy("rank", "site", "text", "regex", "action")
            .agg(F.min(F.struct("count", "token")).alias("rarest")).select(F.col("rarest.token").alias("token"), "rank", "site", "text", "regex", "action"))


def _small(df: DataFrame, rules: int) -> DataFrame:
    """Broadcast what is no larger than the rule list, while that is small."""
    return F.broadcast(df) if rules <= MAX_BROADCAST_RULES else df


def judge(df: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, method_rule (the pattern rule that fits, else null)."""
    host, path = split_url(F.col(f"`{url}`"))
    pages = df.select(F.col(f"`{key}`").alias("__key"), host.alias("host"), path.alias("path"))
    sites = pages.select("host", "path").distinct()
    has_open = any(not r.tokens() for r in rules)
    subject = F.concat("host", "path")
    words = F.array_union(url_tokens(subject), F.array(F.lit(""))) if has_open else url_tokens(subject)
    tokens = sites.select("host", "path", F.explode(words).alias("token"))
    index = rule_index(df.sparkSession, rules, tokens)
    hits = (tokens.join(_small(index, len(rules)), "token").where(F.expr(SUBJECT + " RLIKE regex"))
            .groupBy("host", "path").agg(
                F.max(F.when(F.col("site"), F.struct(F.length("text").alias("n"), F.col("text"), F.col("action")))).alias("s"),
                F.min(F.when(~F.col("site"), F.struct("rank", "text", "action"))).alias("p")))
    return (pages.join(hits, ["host", "path"], "left")
            .select(F.col("__key").alias(key), "host", "path", F.col("s.text").alias("rule"),
                    F.coalesce("s.action", "p.action", F.lit(default)).alias("verdict"), F.col("p.text").alias("method_rule")))
