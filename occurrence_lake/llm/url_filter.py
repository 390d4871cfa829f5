"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path + query + fragment`` (the part of a
url after ``://``, host in lower case):

* ``||text`` starts at the host or at one of its subdomain labels,
* ``|text`` starts at the beginning,
* ``*`` stands for any characters, ``^`` for one separator or the end,
* everything else is literal.

Every literal token of a rule that must appear as a whole token of a
matching url is a possible index key.  One pass over the urls counts those
tokens (a bounded number: the rules' own); each rule is filed under its
rarest.  A url's tokens fetch candidate rules from the index, and only
their regular expressions run.  Rules without a usable token are tried on
every url.

Of the matching rules the lowest tier wins, then the longest pattern, then
block before allow.  The index travels in the task closure; its size is
checked (``MAX_RULE_BYTES``).

Defined results: a null url or one without ``://`` has an empty host and
path and matches no rule, so it gets the default verdict; repeated rows give
repeated results; an empty table or an empty rule list is fine; further
columns of the input, of any name, are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurrence_lake.llm.common import ship

MAX_RULE_BYTES = 32 << 20
_TOKEN = re.compile("[a-z0-9%]+")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    text: str        # shown in the result
    pattern: str
    action: str      # allow or block
    tier: int = 0

    def regex(self) -> str:
        body, start = self.pattern, ""
        if body.startswith("||"):
            body, start = body[2:], r"^(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, start = body[1:], "^"
        steps = {"*": ".*", "^": r"(?:[^A-Za-z0-9%._-]|$)"}
        return start + "".join(steps.get(c) or re.escape(c) for c in body)

    def tokens(self) -> list[str]:
        """Tokens that stand whole in every matching url: both neighbours in
        the pattern are separators or an anchor."""
        anchored = self.pattern.startswith("|")
        body = self.pattern.lstrip("|").lower()
        out = []
        for m in _TOKEN.finditer(body):
            left = body[m.start() - 1] if m.start() else ""
            right = body[m.end()] if m.end() < len(body) else "*"
            if left != "*" and right != "*" and (left or anchored):
                out.append(m.group())
        return out


def domain_rule(text: str, action: str, tier: int = 0) -> Rule:
    """``host/path``: fits the host and all subdomains, by path prefix."""
    return Rule(text, "||" + text, action, tier)


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host``, ``path`` and ``subject`` (host and all that follows)."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    raw = F.regexp_extract(rest, "^([^/?#]*)", 1)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    host = F.translate(raw, _UPPER, _UPPER.lower())
    return (df.withColumn("host", host)
            .withColumn("path", F.regexp_extract(after, "^([^?#]*)", 1))
            .withColumn("subject", F.concat(host, after)))


def token_counts(df: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How often each of the rules' tokens occurs in all urls."""
    if not tokens:
        return {}
    found = df.select(F.explode(F.array_distinct(F.split(F.lower("subject"), "[^a-z0-9%]+"))).alias("token"))
    rows = found.where(F.col("token").isin(sorted(tokens))).groupBy("token").count().collect()  # one row a rule token
    return {r["token"]: r["count"] for r in rows}


def build_index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """(token -> rules, rules tried on every url)."""
    if sum(len(r.text) + len(r.pattern) for r in rules) > MAX_RULE_BYTES:
        raise ValueError(f"the rules exceed {MAX_RULE_BYTES} bytes; split the list")
    index: dict[str, list[int]] = defaultdict(list)
    always = []
    for i, r in enumerate(rules):
        if own := r.tokens():
            index[min(own, key=lambda t: (counts.get(t, 0), -len(t), t))].append(i)
        else:
            always.append(i)
    return dict(index), always


def judge_urls(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``rule`` (text of the
    winning rule), ``tier`` and ``verdict``."""
    parts = with_parts(df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))).drop("url")
    id_type = df.schema[id_col].dataType.simpleString()
    index, always = build_index(rules, token_counts(parts, {t for r in rules for t in r.tokens()}))
    rank = sorted(range(len(rules)), key=lambda i: (rules[i].tier, -len(rules[i].pattern), rules[i].action != "block", rules[i].text))
    place = {i: n for n, i in enumerate(rank)}

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[int, re.Pattern] = {}

        def winner(subject: str) -> int | None:
            candidates = {i for t in set(_TOKEN.findall(subject.lower())) for i in index.get(t, ())}
            for i in sorted({*candidates, *always}, key=place.__getitem__):
                if i not in compiled:
                    compiled[i] = re.compile(rules[i].regex(), re.S)
                if compiled[i].search(subject):
                    return i
            return None

        for batch in batches:
            won = [winner(s) if s else None for s in batch.column(3).to_pylist()]
            columns = [batch.column(0), batch.column(1), batch.column(2),
                       pa.array([None if i is None else rules[i].text for i in won], pa.string()),
                       pa.array([None if i is None else rules[i].tier for i in won], pa.int32()),
                       pa.array([default if i is None else rules[i].action for i in won], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "host", "path", "rule", "tier", "verdict"])

    out = parts.mapInArrow(judged, f"id {id_type}, host string, path string, rule string, tier int, verdict string")
    return out.withColumnRenamed("id", id_col)


ship(__name__)
