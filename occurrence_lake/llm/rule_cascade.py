"""Quality rules as a short-circuit cascade.

A *fact* is a number of a whole text (words, characters of words, symbols,
repeated lines, repeated windows, ...); a *rule* rejects a text by its facts.
On a sample (``SAMPLE_ROWS`` rows in expectation, at most twice as many) one
job counts which rules reject which rows, and one short job a rule takes its
time.  The rules are then put in order: always next the one that rejects
most of the sampled rows still left per second.  The cascade is one lazy
``CASE``: a text that a rule rejects is not looked at by the rules behind
it.  The sample decides the order alone, never a verdict: whatever the
order, the same texts are kept.

DataFrame functions only.  The scan is map only; equal windows of words are
found by sorting a text's windows by hash and then by their words.

Defined results: null and empty texts have no words and are rejected by
``few words``; repeated rows give repeated results; an empty table gives an
empty result; ``judged`` and ``kept_rows`` pass on all columns of the input,
of any name.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurrence_lake.llm.common import let, written

SAMPLE_ROWS = 2000
WINDOW = 8
#: A rule's seconds on the sample are taken as at least this (clock noise).
LEAST_SECONDS = 0.005

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))


def duplicate_lines(text: Column) -> Column:
    return let(lines_of(text), lambda a: F.size(a) - F.size(F.array_distinct(a)))


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words that stand in a window of ``size`` words found twice or more."""

    def positions(hashes: Column) -> Column:
        """Starts of repeated windows: sorted, equal windows are neighbours."""
        windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), F.slice(words, i + 1, size).alias("w"), i.alias("i"))))
        same = lambda a, b: (a["h"] == b["h"]) & (a["w"] == b["w"])
        return let(windows, lambda a: F.sort_array(F.transform(
            F.filter(a, lambda e, k: F.coalesce(same(e, F.get(a, k - 1)), F.lit(False)) | F.coalesce(same(e, F.get(a, k + 1)), F.lit(False))),
            lambda e: e["i"])))

    def covered(starts: Column) -> Column:
        return F.aggregate(F.transform(starts, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(starts, k + 1) - p, F.lit(size)))),
                           F.lit(0), lambda a, b: a + b)

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size)))
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(positions(h), covered)))
    return F.when(F.size(words) > size, found).otherwise(0)


#: fact -> its expression over a text and its words.
FACTS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words),
    "word_chars": lambda text, words: F.length(F.array_join(words, "")),
    "n_symbols": lambda text, words: F.regexp_count(text, F.lit(SYMBOLS)),
    "n_dup_lines": lambda text, words: duplicate_lines(text),
    "n_repeat_words": lambda text, words: repeated_words(words),
    "n_lines": lambda text, words: F.size(lines_of(text)),
    "n_letter_words": lambda text, words: F.size(F.filter(words, lambda w: w.rlike(r"[A-Za-z\x{80}-\x{10FFFF}]"))),
    "n_bullet_lines": lambda text, words: F.regexp_count(text, F.lit(r"(?m)^[ \t]*[-*•]")),
    "n_open_lines": lambda text, words: F.regexp_count(text, F.lit(r"(?m)(\.\.\.|…)[ \t]*$")),
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Callable[[str], Column]], Column]  # of a function from fact names to columns
    base: bool = False


#: Fixed rules of the contract.
BASE_RULES = [
    Rule("few words", lambda f: f("n_words") < 20, True),
    Rule("repeated windows", lambda f: 100 * f("n_repeat_words") > 30 * f("n_words"), True),
]
#: The method's own rules.
RULES = BASE_RULES + [
    Rule("symbols", lambda f: 10 * f("n_symbols") > f("n_words")),
    Rule("word length", lambda f: (f("word_chars") < 3 * f("n_words")) | (f("word_chars") > 10 * f("n_words"))),
    Rule("repeated lines", lambda f: 10 * f("n_dup_lines") > 4 * f("n_lines")),
    Rule("words without letters", lambda f: 10 * f("n_letter_words") < 6 * f("n_words")),
    Rule("bullet lines", lambda f: 10 * f("n_bullet_lines") > 9 * f("n_lines")),
    Rule("open lines", lambda f: 10 * f("n_open_lines") > 3 * f("n_lines")),
]


def fact_columns(text: Column, words: Column, known: dict[str, Column] | None = None) -> Callable[[str], Column]:
    """Facts by name: those ``known`` already, others worked out in place."""
    return lambda name: (known or {})[name] if name in (known or {}) else FACTS[name](text, words)


def first_rejecting(rules: list[Rule], facts: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects; null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.rejects(facts), rule.name).otherwise(out)
    return out


def text_column(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def by_rejection_per_cost(patterns: dict[tuple[bool, ...], int], seconds: list[float]) -> list[int]:
    """Places of the rules, best first.  ``patterns``: sampled rows by which
    rules reject them; each rule counts what the ones before it have left."""
    left, out = dict(patterns), []
    while len(out) < len(seconds):
        rest = [i for i in range(len(seconds)) if i not in out]
        worth = {i: sum(n for p, n in left.items() if p[i]) / max(seconds[i], LEAST_SECONDS) for i in rest}
        best = max(rest, key=lambda i: (worth[i], -seconds[i], -i))
        out.append(best)
        left = {p: n for p, n in left.items() if not p[best]}
    return out


def ordered(df: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order that the sample suggests."""
    total = df.count()
    if not total or len(rules) < 2:
        return list(rules)
    texts = df.select(text_column(text_col).alias("text"))
    sample = written(texts.where(F.rand(17) < min(1.0, sample_rows / total)).limit(2 * sample_rows), "rule-sample")
    of = lambda body: let(words_of(F.col("text")), lambda w: body(fact_columns(F.col("text"), w)))

    def timed(body) -> float:
        spent = []
        for _ in range(2):  # the first run compiles
            began = time.perf_counter()
            sample.agg(F.max(of(body))).collect()
            spent.append(time.perf_counter() - began)
        return min(spent)

    plain = timed(lambda f: f("n_words") < 0)
    seconds = [max(0.0, timed(rule.rejects) - plain) for rule in rules]
    verdicts = sample.select(of(lambda f: F.array(*[F.coalesce(r.rejects(f), F.lit(False)) for r in rules])).alias("p"))
    patterns = {tuple(r["p"]): r["count"] for r in verdicts.groupBy("p").count().collect()}  # no more than sampled rows
    return [rules[i] for i in by_rejection_per_cost(patterns, seconds)]


def judged(df: DataFrame, rules: list[Rule] = RULES, text_col: str = "text", out_col: str = "judged", facts: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a struct column ``out_col``: the named ``facts`` as longs
    and ``rejected_by``, the first rule of the cascade that rejects (null:
    kept)."""
    cascade = ordered(df, rules, text_col)

    def result(text: Column, words: Column) -> Column:
        known = F.struct(*[FACTS[name](text, words).cast("long").alias(name) for name in facts], F.lit(0).alias("_"))
        return let(known, lambda k: F.struct(*[k[name].alias(name) for name in facts], first_rejecting(
            cascade, fact_columns(text, words, {name: k[name] for name in facts})).alias("rejected_by")))

    value = let(text_column(text_col), lambda text: let(words_of(text), lambda words: result(text, words)))
    return df.withColumn(out_col, value)


def kept_rows(df: DataFrame, rules: list[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that no rule rejects."""
    cascade = ordered(df, rules, text_col)
    verdict = let(text_column(text_col), lambda text: let(words_of(text), lambda words: first_rejecting(cascade, fact_columns(text, words))))
    return df.where(verdict.isNull())
