"""License scans with a positional rare-token index.

A template is a sequence of words with a mandatory key phrase inside and a
label.  One pass over all documents counts in how many of them each key word
occurs; every template is filed under the word of its key phrase with the
highest IDF.  A document's words fetch postings from that index (a literal
map in the plan: templates are a parameter of bounded size, not data), a
posting and its word's position give the place where the template would
stand, the words there are intersected with the template's by relative
position, and the key phrase has to stand whole.  A place counts if at least
``least_share`` of the template's words stand where they should.

DataFrame functions only; map only but for the word counts.

Defined results: null or empty text has no words and no places; labels are a
set and the score is the best share, so templates that tie need no order;
repeated rows give repeated results; an empty table gives an empty result; further
columns of the input, of any name, are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurrence_lake.llm.common import contract_words, let
from occurrence_lake.llm.license_notices import NOTICES

MAX_TEMPLATE_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    words: str          # space-separated, lower case
    key: str            # a run of ``words``
    base: bool = False

    @property
    def key_offset(self) -> int:
        words, key = self.words.split(), self.key.split()
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


def phrase(label: str, words: str) -> Template:
    return Template(label, words, words, True)


def words_of(text: str) -> str:
    """A text's words as the operator takes them, joined by spaces."""
    return " ".join(re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split())


#: The method's own templates: notices, headings and SPDX lines.
TEMPLATES = [Template(label, words_of(notice), key) for label, key, notice in NOTICES]


def word_frequencies(texts: DataFrame, words: set[str]) -> tuple[dict[str, int], int]:
    """(documents in which each of ``words`` occurs, all documents)."""
    own = texts.select(F.filter(F.array_distinct(contract_words(F.col("text"))), lambda w: w.isin(sorted(words))).alias("found"))
    counted = own.select(F.explode(F.concat("found", F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()  # a row a key word
    counts = {r["word"]: r["count"] for r in counted}
    return counts, counts.pop("", 0)


def rarest_key_word(t: Template, counts: dict[str, int]) -> tuple[str, int]:
    """The key word of the highest IDF and its place in the template."""
    key = t.key.split()
    i = min(range(len(key)), key=lambda i: (counts.get(key[i], 0), -len(key[i]), i))
    return key[i], t.key_offset + i


def places(words: Column, templates: list[Template], counts: dict[str, int], least_share: float) -> Column:
    """Array of (base, label, at: start of the key phrase, share)."""
    postings: dict[str, list[Column]] = {}
    for t in templates:
        word, offset = rarest_key_word(t, counts)
        arr = lambda s: F.array(*map(F.lit, s.split()))
        postings.setdefault(word, []).append(F.struct(
            F.lit(t.base).alias("base"), F.lit(t.label).alias("label"), F.lit(offset).alias("offset"),
            F.lit(t.key_offset).alias("key_offset"), arr(t.key).alias("key"), arr(t.words).alias("words")))
    index = F.create_map(*[c for word, p in postings.items() for c in (F.lit(word), F.array(*p))])

    def of(w: Column) -> Column:
        hits = F.when(F.size(w) > 0, F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).isin(sorted(postings))))
        hits = F.coalesce(hits, F.array().cast("array<int>"))
        candidates = F.flatten(F.transform(hits, lambda i: F.transform(F.element_at(index, F.get(w, i)), lambda p: F.struct(
            (i - p["offset"]).alias("start"), p.alias("template")))))
        whole = F.filter(candidates, lambda c: (c["start"] >= -c["template"]["key_offset"]) & (c["start"] + c["template"]["key_offset"] >= 0)
                         & (F.slice(w, F.greatest(c["start"] + c["template"]["key_offset"], F.lit(0)) + 1, F.size(c["template"]["key"])) == c["template"]["key"]))
        found = F.transform(whole, lambda c: F.struct(
            c["template"]["base"].alias("base"), c["template"]["label"].alias("label"), (c["start"] + c["template"]["key_offset"]).cast("long").alias("at"),
            (F.size(F.filter(F.transform(c["template"]["words"], lambda x, j: (c["start"] + j >= 0) & (x == F.get(w, F.greatest(c["start"] + j, F.lit(0))))), lambda b: b))
             / F.size(c["template"]["words"])).alias("share")))
        return F.filter(found, lambda f: f["share"] >= least_share)

    return let(words, of)


def scan(df: DataFrame, templates: list[Template], id_col: str = "doc_id", text_col: str = "text",
         least_share: float = 0.6) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score`` (best share)."""
    if sum(len(t.words.split()) for t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"the templates exceed {MAX_TEMPLATE_WORDS} words; scan with parts of the list")
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts, _ = word_frequencies(texts.select("text"), {w for t in templates for w in t.key.split()})
    words = contract_words(F.col("text"))
    made = texts.select("id", let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), places(w, templates, counts, least_share).alias("places"))).alias("r"))
    base = F.filter(F.col("r.places"), lambda p: p["base"])
    labels = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["at"])
    return made.select(F.col("id").alias(id_col), F.col("r.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
                       F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                       labels(base).alias("base_labels"), labels(F.col("r.places")).alias("labels"),
                       F.coalesce(F.array_max(F.transform(F.col("r.places"), lambda p: p["share"])), F.lit(0.0)).alias("score"))
