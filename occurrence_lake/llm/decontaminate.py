"""Benchmark decontamination by winnowing.

A *window* is ``WINDOW`` consecutive words of a benchmark item (a shorter
item is one window).  Both sides are winnowed: of every ``SPAN`` consecutive
``GRAM``-word hashes the smallest is kept, so two texts that share a window
(``GRAM + SPAN - 1`` words) share a kept hash inside it.  Kept hashes of the
documents that a bitmap of the benchmark's does not rule out (its size is
fixed; it only spares rows, the join decides) join those of the benchmark,
with the words around them, so texts are read once and never shuffled.  A
hit is extended word by word to both sides, as far as windows around it can reach; runs of
at least a window are hit words.  So every shared window is found, and hash
collisions are not.

Items shorter than a window are one hash of all their words, and documents
give the hashes of all their runs of such lengths, if there are any.

DataFrame functions only.  Documents are told apart by id and text.

Defined results: null text has no words; a document without words is not
contaminated; repeated documents give repeated results; repeated items count
once; items without words or id are ignored; an empty table gives an empty
result, an empty benchmark no hits; further columns of the inputs, of any
name, are ignored.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurrence_lake.llm.common import contract_words, let, rows_of, written

WINDOW, GRAM = 13, 6
SPAN = WINDOW - GRAM + 1
FILTER_BITS = 20
REACH = WINDOW - GRAM  # words beyond a kept gram that a window around it can hold


def gram_hashes(h: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` of the word hashes ``h``."""
    return F.when(F.size(h) >= n, F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(n)]))
                  ).otherwise(F.array().cast("array<bigint>"))


def sliding(values: Column, span: int, ahead: bool, pick) -> Column:
    """Sliding least or greatest over ``span`` (a power of two) elements, by
    doubling; windows are cut off at the ends."""
    def step(width: int):
        if ahead:
            return lambda v: F.transform(v, lambda x, i: pick(x, F.get(v, i + width)))
        return lambda v: F.transform(v, lambda x, i: F.when(i < width, x).otherwise(pick(x, F.get(v, F.greatest(i - width, F.lit(0))))))

    out, width = values, 1
    while width < span:
        out, width = let(out, step(width)), 2 * width
    return out


def winnowed(h: Column) -> Column:
    """(len, pos, hash) of the kept grams: those that are the least of some
    span of ``SPAN`` grams.  Spans cut off at the end keep a few more."""
    def of(g: Column) -> Column:
        least = sliding(g, SPAN, True, F.least)          # of the span that starts here
        most = sliding(least, SPAN, False, F.greatest)   # over the spans that hold this gram
        kept = let(most, lambda m: F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: F.get(g, i) == F.get(m, i)))
        return F.when(F.size(g) > 0, F.transform(kept, lambda i: F.struct(F.lit(WINDOW).alias("len"), i.alias("pos"), F.get(g, i).alias("hash"))))

    return F.coalesce(let(gram_hashes(h, GRAM), of), F.array().cast("array<struct<len:int,pos:int,hash:bigint>>"))


def short_runs(h: Column, n: int) -> Column:
    return F.transform(gram_hashes(h, n), lambda x, i: F.struct(F.lit(n).alias("len"), i.alias("pos"), x.alias("hash")))


def prints(words: Column, lengths: list[int]) -> Column:
    """Everything a document is looked up by."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: reduce(F.concat, [winnowed(h), *[short_runs(h, n) for n in lengths]]))


def context(words: Column, length: Column, pos: Column) -> Column:
    """The words that a window around a gram can hold (null beyond the
    text); of a short run: its words."""
    wide = F.transform(F.sequence(F.lit(-REACH), F.lit(GRAM + REACH - 1)), lambda j: F.when(pos + j >= 0, F.get(words, F.greatest(pos + j, F.lit(0)))))
    return F.when(length == WINDOW, wide).otherwise(F.slice(words, pos + 1, length))


def benchmark_index(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item``, ``len``, ``hash`` and ``ctx`` of every kept hash."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), contract_words(F.col(text_col).cast("string")).alias("words"))
    items = items.where(F.col("item").isNotNull() & (F.size("words") > 0))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    keys = F.when(F.size("words") >= WINDOW, winnowed(hashes)).otherwise(
        F.array(F.struct(F.size("words").alias("len"), F.lit(0).alias("pos"), F.xxhash64(*[F.get(hashes, F.lit(j)) for j in range(WINDOW - 1)]).alias("hash"))))
    return (items.select("item", "words", F.explode(keys).alias("k"))
            .select("item", "k.len", "k.hash", context(F.col("words"), F.col("k.len"), F.col("k.pos")).alias("ctx")).distinct())


def hash_bits(index: DataFrame) -> Column:
    """The benchmark's hashes as a constant bitmap of ``2 ** FILTER_BITS``
    bits, whatever their number: at most ``2 ** (FILTER_BITS - 6)`` longs
    come to the driver."""
    n = 1 << (FILTER_BITS - 6)
    set_bits = index.groupBy(_long_of(F.col("hash")).alias("i")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit_of(F.col("hash")))).alias("v"))
    found = {r["i"]: r["v"] for r in set_bits.collect()}
    return F.from_json(F.lit(json.dumps([found.get(i, 0) for i in range(n)])), "array<bigint>")


def _long_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit((1 << (FILTER_BITS - 6)) - 1).cast("long")).cast("int")


def _bit_of(h: Column) -> Column:
    return h.bitwiseAND(F.lit(63).cast("long")).cast("int")


def candidates(words: Column, lengths: list[int], bits: Column) -> Column:
    """(len, pos, hash, own) of the prints that the benchmark's bitmap does
    not rule out, with the words around them."""
    def of(p: Column) -> Column:
        maybe = F.filter(p, lambda x: F.getbit(F.get(bits, _long_of(x["hash"])), _bit_of(x["hash"])) == 1)
        return F.transform(maybe, lambda x: F.struct(x["len"].alias("len"), x["pos"].alias("pos"), x["hash"].alias("hash"),
                                                     context(words, x["len"], x["pos"]).alias("own")))

    return let(prints(words, lengths), of)


def hit_words(table: DataFrame, index: DataFrame) -> DataFrame:
    """``id``, ``th``, ``item``, ``lo``, ``hi``: runs of hit words, from the
    candidates of ``table`` joined with the benchmark's hashes."""
    around = table.select("id", "th", F.explode("candidates").alias("p")).select("id", "th", "p.*")
    same = F.zip_with("own", "ctx", lambda a, b: F.coalesce(a == b, F.lit(False)))
    run = lambda part: F.when(F.array_contains(part, False), F.array_position(part, F.lit(False)) - 1).otherwise(F.size(part)).cast("int")
    pairs = around.join(index, ["len", "hash"]).withColumn("same", same)
    pairs = pairs.withColumn("left", run(F.reverse(F.slice("same", 1, REACH)))).withColumn("right", run(F.slice("same", REACH + GRAM + 1, REACH)))
    wide = F.col("len") == WINDOW
    fits = F.when(wide, ~F.array_contains(F.slice("same", REACH + 1, GRAM), False) & (F.col("left") + F.col("right") + GRAM >= WINDOW)
                  ).otherwise(~F.array_contains("same", False))
    return (pairs.where(fits).select("id", "th", "item", F.when(wide, F.col("pos") - F.col("left")).otherwise(F.col("pos")).alias("lo"),
                                     F.when(wide, F.col("pos") + GRAM - 1 + F.col("right")).otherwise(F.col("pos") + F.col("len") - 1).alias("hi")))


def judged(df: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, least_share: tuple[int, int]) -> DataFrame:
    """``id``, ``th`` and the result columns of every row of ``df``."""
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    index = written(benchmark_index(benchmark), "decontaminate-index")
    lengths = sorted(r["len"] for r in index.where(F.col("len") < WINDOW).select("len").distinct().collect())  # at most WINDOW - 1
    bits = hash_bits(index)
    table = written(docs.select("id", "th", let(contract_words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), candidates(w, lengths, bits).alias("candidates"))).alias("r")).select("id", "th", "r.*"), "decontaminate-candidates")
    runs = written(hit_words(table, index).distinct(), "decontaminate-runs")
    words = (runs.select("id", "th", "lo", "hi").distinct().select("id", "th", F.explode(F.sequence("lo", "hi")).alias("at")).distinct()
             .groupBy("id", "th").agg(F.count("*").alias("n_hit")))
    items = runs.groupBy("id", "th").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hit = (words.withColumnsRenamed({"id": "w_id", "th": "w_th"}).join(items, F.col("w_id").eqNullSafe(F.col("id")) & (F.col("w_th") == F.col("th")))
           .select("w_id", "w_th", "n_hit", "items"))
    out = table.select("id", "th", "n_words").join(hit, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("th") == F.col("w_th")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    found = F.coalesce("items", F.array().cast("array<string>"))
    part, of = least_share
    return out.select("id", "th", "n_words", n_hit.alias("n_hit"), F.size(found).cast("long").alias("n_items"),
                      F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
                      ((n_hit > 0) & (of * n_hit >= part * F.col("n_words"))).alias("contaminated"))


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least_share: tuple[int, int] = (1, 20)) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256``, ``contaminated`` (a hit, and hit words at least
    ``least_share`` of all)."""
    return judged(df, benchmark, id_col, text_col, least_share).drop("th").withColumnRenamed("id", id_col)


def decontaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   least_share: tuple[int, int] = (1, 20)) -> DataFrame:
    """The rows of ``df`` that are not contaminated."""
    bad = judged(df, benchmark, id_col, text_col, least_share).where("contaminated")
    keys = written(bad.select("id", "th").distinct(), "contaminated")
    return rows_of(df, keys, "left_anti", id_col, text_col)
