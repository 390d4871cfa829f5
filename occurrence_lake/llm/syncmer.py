"""Document fingerprints from closed syncmers.

Words are runs of non-space characters (cut after ``WORD_CHARS``).  A k-mer
is ``k`` consecutive words; it is kept if the smallest hash among its inner
runs of ``s`` words lies at its first or last run.  Whether a k-mer is kept
depends on its own words alone, so equal passages keep equal *anchors*
wherever they stand, and their positions line up (``anchors``,
``aligned``).  A text of which no k-mer is kept has one anchor, its whole
word sequence.

A text's fingerprint is all its anchors with their positions.  The string
that names it holds the ``SKETCH`` smallest distinct anchor hashes, for
look-ups, and an exact digest of all anchors with their positions: written
out whole it would be as long as the text.

The *likeness* of two fingerprints comes from all anchors of both, not from
those strings: those that are
equal at one shift of the positions, of all anchors of either.  Shifts that
are tried, each counted exactly: equal starts, equal ends, and the commonest
distance between the first places of the anchors that both have.  Passages
in another order line up one by one, not together; in texts that repeat
their own anchors another shift may line up more, so the likeness is then a
lower bound.

DataFrame functions only.

Defined results: a null text counts as empty; an empty text (no words) has
an empty fingerprint, like another empty one by 1 and any other by 0;
repeated rows are neighbours of each other and give a result each; a null id
sorts after all others; an empty table gives an empty result; further
columns of the input, of any name, are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occurrence_lake.llm.common import let

K, S = 4, 2
SKETCH = 64
WORD_CHARS = 32
CELLS = 8        # id cells of which a range is made
ROW_BYTES = 64   # what a row costs beside its text, for ranges of equal size


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"\S{{1,{WORD_CHARS}}}"), F.lit(0))


def run_hash(h: Column, i: Column, n: int) -> Column:
    """Hash of the ``n`` word hashes from place ``i`` on."""
    return F.xxhash64(*[F.get(h, i + j) for j in range(n)])


def positions(h: Column, k: int = K, s: int = S) -> Column:
    """Places of the closed syncmers among word hashes ``h``."""
    def closed(r: Column) -> Column:
        def at_edge(i: Column) -> Column:
            inner = [F.get(r, i + j) for j in range(1, k - s)]
            edges = F.least(F.get(r, i), F.get(r, i + (k - s)))
            return edges <= (F.least(*inner) if len(inner) > 1 else inner[0])

        return F.filter(F.sequence(F.lit(0), F.size(h) - k), at_edge)

    runs = F.transform(h, lambda x, i: run_hash(h, i, s))
    return F.when(F.size(h) >= k, let(runs, closed)).otherwise(F.array().cast("array<int>"))


def worded_anchors(text: Column) -> Column:
    """Struct of the number of ``words`` of a text and its ``anchors``, an
    array of (pos, hash)."""
    def of(h: Column) -> Column:
        kept = F.transform(positions(h), lambda i: F.struct(i.alias("pos"), run_hash(h, i, K).alias("hash")))
        whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(h).alias("hash")))
        return F.struct(F.size(h).alias("words"), let(kept, lambda a: F.when((F.size(a) > 0) | (F.size(h) == 0), a).otherwise(whole)).alias("anchors"))

    return let(F.transform(words_of(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w)), of)


def sketch(anchors: Column) -> Column:
    """The smallest distinct anchor hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(anchors["hash"])), 1, SKETCH)


def fingerprint(anchors: Column) -> Column:
    """Sketch and, after a colon, the digest of all (position, hash)."""
    def of(a: Column) -> Column:
        every = F.array_join(F.transform(a, lambda x: F.concat_ws(" ", x["pos"].cast("string"), x["hash"].cast("string"))), ",")
        least = F.lower(F.array_join(F.transform(sketch(a), F.hex), "."))
        return F.when(F.size(a) == 0, F.lit("")).otherwise(F.concat(least, F.lit(":"), F.sha2(every, 256)))

    return let(anchors, of)


def first_shift(a: Column, b: Column) -> Column:
    """The commonest distance from the first place of an anchor in ``a`` to
    its first place in ``b`` (null without a common anchor)."""
    def tagged(x: Column, side: int) -> Column:
        # A hash's places in a descend, those in b ascend: the two first ones meet.
        return F.transform(x, lambda p: F.struct(p["hash"].alias("hash"), F.lit(side).alias("side"), (p["pos"] if side else -p["pos"]).alias("at")))

    def shifts(s: Column) -> Column:
        meets = F.filter(F.sequence(F.lit(0), F.size(s) - 2), lambda i: (F.get(s, i)["hash"] == F.get(s, i + 1)["hash"]) & (F.get(s, i)["side"] < F.get(s, i + 1)["side"]))
        return F.sort_array(F.transform(meets, lambda i: F.get(s, i)["at"] + F.get(s, i + 1)["at"]))

    def commonest(d: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(d) - 1), lambda i: (i == 0) | (F.get(d, i) != F.get(d, i - 1)))
        runs = lambda st: F.transform(st, lambda i, k: F.struct((F.coalesce(F.get(st, k + 1), F.size(d)) - i).alias("n"), F.get(d, i).alias("shift")))
        return F.when(F.size(d) > 0, F.array_max(let(starts, runs))["shift"])

    return let(let(F.sort_array(F.concat(tagged(a, 0), tagged(b, 1))), shifts), commonest)


def likeness(a: Column, b: Column, shift_of_ends: Column) -> Column:
    """Anchors equal at one shift, of all anchors of two texts."""
    def of(a: Column, b: Column) -> Column:
        there = F.transform(b, lambda x: F.xxhash64(x["pos"], x["hash"]))
        counted = lambda t: F.array_max(F.transform(
            F.array_distinct(F.array(F.lit(0), shift_of_ends, F.coalesce(first_shift(a, b), F.lit(0)))),
            lambda d: F.size(F.array_intersect(F.transform(a, lambda x: F.xxhash64(x["pos"] + d, x["hash"])), t))))
        return F.when(F.arrays_overlap(a["hash"], b["hash"]), let(there, counted)).otherwise(F.lit(0))

    n = F.size(a) + F.size(b)
    return F.when(n == 0, F.lit(1.0)).otherwise(let(of(a, b), lambda m: m / (n - m)))


def anchors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``pos`` (word) and ``hash`` of every anchor."""
    return (df.select(F.col(id_col), F.explode(worded_anchors(F.col(text_col).cast("string"))["anchors"]).alias("a"))
            .select(id_col, "a.pos", "a.hash"))


def aligned(left: DataFrame, right: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Anchors that two sets of texts share, by the distance of their
    positions: ``id``, ``other``, ``shift``, ``n`` anchors."""
    other = right.select(F.col(id_col).alias("other"), F.col("pos").alias("other_pos"), "hash")
    return (left.join(other, "hash").groupBy(F.col(id_col).alias("id"), "other", (F.col("other_pos") - F.col("pos")).alias("shift"))
            .agg(F.count("*").alias("n")))


def literal(values, item: str = "bigint") -> Column:
    """A constant array that the planner sees as one value."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{item}>")


def rank_in(bounds: list[int], x: Column) -> Column:
    """How many of the ascending ``bounds`` are below ``x``: a binary search,
    so the cost grows with the logarithm of their number."""
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    if not bounds:
        return F.lit(0)
    there = literal(bounds)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(F.get(there, at + step - 1) < x, at + step).otherwise(at))


def id_ranges(df: DataFrame, id_col: str, size_col: str, n: int) -> tuple[list[int], list[int | None]]:
    """At most ``n`` ranges of ids of about equal summed sizes: upper bounds
    of all but the last, and the largest id of each.  Quantiles of the ids
    (their accuracy follows ``n``) make ``CELLS`` cells a range; the cells'
    sizes are added in Spark and neighbours joined here, a row a cell."""
    cells = CELLS * n
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.octet_length(size_col).alias("size"))
    cuts = rows.agg(F.percentile_approx("id", literal([i / cells for i in range(1, cells)], "double"), max(10_000, 4 * cells)).alias("c")).first()["c"]
    cell = F.coalesce(rank_in(sorted(set(cuts or [])), F.col("id")), F.lit(0))
    sizes = sorted(rows.groupBy(F.when(F.col("id").isNull(), -1).otherwise(cell).alias("cell"))
                   .agg(F.max("id").alias("top"), F.sum(F.col("size") + ROW_BYTES).alias("size")).collect())
    share, tops, filled, total = sum(r["size"] or 0 for r in sizes) / n, [], 0, 0
    for r in sizes:
        size = r["size"] or 0
        if tops and int((total + size / 2) / share) == filled:
            tops[-1] = r["top"]
        else:
            tops.append(r["top"])
            filled = int((total + size / 2) / share)
        total += size
    return [t for t in tops[:-1] if t is not None], tops


def with_next(df: DataFrame, id_col: str, carried: list[str], tie: str, size_col: str, also=lambda d: d) -> DataFrame:
    """Adds ``next_<c>`` for each carried column: its value in the row of the
    next smaller id (after the smallest: the largest id).  ``also`` may add
    columns to each row, which can be carried too.

    Ids are cut into ranges of about equal bytes, a task each; a window runs
    in each range, and the first row of a range also goes, as a sentinel, to
    the range before it.  One shuffle, no global sort; what the driver sees
    is a number of ids that depends on the partitions, not on the rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, tops = id_ranges(df, id_col, size_col, n)
    if not tops:
        empty = also(df)
        return empty.select("*", *[F.lit(None).cast(empty.schema[c].dataType).alias(f"next_{c}") for c in carried])
    # Null ids sort last: they end the lowest range, and lead it if alone there.
    if tops[0] is None and len(tops) > 1:
        tops = tops[1:]
    dealt = df.select("*", F.col(id_col).cast("bigint").alias("_id"))
    dealt = dealt.select("*", F.coalesce(F.when(F.col("_id").isNull(), 0).otherwise(rank_in(bounds, F.col("_id"))), F.lit(0)).alias("_bucket"))
    above = (F.col("_bucket") + 1) % len(tops)  # its range's first row ends the range above
    copies = F.concat(F.array(F.struct(F.col("_bucket").alias("range"), F.lit(False).alias("sentinel"))),
                      F.when(F.col("_id").eqNullSafe(F.get(literal(tops), F.col("_bucket"))), F.array(F.struct(above.alias("range"), F.lit(True).alias("sentinel"))))
                      .otherwise(F.array().cast("array<struct<range:int,sentinel:boolean>>")))
    dealt = dealt.select(*df.columns, "_id", F.inline(copies)).repartitionById(n, "range")
    order = ["sentinel", F.desc_nulls_last("_id"), tie]
    # Sorted first, so that what ``also`` adds is made after shuffle and sort.
    dealt = also(dealt.sortWithinPartitions("range", *order))
    w = Window.partitionBy("range").orderBy(*order)
    out = dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
    return out.where(~F.col("sentinel")).drop("_id", "range", "sentinel")


def neighbour_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (its last third of
    code points replaced by the first as many of the next document), and the
    likeness of the text to the edited text and to the next document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc"), text.alias("text"))
    rows = rows.select("doc", "text", F.xxhash64("text").alias("tie"))
    # Anchors are made after the shuffle, which so carries each text once, and once a text.
    near = with_next(rows, "doc", ["text", "own"], "tie", "text", lambda d: d.withColumn("own", worded_anchors(F.col("text"))))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    near = near.select("doc", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"))
    near = near.select("doc", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "next_own", worded_anchors(F.col("edited")).alias("new"))
    alike = lambda c: likeness(F.col("own.anchors"), F.col(f"{c}.anchors"), F.col(f"{c}.words") - F.col("own.words"))
    return near.select(F.col("doc").alias(id_col), "n_chars", "edited_sha256", fingerprint(F.col("own.anchors")).alias("fingerprint"),
                       fingerprint(F.col("new.anchors")).alias("edited_fingerprint"), alike("new").alias("near_edited"), alike("next_own").alias("near_next"))
