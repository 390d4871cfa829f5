"""SimHash near-duplicates through sharded BK-trees.

*Fingerprint.*  A-Z are lower-cased, words are runs of non-space characters,
shingles are ``shingle_words`` consecutive words joined by one space (fewer
words: the whole sequence), each hashed with XXH64.  A bit of the
fingerprint is set where over half of the hashes have it.

*Links.*  Two fingerprints link at ``radius`` or fewer differing bits.  The
64 bits are cut into ``radius + 2`` blocks; two linked fingerprints agree in
at least two whole blocks, so every pair of blocks with its value is a
*shard*, and linked fingerprints meet in one.  Only distinct fingerprints
are sharded: exact copies, however many, are one.  A shard's members are
dealt over trees of at most about ``TREE_SIZE`` by a hash, and each member
is sent to every tree of its shard.  A task builds the BK-tree (children
keyed by their integer Hamming distance to the parent) and follows only
edges within the radius of the query's own distance.  It returns a spanning
forest of the links that it found, one row per member, never all pairs.

*Components.*  Minimum labels spread along the links, with pointer jumping,
in rounds that each cut the lineage with a written table.

Defined results: null or empty text has no words and fingerprint zero, which
is linked like any other; equal fingerprints are linked; a null id is larger
than all others (a component of null ids only has a null id); repeated rows
give repeated results; an empty table gives an empty result; further columns
of the input, of any name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurrence_lake.llm.common import rows_of, ship, written

TREE_SIZE = 4096
_LOWER = bytes(range(256)).lower()


def shingle_hashes(text: str | None, shingle_words: int = 3) -> np.ndarray:
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < shingle_words:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, 42) for s in shingles), np.uint64)


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """64-bit SimHash; zero for a text without words."""
    hashes = shingle_hashes(text, shingle_words)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):  # bounded memory for very long texts
        part = hashes[i:i + 65536].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """``id``, ``th`` (hash of the text) and ``fp`` (the 64 bits as a long)
    of every row.  Map only."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [signed(fingerprint(t.as_py(), shingle_words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp, pa.int64())], names=["id", "th", "fp"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("th"))
    return rows.mapInArrow(made, "id bigint, th bigint, fp bigint")


def block_edges(blocks: int) -> list[int]:
    return [round(64 * i / blocks) for i in range(blocks + 1)]


def shards(distinct: DataFrame, radius: int) -> DataFrame:
    """``shard`` (hash of a pair of blocks and its value) of every ``fp``."""
    edges = block_edges(radius + 2)
    blocks = [F.expr(f"shiftrightunsigned(fp, {a}) & {(1 << (b - a)) - 1}L") for a, b in zip(edges, edges[1:])]
    keys = [F.xxhash64(F.lit(f"{i},{j}"), blocks[i], blocks[j]) for i, j in combinations(range(radius + 2), 2)]
    return distinct.select(F.explode(F.array(*keys)).alias("shard"), "fp")


class BkTree:
    """Burkhard-Keller tree over 64-bit integers and the Hamming distance."""

    def __init__(self) -> None:
        self.root: list | None = None  # [value, {distance: node}]

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (value ^ node[0]).bit_count():
            if (child := node[1].get(d)) is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [self.root] if self.root else []
        while stack:
            here, children = stack.pop()
            d = (value ^ here).bit_count()
            if d <= radius:
                found.append(here)
            if children:
                stack += [c for edge, c in children.items() if -radius <= edge - d <= radius]
        return found


def forest(group: Iterator[tuple[int, bool]], radius: int) -> Iterator[tuple[int, int]]:
    """Links of one tree's members (they come first) and of the queries sent
    to it, as a spanning forest."""
    tree, parent = BkTree(), {}

    def top(x: int) -> int:
        while (up := parent[x]) != x:
            parent[x] = parent[up]
            x = up
        return x

    for value, member in group:
        near = tree.within(value, radius)
        if member:
            tree.add(value)
            parent[value] = value
            near.append(value)
        elif near:
            yield value, near[0]
        for other in near[1:]:
            parent[top(near[0])] = top(other)
    for x in parent:
        if (t := top(x)) != x:
            yield x, t


def links(distinct: DataFrame, radius: int, tree_size: int = TREE_SIZE) -> DataFrame:
    """Edges (``a``, ``b``) that connect what links of ``radius`` connect."""
    keyed = shards(distinct, radius)
    sizes = keyed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    dealt = keyed.join(sizes, "shard").withColumn("trees", F.ceil(F.col("n") / tree_size).cast("int"))
    dealt = (dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
             .select("shard", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"))
             .select("shard", "tree", (F.col("tree") == F.col("own")).alias("member"), "fp"))
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "shard", "tree").sortWithinPartitions("shard", "tree", F.desc("member"), "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        rows = ((s, t, m, f & 0xFFFFFFFFFFFFFFFF) for batch in batches for s, t, m, f in zip(*(c.to_pylist() for c in batch.columns)))
        a: list[int] = []
        b: list[int] = []
        for _, group in groupby(rows, key=lambda r: r[:2]):
            for x, y in forest(((r[3], r[2]) for r in group), radius):
                a.append(signed(x))
                b.append(signed(y))
                if len(a) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                    a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(search, "a bigint, b bigint")


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node``, ``root``: the smallest node of its component, for every node
    of ``edges`` (``a``, ``b``) but the roots themselves.  Large-star and
    small-star rounds; each is two grouped minima and two joins."""
    def minima(e: DataFrame) -> DataFrame:
        # a table of its own: the edges then join it directly, and Spark can
        # split the edges of a node that has very many
        return written(e.groupBy("a").agg(F.min("b").alias("m")), "components-minima")

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = minima(both).select("a", F.least("a", "m").alias("m"))
        return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = minima(down)
        kept = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return kept.unionAll(least.select("a", F.col("m").alias("b")))

    def clean(e: DataFrame) -> DataFrame:
        return e.where("a <> b").distinct()

    now, was = written(clean(edges), "components"), None
    for _ in range(most_rounds):
        now = written(clean(small_star(clean(large_star(now)))), "components")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if state == was:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        was = state
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")


def grouped(fps: DataFrame, radius: int) -> DataFrame:
    """``fp``, ``first``: the least (null id last, id, ``th``) of the
    component of every distinct fingerprint of ``fps`` (id, th, fp)."""
    least = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "th"))
    distinct = written(fps.groupBy("fp").agg(least.alias("first")), "simhash-distinct")
    found = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fp", "root").join(heads, "root").select("fp", "first")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    radius: int = 3) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable by links."""
    fps = written(fingerprints(df, id_col, text_col, shingle_words), "simhash")
    of = written(grouped(fps, radius).select("fp", F.col("first.id").alias("component_id")), "simhash-components")
    return fps.join(of, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                radius: int = 3) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the
    document of the smallest id (null last; of equal ids the smallest hash
    of its text; of equal rows one)."""
    fps = written(fingerprints(df, id_col, text_col, shingle_words), "simhash")
    heads = written(grouped(fps, radius).select("first.id", "first.th").distinct(), "simhash-heads")
    return rows_of(df, heads, "left_semi", id_col, text_col, once=True)


ship(__name__)
