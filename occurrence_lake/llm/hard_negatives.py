"""Hard negatives by coordinate pruning over length buckets (after LEMP).

Vectors are scaled and floored to integers; a score is an integer inner
product.  An *anchor*'s positives are its best other rows of the same label;
for each positive the best rows of another label are returned whose score
lies between two percentages of the positive's.

*Index.*  Every row falls in a length bucket (lengths within a factor of
``LENGTH_STEP``); a bucket is dealt by a hash of the label, then of the id,
into blocks of about ``BLOCK_ROWS`` rows, so that most blocks of a table with
few labels hold one.  A block is one row of a table: its integers.  For each
coordinate it has the list of its rows sorted by the coordinate of the unit
vector, made where an anchor can use it.

*Search.*  The anchors are a stated query set, packed in blocks of about
``ANCHOR_ROWS``.  The blocks of the index are dealt over lanes; a lane is one
task, which holds its blocks (``LANE_VALUES`` numbers) and lets every block
of anchors pass.  Blocks without a row of the label asked for are skipped.  A score of at
least ``t`` needs a cosine of at least ``t / (anchor length * longest row)``;
a bucket that cannot reach it is skipped.  For the anchor's ``FOCUS`` largest
coordinates that cosine bounds the coordinate of a row from both sides; the
bounds cut ranges from the sorted lists, the ranges intersect to the
candidates, and only these are scored, exactly.  Where the shortest range
still holds much of a block (vectors in no particular direction), the block
is scored as matrix products, in the shortest kind of number that is exact
for its lengths.  The first bound ``t`` is the score that
enough rows of a small sample reach (``SEED_VALUES`` numbers at most, known
to the driver); the rows found in a lane raise it.  Of many lanes one in
``WAVE`` goes first, and its best rows raise the bounds of the others.  A
bound only spares work, every row is searched.

*Result.*  A lane returns its best rows for a block of anchors as one row of
packed numbers; these are merged for each block of anchors by rank.

Defined results: rows with a null id, label or vector, or a null or
non-finite component, or a squared length of 2**62 or more (scores must fit
a long) take no part; rows that share an id count once, the one of the
smallest label and then vector; vectors of different sizes are filled up with zeros;
ties go to the smaller id; a positive whose percentages span no integer has no
negatives; an empty table gives an empty result; further columns of the
input, of any name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from occurrence_lake.llm.common import ship, written

BLOCK_ROWS = 1 << 15
BLOCK_VALUES = 1 << 21
ANCHOR_ROWS = 1024
ANCHOR_VALUES = 1 << 18
LABEL_GROUPS = 64
LANE_VALUES = 1 << 23
LANES = 64  # as many at least, if there are blocks for them
WAVE = 16
SPLIT = 8  # partitions of a lane of the first wave
LENGTH_STEP = 1.1
FOCUS = 4
SEED_ROWS = 4096
SEED_VALUES = 1 << 20

_LONGEST = 2.0**62
_LEAST = -(2**62)
_EXACT = ((np.float32, 2.0**24), (np.float64, 2.0**53))  # integers below are exact, sums in any order
_SLACK = 1e-6
_SAMPLE = 128  # rows from which the width of a range is told beforehand
_PRUNED = 1 << 20  # multiplications that a pruned query has to spare
_STEP = (256, 2048)  # queries and rows of one product
_SEGMENT = 256  # rows whose best score is compared first
_HITS = 1 << 12  # handed on together


def integers(vectors: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one size as whole numbers; which of them take part."""
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(np.asarray(vectors, float) * scale)
        return x, np.isfinite(x).all(1) & ((x * x).sum(1) < _LONGEST)


def unpacked(rows: list[tuple[bytes, bool]]) -> np.ndarray:
    """Integers of rows, filled up with zeros, as one matrix."""
    if len({(len(b), small) for b, small in rows}) == 1:
        kind = np.int16 if rows[0][1] else np.int64
        return np.frombuffer(b"".join(b for b, _ in rows), kind).reshape(len(rows), -1)
    each = [np.frombuffer(b, np.int16 if small else np.int64) for b, small in rows]
    out = np.zeros((len(each), max(map(len, each), default=0)), np.int64)
    for i, x in enumerate(each):
        out[i, :len(x)] = x
    return out


class Rows:
    """Rows of integers with their lengths."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.lengths = np.sqrt((rows.astype(float) ** 2).sum(1))
        self.shortest, self.longest = (self.lengths.min(), self.lengths.max()) if len(ids) else (0.0, 0.0)
        self._as: dict[type, np.ndarray] = {}

    def numbers(self, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = self.rows.astype(kind)
        return self._as[kind]

    def exact_with(self, other: Rows) -> type:
        """The shortest kind of number that holds every inner product, and every sum on the way to it."""
        return next((kind for kind, end in _EXACT if self.longest * other.longest < end), np.int64)

    @cached_property
    def focus(self) -> tuple[np.ndarray, np.ndarray]:
        """For each row its coordinates by size, largest first, ``FOCUS`` of them, and their angles."""
        unit = self.rows / np.maximum(self.lengths, 1e-300)[:, None]
        spread = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        return spread, np.arccos(np.clip(np.take_along_axis(unit, spread, 1), -1, 1))


class Block(Rows):
    """Rows of one length bucket with their sorted coordinate lists."""

    @cached_property
    def label(self) -> int | None:
        """The label that all rows have."""
        return int(self.labels[0]) if len(self.labels) and (self.labels == self.labels[0]).all() else None

    def unit(self, rows: np.ndarray | slice) -> np.ndarray:
        return (self.rows[rows] / np.maximum(self.lengths[rows], 1e-300)[:, None]).astype(np.float32)

    @cached_property
    def some(self) -> np.ndarray:
        """For each coordinate the sorted values of some rows."""
        return np.sort(self.unit(slice(None, None, -(-len(self.ids) // _SAMPLE))).T, axis=1)

    @cached_property
    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """For each coordinate the rows by its value, and the values."""
        unit = np.ascontiguousarray(self.unit(slice(None)).T)
        order = np.argsort(unit, axis=1, kind="stable").astype(np.int32)
        return order, np.take_along_axis(unit, order, 1)

    def scores(self, at: np.ndarray | slice, queries: Rows) -> np.ndarray:
        """Inner products of the rows ``at`` (lines) and the queries."""
        d, kind = min(self.rows.shape[1], queries.rows.shape[1]), self.exact_with(queries)
        return (self.numbers(kind)[at, :d] @ queries.numbers(kind)[:, :d].T).astype(np.int64)

    def candidates(self, queries: Rows | np.ndarray, low: np.ndarray, high: np.ndarray, which: np.ndarray | None = None,
                   wide: list | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, rows, their scores) for each query (of ``which``) that the
        block may answer; no row with a score from ``low`` to ``high`` is
        missing.  The numbers of queries for which ranges spare too little go
        to ``wide``, if given, instead of all their scores."""
        queries = queries if isinstance(queries, Rows) else Rows(np.arange(len(queries)), np.zeros(len(queries), np.int64), queries)
        which = np.arange(len(queries.ids)) if which is None else which
        n, d = len(self.ids), min(self.rows.shape[1], queries.rows.shape[1])
        lengths, low, high = queries.lengths[which], low[which].astype(float), high[which].astype(float)
        reach = np.where(low > 0, lengths * self.longest, lengths * self.shortest)
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(reach > 0, low / reach, np.where(low > 0, 2.0, -1.0))
            most = np.where(high > 0, high / (lengths * self.shortest), high / (lengths * self.longest))
        least = np.clip(np.nan_to_num(least, nan=-1.0), -1, None)
        most = np.clip(np.nan_to_num(most, nan=1.0, posinf=1.0, neginf=-1.0), -1, 1)
        bounded = (lengths > 0) & (self.shortest > 0)  # angles need lengths
        alive = np.flatnonzero((least <= 1 + 1e-9) & (n > 0) & (~bounded | (low <= high)))
        if not len(alive):
            return
        which, bounded = which[alive], bounded[alive]
        near, far = np.arccos(most[alive])[:, None], np.arccos(np.clip(least[alive], -1, 1))[:, None]
        far = np.maximum(near, far)
        spread, angle = queries.focus[0][which], queries.focus[1][which]
        bounded = bounded & (spread < d).all(1)
        inside = (angle >= near) & (angle <= far)
        up = np.where(inside, 1.0, np.cos(np.minimum(np.abs(angle - near), np.abs(angle - far)))) + _SLACK
        first, last = angle + near, angle + far
        down = np.where((first <= np.pi) & (last >= np.pi), -1.0, np.where(first > np.pi, np.cos(first), np.cos(last))) - _SLACK
        limit = n / 2 if wide is None else min(n / 2, (n * d - _PRUNED) / 256)  # rows of a range worth it
        told = bounded & (limit > 0)
        if wide is not None and told.any():  # most queries of no particular direction need no list
            near_by = self.some[np.minimum(spread[told], d - 1)]
            told[told] = ((near_by >= down[told][:, :, None]) & (near_by <= up[told][:, :, None])).mean(2).min(1, initial=1.0) * n < 1.5 * limit
        start, end = np.zeros(spread.shape, int), np.full(spread.shape, n)
        for f in np.unique(spread[told]):
            at = (spread == f) & told[:, None]
            start[at] = np.searchsorted(self.lists[1][f], down[at].astype(np.float32), "left")
            end[at] = np.searchsorted(self.lists[1][f], up[at].astype(np.float32), "right")
        width = end - start
        whole = ~told | (width.min(1, initial=n) >= limit)
        if whole.any():
            if wide is not None:
                wide.extend(which[whole].tolist())
            else:
                some = Rows(queries.ids[which[whole]], queries.labels[which[whole]], queries.rows[which[whole]])
                for q, scores in zip(which[whole], self.scores(slice(None), some).T):
                    yield int(q), np.arange(n), scores
        kind = self.exact_with(queries)
        for j in np.flatnonzero(~whole):
            lists = np.argsort(width[j], kind="stable")
            f = lists[0]
            rows = self.lists[0][spread[j, f], start[j, f]:end[j, f]]
            for f in lists[1:]:
                x = self.rows[rows, spread[j, f]] / np.maximum(self.lengths[rows], 1e-300)
                rows = rows[(x >= down[j, f] - _SLACK) & (x <= up[j, f] + _SLACK)]
            if len(rows):
                q = int(which[j])
                yield q, rows, (self.numbers(kind)[rows, :d] @ queries.numbers(kind)[q, :d]).astype(np.int64)

    def hits(self, queries: Rows, which: np.ndarray, low: np.ndarray, high: np.ndarray, same_label: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(queries, rows, scores), an element a pair: all rows whose label
        fits, with a score from ``low`` to ``high``, of the queries of
        ``which``.  ``low`` may rise between two results."""
        wide: list[int] = []
        for q, rows, scores in self.candidates(queries, low, high, which, wide):
            fits = (scores >= low[q]) & (scores <= high[q]) & ((self.labels[rows] == queries.labels[q]) == same_label)
            if fits.any():
                yield np.full(np.count_nonzero(fits), q), rows[fits], scores[fits]
        d, kind, wide = min(self.rows.shape[1], queries.rows.shape[1]), self.exact_with(queries), np.sort(np.array(wide, int))
        limit = int(dict(_EXACT).get(kind, _LONGEST))
        x, room = self.numbers(kind)[:, :d], np.empty(_STEP[0] * _STEP[1], kind)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for some in np.split(wide, range(_STEP[0], len(wide), _STEP[0])) if len(wide) else []:
            y = np.ascontiguousarray(queries.numbers(kind)[some, :d])
            ends = [np.clip(v[some], -limit, limit).astype(kind) for v in (low, high)]
            for start in range(0, len(self.ids), _STEP[1]):
                part = x[start:start + _STEP[1]]
                scores, (least, most) = np.matmul(y, part.T, out=room[:len(y) * len(part)].reshape(len(y), len(part))), ends
                parts = scores.reshape(len(y), -1, _SEGMENT if len(part) % _SEGMENT == 0 else len(part))
                q, at = np.nonzero(parts.max(2) >= least[:, None])
                if not len(q):
                    continue
                parts, size = parts[q, at], parts.shape[2]
                fits = (parts >= least[q, None]) & (parts <= most[q, None])
                if self.label is None:
                    labels = self.labels[start:start + len(part)].reshape(-1, size)[at]
                    fits &= (labels == queries.labels[some[q], None]) == same_label
                found = np.flatnonzero(fits)
                if len(found):
                    line, r = np.divmod(found, size)
                    held.append((some[q[line]], start + at[line] * size + r, parts.ravel()[found].astype(np.int64)))
                    if sum(len(h[0]) for h in held) >= _HITS:
                        yield tuple(np.concatenate(c) for c in zip(*held))
                        held, ends[0] = [], np.clip(low[some], -limit, limit).astype(kind)
        if held:
            yield tuple(np.concatenate(c) for c in zip(*held))


def limits(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest negative score of a positive (percentages)."""
    return -((-low * positive) // 100), high * positive // 100


def positive_bounds(seed: Block, anchors: Rows, count: int) -> np.ndarray:
    """For each anchor a score that ``count`` positives reach."""
    out = np.full(len(anchors.ids), _LEAST, np.int64)
    scores = seed.scores(slice(None), anchors)
    for i in range(len(out)):
        own = scores[(seed.labels == anchors.labels[i]) & (seed.ids != anchors.ids[i]), i]
        if len(own) >= count:
            out[i] = np.partition(own, len(own) - count)[-count]
    return out


def negative_bound(own: np.ndarray, low: int, high: int, count: int) -> int:
    """The least score that a negative needs; ``own``: sorted scores of a
    sample's rows of other labels."""
    place = np.searchsorted(own, high, "right") - count
    return max(low, int(own[place])) if place >= 0 else low


def first(goals: np.ndarray, ids: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each goal the first ``count`` by score, ties by smaller id: goals,
    ids, scores, ranks."""
    order = np.lexsort((ids, -scores, goals))
    goals, ids, scores = goals[order], ids[order], scores[order]
    start = np.flatnonzero(np.r_[True, goals[1:] != goals[:-1]]) if len(goals) else np.empty(0, int)
    ranks = np.arange(len(goals)) - np.repeat(start, np.diff(np.r_[start, len(goals)])) + 1
    kept = ranks <= count
    return goals[kept], ids[kept], scores[kept], ranks[kept]


class Best:
    """The first ``count`` rows of each goal of a block of anchors.  A goal
    is a line (anchor's place, least and greatest score wanted)."""

    def __init__(self, anchors: Rows, goals: np.ndarray, count: int):
        self.anchors, self.goals, self.count = anchors, goals.copy(), count
        of = np.sort(goals[:, 0], kind="stable")
        nth = np.arange(len(goals)) - np.searchsorted(of, of)
        self.slots = np.full((len(anchors.ids), int(nth.max(initial=-1)) + 1), -1)
        self.slots[of, nth] = np.argsort(goals[:, 0], kind="stable")
        self.last = np.full(len(goals), np.iinfo(np.int64).max)  # id up to which a row of the least score counts
        self.which = np.unique(of)
        self.low, self.high = np.full(len(anchors.ids), -_LEAST), np.full(len(anchors.ids), _LEAST)
        np.maximum.at(self.high, goals[:, 0], goals[:, 2])
        self.found = [(np.empty(0, np.int64),) * 3]
        self.held = self.kept = 0
        self._low()

    def _low(self) -> None:
        self.low[:] = -_LEAST
        np.minimum.at(self.low, self.goals[:, 0], self.goals[:, 1])

    def add(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        own = ids != self.anchors.ids[queries]
        if not own.all():
            queries, ids, scores = queries[own], ids[own], scores[own]
        for slot in self.slots.T:
            goal = slot[queries]
            _, least, most = self.goals[goal].T
            fits = (goal >= 0) & (scores <= most) & ((scores > least) | (scores == least) & (ids <= self.last[goal]))
            if fits.any():
                self.found.append((goal[fits], ids[fits], scores[fits]))
                self.held += len(self.found[-1][0])
        if self.held > self.kept + max(1 << 13, self.count * len(self.goals)):
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        goals, ids, scores, ranks = first(*(np.concatenate(c) for c in zip(*self.found)), self.count)
        full = ranks == self.count
        self.goals[goals[full], 1], self.last[goals[full]] = scores[full], ids[full]
        self._low()
        self.found, self.held, self.kept = [(goals, ids, scores)], len(goals), len(goals)
        return self.found[0]


def prepared(df: DataFrame, anchor: Column, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """(id, label, anchor, q, small, size, bucket): rows that take part, once an id."""
    vector = F.col(vector_col)
    if df.select(vector).schema[0].dataType != ArrayType(FloatType()):
        vector = vector.cast("array<double>")
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                      F.coalesce(anchor, F.lit(False)).alias("anchor"), vector.alias("vector"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            flat, ends = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()  # a null component is not a number
            sizes = np.diff(ends)
            q = np.full(batch.num_rows, None, object)
            small, bucket = np.zeros(batch.num_rows, bool), np.full(batch.num_rows, -1)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x, fit = integers(flat[ends[at][:, None] + np.arange(size)], scale)
                x, at = x[fit], at[fit]
                small[at] = np.abs(x).max(1, initial=0) < 2**15
                length = np.sqrt((x * x).sum(1))
                bucket[at[length > 0]] = (np.log(length[length > 0]) // np.log(LENGTH_STEP)).astype(int)
                for short, kind in ((True, np.int16), (False, np.int64)):
                    some, own = at[small[at] == short], x[small[at] == short].astype(kind)
                    width, packed = own.itemsize * int(size), own.tobytes()
                    for j, i in enumerate(some.tolist()):
                        q[i] = packed[j * width:(j + 1) * width]
            kept = np.flatnonzero(np.array([b is not None for b in q], bool))
            part = batch.select([0, 1, 2]).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(q[kept].tolist(), pa.binary()), pa.array(small[kept]), pa.array(sizes[kept], pa.int32()),
                                              pa.array(bucket[kept], pa.int32())], names=["id", "label", "anchor", "q", "small", "size", "bucket"])

    out = rows.mapInArrow(made, "id long, label long, anchor boolean, q binary, small boolean, size int, bucket int")
    return out.groupBy("id").agg(F.min(F.struct("label", "q", "small", "size", "bucket", "anchor")).alias("r")).select("id", "r.*")


def label_group() -> Column:
    return F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)).cast("int").alias("label_group")


def dealt(rows: DataFrame, plan: list[tuple[int, int, int, int]]) -> DataFrame:
    """``rows`` with the number of their ``block``.  ``plan``: bucket, label
    group, first block, blocks."""
    to = rows.sparkSession.createDataFrame(plan, "bucket int, label_group int, start int, parts int")
    return (rows.withColumn("label_group", label_group()).join(F.broadcast(to), ["bucket", "label_group"])
            .withColumn("block", (F.col("start") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int")))


def planned(counts: dict[tuple[int, int], int], most: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """The plan of blocks of about ``most`` rows, and their number.
    ``counts``: rows of a bucket and label group.  A bucket has no more
    groups than full blocks."""
    of_bucket: dict[int, int] = {}
    for (bucket, _), n in counts.items():
        of_bucket[bucket] = of_bucket.get(bucket, 0) + n
    merged: dict[tuple[int, int], int] = {}
    group = {key: (key[0], key[1] % min(LABEL_GROUPS, -(-of_bucket[key[0]] // most))) for key in sorted(counts)}
    for key, g in group.items():
        merged[g] = merged.get(g, 0) + counts[key]
    at, blocks = {}, 0
    for g, n in merged.items():
        at[g] = (blocks, -(-n // most))
        blocks += at[g][1]
    return [(*key, *at[g]) for key, g in group.items()], blocks


_BLOCK = "block int, ids binary, labels binary, dim int, small boolean, x binary"


def packed_rows(rows: DataFrame, plan: list[tuple[int, int, int, int]], seed: Block | None = None, positives: int = 0) -> DataFrame:
    """Rows in blocks: one row a block.  With a sample, they are anchors and
    have a goal each, their positives: a line of ``goals`` is an anchor's
    place, least and greatest score wanted."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        t = table.sort_by("id")
        x = unpacked(list(zip(t["q"].to_pylist(), t["small"].to_pylist())))
        small = not x.size or bool(np.abs(x).max() < 2**15)
        ids, labels = np.asarray(t["id"], np.int64), np.asarray(t["label"], np.int64)
        block = {"block": pa.array([key[0].as_py()], pa.int32()), "ids": [ids.tobytes()], "labels": [labels.tobytes()],
                 "dim": pa.array([x.shape[1]], pa.int32()), "small": [small], "x": [x.astype(np.int16 if small else np.int64).tobytes()]}
        if seed is not None:
            least = positive_bounds(seed, Rows(ids, labels, x), positives)
            block["goals"] = [np.stack([np.arange(len(least)), least, np.full(len(least), -_LEAST)], 1).tobytes()]
        return pa.table(block)

    return dealt(rows, plan).select("id", "label", "q", "small", "block").groupBy("block").applyInArrow(pack, _BLOCK if seed is None else f"{_BLOCK}, goals binary")


def block_of(batch: pa.RecordBatch, i: int, kind: type[Rows]) -> Rows:
    value = lambda name: batch.column(name)[i].as_py()
    ids, labels = np.frombuffer(value("ids"), np.int64), np.frombuffer(value("labels"), np.int64)
    return kind(ids, labels, np.frombuffer(value("x"), np.int16 if value("small") else np.int64).reshape(len(ids), value("dim")))


def lines(batch: pa.RecordBatch, i: int, name: str, width: int) -> np.ndarray:
    """Whole numbers packed in a column, none for null, ``width`` a line."""
    return np.frombuffer(batch.column(name)[i].as_py() or b"", np.int64).reshape(-1, width)


def with_positives(anchors: DataFrame, found: DataFrame, seed: Block, negatives: int, low: int, high: int) -> DataFrame:
    """Blocks of anchors with a goal a positive: its negatives.  A line of
    ``positives`` is the id and score of a goal's positive."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = block_of(batch, i, Rows)
                scores = seed.scores(slice(None), rows)
                goals, positives, of, others = [], [], -1, None
                for place, positive, score, _ in lines(batch, i, "best", 4).tolist():
                    if place != of:
                        of, others = place, np.sort(scores[seed.labels != rows.labels[place], place])
                    least, most = limits(score, low, high)
                    if least <= most:
                        goals.append((place, negative_bound(others, least, most, negatives), most))
                        positives.append((positive, score))
                packed = [pa.array([np.array(v, np.int64).tobytes()]) for v in (goals, positives)]
                yield pa.RecordBatch.from_arrays([*batch.drop_columns(["best", "goals"]).slice(i, 1).columns, *packed],
                                                 names=[*batch.drop_columns(["best", "goals"]).schema.names, "goals", "positives"])

    return anchors.join(found, "block").mapInArrow(made, f"{_BLOCK}, goals binary, positives binary")


def raised(anchors: DataFrame, found: DataFrame, count: int) -> DataFrame:
    """Blocks of anchors whose goals with ``count`` rows in ``found`` want no lower score than these."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                goals, best = lines(batch, i, "goals", 3).copy(), lines(batch, i, "best", 4)
                full = best[best[:, 3] == count]
                goals[full[:, 0], 1] = full[:, 2]
                rest = batch.drop_columns(["best", "goals"]).slice(i, 1)
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array([goals.tobytes()])], names=[*rest.schema.names, "goals"])

    return anchors.select("block", "ids", "labels", "dim", "small", "x", "goals").join(found, "block", "left").mapInArrow(made, f"{_BLOCK}, goals binary")


def meet(items: DataFrame, anchors: DataFrame, lanes: int, wave: str = "") -> DataFrame:
    """In a partition a lane: its blocks of the index, then every block of
    anchors.  ``wave``: all lanes, or the ``first`` ones, each of ``SPLIT``
    partitions over which the anchors are dealt, or the ``other`` ones."""
    early, split = F.col("lane") % WAVE == 0, SPLIT if wave == "first" else 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = items.select(F.pmod("block", F.lit(lanes)).cast("int").alias("lane"), every(split).alias("share"), F.lit(0).alias("kind"),
                        *items.columns, F.lit(None).cast("binary").alias("goals"))
    right = anchors.select(every(lanes).alias("lane"), F.pmod("block", F.lit(split)).cast("int").alias("share"), F.lit(1).alias("kind"), *items.columns, "goals")
    met = left.unionByName(right).where({"": F.lit(True), "first": early, "other": ~early}[wave])
    if wave == "first":
        met, lanes = met.withColumn("lane", (F.floor(F.col("lane") / WAVE) * split + F.col("share")).cast("int")), -(-lanes // WAVE) * split
    return met.drop("share").repartitionById(lanes, F.col("lane")).sortWithinPartitions("lane", "kind", "block")


def search(met: DataFrame, same_label: bool, count: int) -> DataFrame:
    """(block, best): of each lane and block of anchors the first ``count``
    rows a goal.  A line of ``best`` is a goal's number, row's id, score and rank."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, blocks = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("lane")[i].as_py() != lane:
                    lane, blocks = batch.column("lane")[i].as_py(), []
                if batch.column("kind")[i].as_py() == 0:
                    blocks.append(block_of(batch, i, Block))
                elif blocks:
                    yield answer(blocks, batch, i)

    def answer(blocks: list[Block], batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        anchors = block_of(batch, i, Rows)
        best = Best(anchors, lines(batch, i, "goals", 3), count)
        for block in blocks:
            labels = anchors.labels[best.which]
            which = best.which[np.isin(labels, block.labels) if same_label else labels != block.label if block.label is not None else slice(None)]
            if len(which):
                for queries, rows, scores in block.hits(anchors, which, best.low, best.high, same_label):
                    best.add(queries, block.ids[rows], scores)
        goals, ids, scores = best.best()
        packed = np.stack([goals, ids, scores, np.zeros(len(goals), np.int64)], 1)
        return pa.RecordBatch.from_arrays([pa.array(batch.column("block")[i:i + 1]), pa.array([packed.tobytes()])], names=["block", "best"])

    return met.mapInArrow(found, "block int, best binary")


def merged(found: DataFrame, count: int) -> DataFrame:
    """(block, best): the best of all lanes."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        each = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 4) for b in table["best"].to_pylist()])
        best = np.stack(first(*each[:, :3].T, count), 1)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "best": [best.tobytes()]})

    return found.groupBy("block").applyInArrow(merge, "block int, best binary")


def best_rows(items: DataFrame, anchors: DataFrame, lanes: int, same_label: bool, count: int) -> DataFrame:
    """(block, best): of each block of anchors the first ``count`` rows a goal."""
    if lanes <= WAVE:
        return merged(search(meet(items, anchors, lanes), same_label, count), count)
    some = written(merged(search(meet(items, anchors, lanes, "first"), same_label, count), count), "first-lanes")
    rest = search(meet(items, raised(anchors, some, count), lanes, "other"), same_label, count)
    return merged(rest.unionByName(some), count)


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: float = 256.0, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each row with ``anchor`` and each of its positives the first
    ``negatives`` rows of another label whose score is ``low`` to ``high``
    per cent of the positive's: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score``."""
    spark = df.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = written(prepared(df, anchor, id_col, vector_col, label_col, scale), "vectors")
    buckets = rows.groupBy("bucket", label_group()).agg(F.count("*").alias("n"), F.sum(F.col("anchor").cast("int")).alias("anchors"),
                                                        F.max("size").alias("size")).collect()  # a row a length bucket and label group
    if not sum(r["anchors"] for r in buckets):
        return spark.createDataFrame([], schema)
    size = max(1, max(r["size"] for r in buckets))
    of_block = min(BLOCK_ROWS, max(1, BLOCK_VALUES // size))
    plan, blocks = planned({(r["bucket"], r["label_group"]): r["n"] for r in buckets}, of_block)
    asked = {}
    for r in buckets:
        if r["anchors"]:
            asked[0, r["label_group"]] = asked.get((0, r["label_group"]), 0) + r["anchors"]
    anchor_plan, _ = planned(asked, min(ANCHOR_ROWS, max(1, ANCHOR_VALUES // size)))
    lanes = max(-(-sum(r["n"] for r in buckets) * size // LANE_VALUES), min(blocks, LANES))
    sample = max(1, min(SEED_ROWS, SEED_VALUES // size))
    some = rows.orderBy(F.xxhash64("id")).limit(sample).select("id", "label", "q", "small").collect()
    seed = Block(np.array([r["id"] for r in some], np.int64), np.array([r["label"] for r in some], np.int64),
                 unpacked([(bytes(r["q"]), r["small"]) for r in some]))
    items = written(packed_rows(rows, plan), "vector-blocks")
    anchors = written(packed_rows(rows.where("anchor").withColumn("bucket", F.lit(0)), anchor_plan, seed, positives), "anchors")
    found = best_rows(items, anchors, lanes, True, positives)
    anchors = written(with_positives(anchors, found, seed, negatives, low, high), "positives")
    best = best_rows(items, anchors, lanes, False, negatives)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, goals, of = lines(batch, i, "ids", 1)[:, 0], lines(batch, i, "goals", 3), lines(batch, i, "positives", 2)
                goal, negative, score, rank = lines(batch, i, "best", 4).T
                columns = [ids[goals[goal, 0]], of[goal, 0], rank.astype(np.int32), negative, of[goal, 1], score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.replace(" long", "").replace(" int", "").split(", "))

    return anchors.select("block", "ids", "goals", "positives").join(best, "block").mapInArrow(made, schema)


ship(__name__)
