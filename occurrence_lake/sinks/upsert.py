"""SNK-3: keyed serving tables kept up to date by upsert.

``INSERT ... ON CONFLICT (k) DO UPDATE SET c = EXCLUDED.c`` becomes, per
batch:

1. the batch is reduced to one row per key, chosen by a caller-given order
   (``max_by``/``min_by`` over a struct: a combinable aggregate, so a key
   repeated a billion times is reduced on the map side, never gathered);
2. a table is Parquet partitioned by ``slot``, a hash of the key (or of the
   columns in ``by``).  Only the slots that the batch touches are read
   (partition pruning), ``left_anti`` joined with the batch, united with it
   and written, first to a staged folder;
3. one small file points at the table's state.  Replacing it commits the
   batch: from then on readers take the touched slots from the staged folder;
4. dynamic partition overwrite moves the staged slots into the table, and
   the pointer lets go of the staged folder, which is removed.  Where every
   slot is touched the staged rows are the table, and are not copied.

A batch of ten rows rewrites at most ten slots.  A writer that dies before
step 3 has changed nothing; one that dies after it leaves a committed batch
whose step 4 the next writer does.  The pointer also names the last batch, so
a replayed batch is not applied twice.  A table has one writer at a time; a
frame read before a commit may find its files gone and is then read again.
``resize`` deals the rows into another number of slots.

``LocatedTable`` is for rows that are looked up by one key and read by
another: they lie by ``place`` columns, and a second keyed table says where
each key lies.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occurrence_lake.config import children, finished, read_text, remove, write_text
from occurrence_lake.operators.metrics import observed

#: Slots of a serving table unless the caller names a number: about one per
#: 128 MB of the table.
SERVING_SLOTS = 16


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def dedupe_by_key(df: DataFrame, key, order_by=None, pick: str = "last") -> DataFrame:
    """One row per key: the row with the greatest (``last``) or smallest
    (``first``) ``order_by``; without an order, the greatest whole row, so
    the choice is still deterministic."""
    keys = _keys(key)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    row = F.struct(*others)
    order = F.struct(*order_by) if order_by else row
    chooser = F.max_by if pick == "last" else F.min_by
    return (df.groupBy(*keys).agg(chooser(row, order).alias("_row"))
            .select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in others]))


class KeyedTable:
    """Rows under ``root``, each in the slot of its ``by`` columns (default:
    the key).  ``order_sql`` sorts the rows of a file (default: the key), so
    that row group statistics prune."""

    def __init__(self, spark: SparkSession, root: str, key, slots: int = SERVING_SLOTS, by=None, order_sql: str | None = None):
        if slots < 1:
            raise ValueError(f"slots must be at least 1, not {slots}")
        self.spark, self.root, self.key = spark, root.rstrip("/"), _keys(key)
        self.by = _keys(by or key)
        self._asked, self._order = int(slots), [F.expr(order_sql)] if order_sql else [F.col(k) for k in self.key]

    # -- state --------------------------------------------------------------
    def state(self) -> dict | None:
        text = read_text(self.spark, f"{self.root}/state.json")
        return json.loads(text) if text else None

    def _point(self, **state) -> None:
        write_text(self.spark, f"{self.root}/state.json", json.dumps(state))

    def exists(self) -> bool:
        return self.state() is not None

    @property
    def slots(self) -> int:
        state = self.state()
        return state["slots"] if state else self._asked

    def last_batch(self) -> str | None:
        state = self.state()
        return state["batch"] if state else None

    def row_count(self) -> int:
        state = self.state()
        return state["rows"] if state else 0

    # -- reading ------------------------------------------------------------
    def slot(self, df: DataFrame, slots: int | None = None) -> Column:
        """A row's slot; ``by`` columns are hashed by their text, whatever
        integer width they come in."""
        return F.pmod(F.xxhash64(*[df[c].cast("string") for c in self.by]), F.lit(slots or self.slots)).cast("int")

    def slots_of(self, df: DataFrame) -> list[int]:
        """The slots that rows fall in: at most as many as the table has."""
        return sorted(r[0] for r in df.select(self.slot(df).alias("slot")).distinct().collect())

    def _stored(self, state: dict, slots: list[int] | None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        with_slot = T.StructType([*schema.fields, T.StructField("slot", T.IntegerType())])
        rows = self.spark.read.schema(with_slot).parquet(f"{self.root}/{state['rows_at']}")
        staged = state["staged"]
        if staged:
            moved = self.spark.read.schema(with_slot).parquet(f"{self.root}/{staged}/rows")
            rows = rows.where(~F.col("slot").isin(state["touched"])).unionByName(moved)
        return rows if slots is None else rows.where(F.col("slot").isin(slots))

    def read(self, slots: list[int] | None = None) -> DataFrame:
        """The table, or the rows of some slots of it."""
        state = self.state()
        if state is None:
            raise FileNotFoundError(f"no table under {self.root}")
        return self._stored(state, slots).drop("slot")

    # -- writing ------------------------------------------------------------
    def _write(self, df: DataFrame, path: str, mode: str = "errorifexists") -> int:
        """Rows with their ``slot``, as slot partitions: AQE splits a slot
        that is large and packs small ones."""
        out, seen = observed(df.hint("rebalance", "slot").sortWithinPartitions("slot", *self._order), "rows")
        out.write.partitionBy("slot").mode(mode).option("partitionOverwriteMode", "dynamic").parquet(path)
        return int(seen.get.get("row_count", 0))

    def replace(self, df: DataFrame, batch_id: str | None = None, slots: int | None = None) -> DataFrame:
        """Write ``df`` as the whole table (first load, full refresh)."""
        before = self.state()
        n = slots or (before["slots"] if before else self._asked)
        at = f"rows-{uuid.uuid4().hex[:12]}"
        rows = self._write(df.withColumn("slot", self.slot(df, n)), f"{self.root}/{at}")
        self._point(rows_at=at, slots=n, batch=batch_id, staged=None, touched=[], emptied=[], rows=rows, schema=df.schema.json())
        for old in [before["rows_at"], before["staged"]] if before else []:
            if old:
                remove(self.spark, f"{self.root}/{old.split('/')[0]}")
        return self.read()

    def resize(self, slots: int) -> DataFrame:
        return self.replace(self.read(), self.last_batch(), int(slots))

    def finish(self) -> None:
        """Move a committed batch's staged slots into the table."""
        state = self.state()
        if not state or not state["staged"]:
            return
        staged = f"{self.root}/{state['staged']}"
        table = f"{self.root}/{state['rows_at']}"
        moved = self.spark.read.schema(T.StructType([*T.StructType.fromJson(json.loads(state["schema"])).fields, T.StructField("slot", T.IntegerType())]))
        self._write(moved.parquet(f"{staged}/rows"), table, "overwrite")
        for slot in state["emptied"]:
            remove(self.spark, f"{table}/slot={slot}")
        self._point(**state | {"staged": None, "touched": [], "emptied": []})
        remove(self.spark, staged)

    def apply(self, rows: DataFrame, gone: DataFrame | None = None, match=None, batch_id: str | None = None, stored: bool = False) -> DataFrame:
        """Drop the stored rows that ``match`` (default: the key) finds in
        ``rows`` or ``gone``, and add ``rows``.  ``gone`` has the match and
        ``by`` columns.  ``stored``: ``rows`` are read from a table, so they
        need not be written for repeated use.  Returns the table."""
        if not self.exists():
            return self.replace(rows, batch_id)
        if batch_id is not None and self.last_batch() == batch_id:
            return self.read()
        self.finish()
        state = self.state()
        match = _keys(match or self.key)
        staged = f"staged-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{staged}"
        names = T.StructType.fromJson(json.loads(state["schema"])).names
        new = rows.withColumn("slot", self.slot(rows, state["slots"])).select(*[F.col(f"`{c}`") for c in names], "slot")
        if not stored:
            new.write.parquet(f"{path}/new")
            new = self.spark.read.schema(new.schema).parquet(f"{path}/new")
        named = new.select(*match, "slot")
        if gone is not None:
            named = named.unionByName(gone.withColumn("slot", self.slot(gone, state["slots"])).select(*match, "slot"))
        touched = sorted(r[0] for r in named.select("slot").distinct().collect())   # slot numbers
        if touched:
            old, seen = observed(self._stored(state, touched), "stored")
            found = named.select(*match).distinct()
            kept = old.join(found, [old[c].eqNullSafe(found[c]) for c in match], "left_anti")
            rebuilt = self._write(kept.unionByName(new), f"{path}/rows")
            full = children(self.spark, f"{path}/rows")
            after = {"batch": batch_id, "rows": state["rows"] - int(seen.get.get("row_count", 0)) + rebuilt}
            if len(touched) == state["slots"]:   # the staged rows are the whole table
                self._point(**state | after | {"rows_at": f"{staged}/rows"})
                remove(self.spark, f"{path}/new")
                remove(self.spark, f"{self.root}/{state['rows_at'].split('/')[0]}")
            else:
                self._point(**state | after | {"staged": staged, "touched": touched, "emptied": [s for s in touched if f"slot={s}" not in full]})
                self.finish()
        else:
            self._point(**state | {"batch": batch_id})
            remove(self.spark, path)
        return self.read()

    def clean(self) -> None:
        """Remove what died writers left beside the table."""
        state = self.state() or {"rows_at": "", "staged": None}
        for name in children(self.spark, self.root):
            if name.startswith(("rows-", "staged-")) and name not in (state["rows_at"].split("/")[0], state["staged"]):
                remove(self.spark, f"{self.root}/{name}")

    def upsert(self, batch: DataFrame, order_by=None, pick: str = "last", drop=(), batch_id: str | None = None) -> DataFrame:
        """Apply one batch; returns the table.

        ``order_by`` picks among rows of one key; columns in ``drop`` (e.g.
        a batch sequence number) are used for that and not stored.  A batch
        with the ``batch_id`` of the last one is not applied again."""
        if batch_id is not None and self.last_batch() == batch_id:
            return self.read()
        reduced = dedupe_by_key(batch, self.key, order_by, pick)
        return self.apply(reduced.drop(*drop) if drop else reduced, batch_id=batch_id)

    def replace_groups(self, rows: DataFrame, groups: DataFrame | None = None, group=None, batch_id: str | None = None) -> DataFrame:
        """Drop every stored row of the groups in ``groups`` and in ``rows``
        (``group``: their columns, default ``by``) and add ``rows``."""
        return self.apply(rows, groups, group or self.by, batch_id)


class LocatedTable:
    """Rows with a key that lie by ``place`` columns (read by these without
    a scan), and a keyed table of the places (found by key without a scan)."""

    def __init__(self, spark: SparkSession, root: str, key: str, place: list[str], slots: int = SERVING_SLOTS):
        self.spark, self.root, self.key, self.place = spark, root.rstrip("/"), key, list(place)
        self.rows = KeyedTable(spark, f"{self.root}/rows", key, slots, by=place)
        self.places = KeyedTable(spark, f"{self.root}/places", key, slots)

    def exists(self) -> bool:
        return self.rows.exists()

    def read(self) -> DataFrame:
        return self.rows.read()

    def at(self, places: DataFrame) -> DataFrame:
        """The rows that lie at ``places``: only their slots are read."""
        rows = self.rows.read(self.rows.slots_of(places))
        return rows.join(places.select(*self.place).distinct(), [rows[c].eqNullSafe(places[c]) for c in self.place], "left_semi")

    def located(self, keys: DataFrame) -> DataFrame:
        """(key, place columns) where ``keys`` lie: only their slots are read."""
        stored = self.places.read(self.places.slots_of(keys))
        return stored.join(keys.select(self.key).distinct(), self.key, "left_semi")

    def prepare(self, batch: DataFrame, work: str, order_by=None, pick: str = "last", drop=()) -> tuple[DataFrame, DataFrame]:
        """(rows of the batch, one a key; where their keys lay before it),
        written below ``work`` once: a replay finds them as they were."""
        self.finish()
        paths = f"{work}/rows", f"{work}/before"
        if not finished(self.spark, paths[0]):
            reduced = dedupe_by_key(batch, self.key, order_by, pick)
            reduced.drop(*drop).write.mode("overwrite").parquet(paths[0])
        rows = self.spark.read.parquet(paths[0])
        if not finished(self.spark, paths[1]):
            before = self.located(rows) if self.exists() else rows.select(self.key, *self.place).limit(0)
            before.write.mode("overwrite").parquet(paths[1])
        return rows, self.spark.read.parquet(paths[1])

    def commit(self, work: str, batch_id: str) -> DataFrame:
        """Store what ``prepare`` has written.  A batch that dies between
        the rows and their places is finished by the next one."""
        write_text(self.spark, f"{self.root}/batch.json", json.dumps({"work": work, "id": batch_id}))
        return self.finish()

    def finish(self) -> DataFrame | None:
        text = read_text(self.spark, f"{self.root}/batch.json")
        if text is None:
            return self.read() if self.exists() else None
        batch = json.loads(text)
        rows, before = (self.spark.read.parquet(f"{batch['work']}/{name}") for name in ("rows", "before"))
        out = self.rows.apply(rows, before, batch_id=batch["id"], stored=True)
        self.places.apply(rows.select(self.key, *self.place), batch_id=batch["id"], stored=True)
        remove(self.spark, f"{self.root}/batch.json")
        return out

    def upsert(self, batch: DataFrame, order_by=None, pick: str = "last", drop=()) -> DataFrame:
        name = f"batch-{uuid.uuid4().hex[:12]}"
        work = f"{self.root}/{name}"
        self.prepare(batch, work, order_by, pick, drop)
        out = self.commit(work, name)
        remove(self.spark, work)
        return out

    def resize(self, slots: int) -> None:
        self.finish()
        self.rows.resize(slots)
        self.places.resize(slots)

    def clean(self) -> None:
        self.finish()
        self.rows.clean()
        self.places.clean()
        for name in children(self.spark, self.root):
            if name.startswith("batch-"):
                remove(self.spark, f"{self.root}/{name}")
