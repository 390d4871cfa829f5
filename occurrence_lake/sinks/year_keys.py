"""CON-1 kept current: the keys of stored years, checked year by year.

The raw dataset is a union of yearly partitions whose key has to be unique
over all of them.  Instead of aggregating every stored key again on each
run, the keys are kept in a table partitioned by year and bucketed by key,
with the file names of each year when it was checked.  A year whose files
have changed (or a new one) is aggregated by itself and joined with the
stored keys of the other years bucket by bucket: the stored side is read in
its buckets and not shuffled, whatever ``spark.sql.shuffle.partitions`` is.
Years that have not changed are not read from the raw dataset at all.

The note of a year goes before its keys are rewritten and comes back after,
so a check that died is made again.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurrence_lake.config import children, read_text, remove, write_text
from occurrence_lake.operators.constraints import KeyViolation, key_violations

#: Buckets unless the caller names a number: about one per 128 MB of keys.
KEY_BUCKETS = 16


class YearKeys:
    def __init__(self, spark: SparkSession, raw_root: str, root: str | None = None, key: str = "gbif_id", buckets: int = KEY_BUCKETS):
        self.spark, self.key = spark, key
        self.raw_root = raw_root.rstrip("/")
        self.root = (root or f"{self.raw_root}_keys").rstrip("/")
        self._asked = int(buckets)
        self._name = f"occlake_keys_{hashlib.sha1(self.root.encode()).hexdigest()[:12]}"

    def _state(self) -> dict:
        return json.loads(read_text(self.spark, f"{self.root}/state.json") or json.dumps({"buckets": self._asked, "years": {}}))

    def _note(self, state: dict) -> None:
        write_text(self.spark, f"{self.root}/state.json", json.dumps(state))

    def years(self) -> dict[str, str]:
        """The raw dataset's years and a digest of their files' names (a
        write gives its files new names)."""
        found = [n.removeprefix("year=") for n in children(self.spark, self.raw_root) if n.startswith("year=")]
        return {y: hashlib.sha1("\n".join(sorted(n for n in children(self.spark, f"{self.raw_root}/year={y}") if not n.startswith(("_", ".")))).encode()).hexdigest()
                for y in found}

    def stored(self, raw: DataFrame) -> DataFrame:
        """``(key, year)`` of the checked years, as a bucketed table."""
        if not self.spark.catalog.tableExists(self._name):
            kind = raw.schema[self.key].dataType.simpleString()
            self.spark.sql(f"CREATE TABLE {self._name} (`{self.key}` {kind}, year INT) USING parquet PARTITIONED BY (year) "
                           f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self._state()['buckets']} BUCKETS LOCATION '{self.root}/keys'")
        if children(self.spark, f"{self.root}/keys"):
            self.spark.sql(f"MSCK REPAIR TABLE {self._name} SYNC PARTITIONS")   # the folders are what counts
        self.spark.catalog.refreshTable(self._name)
        return self.spark.table(self._name)

    def repeated(self, raw: DataFrame, fresh: DataFrame, others: list[str]) -> DataFrame:
        """Stored keys of ``others`` that are among the ``fresh`` ones."""
        new = fresh.select(self.key).distinct().repartition(self._state()["buckets"], self.key)
        return self.stored(raw).where(F.col("year").isin([int(y) for y in others])).join(new, self.key, "left_semi")

    def check(self, raw: DataFrame) -> list[str]:
        """Raise if a key is NULL or repeated in the union of the years;
        returns the years that had to be read."""
        state, now = self._state(), self.years()
        changed = sorted(y for y in now if state["years"].get(y) != now[y])
        others = sorted(y for y in now if y not in changed)
        if changed:
            fresh = raw.where(F.col("year").isin([int(y) for y in changed])).select(self.key, "year")
            own = key_violations(fresh, self.key).first()
            across = self.repeated(raw, fresh, others).count() if others else 0
            if own["null_keys"] or own["duplicated_keys"] or across:
                raise KeyViolation(f"primary key {self.key!r} violated: {own['null_keys']} NULL, {own['duplicated_keys']} duplicated "
                                   f"in the years {', '.join(changed)}, {across} of theirs stored in other years")
        gone = [y for y in state["years"] if y not in now]
        if changed or gone:
            state["years"] = {y: now[y] for y in others}
            self._note(state)
            for y in [*changed, *gone]:
                remove(self.spark, f"{self.root}/keys/year={y}")
            if changed:
                self.stored(raw)
                fresh.repartition(state["buckets"], self.key).sortWithinPartitions("year", self.key).write.mode("append").insertInto(self._name)
            self._note(state | {"years": now})
        return changed
