import contextlib
import io
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from occurrence_lake.schema import RAW_HEADER, RAW_NAMES, RAW_SCHEMA
from occurrence_lake.sinks.parquet import fill_declared, materialize, write_table, write_years
from occurrence_lake.sinks.upsert import KeyedTable, LocatedTable, dedupe_by_key
from occurrence_lake.schema import VERNACULAR_SCHEMA
from occurrence_lake.operators.constraints import KeyViolation
from occurrence_lake.sources import fixtures
from occurrence_lake.sources.parquet import read_raw_years
from occurrence_lake.sources.tsv import TSV_READ_OPTIONS, read_occurrence_tsv, read_quoted_tsv

from conftest import SF_SMALL


def _tsv(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\t".join(RAW_HEADER) + "\n")
        for line in lines:
            f.write(line + "\n")


def _line(**values):
    return "\t".join(values.get(n, "") for n in RAW_NAMES)


def test_tsv_fields(spark, workdir):
    p = f"{workdir}/x/extract.csv"
    _tsv(p, [
        _line(gbif_id="1", locality='a "q" b', taxon_key="5", decimal_latitude="45.5", year="2020"),
        _line(gbif_id="2", locality='"say ""hi"" x"', taxon_key="6"),
        _line(gbif_id="3", locality='""'),
        _line(gbif_id="4"),
    ])
    got = {r.gbif_id: r for r in read_occurrence_tsv(spark, p).collect()}
    assert got["1"].locality == 'a "q" b' and got["1"].taxon_key == 5 and got["1"].decimal_latitude == 45.5
    assert got["2"].locality == 'say "hi" x'
    assert got["3"].locality is None and got["4"].locality is None
    assert got["4"].year is None


@pytest.mark.parametrize("bad", ["too_few", "too_many", "bad_value"])
def test_tsv_malformed_rows_abort(spark, workdir, bad):
    p = f"{workdir}/{bad}/extract.csv"
    line = _line(gbif_id="1", taxon_key="5")
    if bad == "too_few":
        line = "\t".join(line.split("\t")[:10])
    elif bad == "too_many":
        line = line + "\textra"
    else:
        line = _line(gbif_id="1", taxon_key="not-a-number")
    _tsv(p, [line])
    with pytest.raises(Exception):
        read_occurrence_tsv(spark, p).select("gbif_id", "year")      # staged whole, whatever is read of it
    from occurrence_lake.plans.assets import ingest_extracts
    with pytest.raises(Exception):
        ingest_extracts(spark, p, f"{workdir}/raw", check_keys=False)
    from occurrence_lake.streaming.ingest import ServingIngest
    with pytest.raises(Exception):
        ServingIngest(spark, f"{workdir}/{bad}", f"{workdir}/serving", checkpoint=f"{workdir}/ckpt").run_available()


def test_year_partitions_replace_only_their_years(spark, workdir):
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    root = f"{workdir}/raw"
    n_all = write_years(raw, root)
    assert n_all == raw.count()
    write_years(raw.filter((F.col("year") == 2016) & (F.col("kingdom") == "Plantae")), root)
    back = read_raw_years(spark, root)
    assert back.filter(F.col("year") == 2016).count() == raw.filter(
        (F.col("year") == 2016) & (F.col("kingdom") == "Plantae")).count()
    assert back.filter(F.col("year") != 2016).count() == raw.filter(F.col("year") != 2016).count()
    assert back.columns == RAW_NAMES


def test_write_table_counts_and_materialize(spark, workdir):
    df = spark.range(123)
    assert write_table(df, f"{workdir}/t") == 123
    view = materialize(df, "occlake_test_view", f"{workdir}/t2")
    assert spark.table("occlake_test_view").count() == 123 and view.count() == 123


def test_fill_declared_checks_key(spark):
    ok = spark.createDataFrame([(1, "a", None, None)], "taxon_key long, vernacular_name_deu string, "
                               "vernacular_name_eng string, vernacular_name_fra string")
    assert fill_declared(spark, ok, VERNACULAR_SCHEMA, "taxon_key").dtypes[0] == ("taxon_key", "int")
    dup = ok.unionByName(ok)
    with pytest.raises(KeyViolation):
        fill_declared(spark, dup, VERNACULAR_SCHEMA, "taxon_key")


def test_upsert(spark, workdir):
    table = KeyedTable(spark, f"{workdir}/t", "k", slots=4)
    table.upsert(spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, "y")], "k string, v double, w string"))
    batch = spark.createDataFrame([
        ("b", None, "y2", 1),   # NULL replaces the old value
        ("c", 3.0, "z", 1),
        ("c", 4.0, "z2", 2),    # same key twice: the later one wins
    ], "k string, v double, w string, seq int")
    out = {r.k: r for r in table.upsert(batch, order_by=["seq"], drop=["seq"], batch_id="one").collect()}
    assert out["a"].v == 1.0
    assert out["b"].v is None and out["b"].w == "y2"
    assert out["c"].v == 4.0 and out["c"].w == "z2"
    assert table.read().columns == ["k", "v", "w"] and table.row_count() == 3
    table.upsert(spark.createDataFrame([("z", 0.0, "")], "k string, v double, w string"), batch_id="one")   # replayed: not applied again
    again = KeyedTable(spark, f"{workdir}/t", "k")           # as after a restart
    assert again.slots == 4 and again.last_batch() == "one" and again.read().count() == 3
    again.upsert(spark.createDataFrame([], "k string, v double, w string"))
    again.upsert(spark.createDataFrame([(None, 5.0, "q")], "k string, v double, w string"))
    again.upsert(spark.createDataFrame([(None, 6.0, "q")], "k string, v double, w string"))
    assert again.row_count() == 4 == again.read().count()
    assert again.resize(9).count() == 4 and again.slots == 9
    assert set(os.listdir(f"{workdir}/t")) - {".state.json.crc"} == {"state.json", again.state()["rows_at"]}
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, f"{workdir}/none", "k").read()


def _slot_files(table):
    root = f"{table.root}/{table.state()['rows_at']}"
    return {slot: sorted(f for f in os.listdir(f"{root}/{slot}") if f.startswith("part-")) for slot in os.listdir(root) if slot.startswith("slot=")}


def test_a_batch_of_ten_rows_rewrites_at_most_ten_slots(spark, workdir):
    table = KeyedTable(spark, f"{workdir}/s", "k", slots=64)
    table.replace(spark.range(2000).selectExpr("CAST(id AS STRING) AS k", "id AS v"))
    before = _slot_files(table)
    out = table.upsert(spark.range(10).selectExpr("CAST(id AS STRING) AS k", "id + 5000 AS v"))
    after = _slot_files(table)
    assert 0 < sum(before[s] != after[s] for s in before) <= 10 and before.keys() == after.keys()
    assert out.count() == table.row_count() == 2000 and out.filter("v >= 5000").count() == 10


def test_a_writer_that_dies_around_the_pointer(spark, workdir):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v long")
    table = KeyedTable(spark, f"{workdir}/d", "k", slots=32)
    table.replace(spark.range(200).selectExpr("CAST(id AS STRING) AS k", "id AS v"))
    whole, table._point = table._point, _die
    with pytest.raises(RuntimeError):
        table.upsert(rows(("1", -1)))                        # before the pointer: nothing has changed
    table._point = whole
    assert table.read().filter("v < 0").count() == 0 and len([f for f in os.listdir(f"{workdir}/d") if f.startswith("staged-")]) == 1
    table.clean()
    whole, table._write = table._write, lambda df, path, mode="errorifexists": _die() if mode == "overwrite" else whole(df, path, mode)
    with pytest.raises(RuntimeError):
        table.upsert(rows(("1", -1), ("new", -2)), batch_id="b")   # after it: committed, its slots still staged
    other = KeyedTable(spark, f"{workdir}/d", "k")
    assert other.last_batch() == "b" and other.state()["staged"]
    assert other.read().filter("v < 0").count() == 2 and other.read().count() == other.row_count() == 201
    other.upsert(rows(("2", -3)))                            # the next writer finishes it
    assert other.state()["staged"] is None and other.read().filter("v < 0").count() == 3 and other.read().count() == 201
    assert not [f for f in os.listdir(f"{workdir}/d") if f.startswith("staged-")]


def _die(*_, **__):
    raise RuntimeError("lost")


def test_groups_are_replaced_whole(spark, workdir):
    table = KeyedTable(spark, f"{workdir}/g", ["g", "p"], slots=16, by="g")
    rows = lambda *r: spark.createDataFrame(list(r), "g long, p long, v string")
    table.replace_groups(rows((1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (3, 0, "z")))
    table.replace_groups(rows((1, 0, "d")), spark.createDataFrame([(2,)], "g long"))
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, 0, "d"), (3, 0, "z")] and table.row_count() == 2
    slot = table.slots_of(rows((2, 0, "")))[0]
    assert f"slot={slot}" not in _slot_files(table) or table.slots_of(rows((1, 0, ""), (3, 0, ""))).count(slot)   # emptied
    table.replace_groups(rows((1, 1, "e")), group=["g", "p"])
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, 0, "d"), (1, 1, "e"), (3, 0, "z")]


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_located_rows_move_and_are_read_by_place(spark, workdir):
    table = LocatedTable(spark, f"{workdir}/l", "id", ["g"], slots=32)
    rows = lambda *r: spark.createDataFrame(list(r), "id string, g long, v long, seq int")
    table.upsert(spark.range(500).selectExpr("CAST(id AS STRING) AS id", "id % 50 AS g", "id AS v"))
    table.upsert(rows(("7", 8, -1, 1), ("7", 9, -2, 2), ("new", 8, -3, 1)), order_by=["seq"], drop=["seq"])
    places = spark.createDataFrame([(7,), (9,)], "g int")
    assert {(r.id, r.g) for r in table.at(places).collect() if r.v < 0 or r.id == "7"} == {("7", 9)}
    assert table.at(places).count() == 20 and table.read().count() == 501
    assert {(r.id, r.g) for r in table.located(spark.createDataFrame([("7",), ("new",), ("none",)], "id string")).collect()} == {("7", 9), ("new", 8)}
    for read in (table.at(places), table.located(rows(("7", 0, 0, 0)))):
        filters = re.search(r"PartitionFilters: \[([^\]]*)\]", _plan(read))[1]
        assert "slot" in filters, filters


@pytest.mark.parametrize("dies_in", ["rows", "places"])
def test_a_located_batch_is_finished_by_the_next(spark, workdir, dies_in):
    table = LocatedTable(spark, f"{workdir}/l", "id", ["g"], slots=8)
    rows = lambda *r: spark.createDataFrame(list(r), "id string, g long")
    table.upsert(rows(("a", 1), ("b", 2)))
    broken = getattr(table, dies_in)
    whole, broken.apply = broken.apply, _die
    with pytest.raises(RuntimeError):
        table.upsert(rows(("a", 3)))
    broken.apply = whole
    table.upsert(rows(("a", 4)))
    assert {tuple(r) for r in table.read().collect()} == {("a", 4), ("b", 2)}
    table.clean()
    assert sorted(f for f in os.listdir(f"{workdir}/l") if not f.startswith(".")) == ["places", "rows"]


def test_a_batch_reads_what_it_touches_whatever_the_history(spark, workdir):
    """Ten times the history in ten times the slots: as many rows read."""
    read = []
    for n in (1, 10):
        table = LocatedTable(spark, f"{workdir}/h{n}", "id", ["g"], slots=40 * n)
        table.upsert(spark.range(4000 * n).selectExpr("CAST(id AS STRING) AS id", f"id % {400 * n} AS g"))
        batch = spark.createDataFrame([("3", 17), ("5", 18)], "id string, g long")
        read.append((table.rows.read(table.rows.slots_of(batch)).count(), table.places.read(table.places.slots_of(batch)).count()))
    assert all(b < 2.5 * a for a, b in zip(*read)), read


def test_shared_folder_is_not_made_up_on_a_cluster():
    from occurrence_lake.config import shared_dir

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_dedupe_pick_first(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, name string")
    got = {r.k: r.name for r in dedupe_by_key(df, "k", ["name"], pick="first").collect()}
    assert got == {1: "a", 2: "c"}


def test_ingest_rejects_duplicate_ids_within_a_year(spark, workdir):
    from occurrence_lake.plans.assets import ingest_extracts
    p = f"{workdir}/dup/extract.csv"
    _tsv(p, [_line(gbif_id="1", year="2020"), _line(gbif_id="1", year="2020"), _line(gbif_id="1", year="2021")])
    with pytest.raises(KeyViolation):
        ingest_extracts(spark, p, f"{workdir}/raw")
    ok = f"{workdir}/ok/extract.csv"
    _tsv(ok, [_line(gbif_id="1", year="2020"), _line(gbif_id="1", year="2021")])
    assert ingest_extracts(spark, ok, f"{workdir}/raw2") == 2


def test_year_writes_split_a_dominant_year(spark, workdir):
    """A year holding 90% of the rows is written by several tasks (AQE
    rebalance splits it along map outputs); a small year stays one file."""
    import glob
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 200000, 1, 16).select(
            F.col("id").cast("string").alias("gbif_id"),
            F.when(F.col("id") % 10 != 0, F.lit(2020)).otherwise(F.lit(2015) + F.col("id") % 11).alias("year"),
            F.rand(1).alias("v"))
        assert write_years(df, f"{workdir}/skew") == 200000
        assert len(glob.glob(f"{workdir}/skew/year=2020/*.parquet")) > 4
        assert len(glob.glob(f"{workdir}/skew/year=2016/*.parquet")) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)


def test_ingest_leaves_no_staged_copy(spark, workdir):
    from occurrence_lake.config import shared_dir
    from occurrence_lake.plans.assets import ingest_extracts
    staged = lambda: {f for f in os.listdir(shared_dir(spark, "scratch").removeprefix("file:")) if f.startswith("staged-extracts")}
    materialize(spark.range(1), "occlake_some", f"{shared_dir(spark)}/scratch/some")
    before = staged()
    p = f"{workdir}/in/extract.csv"
    _tsv(p, [_line(gbif_id="1", year="2020")])
    assert ingest_extracts(spark, p, f"{workdir}/raw") == 1 and staged() == before
    _tsv(p, [_line(gbif_id="1", year="2020"), _line(gbif_id="1", year="2020")])
    with pytest.raises(KeyViolation):
        ingest_extracts(spark, p, f"{workdir}/raw")
    assert staged() == before


def test_year_append_keeps_both_downloads(spark, workdir):
    raw = fixtures.raw_occurrences(spark, SF_SMALL).filter(F.col("year") == 2018)
    root = f"{workdir}/appended"
    n = write_years(raw, root)
    write_years(raw, root, replace=False)              # same year, another download
    assert read_raw_years(spark, root).count() == 2 * n


def test_read_dataset_and_named_plan(spark, workdir):
    from occurrence_lake.sources.parquet import read_dataset
    spark.range(10).write.parquet(f"{workdir}/ds")
    assert read_dataset(spark, f"{workdir}/ds").count() == 10
    typed = read_dataset(spark, f"{workdir}/ds", schema="id long")
    assert typed.dtypes == [("id", "bigint")]
    view = materialize(spark.range(5), "occlake_named_plan")          # SNK-4 without storage
    assert spark.table("occlake_named_plan").count() == 5 and view.count() == 5


def _messy(rnd, n, eol):
    """Records of which many hold line breaks, quotes and tabs in quotes."""
    lines = []
    for i in range(n):
        kind = rnd.randrange(8)
        place = {0: f'"first{eol}second {i}"', 1: f'"{eol}"', 2: '"said ""so""' + eol + '""again"""', 3: 'a "q" b', 4: '"tab\tin quotes"',
                 5: "plain" * rnd.randrange(9), 6: '"one" more', 7: f'"{eol}{eol}long {"x" * rnd.randrange(300)}{eol}"'}[kind]
        lines.append(_line(gbif_id=str(i), locality=place, taxon_key=str(i % 7), issue='"last' + eol + 'field"' if rnd.random() < 0.2 else "", year="2020"))
        if rnd.random() < 0.05:
            lines.append("")        # an empty line is no record
    return "\t".join(RAW_HEADER) + eol + eol.join(lines) + (eol if rnd.random() < 0.5 else "")


@pytest.mark.parametrize("split", ["300", "2000", "128m"])
def test_line_breaks_in_quotes_do_not_depend_on_the_splits(spark, workdir, split):
    rnd = random.Random(int(split[:3]))
    os.makedirs(f"{workdir}/in")
    for i, (n, eol) in enumerate([(300, "\n"), (40, "\r\n"), (1, "\n"), (0, "\n"), (200, "\n")]):
        with open(f"{workdir}/in/{i}.csv", "w", newline="") as f:
            f.write(_messy(rnd, n, eol))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    want = sorted(map(str, spark.read.schema(RAW_SCHEMA).options(**{**TSV_READ_OPTIONS, "multiLine": "true"}).csv(f"{workdir}/in").collect()))
    try:
        for k, v in zip(keys, (split, "1")):
            spark.conf.set(k, v)
        got = read_quoted_tsv(spark, f"{workdir}/in")
        assert got.columns == RAW_NAMES
        got = sorted(map(str, got.collect()))
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    if split == "2000":
        from occurrence_lake.plans.assets import ingest_extracts
        assert ingest_extracts(spark, f"{workdir}/in/0.csv", f"{workdir}/raw", quoted_breaks=True) == 300
    # multiLine turns CRLF inside quotes into LF; ours keeps the field as it is
    assert sorted(g.replace("\\r\\n", "\\n") for g in got) == sorted(want) and len(got) == 541


def test_quotes_never_closed_and_wrong_rows_abort(spark, workdir):
    for name, line in (("open", _line(gbif_id="1", locality='"never closed')), ("few", 'a\t"b\nc"'), ("value", _line(gbif_id="1", locality='"a\nb"', taxon_key="x"))):
        _tsv(f"{workdir}/{name}/e.csv", [line, _line(gbif_id="2")])
        with pytest.raises(Exception):
            read_quoted_tsv(spark, f"{workdir}/{name}")
