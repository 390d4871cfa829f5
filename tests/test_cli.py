from pyspark.sql import functions as F

from occurrence_lake.__main__ import main
from occurrence_lake.sources import fixtures
from occurrence_lake.sources.tsv import write_occurrence_tsv
from occurrence_lake.streaming.ingest import serving_tables

from conftest import SF_SMALL


def test_cli_end_to_end(spark, workdir, capsys):
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    write_occurrence_tsv(raw.filter(F.col("year") <= 2020), f"{workdir}/landing/a")
    write_occurrence_tsv(raw.filter(F.col("year") > 2020), f"{workdir}/landing/b")
    replies = fixtures.species_replies_from_records(fixtures.vernacular_records(spark, SF_SMALL))
    replies.write.parquet(f"{workdir}/replies")
    common = ["--shuffle-partitions", "8"]

    assert main(common + ["ingest", "--extracts", f"{workdir}/landing/*", "--raw", f"{workdir}/raw"]) == 0
    assert main(common + ["run", "--raw", f"{workdir}/raw", "--replies", f"{workdir}/replies",
                          "--out", f"{workdir}/tables", "--serving", f"{workdir}/serving"]) == 0
    out = capsys.readouterr().out
    assert '"partitioned_raw_occurrences": %d' % raw.count() in out and '"species_names"' in out

    assert main(common + ["layer", "--serving", f"{workdir}/serving", "--bbox", "5", "45", "6", "46",
                          "--output", f"{workdir}/layer"]) == 0
    assert spark.read.parquet(f"{workdir}/layer").count() > 0
    spark.createDataFrame([(9, 269, 123), (9, 270, 124), (3, 8, 1)], "z int, x long, y long") \
        .write.parquet(f"{workdir}/tiles")
    assert main(common + ["tiles", "--serving", f"{workdir}/serving", "--tiles", f"{workdir}/tiles",
                          "--output", f"{workdir}/tile_species", "--grid", "geographic"]) == 0
    pairs = spark.read.parquet(f"{workdir}/tile_species")
    assert pairs.columns[:3] == ["z", "x", "y"] and pairs.filter("z = 3").count() > 0

    assert main(common + ["stream", "--landing", f"{workdir}/landing", "--serving", f"{workdir}/streamed",
                          "--checkpoint", f"{workdir}/ckpt"]) == 0
    streamed, batch = (serving_tables(spark, f"{workdir}/{root}")[0].read() for root in ("streamed", "serving"))
    n = batch.count()
    assert streamed.count() == n > 0
    assert main(common + ["resize", "--serving", f"{workdir}/streamed", "--slots", "3"]) == 0
    resized = serving_tables(spark, f"{workdir}/streamed")
    assert resized[0].rows.slots == resized[1].slots == 3 and resized[0].read().count() == n
    # a stream goes on with what a run has stored
    assert main(common + ["stream", "--landing", f"{workdir}/landing", "--serving", f"{workdir}/serving",
                          "--checkpoint", f"{workdir}/ckpt2", "--parts", "4"]) == 0
    occurrences, species = serving_tables(spark, f"{workdir}/serving")
    assert occurrences.read().count() == n
    assert species.read().agg(F.sum("n_points")).first()[0] == occurrences.read().filter("coordinates IS NOT NULL").count()


def test_cli_ingest_with_acquisition(spark, workdir):
    from occurrence_lake.operators.refine import acquire
    from occurrence_lake.sources.parquet import read_raw_years
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    write_occurrence_tsv(raw, f"{workdir}/landing")
    assert main(["--shuffle-partitions", "8", "ingest", "--extracts", f"{workdir}/landing",
                 "--raw", f"{workdir}/raw", "--acquire"]) == 0
    assert read_raw_years(spark, f"{workdir}/raw").count() == acquire(raw).count() < raw.count()
