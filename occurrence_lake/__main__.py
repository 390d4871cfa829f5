"""Command line: run the pipeline on real extracts.

    python -m occurrence_lake ingest  --extracts 'landing/*.csv' --raw lake/raw
    python -m occurrence_lake run     --raw lake/raw --replies lake/replies --out lake/tables --serving lake/serving
    python -m occurrence_lake layer   --serving lake/serving --bbox 5 45 6 46 [--taxon-key 2440940] --output lake/box
    python -m occurrence_lake tiles   --serving lake/serving --tiles requests/ --output lake/tile_species
    python -m occurrence_lake stream  --landing landing/ --serving lake/serving
    python -m occurrence_lake resize  --serving lake/serving --slots 256
    python -m occurrence_lake clean   [--serving lake/serving]   # what died jobs left behind

``--replies`` is a Parquet or JSON-lines dataset of species-API replies
``(taxon_key, page, body)``; every path may be on any Hadoop file system.
Submit with ``spark-submit -m occurrence_lake ...`` or run locally.
"""

from __future__ import annotations

import argparse
import json
import sys

from occurrence_lake.config import build_session, clean
from occurrence_lake.functions.geo import Box
from occurrence_lake.sinks.upsert import SERVING_SLOTS


def _replies(spark, path: str, rejected: str | None):
    """Name records of a reply dataset; a malformed reply ends the run, or
    goes to the table ``rejected``."""
    from occurrence_lake.sources.replies import checked_replies, parse_species_replies
    reader = spark.read.schema("taxon_key bigint, page bigint, body string")
    df = reader.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)
    good = checked_replies(df.select("taxon_key", "page", "body"), rejected)
    if rejected and (n := spark.read.parquet(rejected).count()):
        print(json.dumps({"malformed_replies": n, "written_to": rejected}), file=sys.stderr)
    return parse_species_replies(good)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="occurrence_lake")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--shuffle-partitions", type=int, default=200)
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest", help="TSV extracts -> year-partitioned raw Parquet")
    p.add_argument("--extracts", required=True)
    p.add_argument("--raw", required=True)
    p.add_argument("--no-key-check", action="store_true")
    p.add_argument("--acquire", action="store_true", help="apply the acquisition predicate (country, area, "
                   "kingdom, years) to extracts that were not filtered at download")
    p.add_argument("--append", action="store_true", help="keep rows already stored for the same years")
    p.add_argument("--quoted-breaks", action="store_true", help="quoted fields may hold line breaks")

    p = sub.add_parser("run", help="all tables + serving upserts")
    p.add_argument("--raw", required=True)
    p.add_argument("--replies", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--serving", required=True)
    p.add_argument("--rejected", default=None, help="write malformed replies here and go on (without: they end the run)")
    p.add_argument("--parts", type=int, default=1, help="rows that each species' MultiPoint is split into")
    p.add_argument("--part-points", type=int, default=None, help="split species by place into parts of at most so many points")
    p.add_argument("--slots", type=int, default=SERVING_SLOTS, help="slots of the serving tables when they are first made")
    p.add_argument("--no-key-check", action="store_true")

    p = sub.add_parser("layer", help="species rows overlapping a box")
    p.add_argument("--serving", required=True)
    p.add_argument("--bbox", type=float, nargs=4, metavar=("MIN_LON", "MIN_LAT", "MAX_LON", "MAX_LAT"),
                   required=True)
    p.add_argument("--taxon-key", type=int, default=None)
    p.add_argument("--output", required=True, help="write the rows as Parquet here")
    p.add_argument("--parts-only", action="store_true", help="only the parts of species that overlap the box, not whole species")

    p = sub.add_parser("tiles", help="species rows overlapping each requested tile (z, x, y)")
    p.add_argument("--serving", required=True)
    p.add_argument("--tiles", required=True, help="Parquet dataset with integer columns z, x, y")
    p.add_argument("--output", required=True)
    p.add_argument("--grid", choices=("mercator", "geographic"), default="mercator",
                   help="tiling scheme of the requests (XYZ map requests are mercator)")

    p = sub.add_parser("stream", help="process every extract in a landing folder, then stop")
    p.add_argument("--landing", required=True)
    p.add_argument("--serving", required=True)
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--parts", type=int, default=1)
    p.add_argument("--slots", type=int, default=SERVING_SLOTS)

    p = sub.add_parser("resize", help="deal the serving tables into another number of slots (about one per 128 MB)")
    p.add_argument("--serving", required=True)
    p.add_argument("--slots", type=int, required=True)

    p = sub.add_parser("clean", help="remove scratch tables and what died writers left (while no job runs)")
    p.add_argument("--serving", default=None)

    args = ap.parse_args(argv)
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)

    if args.cmd == "ingest":
        from occurrence_lake.plans.assets import ingest_extracts
        n = ingest_extracts(spark, args.extracts, args.raw, check_keys=not args.no_key_check,
                            acquire=args.acquire, replace=not args.append, quoted_breaks=args.quoted_breaks)
        print(json.dumps({"partitioned_raw_occurrences": n}))
    elif args.cmd == "run":
        from occurrence_lake.plans.assets import run
        report = run(spark, args.raw, _replies(spark, args.replies, args.rejected), args.out, args.serving,
                     name_order=("page", "pos"), check_keys=not args.no_key_check, parts=args.parts, slots=args.slots,
                     part_points=args.part_points)
        print(json.dumps(report.row_counts | {"null_taxon_keys": report.null_keys}))
    elif args.cmd == "layer":
        from occurrence_lake.operators.layer import layer_bbox
        from occurrence_lake.streaming.ingest import serving_tables
        species = serving_tables(spark, args.serving)[1].read()
        layer_bbox(species, Box(*args.bbox), args.taxon_key, whole=not args.parts_only).write.mode("overwrite").parquet(args.output)
    elif args.cmd == "tiles":
        from occurrence_lake.operators.layer import layer_tiles
        from occurrence_lake.streaming.ingest import serving_tables
        species = serving_tables(spark, args.serving)[1].read()
        pairs = layer_tiles(species, spark.read.parquet(args.tiles), grid=args.grid)
        pairs.write.mode("overwrite").parquet(args.output)
    elif args.cmd == "stream":
        from occurrence_lake.streaming.ingest import ServingIngest
        ServingIngest(spark, args.landing, args.serving, args.checkpoint, parts=args.parts, slots=args.slots).run_available()
    elif args.cmd == "resize":
        from occurrence_lake.streaming.ingest import serving_tables
        for table in serving_tables(spark, args.serving):
            table.resize(args.slots)
    elif args.cmd == "clean":
        from occurrence_lake.streaming.ingest import serving_tables
        clean(spark)
        for table in serving_tables(spark, args.serving) if args.serving else ():
            table.clean()
    return 0


if __name__ == "__main__":
    sys.exit(main())
