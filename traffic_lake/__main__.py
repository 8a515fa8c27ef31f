"""Run one stage on the command line.

    python -m traffic_lake ingest    --lake /lake --land /landing
    python -m traffic_lake raw       --lake /lake
    python -m traffic_lake processed --lake /lake
    python -m traffic_lake inspect   --lake /lake

All tables and checkpoints of a lake lie under its folder. ``--once`` works off
what is there and ends; without it a stage keeps running at its own pace.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import document_count, inspect_fields
from .sinks import ensure_target
from .sources import read_bronze
from .streaming import ingest_stream, processed_stream, raw_stream

# Columns without which a table counts as one of an older structure.
REQUIRED = {"raw": (), "processed": ("pig_event_filter",)}


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = args.lake.rstrip("/")
    documents = f"{lake}/documents"
    if args.stage == "inspect":
        stored = read_bronze(spark, documents)
        if document_count(stored).first()["n"] == 0:
            print("no documents stored yet")
        else:
            found = inspect_fields(stored, newest=args.newest)
            print(*found.columns, sep="\t")
            for row in found.toLocalIterator():  # every path, however many
                print(*row, sep="\t")
        return
    if args.stage == "ingest":
        query = ingest_stream(
            spark, args.land, documents, f"{lake}/checkpoints/ingest", f"{lake}/unreadable",
            f"{lake}/cycles/ingest", multi_line=not args.lines, max_files_per_trigger=args.files,
            available_now=args.once,
        )
    else:
        # A table of an older structure is left as it is; the next version starts from
        # nothing with a checkpoint of its own.
        _, path = ensure_target(spark, f"{lake}/{args.stage}", REQUIRED[args.stage])
        version = path.rsplit("/", 1)[1]
        stream = raw_stream if args.stage == "raw" else processed_stream
        query = stream(
            read_bronze(spark, documents, True, args.files), path, f"{lake}/checkpoints/{args.stage}-{version}",
            f"{lake}/rejected/{args.stage}-{version}", f"{lake}/cycles/{args.stage}-{version}", available_now=args.once,
        )
    query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="traffic_lake", description=__doc__.split("\n")[0])
    parser.add_argument("stage", choices=["ingest", "raw", "processed", "inspect"])
    parser.add_argument("--lake", required=True, help="folder of all tables and checkpoints")
    parser.add_argument("--land", help="folder of landed snapshots (ingest)")
    parser.add_argument("--lines", action="store_true", help="snapshots are one envelope per line")
    parser.add_argument("--files", type=int, help="most files per micro-batch")
    parser.add_argument("--newest", type=int, default=100, help="documents to inspect")
    parser.add_argument("--once", action="store_true", help="end when everything present is read")
    args = parser.parse_args(argv)
    if args.stage == "ingest" and not args.land:
        parser.error("ingest needs --land")
    run(SparkSession.builder.appName(f"traffic-lake-{args.stage}").getOrCreate(), args)


if __name__ == "__main__":
    main()
