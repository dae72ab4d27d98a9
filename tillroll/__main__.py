"""Command line: ``python -m tillroll batch ...`` and ``python -m tillroll stream ...``.

The session comes from the environment (spark-submit / cluster defaults);
``--local`` builds a local one for trying things out.
"""
from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tillroll import config as C
from tillroll.session import local_session, pin_session


def _session(local: bool, app: str) -> SparkSession:
    if local:
        return local_session(app=app)
    return pin_session(SparkSession.builder.appName(app).getOrCreate())


# Flag names are the interface; (flags, options) of each command.
PATHS = ("source_path", "processed_path", "curated_path", "quarantine_path", "state_path")
FLAGS = {
    "batch": [*[(f"--{p}", {"required": True}) for p in PATHS], ("--metrics_path", {}),
              ("--run_date", {"help": "ingest day to process again, YYYY-MM-DD"}),
              ("--log_path", {"help": "table that gets a line for every run"}),
              ("--tables", {"help": "register the three tables in the catalog under names that begin with this, and report drift"}),
              ("--valid_regions", {"default": ",".join(C.REFERENCE_REGIONS), "help": "comma-separated region codes that pass the checks"})],
    "stream": [("--source", {"choices": ("files", "kafka", "kinesis"), "default": "files"}), ("--input", {"help": "where payload files arrive"}),
               ("--bootstrap", {}), ("--topic", {}), ("--stream", {}), ("--region", {"default": "ap-south-1"}),
               ("--output", {"required": True, "help": "folder for tables and checkpoints"}),
               ("--max-records", {"type": int, "default": C.STREAM_MAX_RECORDS}),
               ("--once", {"action": "store_true", "help": "end when the waiting payloads are processed"})],
}


def batch(a: argparse.Namespace) -> None:
    from tillroll.plans.batch import BatchPaths, run_batch

    regions = tuple(filter(None, (r.strip().upper() for r in a.valid_regions.split(","))))
    run_batch(_session(a.local, "tillroll-batch"), BatchPaths(*[getattr(a, p) for p in PATHS], a.metrics_path, a.log_path, a.tables), a.run_date,
              C.LakeConfig(valid_regions=regions))


def stream(a: argparse.Namespace) -> None:
    from tillroll.streaming import job

    options = {"files": lambda: job.file_options(), "kafka": lambda: job.kafka_options(a.bootstrap, a.topic, a.max_records),
               "kinesis": lambda: job.kinesis_options(a.stream, a.region, a.max_records)}[a.source]()
    spark, out = _session(a.local, "tillroll-stream"), a.output.rstrip("/")
    job.run_stream(spark, a.source, out, a.input if a.source == "files" else None, options, once=a.once)
    if a.source == "files":
        table = spark.read.schema(job.PROGRESS).parquet(f"{out}/{C.STREAM_PROGRESS_DIR}")
        for r in table.groupBy("query_name").agg({"num_input_rows": "sum"}).orderBy("query_name").collect():  # a row a query
            logging.info("%s read %d rows", *r)


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s [tillroll] %(message)s")
    parser = argparse.ArgumentParser(prog="tillroll")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, flags in FLAGS.items():
        command = commands.add_parser(name)
        for flag, options in [*flags, ("--local", {"action": "store_true", "help": "use a local session"})]:
            command.add_argument(flag, **options)
    args = parser.parse_args(argv)
    {"batch": batch, "stream": stream}[args.command](args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
