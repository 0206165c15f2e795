"""python -m shelfwise.cli STEP | run-all | run-all-ingestion | load-stores --input FILE"""

from __future__ import annotations

import argparse
import dataclasses
import json
import logging
import os
import sys

from pyspark.sql import SparkSession

from shelfwise.plans import pipeline
from shelfwise.settings import Settings, load_env


def session() -> SparkSession:
    return SparkSession.builder.appName("shelfwise").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="shelfwise", description=__doc__)
    parser.add_argument("step", nargs="?", default="run-all")
    parser.add_argument("--input", help="store list of load-stores")
    parser.add_argument("--batch-run-id", help="batch of index, in place of the newest")
    parser.add_argument("--log-file", default=os.environ.get("LOG_FILE"), help="where to log, beside the terminal")
    given = parser.parse_args(args)
    load_env()
    handlers = [logging.StreamHandler(), *([logging.FileHandler(given.log_file, encoding="utf-8")] if given.log_file else [])]
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", handlers=handlers)
    settings, spark = Settings.from_env(), session()
    if given.batch_run_id:
        settings = dataclasses.replace(settings, batch_run_id=given.batch_run_id)
    if given.step in ("run-all", "run-all-ingestion"):
        names = pipeline.ALL if given.step == "run-all" else pipeline.ALL_INGESTION
        print(json.dumps(pipeline.run_all(spark, settings, names)))
    elif given.step == "load-stores":
        print(json.dumps(pipeline.load_stores(spark, settings, given.input)))
    elif given.step in (known := pipeline.steps(spark, settings)):
        print(known[given.step]())
    else:
        parser.error(f"no step {given.step}; there are run-all, run-all-ingestion, load-stores, {', '.join(known)}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
