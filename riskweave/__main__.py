"""Runs one stage: ``spark-submit ... -m riskweave <stage> -conf <file.json>``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from riskweave.plans.configs import STAGES
from riskweave.plans.stages import run_stage
from riskweave.session import ship_package


def main() -> None:
    parser = argparse.ArgumentParser(prog="riskweave")
    parser.add_argument("stage", choices=list(STAGES))
    parser.add_argument("-conf", required=True, help="JSON configuration of the stage")
    args = parser.parse_args()
    with open(args.conf, encoding="utf-8") as f:
        config = json.load(f)
    spark = SparkSession.builder.appName(f"riskweave {args.stage}").getOrCreate()
    ship_package(spark)
    run_stage(spark, args.stage, config)


if __name__ == "__main__":
    main()
