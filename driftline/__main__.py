"""python -m driftline --config FILE [STAGE...]: the stages in order on one session; the first failure ends the run."""

from __future__ import annotations

import argparse
import sys

from driftline import app
from driftline.config import load_config

STAGES = ("fetch", "extract", "translate", "build", "package")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="driftline")
    parser.add_argument("stages", nargs="*", default=list(STAGES), help=f"of {', '.join(STAGES)}, export; all but export if none is named")
    parser.add_argument("--config", default="config.yaml")
    parser.add_argument("--status", choices=("new", "changed"), help="for export: one status; else both")
    args = parser.parse_args(argv)
    unknown = set(args.stages) - {*STAGES, "export"}
    if unknown:
        parser.error(f"unknown stages: {', '.join(sorted(unknown))}")
    cfg = load_config(args.config)

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("driftline").config("spark.speculation", "false").getOrCreate()  # calls to services have effects
    for stage in args.stages:
        if stage == "package":
            done = app.package(cfg, spark=spark)
        elif stage == "export":
            done = app.export(spark, cfg, args.status)
        else:
            done = getattr(app, stage)(spark, cfg)
            if stage == "extract":
                done = work_counts(done)
        print(f"{stage}: {done}", flush=True)
        if stage == "translate" and done["n_failed_batches"]:
            print("the checkpoint is kept; run again for the failed batches", flush=True)
            return 1
    return 0


def work_counts(items) -> dict:
    from driftline.operators import work

    return work.counts(items).first().asDict()


if __name__ == "__main__":
    sys.exit(main())
