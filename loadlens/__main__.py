"""Training and scoring jobs from the command line.

    python -m loadlens train LOG MODEL [--percentile P] [--valid LOG] [--profile NAME]
    python -m loadlens apply LOG MODEL OUT [--key COLUMN] [--shift S] [--profile NAME]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from loadlens import constants as K
from loadlens.plans.flows import score_job, train_job


def main(words: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loadlens")
    jobs = parser.add_subparsers(dest="job", required=True)
    train = jobs.add_parser("train")
    train.add_argument("log")
    train.add_argument("model")
    train.add_argument("--percentile", type=float, default=K.TRIM_TRAIN)
    train.add_argument("--valid")
    train.add_argument("--valid-percentile", type=float, default=K.TRIM_VALIDATION)
    apply = jobs.add_parser("apply")
    apply.add_argument("log")
    apply.add_argument("model")
    apply.add_argument("out")
    apply.add_argument("--key", default=K.KEY)
    apply.add_argument("--shift", type=float, default=0.0)
    for job in (train, apply):
        job.add_argument("--profile", choices=["production", "spark"], default="production")
    given = parser.parse_args(words)

    spark = SparkSession.builder.appName(f"loadlens-{given.job}").getOrCreate()
    if given.job == "train":
        report = train_job(
            spark, given.log, given.model, given.percentile, given.valid, given.valid_percentile, given.profile
        )
        report.counts.show(truncate=False)
        report.error.show()
        report.profile.orderBy("bin").show(100)
    else:
        report = score_job(spark, given.log, given.model, given.out, given.key, given.profile, given.shift)
        report.counts.show()
        report.histogram.orderBy("bin").show(100)


if __name__ == "__main__":
    main()
