"""Run a job file: spark-submit graphload/__main__.py -c job.json --executor module:factory

The job file is the JSON form of the dict that Job.from_dict takes, on any file
system Spark reads.
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession

from graphload.operators.delivery import reload
from graphload.plans import Job, run_job


def load_factory(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="graphload")
    parser.add_argument("-c", "--config", required=True, help="job file (JSON)")
    parser.add_argument("-D", "--dry", action="store_true", help="show the inputs, write nothing")
    parser.add_argument("-r", "--reload", help="folder of failed statements to send again")
    parser.add_argument("-p", "--params", help="values of path variables, k=v,k=v")
    parser.add_argument("--executor", help="module:factory of the statement executor")
    options = parser.parse_args(args)

    spark = SparkSession.builder.appName("graphload").getOrCreate()
    text = spark.read.text(options.config, wholetext=True).first()[0]
    job = Job.from_dict(json.loads(text))
    factory = load_factory(options.executor) if options.executor else None
    if options.reload:
        done = reload(spark, options.reload, factory, job.delivery, job.failures,
                      spark.sparkContext.applicationId)
        done.selectExpr("sum(records - failed) AS sent", "sum(failed) AS failed").show()
        return
    report = run_job(spark, job, factory, options.params, options.dry)
    for name, rows in report.previews.items():
        print(name)
        rows.show(truncate=False)
    if report.stats is not None:
        report.stats.show(truncate=False)
    if report.streams:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
