"""Session settings for runs that bring no session of their own (bench, tests, checks)."""

import os

from pyspark.sql import SparkSession


def session(name: str, cores: str | int | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or 8
    return (SparkSession.builder.master(f"local[{cores}]").appName(name)
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.sql.files.minPartitionNum", str(cores))
            # small files of one row group, see sources.corpus.dealt; unset, scans stay as they are
            .config("spark.readgrade.partitions", str(cores))
            # documents of a task that one aggregate holds before it falls back to sorting all tokens
            .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "8192")
            .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
            .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
            .config("spark.log.level", "ERROR").getOrCreate())
