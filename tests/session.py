from __future__ import annotations

import os

from pyspark.sql import SparkSession


def make_session(cores: str | int | None = None) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores or os.environ.get('BENCH_CPUS', 8)}]")
        .appName("tablework")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
