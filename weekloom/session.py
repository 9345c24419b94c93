"""Session used by the tests and the benchmark; applications bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    settings = {
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores if cores != "*" else 8),
        "spark.sql.session.timeZone": "UTC",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("weekloom")
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
