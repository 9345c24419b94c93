"""Incremental ingest of a folder that receives daily files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    table_path: str,
    checkpoint: str,
    schema: T.StructType | str,
    file_type: str = "csv",
    files_per_batch: int = 10_000,
    **options,
) -> DataFrame:
    """Append the files not seen before to ``table_path`` and return that table.

    The checkpoint remembers which files were taken, so a repeated or restarted
    run takes each file exactly once.
    """
    if file_type == "csv":
        options = {"header": True, **options}
    arriving = (
        spark.readStream.schema(schema)
        .format(file_type)
        .options(recursiveFileLookup=True, maxFilesPerTrigger=files_per_batch, **options)
        .load(folder)
    )
    run = (
        arriving.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(schema).parquet(table_path)
