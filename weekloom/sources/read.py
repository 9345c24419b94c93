"""CSV and Parquet scans of a file or of a folder of daily files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_data(
    spark: SparkSession,
    path: str | list[str],
    file_type: str = "csv",
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Scan ``path``; further options go to the reader.

    A CSV has a header line. Without a ``schema`` its types are inferred, which
    costs an extra pass over the file: give one for large inputs.
    """
    if file_type not in ("csv", "parquet"):
        raise ValueError(f"unsupported file type: {file_type}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if file_type == "csv":
        options = {"header": True, "inferSchema": schema is None, **options}
    try:
        return reader.options(**options).format(file_type).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such file or folder: {path}") from error
        raise


def read_folder(
    spark: SparkSession,
    folder: str,
    file_type: str = "csv",
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """All files below ``folder`` as one table, whatever their nesting."""
    return load_data(spark, folder, file_type, schema, recursiveFileLookup=True, **options)
