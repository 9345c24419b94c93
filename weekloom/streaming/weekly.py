"""Weekly tables that are kept up to date as daily files arrive.

The state is a folder of cells: per batch of new files the sums and counts per city, category and period. A batch
overwrites its own part only, so a batch that is repeated after a crash counts once, and no file is read twice.
The tables are read off the sum of all parts; ``compact`` folds parts into one, so that there are never many.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.columns import RETAIL, SalesColumns
from weekloom.operators.aggregate import ForecastTables, period_cells, tables_of_cells
from weekloom.operators.schema import coerce_types, quoted

_SUM, _COUNT = "__sum", "__n"


def update_cells(
    spark: SparkSession,
    folder: str,
    cells_path: str,
    checkpoint: str,
    schema: T.StructType | str,
    columns: SalesColumns = RETAIL,
    grain: str = "week",
    file_type: str = "csv",
    files_per_batch: int = 10_000,
    **options,
) -> int:
    """Add the files not seen before to the cells; returns the number of batches that took.

    Rows are coerced as in the flow: what is no number or date counts as missing.
    """
    if file_type == "csv":
        options = {"header": True, **options}
    arriving = (
        spark.readStream.schema(schema)
        .format(file_type)
        .options(recursiveFileLookup=True, maxFilesPerTrigger=files_per_batch, **options)
        .load(folder)
    )
    taken = []

    def add(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, cells_path, columns, grain)
        taken.append(batch_id)

    arriving.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(taken)


def store_batch(batch: DataFrame, batch_id: int, cells_path: str, columns: SalesColumns = RETAIL, grain: str = "week") -> None:
    """Write the cells of one batch in the place that belongs to its id, whatever was there. A batch
    that a fold already holds is left out."""
    if batch_id <= _folded(batch.sparkSession, cells_path)[0]:
        return
    cells = period_cells(coerce_types(batch, columns.required), columns, grain)
    _fixed(cells).write.mode("overwrite").parquet(f"{cells_path.rstrip('/')}/batch-{batch_id}")


def _fixed(cells: DataFrame) -> DataFrame:
    """Sums keep one type, however often they are added up."""
    return cells.withColumns({_SUM: F.col(_SUM).cast("decimal(38,4)"), _COUNT: F.col(_COUNT).cast("long")})


def _parts(spark: SparkSession, cells_path: str) -> dict[str, str]:
    path_type = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = path_type(cells_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
    return {p.getName(): p.toString() for p in found if fs.exists(path_type(p, "_SUCCESS"))}


def _folded(spark: SparkSession, cells_path: str) -> tuple[int, str | None]:
    """The last batch of the newest whole fold, and its path."""
    folds = [(int(m[1]), path) for name, path in _parts(spark, cells_path).items() if (m := re.fullmatch(r"upto-(\d+)", name))]
    return max(folds, default=(-1, None))


def stored_cells(spark: SparkSession, cells_path: str, columns: SalesColumns = RETAIL) -> DataFrame:
    """The sum of all parts, one row per city, category and period."""
    upto, fold = _folded(spark, cells_path)
    paths = [fold] if fold else []
    for name, path in _parts(spark, cells_path).items():
        match = re.fullmatch(r"batch-(\d+)", name)
        if match and int(match[1]) > upto:
            paths.append(path)
    if not paths:
        raise FileNotFoundError(f"no cells in {cells_path}")
    keys = [quoted(c) for c in (columns.city, columns.category, columns.week)]
    return _fixed(spark.read.parquet(*paths).groupBy(*keys).agg(F.sum(_SUM).alias(_SUM), F.sum(_COUNT).alias(_COUNT)))


def compact(spark: SparkSession, cells_path: str, columns: SalesColumns = RETAIL) -> None:
    """Fold all batches into one part. Until that is whole, readers use the parts it replaces; those
    are left in place."""
    batches = [int(m[1]) for name in _parts(spark, cells_path) if (m := re.fullmatch(r"batch-(\d+)", name))]
    last = max(batches, default=-1)
    if last > _folded(spark, cells_path)[0]:
        stored_cells(spark, cells_path, columns).write.mode("overwrite").parquet(f"{cells_path.rstrip('/')}/upto-{last}")


def stored_tables(
    spark: SparkSession, cells_path: str, columns: SalesColumns = RETAIL, grain: str = "week"
) -> ForecastTables:
    """The sales tables and summaries of all files taken so far."""
    return tables_of_cells(stored_cells(spark, cells_path, columns), columns, grain)
