"""Intermediate tables of long operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weekloom.shared import materialise

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH_ROWS, _BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(df: DataFrame) -> None:
    """Have Spark send texts to Python in batches of at most 1,000 rows and about 8 MB, unless the
    session asks for less. The default, 10,000 rows, is a gigabyte of long documents."""
    conf = df.sparkSession.conf
    for key, most in ((_BATCH_ROWS, 1_000), (_BATCH_BYTES, 8 << 20)):
        value = conf.get(key).lower().removesuffix("b")
        if not value.isdigit() or not 0 < int(value) <= most:
            conf.set(key, str(most))


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What was shuffled for it is of no use once it is written. Spark would remove such files when the
    driver's garbage happens to be collected; here they go with the end of the write.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return materialise(df, label)
    finally:
        conf.set(_CLEANUP, before) if before is not None else conf.unset(_CLEANUP)
