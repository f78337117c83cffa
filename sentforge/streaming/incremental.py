"""Run a batch ``DataFrame -> DataFrame`` operator over newly arrived files.

Structured Streaming tracks which files were processed in
``checkpoint_location``, which the caller names and keeps between runs; each
micro-batch is handed to the batch operator via ``foreachBatch`` and written to
its own ``batch=<id>`` folder, overwriting what a failed attempt left there.  A
restart, also of a new application, so neither skips nor repeats a file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def process_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    operator: Callable[[DataFrame], DataFrame],
    output_dir: str,
    checkpoint_location: str,
    fmt: str = "json",
    out_fmt: str = "parquet",
) -> None:
    """Process every file not yet seen in ``source_dir`` once, then stop
    (``availableNow``); call again when new files land."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)

    def batch(df: DataFrame, epoch_id: int) -> None:
        operator(df).write.mode("overwrite").format(out_fmt).save(f"{output_dir.rstrip('/')}/batch={epoch_id}")

    q = stream.writeStream.foreachBatch(batch).option(
        "checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
    q.awaitTermination()
