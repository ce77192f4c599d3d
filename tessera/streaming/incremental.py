"""Apply a stateless DataFrame operator to new files of a folder with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def run_incremental(spark: SparkSession, source_dir: str, schema: T.StructType,
                    transform: Callable[[DataFrame], DataFrame], sink_dir: str,
                    checkpoint_location: str, max_files_per_trigger: int = 1000) -> int | None:
    """Read new Parquet files of ``source_dir``, apply ``transform`` and append the result
    to ``sink_dir`` as Parquet.  Progress is kept in ``checkpoint_location``, which belongs to
    the sink: the caller names a lasting folder and gives the same one on every run, also of
    another application, so a rerun resumes where the last one stopped and each file's rows
    arrive exactly once.  Returns the id of the last micro-batch, None if there was nothing new."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    query = (transform(stream).writeStream.format("parquet")
             .option("path", sink_dir).option("checkpointLocation", checkpoint_location)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    done = query.lastProgress
    return None if done is None else int(done["batchId"])
