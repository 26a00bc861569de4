"""Streams of a job: sequential batches with publishing every few of them, resumption by checkpoint, events as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.events import count_windows, windowed

__all__ = ["count_windows", "run_to_end", "stream_parquet", "windowed"]


def stream_parquet(spark: SparkSession, sf_dir: str, name: str, files: int = 1) -> DataFrame:
    """A table of Parquet files as a stream of `files` files a batch; a single file or a directory of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{sf_dir}/{name}*.parquet")


def run_to_end(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], publish: Callable[[int], None] | None = None, every: int = 0, mode: str = "append") -> int:
    """Works off what is there, batch by batch in order, and gives the number of batches. A run with the same checkpoint goes on where the last
    one ended. publish is called after every `every` batches; its failure is not the job's."""
    seen = 0

    def step(batch: DataFrame, i: int) -> None:
        nonlocal seen
        each(batch, i)
        seen += 1
        if publish and every and (i + 1) % every == 0:
            try:
                publish(i)
            except Exception:  # noqa: BLE001
                pass

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
    query.awaitTermination()
    return seen
