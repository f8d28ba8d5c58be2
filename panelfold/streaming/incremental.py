"""Structured Streaming form of the periodic load: landed files are upserted batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelfold.sources.sinks import claim_version, prune_versions, upsert_partitions, upsert_version


def query_id(checkpoint: str, spark: SparkSession) -> str:
    """What Spark calls the query of a checkpoint: a checkpoint that was deleted and made anew has another id."""
    return spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]


def stream_upsert(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table: str,
    keys: Sequence[str],
    update: Sequence[str],
    checkpoint: str,
    order: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    partition: str | None = None,
    touch: Sequence[str] = (),
    stamp: Sequence[str] = (),
    keep: int = 3,
) -> None:
    """Process everything that has landed since the last run, then stop.

    With ``partition``, the way for facts, the table is partitioned by that key and only the partitions
    of a batch are rewritten; a replay merges the same rows once more, which changes nothing.

    Without it each micro-batch merges into the last version and writes the next one, and only the last
    ``keep`` versions stay.  A batch is known by its checkpoint and its number there: one that is replayed
    writes its own version again from the same parent, while another feed, or the same one with a new
    checkpoint, gets versions of its own behind all others.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        if partition is not None:
            upsert_partitions(batch.sparkSession, table, rows, keys, update, partition, order, touch, stamp)
            return
        at, parent = claim_version(batch.sparkSession, table, f"{query_id(checkpoint, spark)}:{batch_id}")
        upsert_version(batch.sparkSession, table, rows, keys, update, at, order, touch, stamp, parent)
        prune_versions(batch.sparkSession, table, keep)

    query = (
        reader.load(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
