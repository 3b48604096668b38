"""Late observations from a file source, merged batch by batch.

State is the stored table itself, so a batch replayed after a failure changes nothing. Every batch is
one snapshot: readers see all of it or nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from sluice.sources.sinks import conform
from sluice.sources.snapshots import SnapshotStore


def merge_new_files(
    spark: SparkSession,
    landing: str,
    schema: dict[str, str],
    store: SnapshotStore,
    table: str,
    keys: Sequence[str],
    values: Sequence[str],
    arrival: Sequence[str],
    checkpoint: str,
    date: str = "date",
) -> StreamingQuery:
    """Read every file landed since the last run, then stop. Each micro-batch is reduced to one
    row per key and merged into the table, in parts of years."""
    source = spark.readStream.schema(", ".join(f"{c} {t}" for c, t in schema.items())).parquet(
        landing
    )

    def merge(batch: DataFrame, _: int) -> None:
        store.merge(table, conform(batch, schema, keys, arrival), keys, values, date)

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
