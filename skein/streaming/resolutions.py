"""The resolution log as a stream: files that arrive are appended, and the newest version per service
is kept as a table. Goes beyond batch runs; state is one row per service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skein.operators.ranking import latest_per_key


def start(spark: SparkSession, incoming: str, schema: str, table: str, checkpoint: str) -> StreamingQuery:
    """Reads Parquet files that arrive in incoming and keeps table/version=N up to date, one version per
    batch. A batch that is run again writes the same version again, so it is idempotent."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch
        if number > 0:
            rows = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{table}/version={number - 1}"))
        latest_per_key(rows, ["service_id"], "created_at", "resolution_id").write.mode("overwrite").parquet(f"{table}/version={number}")

    source = spark.readStream.schema(schema).parquet(incoming)
    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
