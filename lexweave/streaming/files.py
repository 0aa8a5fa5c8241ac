"""Documents as they arrive: each micro-batch is a corpus of its own, as documents are independent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: str, per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def process(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies work to each batch; a batch that runs again writes the same folder again."""

    def one(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one).trigger(availableNow=True).start()
