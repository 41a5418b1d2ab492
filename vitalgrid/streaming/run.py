"""Sources and sinks of streams, and their progress."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, **options) -> DataFrame:
    """New Parquet files of a folder, with a fixed schema."""
    return spark.readStream.schema(schema).options(**options).parquet(folder)


# process what is there and stop; {"processingTime": "1 minute"} runs on
AVAILABLE = {"availableNow": True}


def start(stream: DataFrame, path: str, checkpoint: str, trigger: Mapping = AVAILABLE) -> StreamingQuery:
    """Append to a Parquet folder; the checkpoint makes a restart go on without loss or repeats."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


class LateRows:
    """Rows dropped behind the watermark, over all batches of a query.

    A query keeps its last hundred progress reports, so they are read while it runs, and each batch
    counts once. A batch whose report was missed is an error, not a smaller count.
    """

    def __init__(self):
        self.by_batch: dict[int, int] = {}

    def read(self, query: StreamingQuery) -> None:
        for report in query.recentProgress:
            dropped = sum(o["numRowsDroppedByWatermark"] for o in report["stateOperators"])
            batch = report["batchId"]
            self.by_batch[batch] = max(dropped, self.by_batch.get(batch, 0))

    def follow(self, query: StreamingQuery, seconds: float = 0.2) -> None:
        """Wait until the query ends."""
        while not query.awaitTermination(seconds):
            self.read(query)
        self.read(query)

    def total(self) -> int:
        seen = self.by_batch
        if seen and len(seen) <= max(seen) - min(seen):
            raise RuntimeError("reports of some batches were dropped before they were read")
        return sum(seen.values())


def drain(stream: DataFrame) -> tuple[DataFrame, LateRows]:
    """Process all that is there, then read the sink back as a batch table."""
    spark = stream.sparkSession
    path = scratch_path(spark, "stream")
    late = LateRows()
    late.follow(start(stream, f"{path}/rows", f"{path}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{path}/rows"), late
