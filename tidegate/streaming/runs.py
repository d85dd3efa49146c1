"""Running streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def append_parquet(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A streaming table from a query: rows are appended exactly once."""
    return (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything there is now, in as many micro-batches as needed, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_live(writer: DataStreamWriter, interval: str = "60 seconds") -> StreamingQuery:
    return writer.trigger(processingTime=interval).start()


def materialize(df: DataFrame, path: str) -> None:
    """A materialized view: the batch result, written anew."""
    df.write.mode("overwrite").parquet(path)
