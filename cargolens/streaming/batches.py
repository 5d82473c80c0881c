"""What the streaming jobs share: run to the end of what is there, one result folder per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch_id"


def run(stream: DataFrame, checkpoint: str, each) -> StreamingQuery:
    """Hand what is available to `each(batch, batch_id)` and stop."""
    query = (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .foreachBatch(each).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def readable(spark, path: str, schema) -> DataFrame:
    """What the batches wrote; an empty folder of batch -1 makes it readable before the first."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite").parquet(batch_folder(path, -1))
    return spark.read.schema(empty.schema).parquet(path)


def is_day(column: str, days) -> Column:
    """Whether a date column is one of the given dates. Dates go as text, which holds for years before 1000 too."""
    return F.col(column).isin([F.lit(d.isoformat()).cast("date") for d in days])
