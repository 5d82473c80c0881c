"""Landed JSON to silver tables, each landed file once.

A file-source stream watches the landing folder. Its log of files, kept in the checkpoint, hands every file to one batch,
so a later run opens only what has landed since. A batch judges its records by their JSON types and files the
valid ones and the rejects under its number; a batch that runs again overwrites itself. The silver tables are views over
these folders: the newest record of a customer, the last landed observation of a warehouse and time.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens import schemas as S
from cargolens.functions.text import stamp_of_file
from cargolens.operators.latest import latest_per_key
from cargolens.sources import bronze, conform
from cargolens.sources.workspace import stored
from cargolens.streaming.batches import batch_folder, readable, run

REJECTS = "file string, reason string, record string, reject_reason array<string>"


@dataclass(frozen=True)
class Feed:
    """One kind of landed files: `<name>_<stamp>.json`, or a folder of that name with JSON lines."""

    name: str
    schema: T.StructType
    documents: Callable[[DataFrame], DataFrame]
    nullable: tuple[str, ...] = ()
    places: tuple[tuple[str, str], ...] = ()  # second JSON paths of fields

    @property
    def filed(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("ingested_at", T.TimestampNTZType()),
                             T.StructField("file", T.StringType())])


CUSTOMERS = Feed("customers", S.CUSTOMERS, bronze.customer_documents)
# Measured values may be null; those of a nested answer of the weather service are found as well.
WEATHER = Feed("weather", S.WEATHER, bronze.weather_documents, ("temperature", "wind_speed"),
               (("temperature", "$.current_weather.temperature"),
                ("wind_speed", "$.current_weather.windspeed")))


def judged_batch(lines: DataFrame, feed: Feed) -> DataFrame:
    """Every record of a batch (value, file) with `typed` and the reasons against it."""
    conform.assert_columns(lines, ["value", "file"])
    found = feed.documents(lines)
    kept = found.select("file", "reason", "record",
                        F.coalesce("document", F.to_json("record")).alias("text"))
    judged = conform.judged_records(kept, feed.schema, feed.nullable, "record", dict(feed.places))
    return judged.select("file", "reason", "text", "typed", "reject_reason")


def ingest(spark: SparkSession, feed: Feed, landing: str, store: str, checkpoint: str,
           multi_line: bool = False, on_error: str = "fail"):
    """Take what has newly landed below `landing` into `store`; returns the finished stream.

    Files hold JSON lines, with `multi_line=True` one indented document each. A record that does not fit fails the
    run before anything of its batch is filed: the next run reads the batch again. With `on_error="skip"` rejects
    are filed with file and reasons (`rejects`) and the others taken.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error is 'fail' or 'skip', not {on_error!r}")
    lines = (spark.readStream.format("text").option("wholetext", multi_line)
             .option("pathGlobFilter", "*.json").load(f"{landing.rstrip('/')}/{feed.name}_*")
             .select("value", F.col("_metadata.file_path").alias("file")))

    refused = []

    def take(batch: DataFrame, batch_id: int) -> None:
        judged = stored(judged_batch(batch, feed), "judged")
        bad = F.col("reason").isNotNull() | (F.size("reject_reason") > 0)
        faults = judged.where(bad).count()
        if faults and on_error == "fail":
            refused.append(f"{faults} landed {feed.name} records do not fit")
            raise conform.RejectedRecords(refused[0])
        (judged.where(bad).select("file", "reason", F.col("text").alias("record"), "reject_reason")
         .write.mode("overwrite").parquet(batch_folder(f"{store}/{feed.name}_rejects", batch_id)))
        (judged.where(~bad).select("typed.*", stamp_of_file(F.col("file")).alias("ingested_at"), "file")
         .write.mode("overwrite").parquet(batch_folder(f"{store}/{feed.name}", batch_id)))

    try:
        return run(lines, checkpoint, take)
    except StreamingQueryException as failed:
        if refused:
            raise conform.RejectedRecords(refused[0]) from failed
        raise


def filed(spark: SparkSession, feed: Feed, store: str) -> DataFrame:
    """All records that were taken, with time stamp and name of the landed file."""
    return readable(spark, f"{store}/{feed.name}", feed.filed).select(*feed.filed.fieldNames())


def rejects(spark: SparkSession, feed: Feed, store: str) -> DataFrame:
    return readable(spark, f"{store}/{feed.name}_rejects", REJECTS).select(
        "file", "reason", "record", "reject_reason")


def silver_customers(spark: SparkSession, store: str) -> DataFrame:
    """One row per customer, the one that landed last; the content decides within one landing."""
    rest = [c for c in S.CUSTOMERS.fieldNames() if c != "customer_id"]
    newest = latest_per_key(filed(spark, CUSTOMERS, store), "customer_id", ["ingested_at", *rest, "file"])
    return newest.select(*S.CUSTOMERS.fieldNames())


def silver_weather(spark: SparkSession, store: str) -> DataFrame:
    """One row per warehouse and time, the one that landed last."""
    return bronze.weather_history(filed(spark, WEATHER, store))
