"""Raw JSON: landing, replay and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens import schemas as S
from cargolens.functions.text import iso_text, stamp_of_file
from cargolens.operators.latest import latest_per_key
from cargolens.sources.conform import RejectedRecords
from cargolens.sources.workspace import stored


def all_text(schema: T.StructType) -> T.StructType:
    """The same fields as strings, so that a wrongly typed value is kept, not nulled."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


CUSTOMER_PAYLOAD = T.StructType([
    T.StructField("results", T.ArrayType(all_text(S.CUSTOMERS))),
    T.StructField("info", T.StructType([
        T.StructField("seed", T.StringType()),
        T.StructField("results", T.LongType()),
        T.StructField("generated_at", T.StringType()),
    ])),
])

API_WEATHER = T.StructType([
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("current_weather", T.StructType([
        T.StructField("temperature", T.DoubleType()),
        T.StructField("windspeed", T.DoubleType()),
    ])),
])


def land_customers(customers: DataFrame, directory: str, stamp: str) -> str:
    """Write one payload document per customer row under a time-stamped name.

    Documents are JSON lines, so the files split and no array has to be gathered in
    one task. `stamp` looks like `20260102_030405_000006`.
    """
    info = F.struct(F.lit("landed").alias("seed"), F.lit(1).cast("bigint").alias("results"),
                    iso_text(F.current_timestamp()).alias("generated_at"))
    path = f"{directory.rstrip('/')}/customers_{stamp}"
    (customers.select(F.array(F.struct(*customers.columns)).alias("results"), info.alias("info"))
     .write.mode("append").json(path))
    return path


def land_weather(weather: DataFrame, directory: str, stamp: str) -> str:
    """Write weather records as JSON lines under a time-stamped name."""
    path = f"{directory.rstrip('/')}/weather_{stamp}"
    (weather.write.mode("append")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))
    return path


CORRUPT = "_corrupt_record"


def _replay(spark: SparkSession, paths, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Documents in `schema`, with the raw text of unreadable ones in `_corrupt_record`."""
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(whole).option("multiLine", multi_line).json(paths)
    return raw.withColumns({"ingested_at": stamp_of_file(F.col("_metadata.file_path")),
                            "file": F.col("_metadata.file_path")})


def _readable(raw: DataFrame, schema: T.StructType) -> DataFrame:
    # A reader of files refuses to look for unreadable documents alone, as when rows are only counted,
    # so the condition names a field as well.
    field = F.length(F.to_json(F.struct(schema.fieldNames()[0]))) > 0
    return raw.where(F.col(CORRUPT).isNull() & field)


def _rejects(raw: DataFrame, schema: T.StructType, broken) -> DataFrame:
    """(file, reason, record, document) of unreadable documents and of those that `broken` names.

    An unreadable document is kept as the text `record`, another one as JSON in `document`.
    """
    reason = F.when(F.col(CORRUPT).isNotNull(), "unreadable").otherwise(broken)
    return (raw.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select("file", "reason", F.col(CORRUPT).alias("record"),
                    F.when(F.col(CORRUPT).isNull(), F.to_json(F.struct(*schema.fieldNames())))
                    .alias("document")))


def _checked(rejects: DataFrame, on_error: str) -> None:
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error is 'fail' or 'skip', not {on_error!r}")
    if on_error == "fail" and (bad := rejects.count()):
        raise RejectedRecords(f"{bad} landed documents cannot be replayed")


def customer_rejects(spark: SparkSession, paths, multi_line: bool = False) -> DataFrame:
    """Landed customer documents that cannot be replayed: cut off, mistyped or without results."""
    return _customer_rejects(_replay(spark, paths, CUSTOMER_PAYLOAD, multi_line))


def _customer_rejects(raw: DataFrame) -> DataFrame:
    return _rejects(raw, CUSTOMER_PAYLOAD, F.when(F.col("results").isNull(), "no results"))


def replay_customers(spark: SparkSession, paths, multi_line: bool = False,
                     on_error: str = "fail") -> DataFrame:
    """Customer records of landed payloads, still as text, with `ingested_at`.

    `multi_line=True` reads files that hold one indented document each. A document that cannot be replayed
    fails the batch; with `on_error="skip"` it is left to `customer_rejects`. Documents are parsed once.
    """
    raw = stored(_replay(spark, paths, CUSTOMER_PAYLOAD, multi_line), "replayed")
    _checked(_customer_rejects(raw), on_error)
    raw = _readable(raw, CUSTOMER_PAYLOAD)
    return raw.select(F.explode("results").alias("r"), "ingested_at").select("r.*", "ingested_at")


def weather_rejects(spark: SparkSession, paths, multi_line: bool = False) -> DataFrame:
    """Landed weather records that are unreadable or hold a value of the wrong type."""
    return _weather_rejects(_replay(spark, paths, all_text(S.WEATHER), multi_line))


def _weather_rejects(raw: DataFrame) -> DataFrame:
    bad = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
                  f"{f.name} invalid") for f in S.WEATHER]
    return _rejects(raw, S.WEATHER, F.coalesce(*bad))


def replay_weather(spark: SparkSession, paths, multi_line: bool = False,
                   on_error: str = "fail") -> DataFrame:
    """Weather history of landed files: typed, with `ingested_at`.

    A record that is unreadable or holds a value of the wrong type fails the batch; with
    `on_error="skip"` it is left to `weather_rejects`, in the history a wrong value is then null.
    """
    raw = stored(_replay(spark, paths, all_text(S.WEATHER), multi_line), "replayed")
    _checked(_weather_rejects(raw), on_error)
    raw = _readable(raw, S.WEATHER)
    return raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in S.WEATHER], "ingested_at")


# --- landed documents as VARIANT ----------------------------------------------

def customer_documents(lines: DataFrame) -> DataFrame:
    """(file, document, reason, record): a row per record of landed payloads, given as (value, file).

    `record` is the VARIANT of one of `results`. A document that is cut off or has no list of results gives one row with
    its text and a reason. Blank lines are no documents.
    """
    return _documents(lines, F.try_variant_get("v", "$.results", "array<variant>"), "no results")


def weather_documents(lines: DataFrame) -> DataFrame:
    """As `customer_documents`; a document is one record or a list of them."""
    kind = F.schema_of_variant("v")
    several = F.when(kind.startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>"))
    one = F.when(kind.startswith("OBJECT"), F.array(F.col("v")))
    return _documents(lines, F.coalesce(several, one), "no records")


def _documents(lines: DataFrame, records, none_found: str) -> DataFrame:
    parsed = lines.where(F.btrim("value", F.lit(" \t\r\n")) != "").select(
        "file", "value", F.try_parse_json("value").alias("v"))
    found = parsed.select("file", "value", F.col("v").isNull().alias("broken"), records.alias("records"))
    reason = F.when(F.col("broken"), "unreadable").when(F.col("records").isNull(), none_found)
    # A document with an empty list has no rows and no fault.
    rows = found.withColumn("reason", reason).withColumn(
        "records", F.when(F.col("reason").isNull(), F.col("records"))
        .otherwise(F.array(F.lit(None).cast("variant"))))
    return rows.select("file", F.when(F.col("reason").isNotNull(), F.col("value")).alias("document"),
                       "reason", F.explode("records").alias("record"))


def flatten_weather(api: DataFrame) -> DataFrame:
    """Weather rows from nested API objects (`current_weather`)."""
    return api.select(
        "warehouse_id", F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp"),
        F.col("current_weather.temperature").cast("double").alias("temperature"),
        F.col("current_weather.windspeed").cast("double").alias("wind_speed"))


def weather_history(replayed: DataFrame) -> DataFrame:
    """One row per warehouse and time from replayed files; the last landed one counts."""
    order = ["ingested_at", "temperature", "wind_speed"]
    return (latest_per_key(replayed, ["warehouse_id", "timestamp"], order)
            .select(*S.WEATHER.fieldNames()))
