"""Typed projection of raw records, with rejects.

Two kinds of records are judged: columns of text, where a value fits if it can be cast, and JSON records kept as
VARIANT, where the value's own type counts as well (`split_records`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class RejectedRecords(ValueError):
    """A batch held records that do not fit the schema."""


def assert_columns(df: DataFrame, required) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def _judged(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Input columns plus `__typed` (the cast fields) and `reject_reason` (an array)."""
    have = set(df.columns)
    typed, reasons = [], []
    for field in schema:
        if field.name not in have:
            typed.append(F.lit(None).cast(field.dataType).alias(field.name))
            reasons.append(F.lit(f"{field.name}:missing"))
            continue
        source, value = F.col(field.name), F.col(field.name).try_cast(field.dataType)
        typed.append(value.alias(field.name))
        reasons.append(F.when(source.isNull(), F.lit(f"{field.name}:missing"))
                       .when(value.isNull(), F.lit(f"{field.name}:invalid")))
    return df.withColumns({"__typed": F.struct(*typed),
                           "reject_reason": F.array_compact(F.array(*reasons))})


def split_rejects(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(valid rows in the schema's columns and types, rejects with `reject_reason`).

    Every field of the schema is required; a value has to be castable to its type.
    Columns outside the schema are dropped from the valid rows and kept in the rejects.
    """
    judged = _judged(df, schema)
    valid = judged.where(F.size("reject_reason") == 0).select("__typed.*")
    rejects = judged.where(F.size("reject_reason") > 0).drop("__typed")
    return valid, rejects


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Valid rows, or `RejectedRecords` when even one record does not fit."""
    valid, rejects = split_rejects(df, schema)
    bad = rejects.count()
    if bad:
        raise RejectedRecords(f"{bad} records do not fit the schema")
    return valid


# --- records whose values keep their JSON type -------------------------------

# Blanks that may stand around a number in text.
_BLANKS = " \t\n\r\f\v"
_WHOLE = r"^[+-]?[0-9]+(\.0*)?$"
_NUMBER = r"(?i)^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?|nan)$"
_LONGS = 2.0 ** 63


def _typed_value(value: Column, kind: Column, wanted: T.DataType) -> Column:
    """`value`, a VARIANT of type `kind`, as `wanted`; null if it does not fit.

    Text has to be a string. A number may also be given as a truth value or in a string, a whole number also as one
    with nothing but zeros after the point. Times are strings. Numbers beyond 64 bits do not fit.
    """
    def read(as_type: str) -> Column:
        return F.try_variant_get(value, "$", as_type)

    text = F.when(kind == "STRING", read("string"))
    if wanted == T.StringType():
        return text
    fraction = kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    if wanted == T.DoubleType():
        word = F.btrim(text, F.lit(_BLANKS))
        return (F.when(fraction | (kind == "BIGINT"), read("double"))
                .when(kind == "BOOLEAN", read("boolean").cast("double"))
                .when(word.rlike(_NUMBER), word.try_cast("double")))
    if wanted == T.LongType():
        word, number = F.btrim(text, F.lit(_BLANKS)), read("double")
        return (F.when(kind == "BIGINT", read("bigint"))
                .when(kind == "BOOLEAN", read("boolean").cast("bigint"))
                .when(fraction & (number == F.floor(number)) & (number >= -_LONGS) & (number < _LONGS),
                      number.cast("bigint"))
                .when(word.rlike(_WHOLE), F.regexp_replace(word, r"\.0*$", "").try_cast("bigint")))
    return text.try_cast(wanted)


def judged_records(records: DataFrame, schema: T.StructType, nullable=(), record: str = "record",
                   places: dict[str, str] | None = None) -> DataFrame:
    """The other columns, `typed` (a struct in `schema`) and `reject_reason` (an array, empty if the record fits).

    `record` is a VARIANT column. Fields outside the schema are ignored, a field that is missing or null is a
    fault unless it is `nullable`. `places` names a second JSON path to look for a field in.
    """
    assert_columns(records, [record])
    others = [c for c in records.columns if c != record]
    fields = []
    for field in schema:
        found = F.try_variant_get(record, f"$['{field.name}']", "variant")
        if places and field.name in places:
            found = F.coalesce(found, F.try_variant_get(record, places[field.name], "variant"))
        fields.append(found.alias(field.name))
    parts = records.select(*others, F.struct(*fields).alias("__raw"))
    typed, reasons = [], []
    for field in schema:
        value = F.col("__raw")[field.name]
        kind = F.schema_of_variant(value)
        fitting = _typed_value(value, kind, field.dataType)
        typed.append(fitting.alias(field.name))
        absent = value.isNull() | (kind == "VOID")
        lacking = F.lit(None) if field.name in nullable else F.lit(f"{field.name}:missing")
        reasons.append(F.when(absent, lacking).when(fitting.isNull(), F.lit(f"{field.name}:invalid")))
    return parts.select(*others, F.struct(*typed).alias("typed"),
                        F.array_compact(F.array(*reasons)).alias("reject_reason"))


def split_records(records: DataFrame, schema: T.StructType, nullable=(), record: str = "record",
                  places: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows in the schema's columns and types, rejects: the record as JSON, the other columns and
    `reject_reason`) of JSON records kept as VARIANT."""
    others = [c for c in records.columns if c != record]
    kept = records.withColumn("__json", F.to_json(record))
    judged = judged_records(kept, schema, nullable, record, places)
    faults = F.size("reject_reason")
    rejects = judged.where(faults > 0).select(F.col("__json").alias(record), *others, "reject_reason")
    return judged.where(faults == 0).select("typed.*"), rejects
