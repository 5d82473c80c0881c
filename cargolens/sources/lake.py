"""Layered Parquet lake, table load and row-count audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cargolens import schemas as S

# table -> (layer, schema); every table lives in its own folder <layer>/<table>
TABLES = {
    "customers": ("silver", S.CUSTOMERS),
    "warehouses": ("silver", S.WAREHOUSES),
    "weather": ("silver", S.WEATHER),
    "orders": ("silver", S.ORDERS),
    "routes": ("gold", S.ROUTES),
    "delivery_risk": ("gold", S.DELIVERY_RISK),
}


def table_path(root: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"Unknown table: {name!r}")
    return f"{root.rstrip('/')}/{TABLES[name][0]}/{name}"


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df` with a row counter that fills while the next action runs."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def save(df: DataFrame, path: str) -> int:
    """Replace the Parquet table at `path`; returns the rows written, without a second scan."""
    watched, seen = counted(df)
    watched.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def declared(df: DataFrame, name: str) -> DataFrame:
    """`df` in the columns and types that the registry declares; columns it lacks are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in TABLES[name][1]])


def read(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    return spark.read.schema(schema or TABLES[name][1]).parquet(table_path(root, name))


def load_table(spark: SparkSession, name: str, path: str, database: str | None = None) -> int:
    """Replace the catalog table `name` by the Parquet data at `path`; returns its row count."""
    if name not in TABLES:
        raise ValueError(f"unregistered table: {name!r}")
    watched, seen = counted(spark.read.parquet(path))
    target = f"{database}.{name}" if database else name
    watched.write.mode("overwrite").saveAsTable(target)
    return seen.get["rows"]


def audit(spark: SparkSession, steps) -> DataFrame:
    """(table_name, layer, path, rows), one row per written table."""
    return spark.createDataFrame(
        list(steps), "table_name string, layer string, path string, rows bigint")
