"""Data-quality checks on tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens import schemas as S


@dataclass(frozen=True)
class Check:
    """One check of a column.

    kind: not_null, unique, accepted_values (`values`), in_range (`low`, `high`, and
    `above` for an exclusive lower bound), relationships (`parent` = (table, column)) or
    same_rows (`parent` = (table, None): as many rows as the parent has).
    """

    table: str
    column: str | None
    kind: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    above: float | None = None
    parent: tuple | None = None


ROW_KINDS = ("not_null", "accepted_values", "in_range")


def violation(check: Check) -> Column:
    value = F.col(check.column)
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "accepted_values":
        return value.isNotNull() & ~value.isin(list(check.values))
    bad = F.lit(False)
    if check.low is not None:
        bad = bad | (value < check.low)
    if check.above is not None:
        bad = bad | (value <= check.above)
    if check.high is not None:
        bad = bad | (value > check.high)
    # NaN compares as larger than any number and so would pass a lower bound.
    return value.isNotNull() & (bad | F.isnan(value.cast("double")))


def _repeated(df: DataFrame, column: str) -> DataFrame:
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count("*").alias("rows")).where(F.col("rows") > 1))


def _orphans(tables: dict, check: Check) -> DataFrame:
    """Child keys without a parent, with their row counts.

    Child rows are counted per key before the join, so a frequent key is one row there.
    """
    table, column = check.parent
    children = (tables[check.table].where(F.col(check.column).isNotNull())
                .groupBy(F.col(check.column).alias("key")).agg(F.count("*").alias("rows")))
    parents = tables[table].select(F.col(column).alias("key")).distinct()
    return children.join(parents, "key", "left_anti")


def _result(df: DataFrame, check: Check) -> DataFrame:
    """`df` has one column `failing_rows` and one row."""
    return df.select(F.lit(check.table).alias("table_name"),
                     F.lit(check.column).cast("string").alias("column_name"),
                     F.lit(check.kind).alias("check_name"), "failing_rows")


def _row_checks(df: DataFrame, checks) -> DataFrame:
    """All row-level checks of a table from one pass over it."""
    counts = df.agg(*[F.count_if(violation(c)).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.table).alias("table_name"),
                              F.lit(c.column).alias("column_name"),
                              F.lit(c.kind).alias("check_name"),
                              F.col(f"c{i}").alias("failing_rows"))
                     for i, c in enumerate(checks)])
    return counts.select(F.inline(rows))


def _key_check(tables: dict, check: Check) -> DataFrame:
    df = tables[check.table]
    if check.kind == "unique":
        failing = _repeated(df, check.column).agg(F.count("*").alias("failing_rows"))
    elif check.kind == "relationships":
        failing = _orphans(tables, check).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("failing_rows"))
    elif check.kind == "same_rows":
        mine = df.agg(F.count("*").alias("n"))
        theirs = tables[check.parent[0]].agg(F.count("*").alias("n"))
        failing = (mine.unionByName(theirs)
                   .agg((F.max("n") - F.min("n")).alias("failing_rows")))
    else:
        raise ValueError(f"unknown check: {check.kind!r}")
    return _result(failing, check)


def run_checks(tables: dict[str, DataFrame], checks) -> DataFrame:
    """(table_name, column_name, check_name, failing_rows, passed), one row per check.

    `unique` counts the repeated values, the other kinds count rows. Null is only an
    offence for `not_null`.
    """
    by_table: dict[str, list[Check]] = {}
    parts = []
    for check in checks:
        if check.kind in ROW_KINDS:
            by_table.setdefault(check.table, []).append(check)
        else:
            parts.append(_key_check(tables, check))
    parts = [_row_checks(tables[t], group) for t, group in by_table.items()] + parts
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failing_rows") == 0)


def failing_rows(tables: dict[str, DataFrame], check: Check) -> DataFrame:
    """The offending rows (for `unique` and `relationships`: keys with their row count)."""
    df = tables[check.table]
    if check.kind in ROW_KINDS:
        return df.where(violation(check))
    if check.kind == "unique":
        return _repeated(df, check.column)
    if check.kind == "relationships":
        return _orphans(tables, check).withColumnRenamed("key", check.column)
    raise ValueError(f"{check.kind!r} has no failing rows to show")


def mart_checks() -> list[Check]:
    """The 17 declared tests of the three marts."""
    def not_null(table, *columns):
        return [Check(table, c, "not_null") for c in columns]

    modes = tuple(label for _, label in S.MODE_TIERS)
    levels = tuple(label for _, label in S.RISK_LEVELS)
    return [
        Check("dim_customers", "customer_id", "unique"),
        *not_null("dim_customers", "customer_id", "country"),
        Check("fact_shipments", "order_id", "unique"),
        *not_null("fact_shipments", "order_id", "customer_id", "warehouse_id", "order_date"),
        Check("fact_shipments", "customer_id", "relationships",
              parent=("dim_customers", "customer_id")),
        Check("fact_shipments", "status", "accepted_values", values=tuple(S.STATUSES)),
        Check("delivery_performance", "order_id", "unique"),
        *not_null("delivery_performance", "order_id", "customer_id", "warehouse_id", "risk_score"),
        Check("delivery_performance", "transport_mode", "accepted_values", values=modes),
        Check("delivery_performance", "risk_category", "accepted_values", values=levels),
    ]


def range_checks() -> list[Check]:
    """Value ranges, source value sets, key inclusion and row counts."""
    return [
        Check("customers", "latitude", "in_range", low=35.0, high=70.0),
        Check("customers", "longitude", "in_range", low=-10.0, high=30.0),
        Check("orders", "package_weight_kg", "in_range", above=0.0, high=30.0),
        Check("orders", "priority", "accepted_values", values=tuple(S.PRIORITIES)),
        Check("orders", "package_size", "accepted_values", values=tuple(S.PACKAGE_SIZES)),
        Check("orders", "status", "accepted_values", values=tuple(S.STATUSES)),
        Check("orders", "customer_id", "relationships", parent=("customers", "customer_id")),
        Check("orders", "warehouse_id", "relationships", parent=("warehouses", "warehouse_id")),
        Check("delivery_performance", "risk_score", "in_range", low=0, high=100),
        Check("delivery_performance", "distance_km", "in_range", low=0.0),
        Check("delivery_performance", "estimated_delivery_hours", "in_range", above=0.0),
        Check("delivery_performance", None, "same_rows", parent=("orders", None)),
    ]
