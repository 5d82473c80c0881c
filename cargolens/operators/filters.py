"""The dashboard's row filter as column predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.operators.joins import fits_broadcast, lookup_join
from cargolens.sources.workspace import stored

# filter key -> column it restricts
COLUMN_FILTERS = {"statuses": "status", "priorities": "priority", "risk": "risk_category"}


def is_active(filters) -> bool:
    return bool(filters) and any(filters.get(k) for k in ("warehouses", *COLUMN_FILTERS))


def apply_filters(df: DataFrame, filters=None, warehouses: DataFrame | None = None) -> DataFrame:
    """Keep the rows that pass every active filter.

    `filters` maps `warehouses` (by name), `statuses`, `priorities` and `risk` to
    lists of accepted values; a missing or empty list does not restrict.
    """
    filters = filters or {}
    for name, column in COLUMN_FILTERS.items():
        if filters.get(name):
            df = df.where(F.col(column).isin(list(filters[name])))
    if filters.get("warehouses"):
        if warehouses is None:
            raise ValueError("the 'warehouses' filter needs the warehouses table")
        chosen = (warehouses.where(F.col("name").isin(list(filters["warehouses"])))
                  .select("warehouse_id"))
        if not fits_broadcast(chosen):  # estimated by the whole table; written, its own size is known
            chosen = stored(chosen, "chosen")
        spread = ["order_id"] if "order_id" in df.columns else None
        df = lookup_join(df, chosen, "warehouse_id", "left_semi", spread=spread)
    return df


def filter_options(dp: DataFrame, warehouses: DataFrame) -> DataFrame:
    """(kind, value) of everything that can be selected.

    The mart is read once: its three small category columns are grouped together and
    only the few combinations are unfolded.
    """
    kinds = {"statuses": "status", "priorities": "priority", "risks": "risk_category"}
    combos = dp.groupBy(*kinds.values()).agg(F.lit(1).alias("__n"))
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value"))
                      for k, c in kinds.items()])
    categories = combos.select(F.inline(pairs)).distinct()
    names = warehouses.select(F.lit("warehouses").alias("kind"), F.col("name").alias("value"))
    return names.unionByName(categories).orderBy("kind", F.asc_nulls_last("value"))
