"""Data-quality checks of tables that grow by batches, without reading again what has been checked.

Row checks add up, so a batch contributes its own violations, per day. Checks of keys need what came before for the
batch's own keys alone: ledgers hold how often a key has occurred in a column, and a lookup opens only the folders of
the keys asked for. From the counts before and after the batch follows by how much the batch changes a check:

* `unique`: keys that are repeated now and were not before;
* `relationships`: rows whose key has no parent, now less before. A parent that arrives later settles the rows that
  waited for it, so the order of arrival does not matter;
* `same_rows`: rows of either table.

All changes are one small folder per batch, which a batch that runs again replaces. Their sums are the state.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.plans.quality import ROW_KINDS, Check, violation
from cargolens.sources.workspace import stored
from cargolens.streaming.batches import batch_folder
from cargolens.streaming.ledger import Ledger

KEY = T.StructField("key", T.StringType())
TOTAL = T.StructField("total", T.LongType())
CHANGES = "number int, day date, side string, change bigint"


class CheckState:
    """The state of `checks` below `root`. `days` names, by table, the time column that violations are dated by."""

    def __init__(self, spark: SparkSession, root: str, checks: list[Check], days: dict[str, str] | None = None):
        self.spark, self.root, self.checks, self.days = spark, root, checks, days or {}

    def _key_columns(self) -> list[tuple[str, str]]:
        found = [(c.table, c.column) for c in self.checks if c.kind in ("unique", "relationships")]
        return sorted({*found, *(c.parent for c in self.checks if c.kind == "relationships")})

    def _keys(self, batch_id: int, tables: dict[str, DataFrame], column: tuple[str, str],
              asked: DataFrame) -> DataFrame:
        """(key, before, now) of the keys of a batch and of those `asked` for."""
        table, name = column
        batch = self._batch_keys(tables, column)
        known = self._ledger(column).before(batch_id, asked.union(batch.select("key")).distinct())
        return (known.join(batch, "key", "full_outer")
                .select("key", F.coalesce("total", F.lit(0)).alias("before"),
                        (F.coalesce("total", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("now")))

    def _batch_keys(self, tables: dict[str, DataFrame], column: tuple[str, str]) -> DataFrame:
        table, name = column
        if table not in tables:
            return self.spark.createDataFrame([], "key string, n bigint")
        return (tables[table].where(F.col(name).isNotNull())
                .groupBy(F.col(name).cast("string").alias("key")).agg(F.count("*").alias("n")))

    def _ledger(self, column: tuple[str, str]) -> Ledger:
        return Ledger(self.spark, f"{self.root}/keys/{column[0]}.{column[1]}", KEY, TOTAL)

    def _row_changes(self, table: str, df: DataFrame) -> DataFrame:
        """Violations by check and day from one pass over the batch's rows."""
        numbered = [(k, c) for k, c in enumerate(self.checks) if c.table == table and c.kind in ROW_KINDS]
        day = F.to_date(self.days[table]) if table in self.days else F.lit(None).cast("date")
        counts = df.groupBy(day.alias("day")).agg(
            F.count("*").alias("rows"), *[F.count_if(violation(c)).alias(f"c{k}") for k, c in numbered])
        cells = [F.struct(F.lit(k).alias("number"), F.lit("").alias("side"), F.col(f"c{k}").alias("change"))
                 for k, _ in numbered]
        cells += [F.struct(F.lit(k).alias("number"), F.lit(side).alias("side"), F.col("rows").alias("change"))
                  for k, c in enumerate(self.checks) if c.kind == "same_rows"
                  for side, name in (("mine", c.table), ("theirs", c.parent[0])) if name == table]
        if not cells:
            return self.spark.createDataFrame([], CHANGES)
        return counts.select("day", F.inline(F.array(*cells))).select("number", "day", "side", "change")

    def add(self, batch_id: int, tables: dict[str, DataFrame]) -> None:
        """Check the rows that a batch adds to some of the tables. Batches are numbered from 0 without gaps."""
        parts = [self._row_changes(table, df) for table, df in tables.items()]
        none = self.spark.createDataFrame([], "key string")
        wanted = {c: none for c in self._key_columns()}
        for check in self.checks:
            if check.kind == "relationships":  # each side's keys are asked for on the other
                mine, theirs = (check.table, check.column), check.parent
                wanted[mine] = wanted[mine].union(self._batch_keys(tables, theirs).select("key"))
                wanted[theirs] = wanted[theirs].union(self._batch_keys(tables, mine).select("key"))
        counts = {c: stored(self._keys(batch_id, tables, c, asked), "keys") for c, asked in wanted.items()}

        def changed(number: int, rows: DataFrame, change) -> DataFrame:
            return rows.agg(F.coalesce(F.sum(change), F.lit(0)).cast("bigint").alias("change")).select(
                F.lit(number).alias("number"), F.lit(None).cast("date").alias("day"),
                F.lit("").alias("side"), "change")

        for number, check in enumerate(self.checks):
            if check.kind == "unique":
                keys = counts[check.table, check.column]
                parts.append(changed(number, keys, ((F.col("now") > 1) & (F.col("before") <= 1)).cast("int")))
            elif check.kind == "relationships":
                parents = counts[check.parent].select(
                    "key", F.col("before").alias("parent_before"), F.col("now").alias("parent_now"))
                both = counts[check.table, check.column].join(parents, "key", "left").na.fill(0)
                waiting = (F.when(F.col("parent_now") == 0, F.col("now")).otherwise(0)
                           - F.when(F.col("parent_before") == 0, F.col("before")).otherwise(0))
                parts.append(changed(number, both, waiting))
        changes = reduce(DataFrame.unionByName, parts, self.spark.createDataFrame([], CHANGES))
        changes.coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{self.root}/changes", batch_id))
        for column, keys in counts.items():
            self._ledger(column).add(batch_id, keys.where("now > before").select("key", F.col("now").alias("total")))

    def _changes(self) -> DataFrame:
        return self.spark.read.schema(CHANGES).parquet(f"{self.root}/changes")

    def results(self) -> DataFrame:
        """As `quality.run_checks` over all rows that batches have added."""
        names = self.spark.createDataFrame(
            [(k, c.table, c.column, c.kind) for k, c in enumerate(self.checks)],
            "number int, table_name string, column_name string, check_name string")
        signed = F.when(F.col("side") == "theirs", -F.col("change")).otherwise(F.col("change"))
        sums = self._changes().groupBy("number").agg(F.sum(signed).alias("n"))
        failing = F.abs(F.coalesce(F.col("n"), F.lit(0))).alias("failing_rows")
        return names.join(sums, "number", "left").select(
            "table_name", "column_name", "check_name", failing).withColumn("passed", F.col("failing_rows") == 0)

    def by_day(self) -> DataFrame:
        """(table_name, column_name, check_name, day, failing_rows) of the row checks with violations."""
        names = self.spark.createDataFrame(
            [(k, c.table, c.column, c.kind) for k, c in enumerate(self.checks) if c.kind in ROW_KINDS],
            "number int, table_name string, column_name string, check_name string")
        found = self._changes().groupBy("number", "day").agg(F.sum("change").alias("failing_rows"))
        return names.join(found.where("failing_rows > 0"), "number").drop("number")
