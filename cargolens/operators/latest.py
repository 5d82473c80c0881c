"""Newest row per key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.sources.workspace import stored

# What a hash aggregate can hold in its buffer.
_FIXED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _fixed(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _FIXED)


def at_greatest(df: DataFrame, keys: list[str], column: str, choose=F.max) -> DataFrame:
    """The rows that have the greatest `column` of their key; all rows of a key that has only nulls in it.

    With `choose=F.min` those that have the least one.

    The greatest values come from a hash aggregate of two narrow columns; the rows themselves are then picked by a
    semi join, which shuffles nothing where there are few keys.
    """
    named = {k: f"__key{i}" for i, k in enumerate(keys)}
    tops = df.groupBy(*keys).agg(choose(column).alias("__top")).withColumnsRenamed(named)
    same = F.col(column).eqNullSafe(F.col("__top"))
    for key, name in named.items():
        same &= F.col(key).eqNullSafe(F.col(name))
    return df.join(tops, same, "left_semi")


def _decided(df: DataFrame, keys: list[str], order) -> DataFrame:
    """`latest_per_key` for an order of fixed width."""
    named = {k: f"__key{i}" for i, k in enumerate(keys)}
    hashed = df.withColumn("__hash", F.xxhash64(*[c for c in df.columns if c not in keys]))
    for number, column in enumerate([*order, "__hash"]):
        tops = hashed.groupBy(*keys).agg(F.max(column).alias("__top"), F.count("*").alias("__n"))
        tops = stored(tops.where("__n > 1").withColumnsRenamed(named), "repeated")
        if tops.isEmpty():
            return hashed.drop("__hash")
        same = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in named.items()])
        wins = F.col("__n").isNull() | F.col(column).eqNullSafe(F.col("__top"))
        hashed = hashed.join(tops, same, "left").where(wins).drop("__top", "__n", *named.values())
        if not number:
            hashed = stored(hashed, "newest")
    return hashed.drop("__hash").distinct()


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the one that is greatest in `order`.

    `order` lists columns from most to least significant; end it with a unique
    column to make ties deterministic. A null sorts lowest, and the chosen
    row is kept whole, nulls included.

    A long history is neither shuffled nor sorted: its rows are narrowed to those with the greatest first column, and
    only what is left, about one row per key, is written and decided by the other columns. Where these are numbers or times as
    well, that goes on by hash aggregates, each of which also counts the rows of its keys: as soon as no key has several
    there is nothing left to decide, and where none has from the start, the rows are not joined at all. Of rows that agree
    in the whole order the one with the greatest hash stays. Text in the order needs an aggregate that sorts: each task sorts
    its own rows by key and sends one row per key on.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    first, *others = order
    if _fixed(df, first):
        if all(_fixed(df, c) for c in others):
            return _decided(df, keys, order)
        df = stored(at_greatest(df, keys, first), "newest")
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return (df.groupBy(*keys).agg(newest.alias("__row"))
            .select(*keys, *[F.col("__row").getField(c).alias(c) for c in rest])
            .select(*df.columns))


def first_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """One row per key: the first in `time`; of several, the least by its other columns. Null times come last."""
    rest = [c for c in df.columns if c not in (key, time)]
    least = F.min_by(F.struct(*rest), F.struct(*rest))
    first = stored(at_greatest(df, [key], time, F.min), "first")
    return (first.groupBy(key, time).agg(least.alias("__row"))
            .select(key, time, *[F.col("__row").getField(c).alias(c) for c in rest])
            .select(*df.columns))
