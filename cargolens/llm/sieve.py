"""Rows told apart by a bitmap of keys before they are shuffled.

A semi or anti join of texts with a list of keys would shuffle all texts, though few are looked for. Hashes of the keys go into a
bitmap of fixed size (`BITS`), which is broadcast; rows whose bit is not set cannot be in the list and need no join.
With very many keys the bitmap fills up and lets more rows pass: then the join does the work, with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import free_name
from cargolens.sources.workspace import stored

BITS = 1 << 24  # 2 MB, in pages of 4 KB


def marked(rows: DataFrame, key: str, wanted: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`rows` with a column that says whether their key may be in column `name` of `wanted`, and that column's name.

    A null key counts as one that may be wanted.
    """
    place = F.pmod(F.xxhash64(F.col(name)), F.lit(BITS)) + 1
    pages = stored(wanted.where(F.col(name).isNotNull()).select(place.alias("place"))
                   .groupBy(F.bitmap_bucket_number("place").alias("page"))
                   .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")), "bitmap")
    at, page, bits, may = (free_name(rows, n) for n in ("__at", "__page", "__bits", "__may"))
    pages = F.broadcast(pages.select(F.col("page").alias(page), F.col("bits").alias(bits)))
    own = F.pmod(F.xxhash64(F.col(key)), F.lit(BITS)) + 1
    looked = rows.withColumn(at, own).join(pages, F.bitmap_bucket_number(F.col(at)) == F.col(page), "left")
    bit = F.bitmap_bit_position(F.col(at))
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    isset = F.expr(f"1 = (shiftright(cast(__byte as int), cast(bitmap_bit_position(`{at}`) % 8 as int)) & 1)")
    found = looked.withColumn("__byte", byte).withColumn(
        may, F.col(key).isNull() | F.coalesce(isset, F.lit(False)))
    return found.select(*rows.columns, may), may


def semi_join(rows: DataFrame, key: str, wanted: DataFrame, name: str) -> DataFrame:
    """The rows whose key is in column `name` of `wanted`."""
    found, may = marked(rows, key, wanted, name)
    few = found.where(may).drop(may)
    return few.join(wanted.select(F.col(name).alias(free_name(rows, "__wanted"))).distinct(),
                    F.col(key) == F.col(free_name(rows, "__wanted")), "left_semi")


def anti_join(rows: DataFrame, key: str, unwanted: DataFrame, name: str) -> DataFrame:
    """The rows whose key is not in column `name` of `unwanted`; rows without a key stay."""
    found, may = marked(rows, key, unwanted, name)
    column = free_name(rows, "__unwanted")
    listed = unwanted.select(F.col(name).alias(column)).distinct()
    rest = found.where(F.col(may)).drop(may).join(listed, F.col(key) == F.col(column), "left_anti")
    return found.where(~F.col(may)).drop(may).union(rest)
