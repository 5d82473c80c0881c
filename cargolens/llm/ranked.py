"""Ranked lexical search: the best documents per item by the NRA method (no random access).

Every term has a list of the documents that hold it, sorted by what the term adds to a document's score (its
points). All lists are read from their tops, and all to the same border before any is read on. What has been seen of a
document gives it an interval: its score is at least the points seen, and at most these and, for every list of the
item in which it has not been seen, the most that can still come there: less than the border, no more than the list's
first points, and nothing once the list has ended. Reading stops for an item as soon as its intervals allow:

* The first stop, where at most `FIRST` of all that the items could read has been read, gives every item a threshold: a
  score that k documents have already. An item with fewer documents there reads on to the end for its threshold.
* The second stop is each item's own: the border at which an unseen document could reach no more than a share
  (`UNSEEN`) of its threshold. A document whose upper end is below the threshold leaves; few candidates stay.
* Items whose candidates' intervals are not all points by then read the rest of their lists for these candidates, until
  members, ties and scores are final.

Ties go to the smaller key, null keys last, then to the row read first. The lists are stored in buckets of documents, each
sorted by points, so that a reading opens the upper part of each bucket and adds up a document's points where they
are: what the items' common words meet in almost all documents is never shuffled nor stored. The words of the items reach
the scan of the documents as a bitmap of fixed size (`BITS`), which may let other words pass but loses none; those drop
out in the join.

Terms are the maximal stretches of ASCII letters and digits and of all characters from 128 on; A-Z become a-z. Null and
empty texts have no terms, are no results and do not count as documents; items without terms have no results. Texts of
any length are read whole. Repeated rows are documents, or items, of their own. Empty tables give an empty result. Only
the named columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cargolens.llm.common import stored_small
from cargolens.operators.joins import lookup_join, shuffle_width
from cargolens.sources.workspace import fresh_path

BITS = 1 << 23  # places of the bitmap of item words: 1 MB
HALVINGS = 12  # borders above zero, each half of the one before
FIRST = 1 / 8  # share of the items' lists that is read at most before the first thresholds
UNSEEN = 1 / 4  # share of the threshold that an unseen document may still reach at the second stop
STEPS = 64  # classes of scores per octave when thresholds are counted
REMEMBERED = 1 << 18  # words whose place in the bitmap a task remembers
ROWS = 1024  # rows of an output batch
FULL = 1_000_000  # every impact is below this

# Separators become spaces, capital letters small ones, all else stays.
FOLDED = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))

READ = "n bigint, terms array<string>, times array<bigint>"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLDED).split()


class Passing(dict):
    """Whether a word's place in the bitmap is set, remembered for some words."""

    def __init__(self, bitmap: bytes | None):
        super().__init__()
        self.bitmap = None if bitmap is None else np.frombuffer(bitmap, np.uint8)

    def __missing__(self, word: bytes) -> bool:
        if self.bitmap is None:
            return True
        if len(self) >= REMEMBERED:
            self.clear()
        place = zlib.crc32(word) % BITS
        self[word] = found = bool(self.bitmap[place >> 3] >> (place & 7) & 1)
        return found


def read_terms(rows: DataFrame, key: str, text: str, bitmap: bytes | None = None) -> DataFrame:
    """Per row with a term: (id, row, n, terms, times); `n` counts all its terms, `terms` are the different ones
    that `bitmap` lets pass. `row` numbers the rows; the table is written, so it stays."""
    shared = None if bitmap is None else rows.sparkSession.sparkContext.broadcast(bitmap)
    kind = rows.schema[key].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        passing = Passing(None if shared is None else shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                kept, sizes, ends, terms, times = [], [], [0], [], []
                for at, value in enumerate(part[1]):
                    words = terms_of(value.as_buffer().to_pybytes()) if value.is_valid else None
                    if not words:
                        continue
                    counts = Counter(words)
                    found = [w for w in counts if passing[w]]
                    terms += found
                    times += map(counts.__getitem__, found)
                    kept.append(at)
                    sizes.append(len(words))
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part[0].take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                     pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))],
                    names=["id", "n", "terms", "times"])

    found = (rows.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
             .mapInArrow(read, f"id {kind}, {READ}"))
    return stored_small(found.withColumn("row", F.monotonically_increasing_id()), "terms")


def exploded(read: DataFrame, *columns: str) -> DataFrame:
    pairs = F.explode(F.arrays_zip("terms", "times"))
    return read.select(*columns, pairs.alias("p")).select(
        *columns, F.col("p.terms").alias("term"), F.col("p.times").alias("times"))


def bitmap_of(terms: DataFrame) -> bytes:
    """The bitmap of a column `term`; at most BITS / 8 bytes reach the driver, however many terms there are."""
    place = F.crc32(F.col("term").cast("binary")) % BITS + 1
    pages = (terms.select(place.alias("place"))
             .groupBy(F.bitmap_bucket_number("place").alias("page"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))
    whole = bytearray(BITS >> 3)
    for page, bits in pages.collect():
        whole[(page - 1) * len(bits):page * len(bits)] = bits
    return bytes(whole)


def weights(postings: DataFrame, wanted: DataFrame, documents: int) -> DataFrame:
    """(term, w) of the terms of some item and some document."""
    found = postings.groupBy("term").agg(F.count("*").alias("df"))
    rarity = F.log(F.lit(2 * documents + 2) / (2 * F.col("df") + 1))
    return (found.join(wanted.select("term").distinct(), "term")
            .select("term", F.floor(1000 * rarity).cast("bigint").alias("w")))


def with_points(postings: DataFrame, documents: int, length: int):
    """`points`, what a term adds to a document's score for each time it stands in the item."""
    size = F.expr(f"25 + (75 * n * {documents}L) div {length}L")
    return (postings.withColumn("m", size)
            .withColumn("points", F.expr("w * ((1000000000 * times) div (1000 * times + 8 * m))")))


def impact_sorted(postings: DataFrame) -> DataFrame:
    """The postings (row, t, points) in buckets of rows, sorted by points in each."""
    spark, width = postings.sparkSession, shuffle_width(postings)
    path = fresh_path(spark, "lists")
    name = f"lists_{path.rpartition('-')[2]}"
    (postings.repartition(width, "row").write.option("path", path).option("compression", "zstd")
     .bucketBy(width, "row").sortBy("points").saveAsTable(name))
    return spark.table(name)


class Reading:
    """The lists of all items: `lists` (item, t, count, first, last) and `postings` (row, t, points)."""

    def __init__(self, lists: DataFrame, postings: DataFrame, borders: list[int], k: int):
        self.lists, self.postings, self.borders, self.k = lists, postings, borders, k

    @staticmethod
    def still(border):
        """The most a list can still give to a document that has not been seen in it."""
        return F.col("count") * F.when(F.col("last") >= border, 0).otherwise(
            F.least(F.col("first"), border - 1))

    def seen(self, lists: DataFrame, *more) -> DataFrame:
        """(item, row, low, ...) of all documents seen when `lists` are read down to their `stop`."""
        least = lists.agg(F.min("stop")).first()[0]
        upper = self.postings.where(F.col("points") >= F.lit(least))
        met = lookup_join(upper, lists, "t").where("points >= stop")
        return met.groupBy("item", "row").agg(F.sum(F.col("points") * F.col("count")).alias("low"), *more)

    def thresholds(self, lists: DataFrame) -> DataFrame:
        """(item, least) of the items of which k documents have `least` or more by now.

        The scores are counted by classes, so the k best are not sorted out; `least` is at most a class, about
        one percent, below the k-th best.
        """
        size = F.floor(F.log2(F.col("low")) * STEPS).alias("size")
        classes = self.seen(lists).where("low > 0").groupBy("item", size).agg(
            F.count("*").alias("n"), F.min("low").alias("least"))
        downwards = W.partitionBy("item").orderBy(F.desc("size"))
        counted = classes.withColumn("n", F.sum("n").over(downwards)).where(F.col("n") >= self.k)
        return counted.groupBy("item").agg(F.max("least").alias("least"))

    def first_stop(self) -> int:
        times = self.lists.groupBy("t").agg(F.count("*").alias("times"))
        readings = [F.sum(F.when(F.col("points") >= b, 1).otherwise(0)).alias(str(k))
                    for k, b in enumerate(self.borders)]
        per_term = self.postings.groupBy("t").agg(*readings).join(times, "t")
        read = per_term.agg(*[F.sum(F.col(str(k)) * F.col("times")) for k in range(len(self.borders))]).first()
        early = [b for b, n in zip(self.borders, read, strict=True) if n and n <= FIRST * read[-1]]
        return early[-1] if early else self.borders[0]

    def goals(self, thresholds: DataFrame) -> DataFrame:
        """(item, least, stop, rest): where each item stops next, and what an unseen document can reach then."""
        borders = F.explode(F.array(*[F.lit(b).cast("bigint") for b in self.borders])).alias("stop")
        rests = (self.lists.select("*", borders).groupBy("item", "stop")
                 .agg(F.sum(self.still(F.col("stop"))).alias("rest")))
        known = rests.join(thresholds, "item", "left").withColumn("least", F.coalesce("least", F.lit(0)))
        enough = (F.col("rest") < UNSEEN * F.col("least")) | (F.col("stop") == 0)
        return known.where(enough).groupBy("item", "least").agg(
            F.max(F.struct("stop", "rest")).alias("s")).select("item", "least", "s.*")

    def ranked(self, candidates: DataFrame, *ties) -> DataFrame:
        order = W.partitionBy("item").orderBy(F.desc("low"), *ties)
        return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.k)

    def finished(self, candidates: DataFrame, lists: DataFrame) -> DataFrame:
        """The candidates of unresolved items with all their points, the others as they are."""
        best = self.ranked(candidates).groupBy("item").agg(
            F.when(F.count("*") == self.k, F.min("low")).otherwise(0).alias("best"))
        near = lookup_join(candidates, best, "item", spread=["item", "row"]).where("high >= best")
        near = stored_small(near.select("item", "row", "low", "high"), "near")
        unsure = stored_small(near.where("high > low").select("item").distinct(), "unsure")
        if unsure.isEmpty():
            return near
        going = lookup_join(near, unsure.withColumn("__go", F.lit(True)), "item", "left",
                            spread=["item", "row"])
        rest = (going.where("__go").select("item", "row").join(self.postings, "row")
                .join(lists, ["item", "t"]).where("points < stop")
                .select("item", "row", (F.col("points") * F.col("count")).alias("low")))
        return near.select("item", "row", "low").unionByName(rest).groupBy("item", "row").agg(
            F.sum("low").alias("low"))

    def run(self) -> DataFrame:
        """(item, row, low) of the documents that can be among the best; `low` is the score."""
        early = self.lists.withColumn("stop", F.lit(self.first_stop()).cast("bigint"))
        thresholds = stored_small(self.thresholds(early), "thresholds")
        late = self.lists.join(thresholds, "item", "left_anti").withColumn("stop", F.lit(0).cast("bigint"))
        if not late.isEmpty():
            thresholds = stored_small(thresholds.unionByName(self.thresholds(late)), "thresholds")
        goals = stored_small(self.goals(thresholds), "goals")
        lists = stored_small(self.lists.join(goals, "item").withColumn("still", self.still(F.col("stop"))),
                             "lists")
        # The item's figures come with its lists, so that the many documents seen need no join.
        high = F.col("low") + F.col("rest") - F.col("met")
        seen = self.seen(lists, F.sum("still").alias("met"), F.max("rest").alias("rest"),
                         F.max("least").alias("least"))
        candidates = seen.withColumn("high", high).where("high >= least and low > 0")
        candidates = stored_small(candidates.select("item", "row", "low", "high"), "candidates")
        return self.finished(candidates, lists)


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item key, rank, document key, score) of the `k` best documents of every item."""
    asked = read_terms(items, item_key, item_text)
    wanted = exploded(asked.withColumnRenamed("row", "item"), "item").withColumnRenamed("times", "count")
    read = read_terms(docs, key, text, bitmap_of(wanted))
    documents, length = read.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    postings = exploded(read, "row", "n")
    rarity = stored_small(weights(postings, wanted, documents)
                          .withColumn("t", F.monotonically_increasing_id()), "weights")
    heaviest = rarity.agg(F.coalesce(F.max("w"), F.lit(0))).first()[0]
    borders = [heaviest * FULL >> n for n in range(1, HALVINGS + 1)] + [0]
    scored = with_points(lookup_join(postings, rarity, "term", spread=["row"]), documents, max(length, 1))
    # Points of 0 change no score.
    sorted_lists = impact_sorted(scored.where("points > 0").select("row", "t", "points"))
    ends = sorted_lists.groupBy("t").agg(F.max("points").alias("first"), F.min("points").alias("last"))
    lists = stored_small(wanted.join(rarity, "term").join(ends, "t")
                         .select("item", "t", "count", "first", "last"), "lists")
    reading = Reading(lists, sorted_lists, borders, k)
    best = reading.run().join(read.select("row", F.col("id").alias("__id")), "row")
    ranks = reading.ranked(best, F.asc_nulls_last("__id"), "row")
    names = asked.select(F.col("row").alias("item"), F.col("id").alias("__item"))
    return ranks.join(names, "item").select(
        F.col("__item").alias(item_key), F.col("rank").cast("int").alias("rank"),
        F.col("__id").alias(key), F.col("low").cast("bigint").alias("score"))
