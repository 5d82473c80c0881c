"""Packing of documents into as few sequences as possible by a grouping genetic algorithm.

Documents are tokenized and stay whole; only one longer than a sequence is cut, into full sequences after a first piece
that holds the rest. Full pieces are sequences of their own. All others are packed by evolution: a solution
is a set of bins, and a child takes one parent's bins, gets whole well-filled bins of the other injected, loses the
own bins that hold a document a second time, and has the documents that this displaces, and those of its
emptiest bins, put back: first in exchange for shorter ones where that fills a bin better, then by best fit in falling
length.

The pieces are dealt to blocks of about `BLOCK`, each length evenly, so that blocks are alike. Every block
evolves on `ISLANDS` islands, groups of a Spark job that differ in their random numbers. After an epoch each island
sends its elite to the next island of the block; blocks that reached the lower bound on the number of bins (a proof that
they are done) leave, the others go on. Of a finished block the best island counts. Bins that are not well filled are then opened
again and their pieces packed together across blocks in the same way, until there is one block or that no longer
halves the pieces. So no group is larger than a block, and what is shuffled is a few numbers per piece.

Null text counts as empty and gives the end id alone. Texts of any length are cut into pieces. Repeated rows are packed
each; an empty table gives an empty result; only the named columns are read. The random numbers follow from block,
island and epoch, so a task that runs again gives the same bins.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.common import stored_small
from cargolens.llm.packing import END, ids_of
from cargolens.operators.joins import shuffle_width

LENGTH = 2048  # tokens of a sequence
BLOCK = 4096  # pieces that evolve together
ISLANDS = 2  # islands of a block
EPOCHS = 3  # at most, with a migration between two
GENERATIONS = 64  # children per island and epoch
PEOPLE = 6  # solutions of an island
WELL_FILLED = 31 / 32  # bins below this share of the length are opened again across blocks
ROWS = 4096  # rows of an output batch


# --- one island ------------------------------------------------------------


class Solution:
    """Bins (lists of pieces) and the tokens in each."""

    def __init__(self, bins: list[list[int]], fills: list[int]):
        self.bins, self.fills = bins, fills
        # Fewer bins are better; of equally many those with the room gathered in few of them.
        self.cost = len(bins), -sum(f * f for f in fills)

    def owners(self, pieces: int) -> np.ndarray:
        """The bin of every piece."""
        owner = np.empty(pieces, np.int64)
        owner[list(chain.from_iterable(self.bins))] = np.repeat(
            np.arange(len(self.bins)), list(map(len, self.bins)))
        return owner


def least_bins(sizes: np.ndarray, length: int) -> int:
    """A lower bound: for each a, pieces above length - a stand alone, those above half of the length apart, and
    pieces from a on must fit beside the latter or into further bins."""
    counts = np.bincount(sizes, minlength=length + 1)
    above = np.append(np.cumsum(counts[::-1])[::-1], 0)  # pieces of at least this size
    tokens = np.append(np.cumsum((counts * np.arange(length + 1))[::-1])[::-1], 0)
    half, a = length // 2 + 1, np.arange(length // 2 + 1)
    alone, apart = above[length - a + 1], above[half] - above[length - a + 1]
    room = apart * length - (tokens[half] - tokens[length - a + 1])
    beyond = np.maximum(tokens[a] - tokens[half] - room, 0)
    return int((alone + apart + -(-beyond // length)).max())


def best_fit(order: Iterable[int], sizes: list[int], length: int, bins: list[list[int]],
             fills: list[int]) -> Solution:
    """Put the pieces one by one into the bin that leaves the least room, a new one if none has room.

    Bins of equal room share a list; the bits of a number say which lists are not empty.
    """
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    some = 0
    for k, fill in enumerate(fills):
        by_room[length - fill].append(k)
        some |= 1 << length - fill
    for piece in order:
        size = sizes[piece]
        fitting = some >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                some ^= 1 << room
            bins[k].append(piece)
            fills[k] += size
        else:
            room, k = length, len(bins)
            bins.append([piece])
            fills.append(size)
        by_room[room - size].append(k)
        some |= 1 << room - size
    return Solution(bins, fills)


def exchanged(displaced: list[int], sizes: list[int], length: int, bins: list[list[int]],
              fills: list[int]) -> list[int]:
    """Fill bins by giving one of their pieces for the longest displaced one that fits in its place.

    Bins change in place. What is displaced afterwards is as many pieces, but shorter ones.
    """
    by_size: dict[int, list[int]] = {}
    some = 0
    for piece in displaced:
        by_size.setdefault(sizes[piece], []).append(piece)
        some |= 1 << sizes[piece]
    for k, own in enumerate(bins):
        room = length - fills[k]
        if not room:
            continue
        best, gain = -1, 0
        for at, piece in enumerate(own):
            size = sizes[piece]
            found = (some & ((2 << size + room) - 1)).bit_length() - 1 - size
            if found > gain:
                best, gain = at, found
                if gain == room:
                    break
        if best >= 0:
            piece = own[best]
            size = sizes[piece]
            waiting = by_size[size + gain]
            own[best] = waiting.pop()
            fills[k] += gain
            if not waiting:
                some ^= 1 << size + gain
            by_size.setdefault(size, []).append(piece)
            some |= 1 << size
    return list(chain.from_iterable(by_size.values()))


def crossed(one: Solution, other: Solution, sizes: list[int], length: int,
            random: np.random.Generator) -> Solution:
    """A child of two solutions."""
    share = random.uniform(0.1, 0.5)
    order = np.argsort(-np.array(other.fills) + random.uniform(0, length / 64, len(other.fills)))
    injected = [other.bins[k] for k in order[:max(1, int(share * len(order)))].tolist()]
    owner = one.owners(len(sizes))
    new = list(chain.from_iterable(injected))
    gone = set(owner[new].tolist())
    emptiest = np.argsort(np.array(one.fills) + random.uniform(0, length / 8, len(one.fills)))
    gone.update(emptiest[:1 + int(random.integers(0, 1 + len(one.bins) // 20))].tolist())
    taken = set(new)
    kept = [k for k in range(len(one.bins)) if k not in gone]
    displaced = [p for k in gone for p in one.bins[k] if p not in taken]
    bins = [list(b) for b in injected] + [list(one.bins[k]) for k in kept]
    fills = [sum(map(sizes.__getitem__, b)) for b in injected] + [one.fills[k] for k in kept]
    displaced = exchanged(displaced, sizes, length, bins, fills)
    displaced.sort(key=sizes.__getitem__, reverse=True)
    return best_fit(displaced, sizes, length, bins, fills)


def evolved(sizes: np.ndarray, length: int, random: np.random.Generator,
            elites: list[list[list[int]]] = (), generations: int = GENERATIONS) -> tuple[Solution, int]:
    """(best solution, lower bound) after so many children of `elites` and of best fits in slightly mixed order."""
    bound, plain = least_bins(sizes, length), sizes.tolist()
    people = [Solution(bins, [sum(map(plain.__getitem__, b)) for b in bins]) for bins in elites]

    def done() -> bool:
        return bool(people) and min(s.cost for s in people)[0] <= bound

    while len(people) < PEOPLE and not done():
        mixed = sizes * random.uniform(1 - 0.02 * len(people), 1, len(sizes))
        people.append(best_fit(np.argsort(-mixed, kind="stable").tolist(), plain, length, [], []))
    for _ in range(generations):
        if done():
            break
        first, second = sorted(random.choice(len(people), 2, replace=False).tolist(),
                               key=lambda k: people[k].cost)
        child = crossed(people[first], people[second], plain, length, random)
        worst = max(range(len(people)), key=lambda k: people[k].cost)
        if child.cost < people[worst].cost and all(child.cost != s.cost for s in people):
            people[worst] = child
    return min(people, key=lambda s: s.cost), bound


# --- islands on Spark --------------------------------------------------------

PACKED = ("block long, island int, number long, length int, sequence long, offset int, fill int, "
          "bins long, spare long, bound long")


def island(epoch: int, length: int):
    """Evolves the pieces of one block on one island; with `from_island` set, from the elites given."""

    def evolve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, here = map(int, key)
        rows = rows.sort_values(["from_island", "number"], ignore_index=True)
        elites, numbers, sizes = [], None, None
        for _, part in rows.groupby("from_island", sort=True):
            numbers, sizes = part["number"].to_numpy(), part["length"].to_numpy().astype(np.int64)
            if epoch:
                parts = pd.Series(range(len(part))).groupby(part["sequence"].to_numpy())
                elites.append([list(members) for _, members in parts])
        best, bound = evolved(sizes, length, np.random.default_rng([block, here, epoch]), elites)
        order = np.fromiter(chain.from_iterable(best.bins), np.int64, len(sizes))
        counts = np.array(list(map(len, best.bins)))
        begins = np.cumsum(counts) - counts
        ahead = np.cumsum(sizes[order]) - sizes[order]
        return pd.DataFrame({
            "block": block, "island": here, "number": numbers[order], "length": sizes[order],
            # A sequence is named after the piece that stands first in it.
            "sequence": np.repeat(numbers[order[begins]], counts),
            "offset": ahead - np.repeat(ahead[begins], counts),
            "fill": np.repeat(best.fills, counts), "bins": len(best.bins), "spare": -best.cost[1],
            "bound": bound})

    return evolve


def dealt(pieces: DataFrame, blocks: int, length: int) -> DataFrame:
    """`pieces` (number, length) with a block; every task deals its pieces of each length in turn."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        random = np.random.default_rng([TaskContext.get().partitionId(), blocks])
        turn = random.integers(0, blocks, length + 1)
        for batch in batches:
            sizes = batch.column("length").to_numpy()
            order = np.argsort(sizes, kind="stable")
            counts = np.bincount(sizes, minlength=length + 1)
            place = np.empty(len(sizes), np.int64)
            place[order] = np.arange(len(sizes)) - np.repeat(np.cumsum(counts) - counts, counts)
            block = (turn[sizes] + place) % blocks
            turn = (turn + counts) % blocks
            yield pa.RecordBatch.from_arrays([batch.column("number"), batch.column("length"),
                                              pa.array(block, pa.int64())],
                                             names=["number", "length", "block"])

    return pieces.select("number", "length").mapInArrow(deal, "number long, length int, block long")


def evolution(pieces: DataFrame, blocks: int, length: int) -> DataFrame:
    """The best solution of every block, as `PACKED`."""
    width = shuffle_width(pieces)

    def epoch(rows: DataFrame, number: int) -> DataFrame:
        groups = rows.repartition(min(width, max(1, blocks * ISLANDS)), "block", "island") \
            .groupBy("block", "island")
        return stored_small(groups.applyInPandas(island(number, length), PACKED), "epoch")

    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    start = dealt(pieces, blocks, length).withColumn("island", islands)
    rows = epoch(start.withColumn("from_island", F.lit(0)), 0)
    finished = []
    for number in range(1, EPOCHS + 1):
        ranks = rows.groupBy("block", "island").agg(
            F.min(F.struct("bins", -F.col("spare"))).alias("cost"), F.min("bound").alias("bound"))
        best = stored_small(ranks.groupBy("block").agg(
            F.min(F.struct("cost", "island")).alias("best"), F.min("bound").alias("bound"))
            .select("block", F.col("best.island").alias("island"),
                    ((F.col("best.cost.bins") <= F.col("bound")) | F.lit(number == EPOCHS)).alias("done")),
            "best")
        finished.append(rows.join(best.where("done"), ["block", "island"]).drop("done"))
        if number == EPOCHS or best.where("not done").isEmpty():
            break
        of_block = Window.partitionBy("block")
        going = rows.withColumn("least", F.min("bins").over(of_block)).where("least > bound").drop("least")
        own = going.withColumn("from_island", F.lit(0))
        migrants = going.withColumns({"from_island": F.lit(1), "island": F.expr(f"(island + 1) % {ISLANDS}")})
        rows = epoch(own.unionByName(migrants), number)
    whole = finished[0]
    for part in finished[1:]:
        whole = whole.unionByName(part)
    return stored_small(whole.select("number", "length", "sequence", "offset", "fill"), "packed")


def packed(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """(number, sequence, offset) of pieces (number, length) of at most `length`; numbers are unique.

    A sequence is named after the number of its first piece.
    """
    closed, waiting = [], pieces
    count = waiting.count()
    while count:
        blocks = -(-count // BLOCK)
        found = evolution(waiting, blocks, length)
        if blocks == 1:
            closed.append(found)
            break
        opened = found.where(F.col("fill") < WELL_FILLED * length)
        left = opened.count()
        if 2 * left > count:
            closed.append(found)
            break
        closed.append(found.where(F.col("fill") >= WELL_FILLED * length))
        waiting, count = opened.select("number", "length"), left
    columns = ["number", "sequence", "offset"]
    if not closed:
        return pieces.select("number", F.col("number").alias("sequence"), F.lit(0).alias("offset"))
    whole = closed[0].select(*columns)
    for part in closed[1:]:
        whole = whole.unionByName(part.select(*columns))
    return whole


# --- documents --------------------------------------------------------------

PIECE = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                   ("ids_crc32", pa.int64())])


def cut(docs: DataFrame, key: str, text: str, path: str | None, length: int) -> DataFrame:
    """The pieces of all documents, numbered and written."""
    kind = docs.schema[key].dataType.simpleString()

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        ids = ids_of(path)
        end = struct.pack("<I", END)

        def batch_of(keys, rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type),
                 *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECE, strict=True))],
                names=[key, *PIECE.names])

        for batch in batches:
            key_type, keys, rows = batch.schema.types[0], [], []
            for name, value in zip(batch[0].to_pylist(), batch[1], strict=True):
                data = ids(value.as_py() or "") + end
                total = len(data) // 4
                stops = range(total % length or length, total + 1, length) if total > length else [total]
                start = 0
                for piece, stop in enumerate(stops):
                    keys.append(name)
                    rows.append((piece, start, stop - start, zlib.crc32(data[4 * start:4 * stop])))
                    start = stop
                if len(rows) >= ROWS:
                    yield batch_of(keys, rows)
                    keys, rows = [], []
            if rows:
                yield batch_of(keys, rows)

    found = docs.select(key, text).mapInArrow(
        pieces_of, f"`{key}` {kind}, piece int, start bigint, length int, ids_crc32 bigint")
    return stored_small(found.withColumn("number", F.monotonically_increasing_id()), "pieces")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
         length: int = LENGTH) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most `length` tokens."""
    pieces = cut(docs, key, text, path, length)
    places = packed(pieces.where(F.col("length") < length).select("number", "length"), length)
    return pieces.join(places, "number", "left").select(
        key, "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32",
        F.coalesce("sequence", "number").alias("sequence_id"),
        F.coalesce(F.col("offset"), F.lit(0)).cast("bigint").alias("offset"))
