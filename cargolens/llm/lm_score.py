"""Code lengths of texts under a context-tree weighting model trained on part of the corpus.

Text is coded byte by byte, a byte as eight binary decisions along the tree of its bits. For each decision the
preceding `DEPTH` bytes form a context, and all shorter suffixes of it are contexts too. Every (context,
decision) keeps counts of zeros and ones with the Krichevsky-Trofimov estimate
(n + 1/2) / (n0 + n1 + 1). Context-tree weighting gives each context the block probability
P_w = (P_e + product of the children's P_w) / 2, so P_e / (2 P_w) is the weight with which prediction stops at that context,
and a decision's probability mixes the estimates of all depths with these weights. A context that
training never met ends the mixture at its parent.

The work is shaped by distinct things, not by positions: texts are cut into groups of `GROUP` characters; each
group gives its distinct words and byte strings with their training counts; the counts are added up over all
groups; the tree is built in groups of contexts that share their last two bytes (their size is bounded by the
alphabet); and the values come back to the groups that asked for them, where texts are scored. Words are
identified by 64-bit hashes. Only the two topmost levels of the tree, at most 65,536 decisions, pass the driver.

Null text is empty: it consists of the end alone. Without training rows every decision has
probability 1/2. Texts are scored whole; repeated rows count and are scored each; an empty table gives an
empty one; only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cargolens.llm.bagminhash import GOLDEN, word_hashes
from cargolens.llm.common import stored_small, utf8
from cargolens.sources.workspace import stored

DEPTH = 4  # bytes of the longest context
GROUP = 24_000_000  # characters of a group of texts, or one longer text
CHUNK = 1_000_000  # bytes handled at a time
EDGE = 255  # a byte that UTF-8 never has: it stands before a text and ends it
WORDS, STRINGS = 0, 1  # kinds of keys

SLICE = pa.schema([("grp", pa.int64()), ("kind", pa.int64()), ("key", pa.int64()),
                   ("n", pa.int64())])


# --- texts as keys ------------------------------------------------------


def lowered(text: str | None) -> bytes:
    return utf8(text or "").lower()  # of bytes, lower() changes A to Z alone


def byte_strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte and end of some texts as a key with its context, and the text it belongs to.

    The last byte of a key is the coded one; the bytes before it are its context, the nearest lowest.
    """
    edge = bytes([EDGE])
    data = np.frombuffer(b"".join(edge * DEPTH + t + edge for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 + DEPTH for t in texts])
    keys = np.zeros(len(data) - DEPTH, np.uint64)
    for k in range(DEPTH + 1):
        keys = (keys << np.uint64(8)) | data[k:len(data) - DEPTH + k]
    first = np.cumsum(sizes) - sizes
    coded = np.ones(len(keys), bool)  # the padding before a text is no coded byte
    for k in range(DEPTH):
        coded[first[1:] - DEPTH + k] = False
    return keys[coded], np.repeat(np.arange(len(texts)), sizes - DEPTH)


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) <= CHUNK:
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and the text each belongs to."""
    keys, sizes = word_hashes(b"\n".join(texts)), [len(t.split()) for t in texts]
    return keys, np.repeat(np.arange(len(texts)), sizes)


class Counts:
    """Distinct keys with the number of times they occur in training texts."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray, training: np.ndarray) -> None:
        unique, where = np.unique(keys, return_inverse=True)
        self.parts.append((unique, np.bincount(where, training, len(unique)).astype(np.int64)))
        self.size += len(unique)
        if self.size > 2_000_000:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, where = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        times = np.concatenate([n for _, n in self.parts])
        return keys, np.bincount(where, times, len(keys)).astype(np.int64)


def counted(texts: list[bytes], training: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct words and byte strings of texts with their counts in the training ones."""
    found = [Counts(), Counts()]
    for at, part in chunks(texts):
        for counts, keys_of in zip(found, (word_keys, byte_strings), strict=True):
            keys, owner = keys_of(part)
            counts.add(keys, training[at + owner].astype(float))
    return [c.merged() for c in found]


class Lookup:
    """Positions of keys in a sorted array by a hashed table; clashes are searched for."""

    BITS = 22

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.table = np.zeros(1 << self.BITS, np.int32)
        self.table[self.slots(keys)] = np.arange(len(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * GOLDEN) >> np.uint64(64 - self.BITS)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self.slots(keys)]
        wrong = np.flatnonzero(self.keys[at] != keys)
        at[wrong] = np.searchsorted(self.keys, keys[wrong])
        return at


# --- the tree -----------------------------------------------------------


def lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers, by Stirling's series above 8."""
    product = np.ones_like(x)
    for k in range(8):
        product = product * (x + k)
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1.0) - np.log(np.pi)


class Level:
    """All (context, decision) nodes of one depth, with counts, weight of stopping and P_w."""

    def __init__(self, nodes, n0, n1, children: Level | None, parent_of=None):
        self.nodes, self.n0, self.n1 = nodes, n0, n1
        own = log_block(n0, n1)
        if children is None:
            self.log_weighted, self.stop = own, np.ones(len(nodes))
        else:
            below = np.bincount(np.searchsorted(nodes, parent_of(children.nodes)),
                                children.log_weighted, len(nodes))
            self.log_weighted = np.logaddexp(own, below) - np.log(2)
            self.stop = np.exp(own - self.log_weighted) / 2

    def mix(self, at: np.ndarray, bit: np.ndarray, deeper, seen):
        """Probability of `bit` at nodes `at`, and whether training met these nodes."""
        n0, n1, stop = self.n0[at], self.n1[at], self.stop[at]
        own = (np.where(bit, n1, n0) + 0.5) / (n0 + n1 + 1)
        if deeper is not None:
            own = np.where(seen, stop * own + (1 - stop) * deeper, own)
        return own, n0 + n1 > 0


def decisions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decisions of every key's last byte: place in the tree of bits, and the bit."""
    byte = (keys & np.uint64(255)).astype(np.int64)[:, None]
    shift = np.arange(7, -1, -1)
    return (256 | byte) >> (shift + 1), (byte >> shift) & 1


def levels(keys: np.ndarray, n: np.ndarray, least: int, most: int = DEPTH) -> dict[int, Level]:
    """The levels of depth `least` to `most` of the tree over some keys."""
    place, bit = decisions(keys)
    out, children = {}, None
    for depth in range(most, least - 1, -1):
        context = (keys >> np.uint64(8)) & np.uint64((1 << (8 * depth)) - 1)
        node = (context[:, None] << np.uint64(8)) | place.astype(np.uint64)
        nodes, where = np.unique(node, return_inverse=True)
        where = where.reshape(node.shape).ravel()
        weight = np.repeat(n.astype(float), 8)
        ones = np.bincount(where, weight * bit.ravel(), len(nodes))
        total = np.bincount(where, weight, len(nodes))
        mask = np.uint64((1 << (8 * depth + 8)) - 1)
        children = Level(nodes, total - ones, ones, children, lambda x, m=mask: x & m)
        out[depth] = children
    return out


def group_levels(keys: np.ndarray, n: np.ndarray) -> dict[int, Level]:
    """Levels 2 to `DEPTH` of contexts that share their last two bytes."""
    return levels(keys, n, 2)


class Top:
    """Levels 0 and 1: counts and weights as arrays over the last byte and the decision."""

    def __init__(self, rows: pd.DataFrame):
        count = np.zeros((2, 256, 256))
        below = np.zeros((256, 256))
        at = (rows["last"].to_numpy(np.int64), rows["place"].to_numpy(np.int64))
        count[0][at], count[1][at] = rows["n0"].to_numpy(float), rows["n1"].to_numpy(float)
        below[at] = rows["below"].to_numpy(float)
        own = log_block(count[0], count[1])
        weighted = np.logaddexp(own, below) - np.log(2)
        seen = count.sum(0) > 0
        self.stop1 = np.exp(own - weighted) / 2
        self.count1, self.count0 = count, count.sum(1)
        own = log_block(*self.count0)
        weighted = np.logaddexp(own, np.where(seen, weighted, 0).sum(0)) - np.log(2)
        self.stop0 = np.exp(own - weighted) / 2

    def mix(self, last, place, bit, deeper, seen) -> np.ndarray:
        for stop, count in ((self.stop1[last, place], self.count1[:, last, place]),
                            (self.stop0[place], self.count0[:, place])):
            total = count.sum(0)
            own = (np.where(bit, count[1], count[0]) + 0.5) / (total + 1)
            deeper = np.where(seen, stop * own + (1 - stop) * deeper, own)
            seen = total > 0
        return deeper


def log10_of(keys: np.ndarray, n: np.ndarray, top: Top) -> np.ndarray:
    """log10 of the probability of each key's last byte in its context."""
    place, bit = decisions(keys)
    found = group_levels(keys, n)
    deeper = seen = None
    for depth in range(DEPTH, 1, -1):
        context = (keys >> np.uint64(8)) & np.uint64((1 << (8 * depth)) - 1)
        node = (context[:, None] << np.uint64(8)) | place.astype(np.uint64)
        at = np.searchsorted(found[depth].nodes, node)
        deeper, seen = found[depth].mix(at, bit, deeper, seen)
    last = ((keys >> np.uint64(8)) & np.uint64(255)).astype(np.int64)[:, None]
    last = np.broadcast_to(last, place.shape)
    return np.log10(top.mix(last, place, bit, deeper, seen)).sum(1)


# --- jobs ---------------------------------------------------------------


def grouped(docs: DataFrame, held_out: Column, key: str, text: str) -> DataFrame:
    """Documents with the number of their group: neighbours up to `GROUP` characters together."""
    rows = docs.select(F.col(key).alias("doc"), held_out.alias("held_out"),
                       F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        group, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            numbers = []
            for n in pa.compute.utf8_length(batch[2]).fill_null(0).to_pylist():
                if size and size + n > GROUP:
                    group, size = group + 1, 0
                size += n
                numbers.append(group)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int64())],
                [*batch.schema.names, "grp"])

    return stored_small(rows.mapInArrow(
        number, f"doc {kind}, held_out boolean, text string, grp bigint"), "grouped")


def slices_of(rows: DataFrame) -> DataFrame:
    """(grp, kind, key, n): distinct keys of each group with their training counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        group, texts, training = None, [], []

        def hand_on():
            found = counted(texts, np.array(training, bool)) if texts else []
            for kind, (keys, n) in enumerate(found):
                for at in range(0, len(keys), 500_000):
                    part = keys[at:at + 500_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), group)), pa.array(np.full(len(part), kind)),
                         pa.array(part), pa.array(n[at:at + 500_000])], schema=SLICE)

        for batch in batches:
            for text, held, number in zip(batch[0].to_pylist(), batch[1].to_pylist(),
                                          batch[2].to_pylist(), strict=True):
                if number != group:
                    yield from hand_on()
                    group, texts, training = number, [], []
                texts.append(lowered(text))
                training.append(not held)
        yield from hand_on()

    schema = "grp bigint, kind bigint, key bigint, n bigint"
    return stored_small(rows.select("text", "held_out", "grp").mapInArrow(count, schema), "slices")


def string_values(slices: DataFrame) -> DataFrame:
    """(key, value): log10 probability of every byte string that occurs."""
    strings = (slices.where(f"kind = {STRINGS}").groupBy("key").agg(F.sum("n").alias("n"))
               .withColumn("pair", F.expr("shiftright(key, 8) & 65535")))
    strings = stored(strings, "strings")

    def summary(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy(np.int64).view(np.uint64)
        level = group_levels(keys, group["n"].to_numpy())[2]
        nodes = level.nodes.astype(np.int64)
        return pd.DataFrame({"last": (nodes >> 8) & 255, "place": nodes & 255, "n0": level.n0,
                             "n1": level.n1, "below": level.log_weighted})

    top = (strings.groupBy("pair")
           .applyInPandas(summary, "last bigint, place bigint, n0 double, n1 double, below double")
           .groupBy("last", "place").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "below"))))
    # 256 last bytes with 255 decisions each, at most.
    shared = slices.sparkSession.sparkContext.broadcast(Top(top.toPandas()))

    def score(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"key": group["key"],
                             "value": log10_of(keys, group["n"].to_numpy(), shared.value)})

    return strings.groupBy("pair").applyInPandas(score, "key bigint, value double")


def score(docs: DataFrame, held_out: Column, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Per document: words and known words, unigram and tree log10 probability.

    `held_out` is true for rows that are not learned from.
    """
    rows = grouped(docs, held_out, key, text)
    slices = slices_of(rows)
    values = stored(string_values(slices), "values")

    # A word's training count in the whole corpus. Groups know their own part, so it goes back only to
    # groups of words that others count as well.
    words = slices.where(f"kind = {WORDS}")
    total = F.sum("n").over(Window.partitionBy("key"))
    totals = words.groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
    ends = rows.where(~F.col("held_out")).count()
    size = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, vocabulary = size["n"] + ends, size["v"] + (ends > 0)
    shared = (words.withColumn("total", total).where("total <> n")
              .select("grp", "kind", "key", F.col("total").cast("double").alias("value")))
    strings = (slices.where(f"kind = {STRINGS}").join(values, "key")
               .select("grp", "kind", "key", "value"))
    answers = shared.union(strings)
    out_type = to_arrow_type(docs.schema[key].dataType)

    def judge(texts_of: pa.Table, values_of: pa.Table) -> pa.Table:
        texts = [lowered(t.as_py()) for t in texts_of["text"]]
        held = np.array(texts_of["held_out"].to_pylist(), bool)
        kinds = values_of["kind"].to_numpy()
        keys = values_of["key"].to_numpy().view(np.uint64)
        value = values_of["value"].to_numpy()

        own = Counts()
        for at, part in chunks(texts):
            found, owner = word_keys(part)
            own.add(found, (~held)[at + owner].astype(float))
        known, count = own.merged()
        count = count.astype(float)
        asked = kinds == WORDS
        count[np.searchsorted(known, keys[asked])] = value[asked]
        string, first = np.unique(keys[~asked], return_index=True)
        string_value = value[~asked][first]

        log = np.log10((count + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
        end = np.log10((ends + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
        find_word, find_string = Lookup(known) if len(known) else None, Lookup(string)
        figures = []
        for _, part in chunks(texts):
            n = len(part)
            found, owner = word_keys(part)
            at = find_word(found) if len(found) else np.zeros(0, np.int64)
            pieces, whose = byte_strings(part)
            figures.append((np.bincount(owner, minlength=n) + 1,
                            np.bincount(owner, count[at] > 0, n) + (ends > 0),
                            np.bincount(owner, log[at], n) + end,
                            np.bincount(whose, string_value[find_string(pieces)], n)))
        n_tokens, n_known, base, tree = (np.concatenate(f) for f in zip(*figures, strict=True))
        return pa.table({
            key: texts_of["doc"].combine_chunks().cast(out_type), "held_out": texts_of["held_out"],
            "n_tokens": n_tokens.astype(np.int64), "n_known": n_known.astype(np.int64),
            "train_tokens": np.full(len(texts), tokens, np.int64),
            "base_score": base.astype(float), "score": np.round(tree, 6)})

    kind = docs.schema[key].dataType.simpleString()
    return rows.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(
        judge, f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
               "train_tokens bigint, base_score double, score double")
