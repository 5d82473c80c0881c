"""Runs: stretches of words that repeat with a period, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q, at least `LEAST` words and two periods long,
that no neighbouring word extends. Words q apart agree over at least max(LEAST - q, q) places of it, which
is never less than `SEED`. So seeds are indexed: k-grams of k = SEED words for periods below 2 k, and of 2, 4, 8, ...
times as many words for periods from k up to 2 k, each length named exactly by pairs of the names of half of it.
Occurrences of one k-gram in a text at such a distance are extended along their diagonal in both directions;
a table of how far each lag is covered already keeps a repeat from being extended again.

Only pairs of the scale's distance are listed, by search in the sorted index. A k-gram of a small period p (4 p <= k)
lies in a run of that period, which a smaller scale has found. Of its occurrences inside that run only the first and
the last are paired with those outside, which is enough: a longer period ends or begins where that run does. Hence the
number of pairs is in proportion to the words on every scale, also for a text of one word.

Null and empty text has no words and no run. Texts of any length are read whole, one at a time. Repeated rows
are read each; an empty table gives an empty result. Words are compared as bytes. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import SPACES, utf8

LEAST = 12  # words of the shortest run
SEED = LEAST // 2  # max(LEAST - q, q) is at least this for every period q
ROWS = 256  # rows of an output batch

FOUND = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def words_of(text: str | None) -> list[bytes]:
    """The words; `SPACES` are the white space of `bytes.split`."""
    return utf8(text or "").split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, from 0."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def pair_names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Equal pairs get equal numbers."""
    return np.unique(first * (second.max() + 1) + second, return_inverse=True)[1]


def seed_keys(ids: np.ndarray) -> np.ndarray:
    """Equal keys at the starts of equal `SEED`-grams."""
    kinds, places = int(ids.max()) + 1, len(ids) - SEED + 1
    if kinds ** SEED < 1 << 62:
        keys = np.zeros(places, np.int64)
        for k in range(SEED):
            keys = keys * kinds + ids[k:k + places]
        return keys
    half = pair_names(pair_names(ids[:-2], ids[1:-1]), ids[2:])
    return half[:places] * (half.max() + 1) + half[SEED // 2:]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Names of the keys that occur more than once, -1 for the others."""
    _, names, times = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(times[names] > 1, names, -1)


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all values in the ranges [low, high) of the rows."""
    sizes = np.maximum(high - low, 0)
    row = np.repeat(np.arange(len(low)), sizes)
    return row, np.arange(len(row)) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)


def agreeing(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from `at` on, forwards (step 1) or backwards (-1), agree with those `lag` later."""
    limit = len(ids) - lag - at if step > 0 else at + 1
    done, size = 0, 32
    while done < limit:
        size = min(size, limit - done)
        low = at + done if step > 0 else at - done - size + 1
        differs = ids[low:low + size] != ids[low + lag:low + lag + size]
        if differs.any():
            return done + int((differs if step > 0 else differs[::-1]).argmax())
        done += size
        size *= 2
    return done


class Seeds:
    """Occurrences of the repeated k-grams of a text, sorted by k-gram and place."""

    def __init__(self, names: np.ndarray, k: int, runs: dict[tuple[int, int], int]):
        self.k, self.width = k, len(names) + 1
        self.at = np.flatnonzero(names >= 0)
        self.sorted = np.sort(names[self.at] * self.width + self.at)
        # The run of a period of at most k / 4 that a k-gram lies in, of which there is one at most.
        self.inside = np.full(len(names), -1)
        border = np.ones(len(names), bool)
        for number, ((start, end), period) in enumerate(runs.items()):
            if 4 * period <= k <= end - start:
                self.inside[start:end - k + 1] = number
                border[start + 1:end - k] = False
        self.names, self.kept = names, border

    def pairs(self, least: int) -> Iterator[tuple[int, int]]:
        """(lag, first place) of pairs `least` to 2 k - 1 apart, by lag and place, without those that the
        pair one place earlier covers."""
        chosen = self.at[self.kept[self.at]]
        base = self.names[chosen] * self.width
        row, where = spread(
            np.searchsorted(self.sorted, base + np.minimum(chosen + least, self.width)),
            np.searchsorted(self.sorted, base + np.minimum(chosen + 2 * self.k, self.width)))
        first, second = chosen[row], self.sorted[where] % self.width
        row, where = spread(
            np.searchsorted(self.sorted, base + np.maximum(chosen - 2 * self.k + 1, 0)),
            np.searchsorted(self.sorted, base + np.maximum(chosen - least + 1, 0)))
        earlier, later = self.sorted[where] % self.width, chosen[row]
        new = ~self.kept[earlier]
        first, second = np.concatenate([first, earlier[new]]), np.concatenate([second, later[new]])
        apart = (self.inside[first] < 0) | (self.inside[first] != self.inside[second])
        code = np.unique((second - first)[apart] * self.width + first[apart])
        code = code[np.diff(code, prepend=-2) != 1]
        yield from zip((code // self.width).tolist(), (code % self.width).tolist(), strict=True)


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a numbered text, by start and period."""
    n, k, least = len(ids), SEED, 1
    if n < LEAST:
        return []
    keys = seed_keys(ids)
    ordered = np.sort(keys)
    if not (ordered[1:] == ordered[:-1]).any():
        return []
    names = repeated(keys)
    found: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period
    while True:
        covered: dict[int, int] = {}  # lag -> end of the agreement that was extended last
        for lag, at in Seeds(names, k, found).pairs(least):
            if at < covered.get(lag, 0):
                continue
            start = at - agreeing(ids, at - 1, lag, -1)
            end = covered[lag] = at + k + agreeing(ids, at + k, lag, 1)
            if end - start + lag >= max(LEAST, 2 * lag):
                # A stretch that has a smaller period too is the run of that period.
                whole = start, end + lag
                found[whole] = min(lag, found.get(whole, lag))
        least = 2 * k
        if n < 2 * least:
            break
        at = np.flatnonzero(names[:n - least + 1] >= 0)
        at = at[names[at + k] >= 0]
        if not len(at):
            break
        longer = np.full(n - least + 1, -1)
        longer[at] = repeated(names[at] * (n + 1) + names[at + k])
        names, k = longer, least
    return sorted((start, end - start, period) for (start, end), period in found.items())


def first_periods(words: list[bytes], runs) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, gone in zip(words, np.cumsum(change).tolist(), strict=False) if not gone]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, `n_words`, `runs` (by start and period) and the `collapsed` text, in which
    every run is cut to its first period and words are joined by one space."""
    picked = docs.select(F.col(key), F.col(text).cast("string"))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                counts, runs, collapsed = [], [], []
                for value in part[1]:
                    words = words_of(value.as_py())
                    own = runs_of(numbered(words)) if len(words) >= LEAST else []
                    counts.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
                    collapsed.append(b" ".join(first_periods(words, own)).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [part[0], pa.array(counts, pa.int64()), pa.array(runs, pa.list_(FOUND)),
                     pa.array(collapsed, pa.string())], names=[key, "n_words", "runs", "collapsed"])

    return picked.mapInArrow(search, schema)


def with_probes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) where a tenth of the texts, picked by crc32 of the key, repeats from some word on.

    With h = crc32(key as text) and g = floor(h / 10), if h is divisible by 10, each word i >= a is replaced by
    word a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and those
    without a key or a word, stay.
    """
    hashed = F.crc32(F.col(key).cast("string").cast("binary"))
    spaces = "".join(f"\\x{c:02X}" for c in SPACES)
    words = F.when(hashed % 10 == 0, F.regexp_extract_all(text, F.lit(f"[^{spaces}]+"), 0))
    split = docs.select(key, F.col(text).cast("string").alias("plain"),
                        F.floor(hashed / 10).alias("g"), words.alias("words"))
    placed = split.withColumn("a", F.when(F.size("words") > 0, F.expr("g % size(words)")))
    placed = placed.withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
    probe = F.expr("array_join(transform(words, (w, i) -> "
                   "if(i < a, w, words[cast(a + (i - a) % p as int)])), ' ')")
    return placed.select(key, F.when(F.col("a").isNotNull(), probe).otherwise(F.col("plain"))
                         .alias(text))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (ties: the first, then the smallest period) and digests of all runs
    and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.withColumns({"__longest": longest, "__listed": listed})
    start, length, period = (F.col("__longest")[c] for c in ("start", "length", "period"))
    return rows.select(
        key, F.size("runs").cast("bigint").alias("n_runs"), (-start).alias("start"),
        length.alias("length"), (-period).alias("period"),
        F.expr("1000 * __longest.length div -__longest.period").alias("exponent_milli"),
        F.sha2(F.col("__listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
