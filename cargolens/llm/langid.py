"""Language identification by bit-sliced Bloom filters of character trigrams.

Trigrams of lower-cased letters, with a blank for anything else at their ends, are counted per language
over all training rows. A language's profile is the trigrams that make up at least `LEAST_SHARE` of its
trigrams and are not much rarer there than in the language where they are most common. All
profiles go into one table of bitmasks, one bit per language: a trigram sets its language's bit at
three hashed places, and the conjunction of the masks at its three places names all languages that contain it.
A text's trigrams are counted per language, the counts are corrected for the filters' share of false
positives, and the largest wins. The score is the corrected share of the text's trigrams that the winner
contains.

Null text and text without letters are `und` with score 0, and so is all text if nothing was learned. A text
with letters that no profile knows gets the commonest language with score 0. Ties go to the first
language in alphabetical order. Texts are read whole; repeated rows count and are judged each;
empty tables give empty results; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.sources.workspace import stored

LEAST_SHARE = 1e-4  # so a profile has at most 10,000 trigrams
LEAST_RATIO = 0.25  # of the share in the language where the trigram is most common
BITS = 18  # each language's filter has 2^BITS bits
CHUNK = 200_000  # characters handled at a time
SLICE = 500  # texts handled at a time
KEPT = 500_000  # distinct trigrams a task holds before it hands them on
BLANK = 32


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of some texts as exact numbers, and the position of the text each belongs to.

    The middle of a trigram is a letter; other characters at its ends count as a blank.
    """
    lowered = [t.lower() for t in texts]
    joined = " " + "".join(t + " " for t in lowered)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters()[codes]
    codes = np.where(known, codes, BLANK).astype(np.uint64)
    middle = np.flatnonzero(known)
    keys = (codes[middle - 1] << np.uint64(42)) | (codes[middle] << np.uint64(21)) | codes[middle + 1]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return keys, np.searchsorted(ends, middle - 1, side="right")


def chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of at most `CHUNK` characters together, or a single longer one."""
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) <= CHUNK:
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


@dataclass
class Filters:
    """The mask table: 64 languages to a column."""

    languages: list[str]
    common: int
    masks: np.ndarray
    false_share: np.ndarray

    @staticmethod
    def places(keys: np.ndarray) -> list[np.ndarray]:
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        low = np.uint64((1 << BITS) - 1)
        return [(mixed >> np.uint64(shift)) & low for shift in (0, BITS, 2 * BITS)]

    @classmethod
    def build(cls, profiles: dict[str, np.ndarray], common: str) -> Filters:
        languages = sorted(profiles)
        masks = np.zeros((1 << BITS, (len(languages) + 63) // 64), np.uint64)
        filled = []
        for k, name in enumerate(languages):
            bit = np.uint64(1) << np.uint64(k % 64)
            for place in cls.places(profiles[name]):
                masks[place, k // 64] |= bit
            filled.append((masks[:, k // 64] & bit != 0).mean())
        return cls(languages, languages.index(common), masks, np.array(filled) ** 3)

    def judge(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for _, part in chunks(texts):
            keys, owner = trigrams(part)
            first, second, third = self.places(keys)
            total = np.bincount(owner, minlength=len(part))
            hits = np.zeros((len(self.languages), len(part)))
            for column in range(self.masks.shape[1]):
                masks = self.masks[:, column]
                found = masks[first] & masks[second] & masks[third]
                for k in range(column * 64, min(len(self.languages), column * 64 + 64)):
                    has = (found >> np.uint64(k % 64)) & np.uint64(1) != 0
                    hits[k] = np.bincount(owner[has], minlength=len(part))
            false = np.minimum(self.false_share, 0.999)[:, None]
            real = np.maximum(hits - total * false, 0) / (1 - false)
            best = real.argmax(0)
            for k, n in enumerate(total):
                if n == 0:
                    out.append(("und", 0.0))
                elif real[best[k], k] == 0:
                    out.append((self.languages[self.common], 0.0))
                else:
                    out.append((self.languages[best[k]], min(1.0, real[best[k], k] / n)))
        return out


def counted(rows: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all rows that have a language and a text."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def hand_on():
            for name, (keys, times) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)),
                     pa.array(times)], schema=schema)
            held.clear()

        for part_of in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            by_lang: dict[str, list[str]] = {}
            for name, value in zip(part_of[1].to_pylist(), part_of[0].to_pylist(), strict=True):
                by_lang.setdefault(name, []).append(value)
            for name, texts in by_lang.items():
                for _, part in chunks(texts):
                    keys, times = np.unique(trigrams(part)[0], return_counts=True)
                    if name in held:
                        keys = np.concatenate([held[name][0], keys])
                        times = np.concatenate([held[name][1], times])
                        keys, where = np.unique(keys, return_inverse=True)
                        times = np.bincount(where, times).astype(np.int64)
                    held[name] = keys, times
            if sum(len(keys) for keys, _ in held.values()) > KEPT:
                yield from hand_on()
        yield from hand_on()

    known = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    grams = known.mapInArrow(count, "lang string, gram bigint, n bigint")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> Filters | None:
    """The filters of all languages in `rows`.

    What reaches the driver is the profiles: at most 1 / `LEAST_SHARE` trigrams per language.
    """
    counts = stored(counted(rows, text, lang), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    sizes = {r["lang"]: r["total"] for r in totals.collect()}
    if not sizes:
        return None
    profile = (counts.join(F.broadcast(totals), "lang")
               .where(F.col("n") >= LEAST_SHARE * F.col("total"))
               .select("lang", "gram", (F.col("n") / F.col("total")).alias("share")).toPandas())
    most = profile.groupby("gram")["share"].transform("max")
    profile = profile[profile["share"] >= LEAST_RATIO * most]
    profiles = {name: np.sort(part["gram"].to_numpy()).astype(np.uint64)
                for name, part in profile.groupby("lang")}
    return Filters.build(profiles, max(sorted(profiles), key=sizes.get))


def predicted(docs: DataFrame, text: Column, filters: Filters | None) -> Column:
    """Language and score of a text column of `docs`."""
    # 2^BITS words of 8 bytes per 64 languages: 2 MB.
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judged(batch: pa.Array) -> pa.Array:
        found = []
        for at in range(0, len(batch), SLICE):  # few texts are Python strings at a time
            texts = [v or "" for v in batch.slice(at, SLICE).to_pylist()]
            found += shared.value.judge(texts) if shared.value else [("und", 0.0)] * len(texts)
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.float64())], ["lang_pred", "score"])

    return judged(text)


def identify(docs: DataFrame, filters: Filters | None, held_out: Column, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    found = docs.select(key, held_out.alias("held_out"),
                        predicted(docs, F.col(text), filters).alias("found"))
    return found.select(key, "held_out", "found.*")
