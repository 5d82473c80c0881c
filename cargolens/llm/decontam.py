"""Benchmark decontamination: a BM25 index of test items that every training passage queries.

Items are cut into chunks of at most `STEP` words, training texts into passages of `2 * STEP` words that overlap by
half, so a copied chunk lies whole in some passage. A passage is a bag-of-words query. A chunk is retrieved when its
BM25 score reaches a share of the score the whole chunk would get. As in block-max WAND, lists that
cannot decide are left out at first: a chunk's weakest terms, which together stay below half of its
threshold, are not essential to it. The inverted index gives for every term the blocks in which it is essential
and its largest impact there; a block is opened only if these maxima reach what its chunks need besides
their other terms. In opened blocks the impacts of essential terms are added up per chunk, and chunks that
reach their own need are scored exactly with all terms. What is retrieved is verified on
the texts: the document must contain `COVERAGE` of the question's five-word shingles and, where items
have answers, `COVERAGE` of the answer's.

The index goes to the workers in shards of at most `SHARD` chunks, which bounds the broadcast at some 25 MB however many
items there are; each shard is matched in a pass of its own.

Words are in lower case and end at white space and ASCII punctuation. Items and texts without words match
nothing; items of fewer than five words are one shingle. Null texts count as empty, null item ids are
carried. Repeated rows, items or documents, are matched each. Texts are searched whole.
Empty tables give no matches. Only the named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cargolens.llm.common import free_name, utf8

STEP = 64  # words of a chunk at most; passages are twice as long
BLOCK = 16  # chunks of a block
SHARD = 1024  # chunks of a broadcast index
RETRIEVE = 0.4  # share of a chunk's own score that a passage must reach
COVERAGE = 0.5  # share of an item's shingles that a document must contain
SHINGLE = 5
K1, B = 1.2, 0.75
WORDS = 200_000  # words matched at a time

# ASCII characters other than letters and digits separate words.
SPLIT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return utf8((text or "").lower()).translate(SPLIT).split()


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


@dataclass
class Item:
    item_id: object
    question: set
    answer: set


@dataclass
class Lists:
    """Inverted lists one after another: where each term's begins, its targets and impacts."""

    begins: np.ndarray
    targets: np.ndarray
    impacts: np.ndarray
    needed: np.ndarray  # by target: the least sum of impacts that counts

    @classmethod
    def of(cls, entries: list[tuple[int, int, float]], n_terms: int, needed) -> Lists:
        entries.sort()
        terms, targets, impacts = (np.array(x) for x in zip(*entries, strict=True))
        return cls(np.searchsorted(terms, np.arange(n_terms + 1)), targets.astype(np.int64),
                   impacts.astype(float), np.array(needed) * (1 - 1e-9))

    def reached(self, passage: np.ndarray, term: np.ndarray, n: int,
                open_to=None) -> np.ndarray:
        """passage x target: whether the impacts of a passage's terms add up to what is needed.

        `open_to(passage, target)` limits the sum to targets in opened blocks.
        """
        lengths = self.begins[term + 1] - self.begins[term]
        row = np.repeat(np.arange(len(term)), lengths)
        at = np.arange(len(row)) + np.repeat(self.begins[term] - np.cumsum(lengths) + lengths, lengths)
        who, target = passage[row], self.targets[at]
        if open_to is not None:
            allowed = open_to(who, target)
            who, target, at = who[allowed], target[allowed], at[allowed]
        size = len(self.needed)
        sums = np.bincount(who * size + target, self.impacts[at], n * size)
        return sums.reshape(n, size) >= self.needed


@dataclass
class Index:
    items: list[Item]
    terms: dict[bytes, int] = field(default_factory=dict)
    chunks: list[tuple[int, np.ndarray, np.ndarray, float]] = field(default_factory=list)
    by_block: Lists = None
    by_chunk: Lists = None

    def matches(self, texts: list[list[bytes]]) -> Iterator[tuple[int, int, float]]:
        """(text, item, score) of all chunks retrieved by some passage of a text."""
        if not self.chunks:
            return
        known, n_terms = self.terms, len(self.terms)
        keys, back, first, owner = [], [], 0, []
        for k, words in enumerate(texts):
            ids = np.fromiter(map(known.get, words, itertools.repeat(-1)), np.int64, len(words))
            at = np.flatnonzero(ids >= 0)
            keys.append((first + at // STEP) * n_terms + ids[at])
            # A step is also the second one of a passage, but for a text's first: what is
            # before that belongs to another text.
            back.append(keys[-1][at >= STEP] - n_terms)
            steps = len(words) // STEP + 2  # with an empty step, so that texts do not touch
            owner += [k] * steps
            first += steps
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        if not len(keys):
            return
        # Passage k is the steps k and k + 1 of a text.
        both = np.unique(np.concatenate([keys, *back]))
        passage, term = np.divmod(both, n_terms)
        edges = np.searchsorted(passage, np.arange(first + 1))
        opened = self.by_block.reached(passage, term, first)
        close = self.by_chunk.reached(passage, term, first,
                                      lambda who, chunk: opened[who, chunk // BLOCK])
        for where, chunk in np.argwhere(close):
            here = term[edges[where]:edges[where + 1]]
            item, terms, impacts, least = self.chunks[chunk]
            score = float(impacts[np.isin(terms, here, assume_unique=True)].sum())
            if score >= least:
                yield owner[where], item, score


def build(rows: list[tuple]) -> Index:
    """The index of (item_id, question, answer) rows."""
    index = Index([])
    chunks = []  # (item, words)
    for item_id, question, answer in rows:
        asked, told = words_of(question), words_of(answer)
        index.items.append(Item(item_id, shingles(asked), shingles(told)))
        both = asked + told
        parts = -(-len(both) // STEP)
        for k in range(parts):  # parts of nearly equal length
            part = both[k * len(both) // parts:(k + 1) * len(both) // parts]
            chunks.append((len(index.items) - 1, part))
    if not chunks:
        return index
    frequency: dict[bytes, int] = {}
    for _, words in chunks:
        for word in set(words):
            frequency[word] = frequency.get(word, 0) + 1
    index.terms = {word: k for k, word in enumerate(sorted(frequency))}
    mean = sum(len(words) for _, words in chunks) / len(chunks)

    def impacts(words: list[bytes]) -> dict[int, float]:
        scale = K1 * (1 - B + B * len(words) / mean)
        out = {}
        for word in set(words):
            times, n = words.count(word), frequency[word]
            rarity = np.log(1 + (len(chunks) - n + 0.5) / (n + 0.5))
            out[index.terms[word]] = rarity * times * (K1 + 1) / (times + scale)
        return out

    scored = [(item, impacts(words)) for item, words in chunks]
    # Chunks of similar scores share blocks, so that a short one does not open a block of long ones.
    scored.sort(key=lambda c: (sum(c[1].values()), c[0]))
    by_chunk, highest, needs = [], {}, []
    for k, (item, found) in enumerate(scored):
        order = sorted(found, key=lambda t: (found[t], t))
        impacts_of = np.array([found[t] for t in order])
        least = RETRIEVE * impacts_of.sum() * (1 - 1e-9)
        weak = int(np.searchsorted(np.cumsum(impacts_of), least / 2, side="right"))
        needs.append(least - impacts_of[:weak].sum())
        index.chunks.append((item, np.array(order), impacts_of, least))
        for t in order[weak:]:
            by_chunk.append((t, k, found[t]))
            highest[t, k // BLOCK] = max(found[t], highest.get((t, k // BLOCK), 0.0))
    by_block = [(t, block, most) for (t, block), most in highest.items()]
    opening = [min(needs[k:k + BLOCK]) for k in range(0, len(needs), BLOCK)]
    index.by_chunk = Lists.of(by_chunk, len(index.terms), needs)
    index.by_block = Lists.of(by_block, len(index.terms), opening)
    return index


def share(wanted: set, found: set) -> float:
    return len(wanted & found) / len(wanted) if wanted else 1.0


def leaks_of(index: Index, texts: list[str | None] | pa.Array) -> Iterator[tuple[int, int, float, float]]:
    """(text, item, score, coverage) of all verified items, in the order of texts and items."""
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at + len(part) < len(texts) and (not part or size < WORDS):
            text = texts[at + len(part)]
            part.append(words_of(text.as_py() if isinstance(text, pa.Scalar) else text))
            size += len(part[-1])
        best: dict[tuple[int, int], float] = {}
        for text, item, score in index.matches(part):
            best[text, item] = max(score, best.get((text, item), 0.0))
        own, own_of = set(), None
        for (text, item), score in sorted(best.items()):
            if text != own_of:
                own, own_of = shingles(part[text]), text
                pool = [index.items[i] for t, i in best if t == text]
                for length in {len(s) for i in pool for s in i.question | i.answer} - {SHINGLE}:
                    own |= set(zip(*(part[text][k:] for k in range(length)), strict=False))
            wanted = index.items[item]
            covered = min(share(wanted.question, own), share(wanted.answer, own))
            if covered >= COVERAGE:
                yield at + text, item, score, covered
        at += len(part)


def shards(items: DataFrame, item: str, question: str, answer: str | None) -> Iterator[Index]:
    """Indexes of at most `SHARD` chunks each, or of one longer item."""
    told = F.col(answer) if answer else F.lit(None).cast("string")
    rows = items.select(item, question, told.alias(free_name(items, "__answer"))).orderBy(item, question)
    held, chunks = [], 0
    for row in rows.toLocalIterator():
        size = -(-(len(words_of(row[1])) + len(words_of(row[2]))) // STEP)
        if held and chunks + size > SHARD:
            yield build(held)
            held, chunks = [], 0
        held.append(tuple(row))
        chunks += size
    if held:
        yield build(held)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
          item: str = "item_id", question: str = "text", answer: str | None = None) -> DataFrame:
    """One row per document and item found in it: score of the best passage, coverage."""
    spark = docs.sparkSession
    kinds = [docs.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()]
    item_type = to_arrow_type(items.schema[item].dataType)
    out = f"`{key}` {kinds[0]}, `{item}` {kinds[1]}, score double, coverage double"

    def matched(index: Index) -> DataFrame:
        shared = spark.sparkContext.broadcast(index)

        def match(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            for batch in batches:
                found = list(leaks_of(shared.value, batch[1]))
                where = pa.array([f[0] for f in found], pa.int64())
                ids = [shared.value.items[f[1]].item_id for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch[0].take(where), pa.array(ids, item_type),
                     pa.array([f[2] for f in found], pa.float64()),
                     pa.array([f[3] for f in found], pa.float64())],
                    [key, item, "score", "coverage"])

        return docs.select(key, text).mapInArrow(match, out)

    found = [matched(index) for index in shards(items, item, question, answer)]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], out)


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
               question: str = "text", answer: str | None = None) -> DataFrame:
    """The rows of `docs` that contain no item, with their columns."""
    def clean(index: Index) -> Column:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        @F.arrow_udf("boolean")
        def checked(texts: pa.Array) -> pa.Array:
            found = {f[0] for f in leaks_of(shared.value, texts)}
            return pa.array([k not in found for k in range(len(texts))], pa.bool_())

        return checked(F.col(text))

    return reduce(DataFrame.where, map(clean, shards(items, item, question, answer)), docs)
