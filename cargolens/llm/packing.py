"""Packing of examples into sequences of limited size by vector bin packing.

A sequence has limits on three things at once: tokens, segments and loss-bearing tokens. It is filled step
by step with the example whose needs, as shares of the limits, have the largest dot product
with what is left, among those that fit. `packed_examples` places examples whole;
`packed_documents` tokenizes texts and may cut them: full sequences are cut off first, the rests are
packed, and when no rest fits any more one is cut to the gap.

Every input partition is packed on its own, without a shuffle and in bounded memory: at most `POOL`
rests wait at a time. Only a partition's last sequences may stay short.

Null text counts as empty and gives the end id alone. Texts of any length are cut into pieces. Repeated
rows are packed each; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

LENGTH = 1024  # tokens of a sequence
SEGMENTS = 64  # pieces of a sequence
POOL = 4096  # rests that wait for a place, per task
END = 0  # the id that ends a document
KNOWN_WORDS = 500_000  # words whose ids a worker remembers
OTHER = re.compile("[\u0250-\U0010ffff]")  # characters beyond the Latin blocks
BLANKS = re.compile(r"\s\s")
CUT = re.compile(r" (?=\S)")  # a text may be cut before such a space
SLICE = 100_000  # characters whose ids are Python numbers at once


class Bins:
    """Fills sequences from a pool of waiting items by the dot-product rule."""

    def __init__(self, limits: tuple[int, int, int]):
        self.limits = np.array(limits, float)
        self.waiting = defaultdict(list)  # (tokens, loss) -> items
        self.count = 0

    def add(self, tokens: int, loss: int, item) -> None:
        self.waiting[tokens, loss].append(item)
        self.count += 1

    def take(self, needs):
        items = self.waiting[needs]
        item = items.pop()
        if not items:
            del self.waiting[needs]
        self.count -= 1
        return item

    def fill(self, cut=None) -> list:
        """The items of one sequence.

        `cut(tokens, loss, item, gap)` may split an item that is too long: it returns the
        first part and the rest as (tokens, loss, item).
        """
        room, chosen = self.limits.copy(), []
        kinds = np.ones((len(self.waiting), 3))
        kinds[:, ::2] = np.fromiter(chain.from_iterable(self.waiting), float,
                                    2 * len(self.waiting)).reshape(-1, 2)
        alive = np.ones(len(kinds), bool)
        names = list(self.waiting)
        shares = kinds / self.limits
        while self.count and room[0] > 0 and room[1] > 0:
            value = shares @ (room / self.limits)
            value[~(alive & (kinds <= room).all(1))] = -1.0
            best = int(value.argmax()) if len(value) else 0
            if not len(value) or value[best] < 0:
                break
            chosen.append(self.take(names[best]))
            alive[best] = names[best] in self.waiting
            room -= kinds[best]
        gap = int(min(room[0], room[2]))  # loss is at most tokens, so a part of this size fits
        if cut is not None and self.count and gap > 0 and room[1] > 0:
            # Everything that waits is longer than the gap: the longest one is cut.
            tokens, loss = max(self.waiting)
            item = self.take((tokens, loss))
            first, rest = cut(tokens, loss, item, gap)
            chosen.append(first[2])
            self.add(*rest)
        return chosen


# --- examples that stay whole -------------------------------------------

PLACED = ("example string, tokens bigint, loss_tokens bigint, sequence_id bigint, slot bigint, "
          "offset bigint")


def packed_examples(examples: DataFrame, key: str, tokens: str, loss: str,
                    limits: tuple[int, int, int] = (LENGTH, SEGMENTS, LENGTH)) -> DataFrame:
    """The place of every example: sequence, slot and offset in it.

    An example that exceeds a limit on its own, or whose figures are null or negative, gets no place: its sequence,
    slot and offset are null.
    """
    picked = examples.selectExpr(f"cast(`{key}` as string) as example",
                                 f"cast(`{tokens}` as bigint) as tokens",
                                 f"cast(`{loss}` as bigint) as loss_tokens")
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in
                        (f.split() for f in PLACED.split(", "))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bins, made = Bins(limits), 0
        first = TaskContext.get().partitionId() << 33

        def flush(least: int):
            nonlocal made
            rows = []
            while bins.count > least:
                offset = 0
                for slot, (name, t, n) in enumerate(bins.fill()):
                    rows.append((name, t, n, first + made, slot, offset))
                    offset += t
                made += 1
            return rows

        def batch_of(rows):
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                schema=schema)

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                name, t, n = row["example"], row["tokens"], row["loss_tokens"]
                if t is None or n is None or t < 0 or n < 0 or t > limits[0] or n > limits[2]:
                    rows.append((name, t, n, None, None, None))
                    continue
                bins.add(t, n, (name, t, n))
                if bins.count >= POOL:
                    rows += flush(POOL // 2)
            yield batch_of(rows)
        yield batch_of(flush(0))

    return picked.mapInArrow(place, PLACED)


# --- documents ----------------------------------------------------------


@cache
def tokenizer(path: str | None):
    """The tokenizer at `path`, by default the public byte-level one, and its fast twin.

    Both have the same vocabulary and merges. The twin is used for words of Latin letters, digits
    and signs, for which the two are tested to agree.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    from cargolens.llm.secret_scan import vocabulary

    reference = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
    return reference, vocabulary(None) if path is None else None


class Words(dict):
    """Ids of words that follow a space, learned on demand and forgotten together when too many."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = ids = self.encode(f" {word}")
        return ids


def slices(text: str) -> Iterable[str]:
    """The text in parts of little more than `SLICE` characters, where it may be cut so soon."""
    at = 0
    while len(text) - at > SLICE and (cut := CUT.search(text, at + SLICE)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    The tokenizer's pattern never joins what stands before a space with what follows it, if that is no white space: there
    a text may be cut. Texts of Latin letters go to the twin in long slices, which takes less time than to look up
    each word. Of other texts the words are looked up, if no two white space characters stand in a row. Added tokens such as
    `<|endoftext|>`, which have one id wherever they stand and which the twin does not know, are an
    exception: a text with one goes to the tokenizer whole.
    """

    def __init__(self, path: str | None):
        self.reference, self.twin = tokenizer(path)
        self.added = [t.content for t in self.reference.get_added_tokens_decoder().values()]
        self.after_space = Words(self.encode)

    def latin(self, text: str) -> bool:
        return self.twin is not None and (text.isascii() or not OTHER.search(text))

    def quick(self, text: str) -> bytes:
        return np.array(self.twin.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str, plain: bool = True) -> bytes:
        if plain and self.latin(text):
            return self.quick(text)
        return np.array(self.reference.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self.encode(text, plain=False)
        if self.latin(text):
            return b"".join(map(self.quick, slices(text)))
        if BLANKS.search(text) or text[:1].isspace() or text[-1:].isspace():
            return self.encode(text)
        first, *rest = text.split(" ")
        return b"".join([self.encode(first), *map(self.after_space.__getitem__, rest)])


@cache
def ids_of(path: str | None) -> Ids:
    """One per worker, so that words learned in one task serve the next."""
    return Ids(path)


PIECE = pa.schema([(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens",
                                             "sequence_id", "offset")])


def packed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     path: str | None = None, segments: int = SEGMENTS,
                     loss_limit: int = LENGTH) -> DataFrame:
    """Pieces of all documents and their places in sequences of `LENGTH` tokens.

    Every token of a document bears loss but its end id.
    """
    limits = (LENGTH, segments, loss_limit)
    out = ", ".join(f"{n} bigint" for n in PIECE.names)
    kind = docs.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        ids, bins, made = ids_of(path), Bins(limits), 0
        first = TaskContext.get().partitionId() << 33
        keys, rows = [], []
        key_type = None

        def place(items):
            nonlocal made
            offset = 0
            for name, start, total, data in items:
                keys.append(name)
                rows.append((start, len(data) // 4, zlib.crc32(data), total, first + made, offset))
                offset += len(data) // 4
            made += 1

        def wait(name, start, total, data):
            length = len(data) // 4
            bins.add(length, length - (start + length == total), (name, start, total, data))

        def cut(tokens, loss, item, gap):
            name, start, total, data = item
            first_part = (name, start, total, data[:4 * gap])
            rest = (name, start + gap, total, data[4 * gap:])
            left = tokens - gap
            return ((gap, gap, first_part),
                    (left, left - (rest[1] + left == total), rest))

        def batch_of():
            columns = list(zip(*rows, strict=True)) or [[]] * len(PIECE)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type),
                 *(pa.array(c, pa.int64()) for c in columns)], names=[key, *PIECE.names])
            keys.clear()
            rows.clear()
            return batch

        for batch in batches:
            key_type = batch.schema.types[0]
            for name, value in zip(batch[0].to_pylist(), batch[1], strict=True):
                data = ids(value.as_py() or "") + struct.pack("<I", END)
                total, start = len(data) // 4, 0
                while total - start >= LENGTH and loss_limit >= LENGTH:
                    place([(name, start, total, data[4 * start:4 * (start + LENGTH)])])
                    start += LENGTH
                while total - start > min(LENGTH, loss_limit):
                    wait(name, start, total, data[4 * start:4 * (start + loss_limit)])
                    start += loss_limit
                if start < total:
                    wait(name, start, total, data[4 * start:])
                if bins.count >= POOL:
                    while bins.count > POOL // 2:
                        place(bins.fill(cut))
            if rows:
                yield batch_of()
        while bins.count:
            place(bins.fill(cut))
        if rows:
            yield batch_of()

    return docs.select(key, text).mapInArrow(pack, f"`{key}` {kind}, {out}")
