"""Grouping packing: exact pieces, gapless sequences, few of them."""
import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cargolens.llm import entry, grouping

DATA = "/root/testdata/sf0.01"
TEXTS = [None, "", " ", "a", "a  b", "don't 's x's", "<|endoftext|> x", "naïve ß İ ſ", "中文 字 और हिन्दी",
         "word " * 9000, "é" * 5000, "x" * 70_000, "word " * 2046 + "word", "word " * 2047 + "word",
         "word " * 4094 + "word", "word " * 4095 + "word"]


PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check(docs, rows, length=2048):
    """`docs`: id -> text. The sequences beyond the bound of tokens, and those of pieces that must be."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert set(pieces) == set(docs)
    total = 0
    for key, text in docs.items():
        ids, at = ids_of(text), 0
        total += len(ids)
        own = sorted(pieces[key])
        assert [p[0] for p in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // length)
        for number, start, size, crc in own:
            assert start == at and 0 < size <= length and (number == 0 or size == length)
            assert zlib.crc32(ids[start:start + size].tobytes()) == crc
            at += size
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    sizes = np.array([p[2] for own in pieces.values() for p in own])
    return len(sequences) - -(-total // length), len(sequences) - grouping.least_bins(sizes, length)


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = entry.op11_best_fit(spark, DATA).collect()
    beyond, _ = check(docs, rows)
    assert beyond <= 1


def test_blocks_and_levels(spark, monkeypatch):
    monkeypatch.setattr(grouping, "BLOCK", 60)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .repartition(3).collect()}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    beyond, _ = check(docs, grouping.pack(df).collect())
    assert beyond <= 3


def test_odd_texts(spark):
    schema = "doc_id bigint, text string, piece string, number int, length string, block int"
    df = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in enumerate(TEXTS)], schema)
    check(dict(enumerate(TEXTS)), grouping.pack(df).collect())
    assert grouping.pack(df.where("false")).collect() == []
    full = df.where("doc_id = 13")
    assert [(r["piece"], r["length"]) for r in grouping.pack(full).collect()] in ([(0, 2048)], [(0, 1), (1, 2048)])
    twice = grouping.pack(df.union(df)).selectExpr("sum(length)").first()[0]
    assert twice == 2 * sum(len(ids_of(t)) for t in TEXTS)
    named = spark.createDataFrame([("k", "word " * 30), (None, "a")] * 2, "name string, body string")
    rows = grouping.pack(named, "name", "body", length=8).collect()
    assert sum(r["length"] for r in rows) == 2 * (len(ids_of("word " * 30)) + 2)


def optimum(sizes, length):
    """The fewest bins, by search over all ways to place pieces in falling length."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(k, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if k == len(sizes):
            best = len(fills)
            return
        for b in range(len(fills)):
            if fills[b] + sizes[k] <= length and fills[b] not in fills[:b]:
                place(k + 1, fills[:b] + [fills[b] + sizes[k]] + fills[b + 1:])
        place(k + 1, fills + [sizes[k]])
    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=11), st.integers(0, 5))
def test_bounds_and_small_optima(sizes, seed):
    fewest = optimum(sizes, 20)
    sizes = np.array(sizes)
    best, bound = grouping.evolved(sizes, 20, np.random.default_rng(seed))
    assert bound <= fewest <= len(best.bins) <= fewest + (fewest > 3)
    assert sorted(itertools.chain.from_iterable(best.bins)) == list(range(len(sizes)))
    assert best.fills == [sizes[b].sum() for b in best.bins] and max(best.fills) <= 20


def test_evolution_beats_best_fit():
    """Triples that fill a bin exactly, where best fit wastes some of them."""
    random = np.random.default_rng(5)
    first, second = random.integers(500, 800, 300), random.integers(500, 700, 300)
    sizes = np.concatenate([first, second, 2048 - first - second])
    start = grouping.best_fit(np.argsort(-sizes).tolist(), sizes.tolist(), 2048, [], [])
    best, bound = grouping.evolved(sizes, 2048, random, generations=300)
    assert bound == 300 and len(best.bins) < len(start.bins)


def test_migrants_are_taken_over():
    sizes = np.array([5, 5, 6, 4, 7, 3, 8, 2] * 10)
    perfect = [[8 * k + j, 8 * k + j + 1] for k in range(10) for j in range(0, 8, 2)]
    best, bound = grouping.evolved(sizes, 10, np.random.default_rng(1), [[[k] for k in range(80)], perfect], 0)
    assert len(best.bins) == bound == 40


@pytest.mark.parametrize("blocks", [1, 2, 7])
def test_dealing_is_even(spark, blocks):
    pieces = spark.range(5000).selectExpr("id as number", "cast(1 + id % 13 * (id % 3) as int) as length")
    rows = grouping.dealt(pieces.repartition(4), blocks, 64).groupBy("block", "length").count().collect()
    assert sum(r["count"] for r in rows) == 5000
    by_length = defaultdict(list)
    for r in rows:
        by_length[r["length"]].append(r["count"])
    assert all(max(c) - min(c) <= 4 for c in by_length.values())
