"""Periodic runs against a search of every period at every place."""
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cargolens.llm import entry, periodic

DATA = "/root/testdata/sf0.001"


def brute(words):
    """(start, length, period) of all runs, straight from the definition."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            start = at
            while at + q < n and words[at] == words[at + q]:
                at += 1
            length = at - start + q
            if length >= max(12, 2 * q):
                run = words[start:start + length]
                if all(run[p:] != run[:-p] for p in range(1, q)):
                    found.append((start, length, q))
    return sorted(found)


def probe(key, words):
    h = zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(key, text):
    words = probe(key, periodic.words_of(text))
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    s, length, q = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    return (key, len(runs), s, length, q, runs and 1000 * length // q or None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256"]


def same(words):
    words = list(words)
    assert periodic.runs_of(np.array(words, np.int64)) == brute(words)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90))
def test_two_words(words):
    same(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 14)),
                max_size=7), st.integers(0, 6))
def test_powers_side_by_side(parts, again):
    """Runs within runs: blocks of repeated words, and the whole once more."""
    words = [w for block, times in parts for w in block * times]
    same((words + words[:again])[:240] * 2)


@pytest.mark.parametrize("m", [4, 9, 20, 45])
def test_repeats_that_touch(m):
    for block in ((0,), (0, 1), (0, 1, 2), (0, 0, 1)):
        for between in ((), (0,), (5,), (0, 1), (1, 0, 0)):
            same(block * m + between + block * m)
            same((block * m + between) * 3 + block)
            same(block * (m // 2) + between + block * m + (7,) + block * (m // 2) + between + block * m)


@pytest.mark.parametrize("period", [1, 2, 5, 11, 12, 13, 23, 24, 25, 96, 130])
def test_planted_periods(period):
    rng = np.random.default_rng(period)
    for extra in (0, 1, period // 2, period):
        block = rng.integers(0, 50, period)
        words = np.concatenate([rng.integers(0, 50, 40), np.resize(block, 2 * period + extra),
                                rng.integers(0, 50, 33)])
        same(words.tolist())


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    same(b)


def test_many_kinds_of_words():
    """Too many different words for one key per seed."""
    words = list(range(5000)) + list(range(3000, 5000)) + [4999, 7] * 9
    same(words)


def test_very_long_texts():
    """Work in proportion to the words, whatever they are."""
    assert periodic.runs_of(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    assert periodic.runs_of(np.arange(300_000) % 3) == [(0, 300_000, 3)]
    assert periodic.runs_of(np.arange(300_000) % 70_000) == [(0, 300_000, 70_000)]


def test_query(spark):
    """Every row of the small table; the planted periods reach into the longest texts."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = entry.op13_periodic(spark, DATA).collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(rows) == len(got) == len(docs)
    short = [d for d in docs if len(d["text"]) < 6000]
    assert len(short) > 150
    for d in short:
        assert got[d["doc_id"]] == expected(d["doc_id"], d["text"])
    assert sum(r["n_runs"] > 0 for r in rows) > 10


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a b " * 6), (5, "a b " * 6), (6, "a b " * 5 + "a"),
       (7, "é 中 x " * 12), (8, "a\xa0b " * 12), (9, "x\x00y z\x1c " * 12), (None, "a b " * 6),
       (33, "one two three four five six seven eight nine ten " * 3), (49, "w " * 5000)]


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, whole string, runs int, words string, a int"
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in ODD + [(k, "a b c d e f g" * 4) for k in range(100, 140)]],
                               schema)
    rows = periodic.digests(periodic.find(periodic.with_probes(df))).collect()
    want = [expected(r["doc_id"], r["text"]) for r in df.collect() if r["doc_id"] != 49]
    assert sorted([tuple(r[c] for c in COLUMNS) for r in rows if r["doc_id"] != 49], key=repr) == sorted(want, key=repr)
    assert [r["length"] for r in rows if r["doc_id"] == 49] == [5000]
    assert periodic.find(df.where("false")).collect() == []
    whole = {r["doc_id"]: r for r in periodic.find(df).collect() if r["doc_id"] not in (5, None)}
    assert (whole[2]["n_words"], whole[2]["runs"], whole[2]["collapsed"]) == (0, [], "")
    assert whole[7]["collapsed"] == "é 中 x"
    named = spark.createDataFrame([("k", "a b " * 9)], "name string, body string")
    assert periodic.find(named, "name", "body").first()["collapsed"] == "a b"
