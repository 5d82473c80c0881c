"""Ranked search against a full scoring of every document for every item."""
import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cargolens.llm import entry, ranked

DATA = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """(item, rank, doc, score), documents in the order of their rows."""
    read = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    read = [r for r in read if r[2]]
    n_docs, n_terms = len(read), sum(r[2] for r in read)
    df = Counter(t for _, counts, _ in read for t in counts)
    out = []
    for item, text in items:
        scores = []
        for at, (i, counts, n) in enumerate(read):
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * counts[t]) // (1000 * counts[t] + 8 * m))
                        for t, c in Counter(terms(text)).items() if counts[t])
            if score > 0:
                scores.append((-score, i is None, i, at))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0, s[3]))
        out += [(item, rank, i, -s) for rank, (s, _, i, _) in enumerate(scores[:k], 1)]
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (str(r[0]), r[1], str(r)))


def test_query_against_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    df = entry.op12_ranked_search(spark, DATA)
    want = con.execute(entry.ORACLES["op12_ranked_search"]).fetchall()
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert len(want) == 400
    assert in_order(df.collect()) == in_order(want)


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(1, 300))) + "Été_ß É1a A\x00b 中文-x İI"
    assert [t.decode() for t in ranked.terms_of(text.encode())] == terms(text)


WORDS = [f"w{n}" for n in range(40)]


def made(n):
    """Documents of skewed words, many of them copies of each other."""
    out = []
    for i in range(n):
        seed = i if i % 3 else 3
        words = [WORDS[(seed * j * j + j) % (1 + (seed + j) % 40)] for j in range(seed * 7 % 60)]
        out.append((i, " ".join(words)))
    return out


ITEMS = [(1, "w1 w2 W3 w3 w39"), (2, "w0"), (3, None), (4, ""), (5, "nothing here"), (2, "w0"), (None, "w7 w8"),
         (6, " ".join(WORDS)), (7, "w38 w39 w37 w36 w1 w1 w1")]
ODD = [(500, None), (501, ""), (502, "--- !"), (503, "w39 " * 3000), (503, "w39 " * 3000), (504, "w39"),
       (None, "w1 w2 w3 w39"), (505, "é w7É w8 中 w0"), (506, "w39,W38;w37")]


@pytest.mark.parametrize("halvings", [0, 3, 12])
def test_made_rows(spark, monkeypatch, halvings):
    monkeypatch.setattr(ranked, "HALVINGS", halvings)
    rows = made(300) + ODD
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id int, text string, term string, row int")
    items = spark.createDataFrame([(*r, "y") for r in ITEMS], "item_id int, text string, item string")
    got = ranked.search(df, items)
    assert in_order(got.collect()) == in_order(brute(rows, ITEMS))
    assert in_order(ranked.search(df, items, 3).collect()) == in_order(brute(rows, ITEMS, 3))


def test_shuffled_joins(spark, no_broadcast):
    rows = made(200)
    df, items = spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame(ITEMS, "item_id int, text string")
    assert in_order(ranked.search(df, items).collect()) == in_order(brute(rows, ITEMS))


def test_empty_tables(spark):
    df = spark.createDataFrame(made(20), "doc_id int, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert ranked.search(df.where("false"), items).collect() == []
    assert ranked.search(df, items.where("false")).collect() == []
    assert ranked.search(df, items.where("item_id = 5")).collect() == []


def test_bitmap_keeps_every_word(spark):
    df = spark.createDataFrame([(w,) for w in [*WORDS, "é", "中文"]], "term string")
    passing = ranked.Passing(ranked.bitmap_of(df))
    assert all(passing[w.encode()] for w in [*WORDS, "é", "中文"])
    assert sum(passing[f"other{n}".encode()] for n in range(2000)) < 5


def test_lists_are_not_read_to_the_end_when_all_is_clear(spark, monkeypatch):
    """Items whose best documents are clear ahead stop above the common words, which no reading opens."""
    stops = []
    whole = ranked.Reading.seen

    def watched(self, lists, *more):
        stops.append(lists.agg(F.min("stop")).first()[0])
        return whole(self, lists, *more)
    monkeypatch.setattr(ranked.Reading, "seen", watched)
    rows = [(i, f"a{i % 12} b{i % 12} common") for i in range(24)] + [(100 + i, f"common x{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    items = [(k, f"a{k} b{k}") for k in range(3)] + [(5, "common a7 b7")]
    got = ranked.search(df, spark.createDataFrame(items, "item_id int, text string"), 2)
    assert in_order(got.collect()) == in_order(brute(rows, items, 2))
    assert min(stops) > 0
