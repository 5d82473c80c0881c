"""WARC round trip: every page comes back as it was written."""
import hashlib

import duckdb
import pytest

from cargolens.llm import entry, warc
from cargolens.sources.workspace import fresh_path

DATA = "/root/testdata/sf0.01"
BIG = "<p>" + "same " * 400
PAGES = [(1, "http://a/ b\r\n", BIG), (2, "http://b/é", BIG), (3, None, BIG + "x"), (4, "u", None), (5, "u", ""),
         (6, "u", "short"), (7, "u", "short"), (None, "u", BIG), (2, "again", BIG),
         (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 90), (9, "u", "ü" * 500), (10, "u", "ü" * 500)]
SCHEMA = "page_id bigint, url string, html string, digest int, refers_to int"


def as_set(rows):
    return sorted(map(repr, rows))


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{DATA}/pages.parquet'")
    got = entry.op10_warc(spark, DATA)
    want = con.execute(f"select {', '.join(got.columns)} from ({entry.ORACLES['op10_warc']})")
    assert as_set(map(tuple, got.collect())) == as_set(want.fetchall())


@pytest.mark.parametrize("width", ["1", "50"])
def test_odd_pages(spark, width):
    """With one partition no digest is hot; with fifty every shared one is."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        df = spark.createDataFrame([(*p, 0, 0) for p in PAGES], SCHEMA)
        rows = warc.round_trip(df).drop("url").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = []
    for page_id, _, text in PAGES:
        data = (text or "").encode()
        same = [p for p, _, t in PAGES if (t or "").encode() == data and p is not None]
        again = len(data) >= 1000 and page_id != max(same)
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(),
                     "revisit" if again else "response", max(same) if again else None))
    assert as_set(map(tuple, rows)) == as_set(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert warc.round_trip(df).collect() == []


def test_selected_records(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    folder = fresh_path(spark, "warc")
    index = warc.write(warc.classified(pages), folder)
    some = index.where("page_id % 7 = 0")
    got = {r["page_id"] for r in warc.read(some, folder).collect()}
    assert got == {r["page_id"] for r in some.collect()}


def test_ranges_are_joined_across_small_gaps():
    assert warc.ranges([(100, 10), (0, 10), (15, 5), (500, 1)], gap=90) == [
        [(0, 10), (15, 5), (100, 10)], [(500, 1)]]
    assert warc.ranges([]) == []


def test_a_damaged_record_is_not_accepted():
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest())
    assert warc.described(data)["payload_bytes"] == 7
    with pytest.raises(ValueError):
        warc.described(data + data)
    with pytest.raises(ValueError):
        warc.described(warc.record(1, "u", b"payload", "0" * 40))
