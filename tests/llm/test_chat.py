"""Chat formatting: exact round trips, layouts by fingerprint, and the query against SQL."""
import json

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cargolens.llm import chat, entry

DATA = "/root/testdata/sf0.01"
TURNS = f"key bigint, turns {chat.TURNS}"


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{DATA}/conversations.parquet'")
    got = entry.op6_chat(spark, DATA)
    want = con.execute(f"select {', '.join(got.columns)} from ({entry.ORACLES['op6_chat']})")
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def trip(spark, conversations):
    df = spark.createDataFrame(list(enumerate(conversations)), TURNS)
    pieces = df.select("key", chat.segments(F.col("turns")).alias("pieces"))
    out = pieces.select("key", "pieces", chat.formatted(F.col("pieces")).alias("text"))
    out = out.select("key", "text", chat.read_back(F.col("text")).alias("back"), F.transform(
        F.filter("pieces", lambda p: p["loss"]), lambda p: chat.unescape(p["text"])).alias("loss"))
    return {r["key"]: r for r in out.collect()}


PIECES = st.lists(st.sampled_from([*"~n\n<>/[]aé", "INST", "[INST]", "[/INST]", "<s>", "</s>"]),
                  max_size=8).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(PIECES | st.sampled_from(["assistant", "user"]), PIECES),
                         max_size=4), min_size=20, max_size=60))
def test_round_trip(spark, conversations):
    found = trip(spark, conversations)
    for k, turns in enumerate(conversations):
        assert [tuple(t) for t in found[k]["back"]] == turns
        assert found[k]["loss"] == [t for r, t in turns if r == "assistant"]


def test_nulls_and_long_texts(spark):
    found = trip(spark, [[(None, None), ("assistant", None)], [("user", "~</s>" * 100_000)],
                         [("user", "same")] * 3000, []])
    assert [tuple(t) for t in found[0]["back"]] == [("", ""), ("assistant", "")]
    assert found[1]["back"][0]["text"] == "~</s>" * 100_000
    assert len(found[2]["back"]) == 3000
    assert found[3]["back"] == [] and found[3]["text"] == ""


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"content": None, "role": "x"}]},
     "messages", [("user", "a"), ("x", None)]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
     "share", [("user", "a"), ("assistant", "b")]),
    ({"example": {"messages": [{"author": "user", "body": "a"}]}}, "chosen", [("user", "a")]),
    ({"completion": "b", "prompt": "a"}, "prompt", [("user", "a"), ("assistant", "b")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction",
     [("system", "i"), ("user", ""), ("assistant", "o")]),
    ({"data": {"answer": "b", "question": "a: `x`, ARRAY<"}}, "question",
     [("user", "a: `x`, ARRAY<"), ("assistant", "b")]),
    ({"prompt": "a"}, "unknown", []), ({"data": {"question": "a"}, "answer": "b"}, "unknown", []),
    ([1, 2], "unknown", []), ("text", "unknown", []), ({}, "unknown", []),
]


def test_layouts(spark):
    rows = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(RECORDS)] + [(98, None), (99, "{oops")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "key int, record string, layout int")
    found = {r["key"]: r for r in chat.canonical(df, "record", layout="kind").collect()}
    for k, (_, layout, turns) in enumerate(RECORDS):
        assert found[k]["kind"] == layout, RECORDS[k]
        assert [tuple(t) for t in found[k]["turns"]] == turns
    assert found[98]["kind"] == found[99]["kind"] == "unknown"
    assert chat.chat_table(df, "key", "record").count() == len(rows)


@pytest.mark.parametrize("mapping", chat.MAPPINGS, ids=lambda m: m.name)
def test_every_mapping_reads_what_it_writes(spark, mapping):
    turns = ([(role, f"text {k}") for k, (_, role) in enumerate(mapping.fields)]
             or [("user", 'a "b"\n'), ("assistant", "c"), ("tool", "")])
    df = spark.createDataFrame([(1, turns)], TURNS).select("key", mapping.record(
        F.col("turns")).alias("record"))
    row = chat.canonical(df, "record").first()
    assert row["layout"] == mapping.name
    assert [tuple(t) for t in row["turns"]] == turns


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a"), (None, 0, None, None), (1, None, "user", "x"), (2, 0, "human", "h"),
            (2, 0, "human", "h"), (2, 1, "gpt", "g"), (3, 0, "user", "q"), (3, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    table = chat.chat_table(chat.gathered(df), "conv_id", "record")
    assert {r["conv_id"]: r["n_turns"] for r in chat.digests(table, "conv_id").collect()} == {
        None: 2, 1: 1, 2: 3, 3: 2}
    assert table.where("layout = 'unknown'").count() == 0
    empty = chat.chat_table(chat.gathered(df.where("false")), "conv_id", "record")
    assert chat.digests(empty, "conv_id").collect() == []


def test_long_texts_and_records(spark):
    """Beyond 20 million characters of a text, and 128 MB of a record."""
    sizes = {1: [20_100_000], 2: [5, 20_100_000], 3: [18_000_000] * 8, 4: [5, 5, 20_100_000]}
    roles = {2: ["user", "assistant"], 4: ["system", "user", "assistant"]}
    rows = [(c, k, roles.get(c, ["assistant"] * 8)[k], n) for c, of in sizes.items()
            for k, n in enumerate(of)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, n int").select(
        "conv_id", "turn", "role", F.expr("repeat('x', n)").alias("text"))
    table = chat.chat_table(chat.gathered(df), "conv_id", "record", strict=True)
    got = {r["conv_id"]: r for r in table.select("conv_id", "layout", F.transform(
        F.filter("pieces", lambda p: p["loss"]), lambda p: F.length(p["text"])).alias("n")).collect()}
    assert {k: r["n"] for k, r in got.items()} == {
        k: of[-1:] if k in roles else of for k, of in sizes.items()}
    assert "unknown" not in {r["layout"] for r in got.values()}


def test_large_records_are_read_like_small_ones(spark, monkeypatch):
    odd = [{"messages": [{"role": r"\" {}\\", "content": '{"a": 1}, {"a": 1}'}] * 3 + [
        {"role": "x", "content": "é\n\x01"}]}, {"messages": [{"{x},{x}": "a"}]}]
    texts = [json.dumps(r) for r, _, _ in RECORDS] + [json.dumps(r) for r in odd] + [
        "{oops", None, r'{"prompt":"\q","completion":"b"}', '{"prompt":"a\nb","completion":"b"}',
        '{"prompt":"a","completion":"b","prompt":"c"}', '{"prompt": null, "completion": "[1]"}']
    df = spark.createDataFrame(list(enumerate(texts)), "key int, record string")
    small = sorted(map(str, chat.canonical(df, "record").collect()))
    monkeypatch.setattr(chat, "WHOLE", 60)
    mixed = sorted(map(str, chat.canonical(df.where("length(record) > 60"), "record").collect()))
    assert mixed and set(mixed) <= set(small)
    monkeypatch.setattr(chat, "WHOLE", 0)
    monkeypatch.setattr(chat, "parsed", lambda r: F.try_parse_json(chat.outline(r)))
    assert sorted(map(str, chat.canonical(df, "record").collect())) == small


def test_own_records_must_be_known(spark):
    df = spark.createDataFrame([(1, '{"a": "b"}')], "key int, record string")
    with pytest.raises(Exception, match="none of the layouts"):
        chat.chat_table(df, "key", "record", strict=True).select("formatted").collect()
