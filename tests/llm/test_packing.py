"""Packing: every token in one piece, gapless sequences within their limits, little padding."""
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cargolens.llm import entry, packing

DATA = "/root/testdata/sf0.01"
TEXTS = [None, "", " ", "a", "a  b", " lead", "trail ", "a \n b\n\nc\td", "don't 's x's", "<|endoftext|> x",
         "naïve ß İ ſ", "中文 字 और हिन्दी", " wide space \x85 \x1c end", "word " * 9000, "é" * 5000,
         "‍ ﻿ a", "x" * 70_000]


def reference_ids(text):
    reference, _ = packing.tokenizer(None)
    return reference.encode(text or "", add_special_tokens=False).ids


def check(docs, rows):
    """`docs`: id -> text, unique. The padding share of all sequences."""
    whole = {k: np.array([*reference_ids(t), 0], "<u4") for k, t in docs.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = whole[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["length"] >= 1
        part = ids[r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, ids in whole.items():
        at = 0
        for start, length in sorted(pieces[k]):
            assert start == at
            at += length
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and len(parts) <= packing.SEGMENTS
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding / sum(map(len, whole.values()))


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in
            spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert check(docs, entry.op4_packing(spark, DATA).collect()) < 0.005


def test_odd_texts(spark):
    schema = "doc_id bigint, text string, start string, offset int"
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], schema)
    check(dict(enumerate(TEXTS)), packing.packed_documents(df).collect())
    assert packing.packed_documents(df.where("false")).collect() == []
    twice = packing.packed_documents(df.union(df).coalesce(1))
    assert twice.selectExpr("sum(length)").first()[0] == 2 * sum(
        len(reference_ids(t)) + 1 for t in TEXTS)


def test_text_keys_and_tight_limits(spark):
    df = spark.createDataFrame([(f"k{i}", "word " * i) for i in range(300)] + [(None, None)],
                               "name string, text string")
    rows = packing.packed_documents(df, "name", "text", segments=3, loss_limit=100).collect()
    loss, segments = defaultdict(int), defaultdict(int)
    for r in rows:
        ends = r["start"] + r["length"] == r["doc_tokens"]
        loss[r["sequence_id"]] += r["length"] - ends
        segments[r["sequence_id"]] += 1
    assert max(loss.values()) <= 100 and max(segments.values()) <= 3
    assert sum(r["length"] for r in rows) == sum(len(reference_ids("word " * i)) + 1
                                                 for i in range(300)) + 1


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'sé1 \n\t 　.中́")))
def test_ids_are_those_of_the_whole_text(text):
    ids = np.frombuffer(packing.ids_of(None)(text), "<u4").tolist()
    assert ids == reference_ids(text)


def test_twin_agrees_on_the_given_texts(spark):
    ids = packing.ids_of(None)
    for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(300).collect():
        assert np.frombuffer(ids(r["text"]), "<u4").tolist() == reference_ids(r["text"])


def test_packed_examples(spark):
    rows = [(f"e{i}", 1 + i * 37 % 700, i * 13 % 300) for i in range(2000)]
    odd = [("long", 2000, 1), ("loss", 10, 5000), ("none", None, 1), ("neg", -1, 0), (None, 5, 5)]
    df = spark.createDataFrame([(*r, 0) for r in rows + odd],
                               "example string, tokens long, loss long, slot long")
    limits = (1024, 8, 512)
    placed = packing.packed_examples(df, "example", "tokens", "loss", limits).collect()
    assert len(placed) == len(rows) + len(odd)
    assert {r["example"] for r in placed if r["sequence_id"] is None} == {
        "long", "loss", "none", "neg"}
    bins = defaultdict(list)
    for r in placed:
        if r["sequence_id"] is not None:
            bins[r["sequence_id"]].append(r)
    for items in bins.values():
        items.sort(key=lambda r: r["slot"])
        assert [r["offset"] for r in items] == [sum(x["tokens"] for x in items[:k])
                                                for k in range(len(items))]
        assert sum(r["tokens"] for r in items) <= 1024 and len(items) <= 8
        assert sum(r["loss_tokens"] for r in items) <= 512
    need = max(sum(r[1] for r in rows) / 1024, len(rows) / 8, sum(r[2] for r in rows) / 512)
    assert len(bins) <= 1.15 * need + 8


def test_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["<|endoftext|> x", "a <|endoftext|> x", "a<|endoftext|><|endoftext|>", "<|endoftext|>  é",
             "no <|ENDOFTEXT|> and <|endoftext |>", "word " * 2000 + "中<|endoftext|>"]
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packing.ids_of(None)(text), "<u4").tolist() == want
    assert plain.encode(texts[0], add_special_tokens=False).ids == [50256, 2124]
    df = spark.createDataFrame([(1, texts[0])], "doc_id bigint, text string")
    row = packing.packed_documents(df).first()
    assert (row["doc_tokens"], row["ids_crc32"]) == (
        3, zlib.crc32(np.array([50256, 2124, packing.END], "<u4").tobytes()))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab's\xe9\x1c\x85 \n\t1.")))
def test_slices_have_the_ids_of_the_whole_text(text):
    size, packing.SLICE = packing.SLICE, 2
    try:
        assert "".join(packing.slices(text)) == text
        assert np.frombuffer(packing.ids_of(None)(text), "<u4").tolist() == reference_ids(text)
    finally:
        packing.SLICE = size


def test_latin_texts_take_few_calls(monkeypatch):
    """A call of a tokenizer for each slice, not for each word, and no slice much longer than `SLICE`."""
    ids, lengths = packing.Ids(None), []

    class Twin:
        def encode_ordinary(self, text, twin=ids.twin):
            lengths.append(len(text))
            return twin.encode_ordinary(text)

    monkeypatch.setattr(ids, "twin", Twin())
    for end in ("", "  \n\n end"):
        lengths.clear()
        text = " ".join(f"w\xf6rd{i}" for i in range(50_000)) + end
        assert np.frombuffer(ids(text), "<u4").tolist() == reference_ids(text)
        assert sum(lengths) == len(text)
        assert len(lengths) <= len(text) / 100_000 + 1 and max(lengths) <= 100_020
    assert not ids.after_space
