"""Quality rules against a plain version of their definitions."""
import re

import pytest

from cargolens.llm import entry, quality

DATA = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, kept string, n_words string"
TEXTS = [None, "", " \n\t ", "a b c", "a b c d e f a b c d e", "x " * 500, "line\nline\n\nline \nline",
         "  \x85 a b \x1c c", "# * $ % & | < >" * 3, "ab " * 30_000,
         "one two three four five six seven eight nine ten eleven", "é" * 70_000]


def plain(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    earlier, again = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            again += line in earlier
            earlier.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    n = len(words)
    return (n, sum(map(len, words)), symbols, again, len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_counts_of_odd_texts():
    for text in TEXTS:
        got = quality.counts(text or "")
        assert (*got, quality.base_failed(got[0], got[4])) == plain(text), (text or "")[:40]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in
            spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = entry.op1_quality_rules(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:7] == plain(docs[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_held_out_accuracy(spark):
    """Labelled rows that the sample leaves out are judged as labelled."""
    data = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    even = labels.where("doc_id % 2 = 0")
    judged = quality.judge_table(docs, even, "doc_id", "text")
    rows = judged.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    kept_good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    kept_bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(kept_good) >= 0.995 * len(kept_good)
    assert sum(kept_bad) <= 0.05 * len(kept_bad)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in enumerate(TEXTS)] * 2
                                 + [(None, "a b", None, None)], DOCS)
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id bigint, quality int")
    rows = quality.judge_table(docs, labels).collect()
    assert len(rows) == 2 * len(TEXTS) + 1
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["kept"]}
    assert quality.judge_table(docs.where("false"), labels).collect() == []
    assert quality.judge_table(docs, labels.where("false")).count() == len(rows)


@pytest.mark.parametrize("good", [[True] * 20, [False] * 20])
def test_one_class_gives_no_model(good):
    assert quality.fit(["a b"] * 20, good, 0.5) is None


def test_long_rows_do_not_shrink_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_CHARS", 20)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda texts, good, prior: seen.append((texts, good)))
    docs = spark.createDataFrame([(k, f"text {k}" + " long" * 10 * (k % 4 != 0)) for k in range(80)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k // 4 % 2) for k in range(80)], "doc_id bigint, quality int")
    quality.train(docs, labels, per_class=10)
    (texts, good), = seen
    assert len(texts) == 20 and sum(good) == 10 and max(map(len, texts)) <= 20
