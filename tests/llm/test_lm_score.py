"""Context-tree weighting and unigram scores against plain versions on small texts."""
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cargolens.llm import entry, lm_score

DATA = "/root/testdata/sf0.001"


def plain_unigram(docs, held):
    tokens = {k: [*lm_score.lowered(t).split(), None] for k, t in docs}
    count = Counter(w for k, words in tokens.items() if not held[k] for w in words)
    n, v = sum(count.values()), len(count)
    return {k: (len(words), sum(count[w] > 0 for w in words), n,
                sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
            for k, words in tokens.items()}


def plain_tree(docs, held):
    """log10 probability of every text, node by node in plain Python."""
    depth = lm_score.DEPTH
    counts = defaultdict(lambda: [0, 0])

    def path(data, i):
        byte = data[i]
        for b in range(8):
            place, bit = (1 << b) | (byte >> (8 - b)), (byte >> (7 - b)) & 1
            yield [(data[i - d:i], place) for d in range(depth + 1)], bit

    padded = {k: b"\xff" * depth + lm_score.lowered(t) + b"\xff" for k, t in docs}
    for k, data in padded.items():
        if not held[k]:
            for i in range(depth, len(data)):
                for nodes, bit in path(data, i):
                    for node in nodes:
                        counts[node][bit] += 1
    own = {n: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1)
           - math.log(math.pi) for n, (a, b) in counts.items()}
    below, weighted = defaultdict(float), {}
    for node in sorted(own, key=lambda n: -len(n[0])):
        context, place = node
        weighted[node] = (own[node] if len(context) == depth else
                          np.logaddexp(own[node], below[node]) - math.log(2))
        if context:
            below[context[1:], place] += weighted[node]

    def chance(nodes, bit):
        value = None
        for node in reversed(nodes):
            zeros, ones = counts.get(node, (0, 0))
            if zeros + ones == 0 and node[0]:
                continue
            estimate = ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
            if value is None:
                value = estimate
            else:
                stop = math.exp(own[node] - weighted[node]) / 2
                value = stop * estimate + (1 - stop) * value
        return value

    return {k: sum(math.log10(chance(nodes, bit)) for i in range(depth, len(data))
                   for nodes, bit in path(data, i)) for k, data in padded.items()}


def check(rows, docs, held):
    unigram, tree = plain_unigram(docs, held), plain_tree(docs, held)
    assert len(rows) == len(docs)
    for r in rows:
        k = r["doc_id"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == unigram[k][:3]
        assert r["base_score"] == pytest.approx(unigram[k][3], rel=1e-9)
        assert r["score"] == pytest.approx(tree[k], rel=1e-6, abs=2e-6)


@pytest.mark.parametrize("group", [24_000_000, 40])
def test_small_texts(spark, monkeypatch, group):
    """In one group, and in groups so small that words and strings are spread over many."""
    monkeypatch.setattr(lm_score, "GROUP", group)
    texts = ["The cat sat on the mat. The cat sat.", "the dog sat on THE log", "unseen words ünd ß", None, "",
             "  \n", "mat " * 30, "The cat sat on the mat. The cat sat.", "日本 語"]
    held = {k: k in (2, 3, 8) for k in range(len(texts))}
    df = spark.createDataFrame([(k, t, held[k], 1.5) for k, t in enumerate(texts)],
                               "doc_id int, text string, held boolean, score double")
    rows = lm_score.score(df.repartition(2), df["held"]).collect()
    check(rows, list(enumerate(texts)), held)


def test_untrained_and_empty(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in lm_score.score(df, df["doc_id"] > 0).collect()}
    assert rows[1]["score"] == pytest.approx(-3 * 8 * math.log10(2), abs=1e-5)
    assert rows[2]["n_tokens"] == 1 and rows[2]["train_tokens"] == 0
    assert lm_score.score(df.where("false"), df["doc_id"] > 0).collect() == []


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet")
            .select("doc_id", "text").collect()]
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in docs}
    rows = entry.op9_lm_score(spark, DATA).collect()
    unigram = plain_unigram(docs, held)
    assert {r["doc_id"]: r["held_out"] for r in rows} == held
    for r in rows:
        assert tuple(r)[2:5] == unigram[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(unigram[r["doc_id"]][3], rel=1e-9)


def test_held_out_code_length(spark):
    """The tree codes held-out text better than the unigram words do."""
    rows = [r for r in entry.op9_lm_score(spark, "/root/testdata/sf0.1").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_a_decision_has_probability_one_in_total():
    keys = lm_score.byte_strings([b"abracadabra", b"abba"])[0]
    keys, n = np.unique(keys, return_counts=True)
    context = np.uint64(int(keys[0]) & ~255)
    every = np.union1d(keys, context | np.arange(256, dtype=np.uint64))
    counts = np.zeros(len(every))
    counts[np.searchsorted(every, keys)] = n
    nodes = lm_score.levels(every, counts, 1)[1].nodes.astype(np.int64)
    level = lm_score.levels(every, counts, 1)
    import pandas as pd
    top = lm_score.Top(pd.DataFrame({
        "last": nodes >> 8 & 255, "place": nodes & 255, "n0": level[1].n0, "n1": level[1].n1,
        "below": np.bincount(np.searchsorted(level[1].nodes, level[2].nodes & np.uint64(0xFFFF)),
                             level[2].log_weighted, len(nodes))}))
    logs = lm_score.log10_of(every, counts, top)
    inside = (every & ~np.uint64(255)) == context
    assert (10 ** logs[inside]).sum() == pytest.approx(1.0)
