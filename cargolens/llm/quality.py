"""Quality rules: fixed rules on word counts, then a trained classifier.

The classifier is a logistic regression on hashed word 1- and 2-grams and character 3- and 4-grams, as
shares of a text's n-grams. It is fitted on a bounded, class-balanced sample of labelled rows, its
margins are calibrated by Platt's method on rows kept out of the fit, the calibrated odds are corrected for
the classes' true proportions, and a text is kept when the probability of good quality reaches
`THRESHOLD`. Scoring runs in Arrow batches.

Null text has no words and fails the rules. Whole texts are counted and scored. Without labels of both
classes there is no classifier and the rules decide alone. Repeated rows get equal results; an empty
table gives an empty one. Only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import SPACES, free_name, utf8

SAMPLE_PER_CLASS = 500  # labelled rows of each class the classifier is fitted on, at most
SAMPLE_CHARS = 20_000  # texts beyond this length are not taken into that sample
THRESHOLD = 0.1  # least probability of good quality: a text goes when junk is nine times as likely
BITS = 18  # n-gram features are hashed into 2^BITS weights
CHUNK = 500_000  # characters scored at a time
TOGETHER = 500  # texts of an Arrow batch that are Python strings at once

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


# --- counts -------------------------------------------------------------


def repeated_words(words: list[bytes]) -> int:
    """Words in five-word windows that occur twice or more in the text."""
    if len(words) <= WINDOW:
        return 0
    number = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    n = len(words) - WINDOW + 1
    hashed = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        hashed = hashed * BASE + ids[k:k + n] * MIX + np.uint64(k + 1)
    order = np.sort(hashed)
    if not (order[1:] == order[:-1]).any():
        return 0
    # Some hash repeats: count the windows themselves, so that a collision cannot matter.
    windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    times = Counter(windows)
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(np.fromiter((times[w] > 1 for w in windows), bool, n))
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + WINDOW, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = data.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    worded = [line for line in lines if line.translate(None, SPACES)]
    return len(worded) - len(set(worded))


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = utf8(text)
    # Of bytes, split() and translate() know exactly the six white space characters.
    words = data.split()
    blanks = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - blanks, symbols, repeated_lines(data), repeated_words(words)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


# --- features -----------------------------------------------------------


@cache
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2^bits powers of an odd base modulo 2^64, and of its inverse."""
    base = int(BASE) | 1
    both = (base, pow(base, -1, 1 << 64))
    return tuple(np.multiply.accumulate(np.concatenate(
        [np.ones(1, np.uint64), np.full((1 << bits) - 1, b, np.uint64)])) for b in both)


def slots(hashed: np.ndarray, order: int) -> np.ndarray:
    salted = hashed ^ np.uint64(order * 0x1000193)
    salted = (salted ^ (salted >> np.uint64(31))) * MIX
    return ((salted ^ (salted >> np.uint64(29))) * BASE >> np.uint64(64 - BITS)).astype(np.int32)


def features(texts: list[str]):
    """Feature slots of some texts together.

    Returns (slots, texts they belong to) of all n-grams, once for characters and once
    for words.
    """
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    chars = [(np.zeros(0, np.int32), np.zeros(0, np.int32))]
    codes = data.astype(np.uint64)
    for n in (3, 4):
        if len(codes) < n:
            continue
        m = len(codes) - n + 1
        hashed = codes[:m].copy()
        for k in range(1, n):
            hashed *= BASE
            hashed += codes[k:k + m]
        inside = owner[:m] == owner[n - 1:]
        chars.append((slots(hashed[inside], n), owner[:m][inside]))

    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.ones(len(data) + 1, bool)  # a position where another text begins
    edge[1:-1] = owner[1:] != owner[:-1]
    starts = np.flatnonzero(~blank & (np.concatenate([[True], blank[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(~blank & (np.concatenate([blank[1:], [True]]) | edge[1:])) + 1
    up, down = powers(max(20, int(len(data) + 1).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64),
                           np.cumsum((codes + np.uint64(1)) * up[:len(codes)], dtype=np.uint64)])
    words = (sums[ends] - sums[starts]) * down[starts]
    whose = owner[starts]
    pairs = whose[1:] == whose[:-1]
    two = (words[:-1] * BASE + words[1:])[pairs]
    return ([np.concatenate(x) for x in zip(*chars, strict=True)],
            [np.concatenate([slots(words, 1), slots(two, 2)]),
             np.concatenate([whose, whose[1:][pairs]])])


@dataclass
class Model:
    """Weights, bias, and the calibration that turns a margin into log odds."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for slot, owner in features(texts):
            total = np.bincount(owner, minlength=len(texts))
            out += (np.bincount(owner, self.weights[slot], len(texts)) / np.maximum(total, 1))
        return out

    def probabilities(self, texts: list[str]) -> np.ndarray:
        out, at = [], 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= CHUNK:
                size += len(texts[end])
                end += 1
            out.append(self.slope * self.margins(texts[at:end]) + self.shift)
            at = end
        odds = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


# --- training -----------------------------------------------------------


def platt(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds of `good`, fitted with Platt's smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)])
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -500, 500)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        theta = theta - np.linalg.solve(hessian, x @ (p - target))
    return float(theta[0]), float(theta[1])


def fit(texts: list[str], good: list[bool], prior: float, rounds: int = 60) -> Model | None:
    """The calibrated model of a sample; `prior` is the true share of good rows."""
    good = np.array(good, bool)
    held = np.arange(len(texts)) % 5 == 0
    if any(len(set(good[part].tolist())) < 2 for part in (held, ~held)):
        return None
    train = np.flatnonzero(~held)
    columns, values, lengths = [], [], []
    for part in (features([texts[i]]) for i in train):
        length = 0
        for slot, _ in part:
            unique, times = np.unique(slot, return_counts=True)
            columns.append(unique)
            values.append((times / max(1, times.sum())).astype(np.float32))
            length += len(unique)
        lengths.append(length)
    columns, values = np.concatenate(columns), np.concatenate(values)
    rows = np.repeat(np.arange(len(train), dtype=np.int32), lengths)
    y = good[train].astype(float)
    # Frequent and rare slots get steps of their own size (Adagrad).
    weights, bias = np.zeros(1 << BITS), 0.0
    seen, seen_bias = np.full(1 << BITS, 1e-12), 1e-12
    for _ in range(rounds):
        margin = np.bincount(rows, weights[columns] * values, len(train)) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y) / len(train)
        gradient = np.bincount(columns, values * error[rows], 1 << BITS) + 1e-8 * weights
        seen += gradient ** 2
        seen_bias += error.sum() ** 2
        weights -= 2.0 * gradient / np.sqrt(seen)
        bias -= 0.1 * error.sum() / np.sqrt(seen_bias)
    model = Model(weights.astype(np.float32), float(bias))
    model.slope, shift = platt(model.margins([texts[i] for i in np.flatnonzero(held)]), good[held])
    balance = good.mean()
    model.shift = shift + np.log(prior / (1 - prior)) - np.log(balance / (1 - balance))
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """Fit on at most `per_class` labelled rows of each class, those of the smallest key hashes
    among the rows of at most `SAMPLE_CHARS` characters.

    What the driver gets is that sample, bounded in rows and characters. The proportions of the classes
    are counted over all labels.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(key, F.col(label).alias("__label"))
    sizes = {r["__label"]: r["n"] for r in
             known.groupBy("__label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    short = (docs.where(F.char_length(text) <= SAMPLE_CHARS)
             .select(key, F.col(text).alias("__text")))
    picked = []
    for value in (0, 1):
        # Long texts are left out first, so that others of the class take their places.
        chosen = (known.where(F.col("__label") == value).select(key).distinct()
                  .join(short.select(key), key, "left_semi").orderBy(F.xxhash64(key), key).limit(per_class))
        found = (short.join(F.broadcast(chosen), key).groupBy(key)
                 .agg(F.min("__text").alias("__text")).orderBy(key).toArrow())
        picked += [(k, t, value == 1) for k, t in
                   zip(found[key].to_pylist(), found["__text"].to_pylist(), strict=True)]
    picked.sort(key=lambda row: (str(row[0]), row[2]))
    prior = sizes[1] / (sizes[0] + sizes[1])
    return fit([t for _, t, _ in picked], [g for _, _, g in picked], prior)


# --- scoring ------------------------------------------------------------

RESULT = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
          "n_repeat_words:bigint,base_failed:boolean,kept:boolean,probability:double>")
ARROW = pa.struct([*((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                               "n_repeat_words")),
                   ("base_failed", pa.bool_()), ("kept", pa.bool_()),
                   ("probability", pa.float64())])


def judge(docs: DataFrame, text: Column, model: Model | None,
          threshold: float = THRESHOLD) -> Column:
    """The counts and the verdict on a text column of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 1 MB: 2^BITS weights

    @F.arrow_udf(RESULT)
    def judged(batch: pa.Array) -> pa.Array:
        figures, good = [], np.ones(len(batch))
        for at in range(0, len(batch), TOGETHER):
            texts = [v or "" for v in batch.slice(at, TOGETHER).to_pylist()]
            figures += [counts(t) for t in texts]
            if shared.value:
                good[at:at + TOGETHER] = shared.value.probabilities(texts)
        failed = [base_failed(f[0], f[4]) for f in figures]
        columns = [pa.array([f[k] for f in figures], pa.int64()) for k in range(5)]
        kept = ~np.array(failed, bool) & (good >= threshold)
        return pa.StructArray.from_arrays(
            [*columns, pa.array(failed, pa.bool_()), pa.array(kept), pa.array(good)],
            fields=list(ARROW))

    return judged(text)


def judge_table(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """One row per document: counts, verdict of the rules, verdict of all, probability."""
    model = train(docs, labels, key, text)
    judged = docs.select(key, judge(docs, F.col(text), model).alias("judged"))
    return judged.select(key, "judged.*")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows of `docs` that are kept, with their columns."""
    model = train(docs, labels, key, text)
    name = free_name(docs, "__judged")
    judged = docs.withColumn(name, judge(docs, F.col(text), model))
    return judged.where(F.col(name)["kept"]).drop(name)
