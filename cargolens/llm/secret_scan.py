"""Secrets in texts: known shapes, and random strings found by token efficiency.

A tokenizer spends few tokens on words it has seen and many on random characters. A long run of
key characters that costs more than one token per `CHARS_PER_TOKEN` characters is random, unless it is
a digest of a known length or an identifier.

Null text counts as empty and has no spans. Texts are searched whole, whatever their length; repeated
rows give repeated results; an empty table gives an empty one. Only the text column is read, so
extra columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 2.0
TOGETHER = 100  # texts of an Arrow batch that are Python strings at once
KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
# Runs are taken whole, so asking for the least length at once finds the same ones.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

# May stand right after "=", as in NAME=value; "=" belongs to a run only as padding at its end.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
# MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hexadecimal digits.
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
# Words or numbers joined by separators: paths, names, dates.
NAME = re.compile(r"[+/_-]*(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)(?:[+/_-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*"
                  r"[0-9]{0,4}[+/_=-]*\Z")

RESULT = ("struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string>")


@cache
def vocabulary(path: str | None):
    """The tiktoken vocabulary at `path`, by default the public one with 50,256 ranks."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@lru_cache(maxsize=50_000)
def is_random(run: str, chars_per_token: float, path: str | None) -> bool:
    kinds = (any(map(str.isdigit, run)) + any(map(str.islower, run[1:]))
             + any(map(str.isupper, run[1:])))
    if kinds < 2 or UUID.match(run) or NAME.match(run):
        return False
    if len(run) in DIGEST_LENGTHS and DIGEST.match(run):
        return False
    return len(run) < chars_per_token * len(vocabulary(path).encode_ordinary(run))


def find(text: str, chars_per_token: float = CHARS_PER_TOKEN,
         path: str | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans in order; kind is a position in `KINDS`."""
    spans = []
    if ":" in text or "=" in text:
        lower = text.lower()
        if any(hint in lower for hint in ASSIGN_HINTS):
            spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                      if m.end(2) - m.start(2) >= 8]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    for m in CANDIDATE.finditer(text):
        if is_random(m.group(), chars_per_token, path):
            spans.append((m.start(), 3, m.end()))
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def listed(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by `mark`."""
    parts, done, open_to = [], 0, -1
    for start, _, end in spans:
        if start > open_to:
            parts += [text[done:start], mark]
        open_to = max(open_to, end - 1)
        done = max(done, end)
    return "".join(parts) + text[done:]


def scan(text: Column, chars_per_token: float = CHARS_PER_TOKEN,
         path: str | None = None) -> Column:
    """Counts of the known kinds, digest of their spans, and all spans of a text column."""

    @F.arrow_udf(RESULT)
    def scanned(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            spans = find(value.as_py() or "", chars_per_token, path)
            base = [s for s in spans if s[1] < 3]
            rows.append({f"n_{name}": sum(s[1] == k for s in base)
                         for k, name in enumerate(KINDS[:3])}
                        | {"base_sha256": hashlib.sha256(listed(base).encode()).hexdigest(),
                           "spans": listed(spans)})
        kinds = [(f"n_{name}", pa.int64()) for name in KINDS[:3]]
        return pa.array(rows, pa.struct([*kinds, ("base_sha256", pa.string()),
                                         ("spans", pa.string())]))

    return scanned(text)


def redacted(text: Column, chars_per_token: float = CHARS_PER_TOKEN,
             path: str | None = None) -> Column:
    """The text column with its secrets replaced; null stays null."""

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        done = [pa.array([], pa.string())]
        for at in range(0, len(texts), TOGETHER):
            values = texts.slice(at, TOGETHER).to_pylist()
            done.append(pa.array([None if v is None else redact(v, find(v, chars_per_token, path))
                                  for v in values], pa.string()))
        return pa.concat_arrays(done)

    return cleaned(text)


def scan_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts, digest of the known spans, all spans."""
    found = docs.select(F.col(key), scan(F.col(text)).alias("found"))
    return found.select(key, "found.*")
