"""Secret scan: fixed patterns and a token-efficiency test.

Three patterns give the base spans. The method adds spans of kind ``random``: strings
of key-like characters for which a byte-pair vocabulary needs so many tokens that only
few characters fall to each. Words and identifiers made of words take few tokens.
Strings of known shape are left out before the test: digests in hexadecimal, UUIDs,
plain numbers, and identifiers whose parts between separators are short plain words. Long
runs of letters of one case count as words only if they pass the test themselves, and a
long part between separators is tested alone where the whole string passes.

Strings and parts of under ``LEAST`` characters are not tested: of random letters so short,
many need no more tokens than a word does.

Spans are in code points, end exclusive. Defined results: a null or empty text has no
spans; rows with null or repeated ids keep their own result; other columns stay.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, functions as F, types as T

KINDS = ("assign", "access", "hex", "random")
SPANS = "array<struct<kind:string,start:int,end:int>>"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

LEAST = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
PART = re.compile(rf"[A-Za-z0-9]{{{LEAST},}}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})  # MD5, SHA-1 and the SHA-2 family
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
PLAIN_PART = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]*)\Z")
SEPARATORS = re.compile(r"[+/_=-]+")


class SecretScanner:
    """Finds spans in one text after another; one per Python worker."""

    def __init__(self, vocabulary: str, most_chars_per_token: float) -> None:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(
            "secrets",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        ).encode_ordinary
        self.most_chars_per_token = most_chars_per_token

    @staticmethod
    def digest_like(value: str) -> bool:
        """A digest, a UUID or a number."""
        return (
            (len(value) in DIGEST_LENGTHS and DIGEST.match(value) is not None)
            or UUID.match(value) is not None
            or value.isdecimal()
        )

    @staticmethod
    def identifier(value: str) -> bool:
        """Plain words and numbers between separators."""
        return all(PLAIN_PART.match(x) for x in SEPARATORS.split(value))

    def inefficient(self, value: str) -> bool:
        return len(value) / len(self.encode(value)) <= self.most_chars_per_token

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind as a number, end) of the fixed patterns."""
        spans = []
        lower = text.lower()
        if any(word in lower for word in ASSIGN_WORDS):
            spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(spans)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        found = self.base(text)
        covered = found[:]
        for m in CANDIDATE.finditer(text):
            value, at = m[0], m.start()
            if any(s < m.end() and at < e for s, _, e in covered) or self.digest_like(value):
                continue
            if not self.identifier(value) and self.inefficient(value):
                found.append((at, 3, m.end()))
                continue
            for part in PART.finditer(value):
                if not self.digest_like(part[0]) and self.inefficient(part[0]):
                    found.append((at + part.start(), 3, at + part.end()))
        return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


_scanners: dict[tuple[str, float], SecretScanner] = {}


def scanner(vocabulary: str, most_chars_per_token: float) -> SecretScanner:
    key = vocabulary, most_chars_per_token
    if key not in _scanners:
        _scanners[key] = SecretScanner(*key)
    return _scanners[key]


def secret_spans(
    text: Column, vocabulary: str, most_chars_per_token: float = 2.0
) -> Column:
    """The spans of every kind in a text column, by start and then by kind."""

    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = scanner(vocabulary, most_chars_per_token).spans
        for batch in batches:
            yield pd.Series([[dict(zip(("kind", "start", "end"), x)) for x in find(t or "")] for t in batch])

    return scan(text)


def find_secrets(
    docs: DataFrame,
    vocabulary: str,
    most_chars_per_token: float = 2.0,
    text_column: str = "text",
    spans_column: str = "secret_spans",
) -> DataFrame:
    """``docs`` with the spans found in each text."""
    return docs.withColumn(
        spans_column, secret_spans(F.col(text_column), vocabulary, most_chars_per_token)
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""

    @F.pandas_udf(T.StringType())
    def replace(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for value, items in zip(texts, found):
            parts, at = [], 0
            for x in items if value is not None else ():
                if x["end"] <= at:
                    continue
                if x["start"] >= at:
                    parts += [value[at : x["start"]], mark]
                at = x["end"]
            out.append(value if not parts else "".join(parts) + value[at:])
        return pd.Series(out, dtype=object)

    return replace(text, spans)
