"""Tokenisation shared by the encoder, the scorers and the SQL oracles.

A token is a maximal run of letters and digits of the lower-cased text.
The same pattern runs in Spark (Java regex), in Python (``regex``) and in
DuckDB (RE2), so all three agree.
"""

from __future__ import annotations

import hashlib

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Token pattern and hash-bucket width (hex digits of md5).
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
HASH_HEX_DIGITS = 7

_TOKEN_RE = regex.compile(TOKEN_PATTERN)


def tokens(c: Column) -> Column:
    """array<string> of word tokens of a string column."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def py_tokens(text: str | None) -> list[str]:
    if text is None:
        return []
    return _TOKEN_RE.findall(str(text).lower())


def bucket(token: Column, dim: int) -> Column:
    """Hash bucket of a token column: first 28 bits of md5, modulo ``dim``."""
    return (F.conv(F.substring(F.md5(token), 1, HASH_HEX_DIGITS), 16, 10)
            .cast("long") % dim).cast("int")


def py_bucket(token: str, dim: int) -> int:
    return int(hashlib.md5(token.encode("utf-8")).hexdigest()[:HASH_HEX_DIGITS], 16) % dim


def whitespace_tokens(c: Column) -> Column:
    """Tokens split on runs of whitespace, empties removed (tone windows)."""
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")
