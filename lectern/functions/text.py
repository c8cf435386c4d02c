"""Scalar text functions as Column expressions.

All are built-in Spark SQL functions, so they run inside whole-stage
codegen and need no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.config import CHUNK_OVERLAP

# Date formats tried in order by ``normalize_date`` (the
# reference's list, written as Java patterns; one-letter fields because the
# reference's parser accepts one or two digits).
DATE_FORMATS = (
    "yyyy-M-d",
    "M/d/yyyy",
    "d/M/yyyy",
    "MMMM d, yyyy",
    "MMM d yyyy",
    "d MMMM yyyy",
    "d MMM yyyy",
    "yyyy/M/d",
    "M-d-yyyy",
)

def normalize_text(c: Column) -> Column:
    """P3: '' for null/empty; drop leading front matter; newline -> space;
    runs of spaces/tabs -> one space; strip."""
    t = F.regexp_replace(c, r"\A---\s*\n(?s:.*?)\n---\s*\n", "")
    t = F.regexp_replace(t, "\n", " ")
    t = F.regexp_replace(t, "[ \t]+", " ")
    t = F.regexp_replace(t, r"^\s+|\s+\z", "")
    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(t)


def normalize_title(c: Column) -> Column:
    """Text before the first '|', stripped; '' for null/empty."""
    head = F.substring_index(c, "|", 1)
    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(
        F.regexp_replace(head, r"^\s+|\s+\z", ""))


def normalize_date(c: Column) -> Column:
    """P5: first format that parses the whole string, as yyyy-MM-dd, else ''.

    Only strings with a four-digit year are tried; a bare year gives ''."""
    parsed = F.coalesce(*[F.try_to_date(c, fmt) for fmt in DATE_FORMATS])
    ok = c.rlike(r"(^|[^0-9])[0-9]{4}([^0-9]|$)") & ~c.rlike(r"^[0-9]{4}$")
    out = F.when(ok, F.date_format(parsed, "yyyy-MM-dd"))
    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(F.coalesce(out, F.lit("")))


def parse_published_at(c: Column) -> Column:
    """ISO date (or its basic form yyyyMMdd) in the first 10 characters of
    the trimmed string, else null."""
    s = F.substring(F.regexp_replace(c.cast("string"), r"^\s+|\s+\z", ""), 1, 10)
    return (F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(s, "yyyy-MM-dd"))
            .when(s.rlike(r"^[0-9]{8}$"), F.try_to_date(s, "yyyyMMdd")))


def content_hash(c: Column) -> Column:
    """SHA-256 hex of the UTF-8 body."""
    return F.sha2(c.cast("string"), 256)


def normalize_tags(c: Column) -> Column:
    """Trimmed, no null, no blank; order and duplicates kept; null -> []."""
    trimmed = F.transform(F.coalesce(c, F.array().cast("array<string>")),
                          lambda t: F.regexp_replace(t, r"^\s+|\s+\z", ""))
    return F.filter(trimmed, lambda t: t.isNotNull() & (t != ""))


def is_article_url(url: Column, section: str = "library") -> Column:
    """Contains '/<section>/' and does not end in '/<section>' once trailing '/' go."""
    stripped = F.regexp_replace(url, "/+$", "")
    return url.contains(f"/{section}/") & ~stripped.endswith(f"/{section}")


def sitemap_urls(lines: Column, section: str = "library") -> Column:
    """P1 on a sitemap text: its trimmed lines that are article urls."""
    urls = F.transform(F.split(lines, r"\r?\n"), lambda u: F.trim(u))
    return F.filter(urls, lambda u: is_article_url(u, section))


def longest_overlap(left: Column, right: Column, cap: int = CHUNK_OVERLAP) -> Column:
    """Longest suffix of ``left`` that is a prefix of ``right`` (<= cap).

    Both are cut to the characters that can match, once: the outer lambda's
    variable holds the cut strings, where a column's expression would be evaluated
    again for every length that is tried."""
    ends = F.array(F.struct(F.right(left, F.lit(cap)).alias("tail"), F.left(right, F.lit(cap)).alias("head")))

    def overlap(s):
        top = F.least(F.length(s["tail"]), F.length(s["head"]))
        cands = F.filter(F.sequence(F.greatest(top, F.lit(1)), F.lit(1), F.lit(-1)),
                         lambda n: (n <= top) & F.endswith(s["tail"], F.left(s["head"], n)))
        return F.coalesce(F.get(cands, 0), F.lit(0))
    return F.get(F.transform(ends, overlap), 0)
