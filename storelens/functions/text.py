"""Column helpers shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_blank(c: Column | str) -> Column:
    """True for a value that is neither NULL nor empty; never NULL."""
    return F.coalesce(col(c) != "", F.lit(False))


def or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def email_hash(c: Column | str) -> Column:
    """Lower-case hex SHA-256, the cross-table identity of a person."""
    return F.sha2(col(c), 256)


def comma_price(c: Column | str) -> Column:
    """``1234567`` as ``1,234,567``; empty when it is not a whole number."""
    return F.coalesce(F.format_number(col(c).try_cast("bigint"), 0), F.lit(""))


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL when nothing matches."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def url_part(c: Column | str, part: str, key: str | None = None) -> Column:
    """HOST, PATH or one QUERY parameter; NULL for a malformed URL."""
    if key is None:
        return F.try_parse_url(col(c), F.lit(part))
    return F.try_parse_url(col(c), F.lit(part), F.lit(key))


def product_handle(url: Column | str) -> Column:
    """The handle after ``/products/`` in a product page address."""
    return extract(url, r"/products/([^/?]+)")


def plain_vowels(c: Column | str) -> Column:
    """Drops the macron of a long o in romanised place names."""
    return F.regexp_replace(F.regexp_replace(col(c), "^Ō", "O"), "ō", "o")


def null_text(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)
