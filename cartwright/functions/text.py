"""Text rules for names, addresses, categories and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spark's trim cuts blanks only; documents also carry tabs and line ends.
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def email_clean(c: Column) -> Column:
    return F.lower(strip(c))


def last_part(c: Column, sep: str) -> Column:
    """Text after the last separator; the whole text when there is none."""
    return F.substring_index(c, sep, -1)


def email_domain(clean: Column) -> Column:
    """Part after the last '@' of a cleaned address, '' when it has none."""
    return F.when(F.instr(clean, "@") > 0, last_part(clean, "@")).otherwise(F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", strip(first), strip(last))


def default_to(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def or_unknown(c: Column) -> Column:
    return default_to(F.nullif(strip(c), F.lit("")), "Unknown")


def truthy(c: Column) -> Column:
    """Switch-like text to boolean; anything unknown, or null, is false."""
    return default_to(F.lower(strip(c.cast("string"))).isin("1", "true", "yes", "on"), False)


def record_key(prefix: str, key: Column) -> Column:
    """``prefix#key``. A null key would collide with other null keys, so it fails the job."""
    return F.when(
        key.isNull(), F.raise_error(F.lit(f"null key for a {prefix} record")).cast("string")
    ).otherwise(F.concat(F.lit(f"{prefix}#"), key.cast("string")))
