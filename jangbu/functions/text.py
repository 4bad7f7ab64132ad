"""Text expressions. Everything here is a Catalyst expression; nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character with the Unicode White_Space property, and the two zero-width marks that travel with pasted text.
WHITE_SPACE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))


def trimmed(value: Column | str) -> Column:
    """``value`` without white space at both ends, wide and no-break spaces and tabs included; null stays null."""
    return F.btrim(F.col(value) if isinstance(value, str) else value, F.lit(WHITE_SPACE))


def blank_to_null(value: Column | str) -> Column:
    """Trimmed value; null where nothing is left."""
    return F.nullif(trimmed(value), F.lit(""))


def is_blank(value: Column | str) -> Column:
    return F.coalesce(trimmed(value), F.lit("")) == ""


def collapse_spaces(value: Column | str) -> Column:
    """Runs of any white space become one space, none at the ends (null stays null)."""
    c = F.col(value) if isinstance(value, str) else value
    return trimmed(F.regexp_replace(c, r"(?U)\s+", " "))


def compact(value: Column | str) -> Column:
    """``value`` without any white space."""
    c = F.col(value) if isinstance(value, str) else value
    return F.regexp_replace(c, r"(?U)\s+", "")


def day(value: Column | str) -> Column:
    """The date in ``value``, a text in any usual year-first notation; null where there is none.

    Known: ``2026-01-05``, ``2026/1/5``, ``2026.01.05``, ``20260105``, ``2026년 1월 5일``, each with or
    without a time behind it. Impossible days give null.
    """
    c = trimmed(value)
    pattern = r"^(\d{4})(?:(\d{2})(\d{2})|\D{1,2}(\d{1,2})\D{1,2}(\d{1,2}))(?!\d)"
    stamp = r"^(\d{4})(\d{2})(\d{2})\d{4}(\d{2})?$"
    month = F.concat(F.regexp_extract(c, pattern, 2), F.regexp_extract(c, pattern, 4))
    dom = F.concat(F.regexp_extract(c, pattern, 3), F.regexp_extract(c, pattern, 5))
    usual = F.concat_ws("-", F.regexp_extract(c, pattern, 1), F.lpad(month, 2, "0"), F.lpad(dom, 2, "0"))
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}(?!\d)"), F.substring(c, 1, 10)).when(c.rlike(stamp), F.regexp_replace(c, stamp, "$1-$2-$3")).otherwise(usual)
    return F.try_to_date(iso, "yyyy-MM-dd")
