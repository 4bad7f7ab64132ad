"""From source text to typed values and labels. Catalyst expressions only; bad input gives null, never an error."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F

from jangbu.functions.text import collapse_spaces, compact, trimmed

#: Texts of the two truth values (fixed values).
TRUE_TEXTS = ("Y", "y", "1", "여", "TRUE", "True", "true")
FALSE_TEXTS = ("N", "n", "0", "부", "FALSE", "False", "false")
#: Notations of a moment that the sources use, most specific first.
MOMENTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyyMMddHHmmss", "yyyyMMddHHmm", "yyyyMMdd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "yyyy.MM.dd", "yyyy-MM", "yyyy")
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def number(value: Column | str) -> Column:
    """A double from text with thousands separators or a percent sign. Words such as NaN, inf or 1d are no numbers."""
    bare = trimmed(F.translate(_col(value), ",%", ""))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def moment(value: Column | str) -> Column:
    """A timestamp from text in any year-first notation: separated by dashes, slashes, dots or 년월일, or not at all, with parts of
    one digit, with a time behind a space or a T, or none; a year, or a year and a month, is its beginning. An impossible
    moment is null, and so is a bare time of day."""
    bare = trimmed(value)
    short = F.coalesce(*[F.when(F.length(bare) == len(f), F.try_to_timestamp(bare, F.lit(f))) for f in MOMENTS])
    date = r"^(\d{4})\s?[-/.년]\s?(\d{1,2})\s?[-/.월]\s?(\d{1,2})일?\.?(?:[T ]\s?(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:\.\d{1,9})?(?:Z|[+-]\d{2}:?\d{2})?)?$"
    part = lambda k, n: F.lpad(F.regexp_extract(bare, date, k), n, "0")
    whole = F.concat(part(1, 4), F.lit("-"), part(2, 2), F.lit("-"), part(3, 2), F.lit(" "), part(4, 2), F.lit(":"), part(5, 2), F.lit(":"), part(6, 2))
    return F.coalesce(short, F.when(bare.rlike(date), F.try_to_timestamp(whole, F.lit("yyyy-MM-dd HH:mm:ss"))))


def flag(value: Column | str) -> Column:
    """Three-valued truth: true, false, or null for any other text."""
    bare = trimmed(value)
    return F.when(bare.isin(*TRUE_TEXTS), True).when(bare.isin(*FALSE_TEXTS), False)


def business_number(value: Column | str) -> Column:
    """Without hyphens and outer white space; null becomes an empty text."""
    return trimmed(F.regexp_replace(F.coalesce(_col(value), F.lit("")), "-", ""))


def valid_business_number(value: Column | str) -> Column:
    """Ten ASCII digits once hyphens are gone."""
    return business_number(value).rlike("^[0-9]{10}$")


def masked_business_number(value: Column | str) -> Column:
    """The first five digits shown, the rest hidden; an empty text for an invalid number."""
    n = business_number(value)
    return F.when(valid_business_number(value), F.concat(F.substring(n, 1, 3), F.lit("-"), F.substring(n, 4, 2), F.lit("-*****"))).otherwise("")


def name(value: Column | str) -> Column:
    """White space runs as one space and none at the ends; null stays null."""
    return collapse_spaces(value)


def year_month(day: Column, year: Column | str = "unknown", month: Column | str = "01") -> tuple[Column, Column]:
    """Four-digit year and two-digit month of a day, with defaults where it is null."""
    default = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.coalesce(F.date_format(day, "yyyy"), default(year)), F.coalesce(F.date_format(day, "MM"), default(month))


def labelled(value: Column | str, rules: Iterable[tuple[tuple[str, ...], str]], mode: str = "contains", blank: str | None = None, other: str | None = None) -> Column:
    """The label of the first rule whose words all match (mode contains, prefix or regex) the text without white space.

    A blank value gets ``blank``; a text that no rule matches gets ``other``, or stays as it is (trimmed).
    """
    c = _col(value)
    flat = F.coalesce(compact(c), F.lit(""))
    test = {"contains": lambda w: flat.contains(w), "prefix": lambda w: flat.startswith(w), "regex": lambda w: flat.rlike(w)}[mode]
    out = F.when(flat == "", F.lit(blank)) if blank is not None else F.when(F.lit(False), F.lit(None).cast("string"))
    for words, label in rules:
        hit = test(words[0])
        for w in words[1:]:
            hit = hit & test(w)
        out = out.when(hit, label)
    return out.otherwise(F.lit(other) if other is not None else trimmed(c))


#: Division and method labels (fixed values): words that all occur, and the label, first match first.
DIVISIONS = ((("용역",), "Services"), (("공사",), "Construction"), (("물품",), "Goods"), (("외자",), "Foreign supplies"))
METHODS = ((("수의",), "Direct / negotiated"), (("제한", "경쟁"), "Restricted competition"), (("일반", "경쟁"), "Open competition"), (("지명", "경쟁"), "Selective competition"))
DIVISION_CODES = {"1": "goods", "2": "foreign", "3": "construction", "5": "service", "물품": "goods", "외자": "foreign", "공사": "construction", "용역": "service"}
METHOD_PREFIXES = ((("수의계약",), "수의계약 (private_contract)"), (("제한경쟁",), "제한경쟁 (restricted_competitive)"), (("일반경쟁",), "일반경쟁 (general_competitive)"), (("지명경쟁",), "지명경쟁 (limited_competitive)"))


#: Award methods by a word they hold, first match first (fixed values).
AWARD_METHODS = ((("적격심사",), "qualification_review"), (("수의",), "small_sum_private"), (("협상",), "negotiation"), (("최저가",), "lowest_price"), (("종합평가",), "comprehensive_evaluation"))


def award_method_label(value: Column | str) -> Column:
    """The group of an award method; any other text, and none, is ``other``."""
    return labelled(value, AWARD_METHODS, blank="other", other="other")


def division_label(value: Column | str) -> Column:
    return labelled(value, DIVISIONS, blank="Unknown")


def method_label(value: Column | str) -> Column:
    return labelled(value, METHODS, blank="Unknown")


def coded(value: Column | str, codes: Mapping[str, str] = DIVISION_CODES) -> Column:
    """A controlled term for an exact code or text, else ``unknown(text)``."""
    bare = trimmed(value)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, term in codes.items():
        out = out.when(bare == code, term)
    return out.otherwise(F.concat(F.lit("unknown("), F.coalesce(bare, F.lit("")), F.lit(")")))


def method_prefix_label(value: Column | str) -> Column:
    """A contract method by what it begins with; other methods are marked so."""
    bare = F.coalesce(trimmed(value), F.lit(""))
    out = F.when(bare == "", "알수없음 (unknown)")
    for (prefix,), label in METHOD_PREFIXES:
        out = out.when(bare.startswith(prefix), label)
    return out.otherwise(F.concat(bare, F.lit(" (other)")))


def secrets_hidden(value: Column | str) -> Column:
    """A request text with its service key hidden."""
    return F.regexp_replace(_col(value), r"(?i)(serviceKey=)([^&\s]+)", "$1[REDACTED]")


def shown_key(key: str | None) -> str:
    """A key for logs: its ends at most, and nothing of a short one."""
    if not key:
        return "<none>"
    return "********" if len(key) <= 8 else f"{key[:4]}********{key[-4:]}"


def decoded_key(key: str) -> str:
    """A service key as it is sent: without white space around it, percent signs resolved."""
    key = key.strip()
    return unquote(key) if "%" in key else key


def ratio(part: Column, whole: Column, digits: int, empty: float = 0.0) -> Column:
    return F.coalesce(F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits), F.lit(float(empty)))
