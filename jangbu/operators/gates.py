"""Checks that a build must pass before it is published; each is one row, and failing rows make one error."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from jangbu.functions.text import is_blank
from jangbu.operators.relational import key_integrity

#: Column names that must not be published (fixed values), and the same without their anchors, which catches prefixed names too.
FORBIDDEN = (r"(?<![a-z_])business_registration_no", r"(?<![a-z_])biz_no$", r"(?<![a-z_])bizno$", r"^biz_reg", r"^phone_|^tel_|^fax_|^mobile_|^email_", r"_phone$|_tel$|_fax$|_mobile$|_email$", r"^representative_name|^ceo_name|^president_name", r"^masked_biz_no$")
STRICT = (r"business_registration_no", r"biz_?no", r"biz_reg", r"(^|_)(phone|tel|fax|mobile|email)(_|$)", r"(representative|ceo|president|official)_(name|tel|email)", r"_address$")
IDENTIFIERS = frozenset("bid_submission_id award_outcome_id supplier_id agency_code unified_contract_no bid_notice_no bid_notice_round contract_no bidder_supplier_id winner_supplier_id contractor_supplier_id".split())


def forbidden_columns(columns: Sequence[str], strict: bool = True) -> list[str]:
    return [c for c in columns if any(re.search(p, c, re.I) for p in (STRICT if strict else FORBIDDEN))]


def type_faults(df: DataFrame) -> list[str]:
    """Identifiers must be text and money must be numbers."""
    out = []
    for f in df.schema.fields:
        if f.name in IDENTIFIERS and not isinstance(f.dataType, T.StringType):
            out.append(f"{f.name} is no text")
        if f.name.endswith("_krw") and not isinstance(f.dataType, T.NumericType):
            out.append(f"{f.name} is no number")
    return out


def report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], expected: Mapping[str, int] | None = None, linked: str | None = None) -> list[dict[str, object]]:
    """One entry per gate: ``gate, table, passed, detail``. Each table is aggregated once."""
    out: list[dict[str, object]] = []
    add = lambda gate, table, passed, detail: out.append({"gate": gate, "table": table, "passed": bool(passed), "detail": detail})
    for name, df in tables.items():
        r = key_integrity(df, keys[name]).first()
        if expected and name in expected:
            add("row count", name, r.total == expected[name], f"{r.total} of {expected[name]}")
        add("primary key", name, r.is_unique or not r.total, f"{r.duplicates} repeated, {r.total - r.non_null} null")
        bad = forbidden_columns(df.columns)
        add("private columns", name, not bad, ", ".join(bad))
        faults = type_faults(df)
        add("column types", name, not faults, ", ".join(faults))
    if linked:
        n = tables[linked].where(is_blank("bid_notice_no")).count()
        add("linked rows name a notice", linked, n == 0, f"{n} blank")
    return out


def no_company_names(tables: Mapping[str, DataFrame]) -> list[dict[str, object]]:
    """One entry per table: no column may name a firm, by name or by the list of names that a build keeps for itself."""
    named = lambda c: re.search(r"(bidder|winner|contractor|supplier|company|corp)_?name", c, re.I) or c == "names"
    out = []
    for name, df in tables.items():
        bad = [c for c in df.columns if named(c)]
        out.append({"gate": "company names", "table": name, "passed": not bad, "detail": ", ".join(bad)})
    return out


def require(gates: Sequence[Mapping[str, object]]) -> None:
    failed = [f"{g['table']}: {g['gate']} ({g['detail']})" for g in gates if not g["passed"]]
    if failed:
        raise ValueError("; ".join(failed))
