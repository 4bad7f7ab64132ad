"""Queries on references between the procurement tables (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jangbu.functions.text import WHITE_SPACE
from jangbu.operators.references import Parent, Reference, orphan_counts, orphan_rows, orphans
from jangbu.session import table

PARENTS = (
    Parent("tenders", ("bid_notice_no", "bid_notice_round"), "data_base_date"),
    Parent("contracts", ("unified_contract_no",), "data_base_date", "contract_status_ko", "삭제"),
    Parent("agencies", ("agency_code",)),
    Parent("suppliers", ("supplier_id",)),
)
_TENDER = ("bid_notice_no", "bid_notice_round")
REFERENCES = (
    Reference("award_outcomes", _TENDER, "tenders", ("award_outcome_id",), "data_base_date", late=True),
    Reference("tender_contract_bridge", ("unified_contract_no",), "contracts", ("unified_contract_no",), "contract_date"),
    Reference("tenders", ("notice_agency_code",), "agencies", _TENDER, "data_base_date"),
    Reference("tenders", ("demand_agency_code",), "agencies", _TENDER, "data_base_date"),
    Reference("contracts", ("contract_agency_code",), "agencies", ("unified_contract_no",), "data_base_date"),
    Reference("bidder_submissions", ("bidder_supplier_id",), "suppliers", ("bid_submission_id",), "data_base_date"),
    Reference("award_outcomes", ("winner_supplier_id",), "suppliers", ("award_outcome_id",), "data_base_date"),
    Reference("contracts", ("contractor_supplier_id",), "suppliers", ("unified_contract_no",), "data_base_date"),
)


def _orphans(spark: SparkSession, sf_dir: str, counted: bool = False) -> DataFrame:
    names = {r.table for r in REFERENCES} | {p.name for p in PARENTS}
    return orphans({n: table(spark, sf_dir, n) for n in names}, REFERENCES, PARENTS, counted)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_rows(_orphans(spark, sf_dir))


def p2_orphans_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_counts(_orphans(spark, sf_dir, counted=True))


_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def sql_trim(column: str) -> str:
    return f"trim({column}, {_CHARS})"


def sql_day(column: str) -> str:
    """First day in a text: the notations that the tables hold."""
    digits = f"regexp_replace(regexp_replace({sql_trim(column)}, '[ T].*$', ''), '[^0-9]', '', 'g')"
    return f"try_cast(substr({digits}, 1, 4) || '-' || substr({digits}, 5, 2) || '-' || substr({digits}, 7, 2) as date)"


def _sql_rows() -> str:
    parts = []
    for r in REFERENCES:
        ref = " || chr(31) || ".join(f"nullif({sql_trim(c)}, '')" for c in r.columns)
        name = " || '-' || ".join(sql_trim(c) for c in r.row_key)
        parts.append(f"select '{r.table}' as ref_table, '{r.name}' as ref_column, '{r.parent}' as parent, {ref} as ref, {name} as row_key, {sql_day(r.period)} as row_day, {str(r.late).lower()} as dated from {r.table}")
    return "\nunion all\n".join(parts)


def _sql_keys() -> str:
    parts = []
    for p in PARENTS:
        ref = " || chr(31) || ".join(f"nullif({sql_trim(c)}, '')" for c in p.keys)
        d = sql_day(p.period) if p.period else "cast(null as date)"
        gone = f"{sql_trim(p.status)} is not distinct from '{p.deleted}'" if p.status else "false"
        parts.append(f"select '{p.name}' as parent, {ref} as ref, {d} as d, {gone} as gone from {p.name}")
    return "\nunion all\n".join(parts)


_SQL_FOUND = f"""
with rws as ({_sql_rows()}),
parent_rows as ({_sql_keys()}),
keys as (
  select parent, ref, min(d) as first_day from parent_rows where ref is not null group by parent, ref),
latest as (
  select parent, ref, gone from (
    select *, row_number() over (partition by parent, ref order by coalesce(d, date '0001-01-01') desc, gone desc) as rn
    from parent_rows where ref is not null) where rn = 1),
found as (
  select ref_table, ref_column, ref, row_key, row_day, 'missing' as kind from rws
  where ref is not null and not exists (select 1 from keys k where k.parent = rws.parent and k.ref = rws.ref)
  union all
  select ref_table, ref_column, rws.ref, row_key, row_day, 'deleted' from rws join latest l on l.parent = rws.parent and l.ref = rws.ref where l.gone
  union all
  select ref_table, ref_column, rws.ref, row_key, row_day, 'late' from rws join keys k on k.parent = rws.parent and k.ref = rws.ref
  where rws.dated and k.first_day > rws.row_day)
"""

QUERIES = {"p2_found": p2_found, "p2_orphans_by_month": p2_orphans_by_month}
SQL = {
    "p2_found": _SQL_FOUND + "select distinct ref_table, ref_column, row_key, kind from found",
    "p2_orphans_by_month": _SQL_FOUND
    + "select ref_table, ref_column, kind, strftime(row_day, '%Y-%m') as month, cast(count(*) as bigint) as orphan_rows, cast(count(distinct ref) as bigint) as orphan_keys from found group by all",
}
