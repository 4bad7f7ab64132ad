"""Per-notice and per-agency results from the bids, where a few keys hold most rows (problem 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.text import blank_to_null
from jangbu.operators.selection import exact_quantiles, heavy_keys
from jangbu.plans.references import sql_trim
from jangbu.session import table

KEYS = ("bid_notice_no", "notice_agency_code")
SHARE = 0.02
PROBS = (0.25, 0.5, 0.75)


def _columns() -> dict[str, Column]:
    return {c: blank_to_null(c) for c in KEYS}


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_keys(table(spark, sf_dir, "bidder_submissions"), _columns(), SHARE).select("column_name", "key_value")


def _quantiles(spark: SparkSession, sf_dir: str, key: str, value: str) -> DataFrame:
    rows = table(spark, sf_dir, "bidder_submissions").select(blank_to_null(key).alias(key), value).where(F.col(key).isNotNull())
    return exact_quantiles(rows, [key], value, PROBS)


def p5_amounts_by_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quantiles(spark, sf_dir, "bid_notice_no", "bid_amount_krw")


def p5_rates_by_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quantiles(spark, sf_dir, "notice_agency_code", "bid_rate")


def _sql_quantiles(key: str, value: str) -> str:
    return f"""
with v as (
  select {sql_trim(key)} as {key}, {value} as v from bidder_submissions
  where {sql_trim(key)} <> '' and {value} is not null and isfinite({value})),
r as (select *, row_number() over (partition by {key} order by v) as rn, count(*) over (partition by {key}) as n from v)
select {key}, prob, n, v as value from r, (values (0.25::double), (0.5::double), (0.75::double)) t(prob)
where rn = greatest(1, ceil(round(prob * n, 9)))
"""


QUERIES = {"p5_found": p5_found, "p5_amounts_by_notice": p5_amounts_by_notice, "p5_rates_by_agency": p5_rates_by_agency}
SQL = {
    "p5_found": "\nunion all\n".join(
        f"select '{c}' as column_name, {sql_trim(c)} as key_value from bidder_submissions where {sql_trim(c)} <> '' group by 2 having count(*) >= {SHARE} * (select count(*) from bidder_submissions)" for c in KEYS
    ),
    "p5_amounts_by_notice": _sql_quantiles("bid_notice_no", "bid_amount_krw"),
    "p5_rates_by_agency": _sql_quantiles("notice_agency_code", "bid_rate"),
}
