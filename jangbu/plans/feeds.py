"""The procurement tables seen as typed feeds, and the pieces of SQL that say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.text import day
from jangbu.plans.references import sql_day, sql_trim
from jangbu.session import table

#: Key of the pseudonyms in the named queries; a real build passes a secret of its own.
DEMO_KEY = b"jangbu demonstration key, not a secret"
DAYS = {
    "tenders": ("bid_notice_date", "bid_begin_date", "bid_close_date", "opening_date", "data_base_date"),
    "bidder_submissions": ("bid_submission_date", "opening_date", "data_base_date"),
    "award_outcomes": ("award_date", "opening_date", "data_base_date"),
    "contracts": ("contract_date", "data_base_date"),
    "tender_contract_bridge": ("contract_date",),
}


def dated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its days as dates and not-a-number as null."""
    df = table(spark, sf_dir, name)
    days = {c: day(c) for c in DAYS.get(name, ())}
    doubles = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast("double")) for f in df.schema.fields if f.dataType.simpleString() == "double"}
    return df.withColumns(days | doubles)


def business_number_of(supplier: str) -> Column:
    """Ten digits out of a pseudonymous id: the feeds had business numbers, these tables don't."""
    return F.translate(F.substring(supplier, 5, 10), "abcdef", "012345")


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir, "tenders").drop("load_batch")


def awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dated(spark, sf_dir, "bidder_submissions")
    won, number = F.col("is_selected_winner"), business_number_of("bidder_supplier_id")
    return df.drop("bid_submission_id", "tender_in_scope").withColumns({
        "bidder_business_registration_no": number,
        "bidder_name_ko": F.concat(F.lit("업체 "), F.substring("bidder_supplier_id", 5, 4)),
        "winner_business_registration_no": F.when(won, number),
        "winner_name_ko": F.when(won, F.concat(F.lit("업체  "), F.substring("bidder_supplier_id", 5, 4))),
        "award_amount_krw": F.when(won, F.col("bid_amount_krw")),
        "award_rate": F.when(won, F.col("bid_rate")),
        "award_date": F.when(won, F.col("opening_date")),
    })


def contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dated(spark, sf_dir, "contracts")
    return df.withColumns({"contractor_business_registration_no": business_number_of("contractor_supplier_id"), "contractor_name_ko": F.concat(F.lit("업체 "), F.substring("contractor_supplier_id", 5, 4))})


def sql_number_of(supplier: str) -> str:
    return f"translate(substr({supplier}, 5, 10), 'abcdef', '012345')"


def sql_finite(column: str) -> str:
    return f"case when not isnan({column}) then {column} end"


def sql_valid(number: str) -> str:
    return f"regexp_matches({number}, '^[0-9]{{10}}$')"


def sql_pseudonym(number: str, inner: str, outer: str) -> str:
    first = f"unhex(sha256(unhex('{inner}') || encode({number})))"
    return f"case when {sql_valid(number)} then 'SUP_' || substr(sha256(unhex('{outer}') || {first}), 1, 32) else '' end"


SQL_AWARDS = f"""
awards as (
  select * replace ({sql_day('opening_date')} as opening_date, {sql_finite('bid_amount_krw')} as bid_amount_krw, {sql_finite('bid_rate')} as bid_rate, {sql_finite('opening_rank')} as opening_rank),
    {sql_number_of('bidder_supplier_id')} as bidder_no, '업체 ' || substr(bidder_supplier_id, 5, 4) as bidder_name,
    case when is_selected_winner then {sql_number_of('bidder_supplier_id')} end as winner_no
  from bidder_submissions)"""
SQL_CONTRACTS = f"""
contract_feed as (
  select * replace ({sql_day('contract_date')} as contract_date, {sql_finite('contract_amount_krw')} as contract_amount_krw),
    {sql_number_of('contractor_supplier_id')} as contractor_no, '업체 ' || substr(contractor_supplier_id, 5, 4) as contractor_name
  from contracts)"""
SQL_TENDER_KEYS = f"""
tender_keys as (
  select distinct {sql_trim('bid_notice_no')} as no, {sql_trim('bid_notice_round')} as round from tenders
  where {sql_trim('bid_notice_no')} <> '' and {sql_trim('bid_notice_round')} <> '')"""
