"""Seven relational tables from typed feeds: projections, surrogate keys, pseudonyms, name resolution, scope flags."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jangbu.functions.cleaning import business_number, name, valid_business_number
from jangbu.functions.identity import outcome_id, submission_id, supplier_pseudonym
from jangbu.functions.text import blank_to_null, is_blank, trimmed
from jangbu.operators.relational import column_or, flag_existing, most_frequent_name, text_or_blank

#: Column lists of the curated tables (fixed values).
TENDERS = "bid_notice_no bid_notice_round bid_title_ko notice_agency_code notice_agency_name_ko demand_agency_code demand_agency_name_ko business_div_name_ko contract_method_ko contract_status_ko award_method_ko assigned_budget_krw estimated_price_krw bid_notice_date bid_notice_time bid_begin_date bid_begin_time bid_close_date bid_close_time opening_date opening_time opening_place_ko ref_notice_no ref_notice_round bid_notice_url is_joint_contract is_electronic_bid is_international_bid is_pps_notice is_region_limited is_industry_limited data_base_date".split()
LABELS = "bid_title_ko business_div_name_ko contract_method_ko award_method_ko notice_agency_code notice_agency_name_ko demand_agency_code demand_agency_name_ko".split()
PRICES = "scheduled_price_krw base_amount_krw estimated_price_krw award_lower_limit_rate".split()
CONTRACT_TEXTS = "contract_no contract_round contract_title_ko contract_method_ko contract_status_ko contract_agency_code contract_agency_name_ko demand_agency_code demand_agency_name_ko contractor_name_ko bid_notice_no bid_notice_round contract_period long_term_contract_div_ko private_contract_reason_ko contract_info_url bid_notice_url data_base_date".split()
TENDER_KEY = ["bid_notice_no", "bid_notice_round"]


def in_scope(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows whose day lies in the interval, both ends included; a null day lies outside. The test is on the typed column."""
    return df.where(F.col(column).cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def in_any_month(df: DataFrame, column: str, month: str | None = None) -> DataFrame:
    """``in_scope`` from the first to the last month there is: every row that has a day. ``month`` names a column for its month."""
    day = F.col(column).cast("date")
    rows = df.where(day.isNotNull())
    return rows.withColumn(month, F.date_format(day, "yyyy_MM")) if month else rows


def tenders(bids: DataFrame) -> DataFrame:
    keyed = bids.withColumns({k: trimmed(F.col(k).cast("string")) for k in TENDER_KEY})
    return keyed.select(*[c for c in TENDERS if c in bids.columns])


def _numbers(df: DataFrame, names: list[str]) -> list[Column]:
    return [column_or(df, n, None, "double").alias(n) for n in names]


def submissions(awards: DataFrame, tender_rows: DataFrame, key: bytes) -> DataFrame:
    """Every submitted bid with its surrogate key and whether its notice is in scope."""
    supplier = supplier_pseudonym("bidder_business_registration_no", key)
    texts = [text_or_blank(awards, c, trim=False) for c in ("disqualification_reason_ko", "bid_submission_time", *LABELS, "bidder_name_ko", "opening_time", "opening_result_status_ko", "data_base_date")]
    keys = [text_or_blank(awards, k) for k in TENDER_KEY]
    full = awards.withColumns({c: column_or(awards, c, None, k) for c, k in (("opening_rank", "double"), ("disqualification_reason_ko", "string"), ("bid_amount_krw", "double"), ("bid_submission_time", "string")) if c not in awards.columns})
    winner = F.coalesce(column_or(awards, "is_selected_winner", False, "boolean"), F.lit(False)).alias("is_selected_winner")
    rows = full.select(submission_id(supplier).alias("bid_submission_id"), *keys, supplier.alias("bidder_supplier_id"), *_numbers(full, ["opening_rank", "bid_amount_krw", "bid_rate", *PRICES]), column_or(full, "bid_submission_date", None, "date").alias("bid_submission_date"), winner, column_or(full, "opening_date", None, "date").alias("opening_date"), *texts)
    return flag_existing(rows, TENDER_KEY, tender_rows, TENDER_KEY, "tender_in_scope")


def outcomes(awards: DataFrame, tender_rows: DataFrame, key: bytes) -> DataFrame:
    """Rows that were selected (a null flag is not), with their surrogate key."""
    won = awards.where(F.col("is_selected_winner"))
    supplier = supplier_pseudonym("winner_business_registration_no", key)
    texts = [text_or_blank(won, c, trim=False) for c in ("bid_submission_time", "winner_name_ko", *LABELS, "data_base_date")]
    full = won.withColumns({c: column_or(won, c, None, k) for c, k in (("award_amount_krw", "double"), ("bid_submission_time", "string")) if c not in won.columns})
    rows = full.select(outcome_id(supplier).alias("award_outcome_id"), *[text_or_blank(won, k) for k in TENDER_KEY], supplier.alias("winner_supplier_id"), *_numbers(full, ["award_amount_krw", "award_rate", "bid_amount_krw", "opening_rank", *PRICES]), column_or(full, "award_date", None, "date").alias("award_date"), column_or(full, "opening_date", None, "date").alias("opening_date"), *texts)
    return flag_existing(rows, TENDER_KEY, tender_rows, TENDER_KEY, "tender_in_scope")


def contracts(rows: DataFrame, key: bytes) -> DataFrame:
    flags = [F.coalesce(column_or(rows, c, False, "boolean"), F.lit(False)).alias(c) for c in ("is_joint_contract", "is_domestic_corp")]
    return rows.select(trimmed("unified_contract_no").alias("unified_contract_no"), *[text_or_blank(rows, c) for c in CONTRACT_TEXTS], *_numbers(rows, ["contract_amount_krw", "total_contract_amount_krw"]), column_or(rows, "contract_date", None, "date").alias("contract_date"), supplier_pseudonym("contractor_business_registration_no", key).alias("contractor_supplier_id"), *flags)


def suppliers(awards: DataFrame, rows: DataFrame, key: bytes, by: Sequence[str] = ()) -> DataFrame:
    """One row per valid business number in any role: names by majority, roles, counts and the contract sum; ``names`` says
    how many different names a supplier has (more than one is a conflict). One pass over a union of the three roles. With
    ``by``, columns of both tables that are never null (the month), one row per number and value of these."""
    part = lambda df, number, who, role, amount=None: df.select(
        *by,
        business_number(number).alias("number"), valid_business_number(number).alias("valid"), F.coalesce(name(column_or(df, who, "", "string")), F.lit("")).alias("who"), F.lit(role).alias("role"),
        (F.col(amount) if amount and amount in df.columns else F.lit(None)).cast("double").alias("amount"),
    ).where("valid")
    won = awards.where(F.col("is_selected_winner"))
    roles = part(awards, "bidder_business_registration_no", "bidder_name_ko", "bidder").unionByName(part(won, "winner_business_registration_no", "winner_name_ko", "winner")).unionByName(part(rows, "contractor_business_registration_no", "contractor_name_ko", "contractor", "contract_amount_krw"))
    is_ = lambda role: F.col("role") == role
    stats = roles.groupBy(*by, "number").agg(
        *[F.bool_or(is_(r)).alias(f"is_{r}") for r in ("bidder", "winner", "contractor")],
        F.count_if(is_("bidder")).alias("snapshot_total_bids_in_scope"),
        F.count_if(is_("winner")).alias("snapshot_total_wins_in_scope"),
        F.count_if(is_("contractor")).alias("snapshot_total_contracts_in_scope"),
        F.coalesce(F.sum(F.col("amount").cast("decimal(28,4)")).cast("double"), F.lit(0.0)).alias("snapshot_total_contract_amount_krw"),
    )
    names = most_frequent_name(roles, "number", F.col("who"), by=by)
    out = stats.join(names, [*by, "number"], "left")
    return out.select(supplier_pseudonym("number", key).alias("supplier_id"), F.coalesce("name", F.lit("")).alias("supplier_name_ko"), *[c for c in stats.columns if c != "number"], F.coalesce("names", F.lit(0)).alias("names"))


def agencies(bids: DataFrame, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per agency code in any of four roles; tenders are counted by notice code, contracts by contract code. ``by`` as
    for ``suppliers``."""

    def part(df: DataFrame, code: str, who: str, role: str) -> DataFrame:
        return df.select(*by, blank_to_null(code).alias("agency_code"), F.coalesce(name(column_or(df, who, "", "string")), F.lit("")).alias("who"), F.lit(role).alias("role")).where("agency_code is not null")

    roles = part(bids, "notice_agency_code", "notice_agency_name_ko", "notice").unionByName(part(bids, "demand_agency_code", "demand_agency_name_ko", "demand")).unionByName(part(rows, "contract_agency_code", "contract_agency_name_ko", "contract")).unionByName(part(rows, "demand_agency_code", "demand_agency_name_ko", "demand"))
    stats = roles.groupBy(*by, "agency_code").agg(
        *[F.bool_or(F.col("role") == r).alias(f"is_{r}_agency") for r in ("notice", "demand", "contract")],
        F.count_if(F.col("role") == "notice").alias("snapshot_total_tenders_in_scope"),
        F.count_if(F.col("role") == "contract").alias("snapshot_total_contracts_in_scope"),
    )
    names = most_frequent_name(roles, "agency_code", F.col("who"), by=by)
    return stats.join(names, [*by, "agency_code"], "left").select("agency_code", F.coalesce("name", F.lit("")).alias("agency_name_ko"), *[c for c in stats.columns if c != "agency_code"], F.coalesce("names", F.lit(0)).alias("names"))


def bridge(rows: DataFrame, tender_rows: DataFrame) -> DataFrame:
    """Contracts that name a notice, and whether that notice is in scope."""
    linked = rows.where(~is_blank("bid_notice_no"))
    out = linked.select(trimmed("unified_contract_no").alias("unified_contract_no"), *[text_or_blank(linked, k) for k in TENDER_KEY], F.lit("DIRECT_NOTICE_MATCH").alias("match_type"), column_or(linked, "contract_date", None, "date").alias("contract_date"), column_or(linked, "contract_amount_krw", None, "double").alias("contract_amount_krw"))
    return flag_existing(out, TENDER_KEY, tender_rows, TENDER_KEY, "tender_in_scope")


@dataclass
class Curated:
    tenders: DataFrame
    submissions: DataFrame
    outcomes: DataFrame
    contracts: DataFrame
    suppliers: DataFrame
    agencies: DataFrame
    bridge: DataFrame


def curated(bids: DataFrame, awards: DataFrame, contract_rows: DataFrame, key: bytes) -> Curated:
    t = tenders(bids)
    return Curated(t, submissions(awards, t, key), outcomes(awards, t, key), contracts(contract_rows, key), suppliers(awards, contract_rows, key), agencies(bids, contract_rows), bridge(contract_rows, t))
