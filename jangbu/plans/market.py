"""Market queries over the procurement tables, and history features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.cleaning import division_label, method_label
from jangbu.functions.text import blank_to_null, day, trimmed
from jangbu.operators import features as X
from jangbu.operators import relational as R
from jangbu.plans import feeds
from jangbu.plans.cleaning import _SQL_DIVISION, _SQL_METHOD
from jangbu.plans.references import sql_day, sql_trim
from jangbu.session import table

KEY = ["bid_notice_no", "bid_notice_round"]


def notices_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.monthly(table(spark, sf_dir, "tenders"), day("bid_notice_date"))


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards with the division and method of their notice (inner, each notice once)."""
    keyed = lambda t: table(spark, sf_dir, t).withColumns({k: blank_to_null(k) for k in KEY}).dropna(subset=KEY)
    notices = keyed("tenders").groupBy(*KEY).agg(F.max("business_div_name_ko").alias("division"), F.max("contract_method_ko").alias("method"))
    return keyed("award_outcomes").select(*KEY, "award_rate").join(notices, KEY)


def rates_by_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.rates_by(_priced(spark, sf_dir), division_label("division"), "award_rate")


def rates_by_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent methods."""
    return X.rates_by(_priced(spark, sf_dir), method_label("method"), "award_rate", 10)


def busiest_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen agencies with most notices."""
    return X.top_values(table(spark, sf_dir, "tenders").select(blank_to_null("notice_agency_code").alias("agency_code")), "agency_code", 15)


def competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bidders per notice, and whether there was only one."""
    df = table(spark, sf_dir, "bidder_submissions").withColumns({k: blank_to_null(k) for k in KEY}).dropna(subset=KEY)
    per = df.groupBy(*KEY, "bidder_supplier_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(*KEY).agg(F.sum("n").alias("bids"), F.count(F.lit(1)).alias("bidders")).withColumn("single_bid", F.col("bidders") == 1)


def price_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feeds.dated(spark, sf_dir, "award_outcomes").select("award_outcome_id", "award_amount_krw", "bid_amount_krw", "scheduled_price_krw").distinct()
    return X.price_ratios(df).select("award_outcome_id", "award_to_bid", "award_to_scheduled", "bid_to_scheduled")


def notice_to_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = X.days_between(day("bid_notice_date"), day("opening_date"))
    return table(spark, sf_dir, "tenders").groupBy(days.cast("long").alias("days")).agg(F.count(F.lit(1)).alias("n"))


def supplier_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each bid with its supplier's bids and wins on earlier days."""
    df = table(spark, sf_dir, "bidder_submissions").select("bid_submission_id", blank_to_null("bidder_supplier_id").alias("supplier"), day("opening_date").alias("opened"), "is_selected_winner").distinct()
    out = X.history(df.where("supplier is not null and opened is not null"), "supplier", "opened", "is_selected_winner")
    return out.select("bid_submission_id", "prior_bids", "prior_wins", F.round("prior_win_rate", 6).alias("prior_win_rate"))


def agency_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How concentrated each agency's contracts are on suppliers."""
    df = table(spark, sf_dir, "contracts").select(blank_to_null("contract_agency_code").alias("agency_code"), trimmed("contractor_supplier_id").alias("supplier"))
    return X.concentration(df.where("agency_code is not null"), "agency_code", "supplier")


def agency_bidders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bidders that each agency had on earlier days, per agency and day."""
    df = table(spark, sf_dir, "bidder_submissions").select(blank_to_null("notice_agency_code").alias("agency_code"), day("opening_date").alias("opened")).where("agency_code is not null and opened is not null")
    per_day = df.groupBy("agency_code", "opened").agg(F.count(F.lit(1)).alias("bids"))
    out = X.history(per_day.withColumn("won", F.lit(False)).drop("bids"), "agency_code", "opened", "won")
    return out.select("agency_code", F.col("opened").cast("string").alias("opened"), F.col("prior_bids").alias("prior_days"))


def named_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards with the majority name of their agency, blank where there is none."""
    names = R.most_frequent_name(table(spark, sf_dir, "tenders").select(blank_to_null("notice_agency_code").alias("code"), F.coalesce(trimmed("notice_agency_name_ko"), F.lit("")).alias("who")), "code", F.col("who"))
    df = table(spark, sf_dir, "award_outcomes").select("award_outcome_id", blank_to_null("notice_agency_code").alias("code")).distinct()
    return df.join(names.select("code", "name"), "code", "left").select("award_outcome_id", "code", F.coalesce("name", F.lit("")).alias("agency_name"))


_PRICED = f"""
with t as (select {sql_trim('bid_notice_no')} as no, {sql_trim('bid_notice_round')} as r, max(business_div_name_ko) as business_div_name_ko, max(contract_method_ko) as contract_method_ko from tenders where {sql_trim('bid_notice_no')} <> '' and {sql_trim('bid_notice_round')} <> '' group by 1, 2),
a as (select {{label}} as label, award_rate from award_outcomes a join t on {sql_trim('a.bid_notice_no')} = t.no and {sql_trim('a.bid_notice_round')} = t.r where award_rate between 0 and 100)
select label, count(*) as n, median(award_rate) as median_rate, round(avg(award_rate), 6) as mean_rate from a group by 1"""


def _priced_sql(label: str) -> str:
    return _PRICED.replace("{label}", label.replace("business_div_name_ko", "t.business_div_name_ko").replace("contract_method_ko", "t.contract_method_ko"))


_DAY_BIDS = f"select distinct bid_submission_id, {sql_trim('bidder_supplier_id')} as s, {sql_day('opening_date')} as d, is_selected_winner as w from bidder_submissions where {sql_trim('bidder_supplier_id')} <> '' and {sql_day('opening_date')} is not null"
QUERIES = {f.__name__: f for f in (notices_by_month, rates_by_division, rates_by_method, busiest_agencies, competition, price_ratios, notice_to_opening, supplier_history, agency_concentration, agency_bidders, named_awards)}
SQL = {
    "notices_by_month": f"select strftime({sql_day('bid_notice_date')}, '%Y-%m') as month, count(*) as n from tenders where {sql_day('bid_notice_date')} is not null group by 1",
    "rates_by_division": _priced_sql(_SQL_DIVISION),
    "rates_by_method": _priced_sql(_SQL_METHOD) + " order by n desc, label limit 10",
    "busiest_agencies": f"select {sql_trim('notice_agency_code')} as agency_code, count(*) as n from tenders where {sql_trim('notice_agency_code')} <> '' group by 1 order by 2 desc, 1 limit 15",
    "competition": f"select {sql_trim('bid_notice_no')} as bid_notice_no, {sql_trim('bid_notice_round')} as bid_notice_round, count(*) as bids, count(distinct coalesce(bidder_supplier_id, chr(0))) as bidders, count(distinct coalesce(bidder_supplier_id, chr(0))) = 1 as single_bid from bidder_submissions where {sql_trim('bid_notice_no')} <> '' and {sql_trim('bid_notice_round')} <> '' group by 1, 2",
    "price_ratios": "with v as (select distinct award_outcome_id, "
    + ", ".join(f"{feeds.sql_finite(c)} as {c}" for c in ("award_amount_krw", "bid_amount_krw", "scheduled_price_krw"))
    + " from award_outcomes) select award_outcome_id, round(award_amount_krw / nullif(bid_amount_krw, 0), 6) as award_to_bid, round(award_amount_krw / nullif(scheduled_price_krw, 0), 6) as award_to_scheduled, round(bid_amount_krw / nullif(scheduled_price_krw, 0), 6) as bid_to_scheduled from v",
    "notice_to_opening": f"select cast({sql_day('opening_date')} - {sql_day('bid_notice_date')} as bigint) as days, count(*) as n from tenders group by 1",
    "supplier_history": f"""
with e as ({_DAY_BIDS}),
g as (select s, d, count(*) as n, count(*) filter (w) as w from e group by 1, 2),
h as (select s, d, coalesce(sum(n) over q, 0)::bigint as b, coalesce(sum(w) over q, 0)::bigint as w from g window q as (partition by s order by d rows between unbounded preceding and 1 preceding))
select bid_submission_id, h.b as prior_bids, h.w as prior_wins, round(h.w / nullif(h.b, 0), 6) as prior_win_rate from e join h on e.s = h.s and e.d = h.d""",
    "agency_concentration": f"""
with p as (select {sql_trim('contract_agency_code')} as agency_code, {sql_trim('contractor_supplier_id')} as s, count(*) as n from contracts where {sql_trim('contract_agency_code')} <> '' group by 1, 2)
select agency_code, cast(sum(n) as bigint) as rows, count(*) as suppliers, round(sum(n * n) / (sum(n)::double * sum(n)), 8) as hhi from p group by 1""",
    "agency_bidders": f"""
with g as (select distinct {sql_trim('notice_agency_code')} as agency_code, {sql_day('opening_date')} as d from bidder_submissions where {sql_trim('notice_agency_code')} <> '' and {sql_day('opening_date')} is not null)
select agency_code, d::varchar as opened, row_number() over (partition by agency_code order by d) - 1 as prior_days from g""",
    "named_awards": f"""
with c as (select {sql_trim('notice_agency_code')} as code, {sql_trim('notice_agency_name_ko')} as name, count(*) as n from tenders where {sql_trim('notice_agency_code')} <> '' and {sql_trim('notice_agency_name_ko')} <> '' group by 1, 2),
b as (select code, name from (select *, row_number() over (partition by code order by n desc, name) as rn from c) where rn = 1),
a as (select distinct award_outcome_id, nullif({sql_trim('notice_agency_code')}, '') as code from award_outcomes)
select award_outcome_id, a.code, coalesce(b.name, '') as agency_name from a left join b on a.code = b.code""",
}
