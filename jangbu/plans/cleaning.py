"""Queries on cleaning, labels and identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions import cleaning as C
from jangbu.functions.identity import outcome_id, pads, submission_id, supplier_pseudonym
from jangbu.functions.text import day, is_blank
from jangbu.operators.features import shares
from jangbu.plans import feeds
from jangbu.plans.references import sql_day, sql_trim
from jangbu.session import table

N = lambda: F.count(F.lit(1)).alias("n")


def clean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of the raw contract lines as numbers, per file: how many are, how many aren't, and their sum."""
    lines = table(spark, sf_dir, "contract_files").select("file_name", F.get_json_object("payload", "$.cntrctAmt").alias("t"))
    v = C.number("t")
    return lines.where("t is not null").groupBy("file_name").agg(F.count(v).alias("numbers"), F.count_if(v.isNull()).alias("others"), F.sum(v.cast("decimal(28,2)")).cast("double").alias("total"))


def clean_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in several notations as one type, counted by month."""
    return table(spark, sf_dir, "tenders").groupBy(F.date_format(C.moment("data_base_date"), "yyyy-MM-dd").alias("day")).agg(N())


def clean_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "contract_files").select(F.get_json_object("payload", "$.cmmnCntrctYn").alias("t"))
    return lines.groupBy(C.flag("t").alias("flag")).agg(N())


def masked_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = feeds.business_number_of("supplier_id")
    with_hyphens = F.concat(F.substring(number, 1, 3), F.lit("-"), F.substring(number, 4, 2), F.lit("-"), F.substring(number, 6, 5))
    return table(spark, sf_dir, "suppliers").select("supplier_id", C.masked_business_number(with_hyphens).alias("masked"), C.valid_business_number(with_hyphens).alias("valid")).distinct()


def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "agencies").groupBy(C.name("agency_name_ko").alias("name")).agg(N())


def division_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "tenders")
    return df.groupBy(C.division_label("business_div_name_ko").alias("division"), C.method_label("contract_method_ko").alias("method")).agg(N())


def controlled_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "award_outcomes").groupBy(C.coded("business_div_name_ko").alias("term")).agg(N())


def unlinked_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts without a notice by method."""
    return table(spark, sf_dir, "contracts").where(is_blank("bid_notice_no")).groupBy(C.method_prefix_label("contract_method_ko").alias("method")).agg(N())


def event_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition that their event day goes to, with the default for those without one."""
    year, month = C.year_month(day("award_date"))
    return table(spark, sf_dir, "award_outcomes").groupBy(year.alias("year"), month.alias("month")).agg(N())


def hidden_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat("contract_info_url", F.lit("?ServiceKey="), "contract_no", F.lit("&type=json"))
    return table(spark, sf_dir, "contracts").select("unified_contract_no", C.secrets_hidden(url).alias("url")).distinct()


def supplier_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = feeds.business_number_of("supplier_id")
    return table(spark, sf_dir, "suppliers").select("supplier_id", supplier_pseudonym(number, feeds.DEMO_KEY).alias("pseudonym")).distinct()


def submission_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.dated(spark, sf_dir, "bidder_submissions").select(submission_id(F.col("bidder_supplier_id")).alias("id")).groupBy("id").agg(N())


def outcome_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.dated(spark, sf_dir, "award_outcomes").select(outcome_id(F.col("winner_supplier_id")).alias("id")).groupBy("id").agg(N())


def division_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(table(spark, sf_dir, "tenders"), C.division_label("business_div_name_ko"))


_SQL_DIVISION = f"""case when coalesce({sql_trim('business_div_name_ko')}, '') = '' then 'Unknown' when contains(business_div_name_ko, '용역') then 'Services' when contains(business_div_name_ko, '공사') then 'Construction'
  when contains(business_div_name_ko, '물품') then 'Goods' when contains(business_div_name_ko, '외자') then 'Foreign supplies' else {sql_trim('business_div_name_ko')} end"""
_SQL_METHOD = f"""case when coalesce({sql_trim('contract_method_ko')}, '') = '' then 'Unknown' when contains(contract_method_ko, '수의') then 'Direct / negotiated'
  when contains(contract_method_ko, '제한') and contains(contract_method_ko, '경쟁') then 'Restricted competition' when contains(contract_method_ko, '일반') and contains(contract_method_ko, '경쟁') then 'Open competition'
  when contains(contract_method_ko, '지명') and contains(contract_method_ko, '경쟁') then 'Selective competition' else {sql_trim('contract_method_ko')} end"""


def _sql_part(column: str) -> str:
    return f"to_json(coalesce(nullif({sql_trim(column)}, ''), '__NULL__'))"


def _sql_fixed(column: str, places: int) -> str:
    return f"to_json(case when {column} is null or isnan({column}) then '__NULL__' else printf('%.{places}f', {column}) end)"


_INNER, _OUTER = pads(feeds.DEMO_KEY)
QUERIES = {f.__name__: f for f in (clean_numbers, clean_moments, clean_flags, masked_numbers, normalized_names, division_labels, controlled_terms, unlinked_methods, event_partitions, hidden_secrets, supplier_pseudonyms, submission_ids, outcome_ids, division_mix)}
SQL = {
    "clean_numbers": f"""
with t as (select file_name, payload ->> '$.cntrctAmt' as t from contract_files where json_valid(payload)),
v as (select file_name, trim(replace(replace(t, ',', ''), '%', '')) as b from t where t is not null),
n as (select file_name, case when regexp_matches(b, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') then try_cast(b as double) end as v from v)
select file_name, count(v) as numbers, count(*) filter (v is null) as others, cast(sum(cast(v as decimal(28,2))) as double) as total from n group by 1""",
    "clean_moments": f"select strftime({sql_day('data_base_date')}, '%Y-%m-%d') as day, count(*) as n from tenders group by 1",
    "clean_flags": "select case when t in ('Y', 'y', '1', '여', 'TRUE', 'True', 'true') then true when t in ('N', 'n', '0', '부', 'FALSE', 'False', 'false') then false end as flag, count(*) as n from (select trim(case when json_valid(payload) then payload ->> '$.cmmnCntrctYn' end) as t from contract_files) group by 1",
    "masked_numbers": f"select distinct supplier_id, case when {feeds.sql_valid('b')} then substr(b, 1, 3) || '-' || substr(b, 4, 2) || '-*****' else '' end as masked, {feeds.sql_valid('b')} as valid from (select supplier_id, {feeds.sql_number_of('supplier_id')} as b from suppliers)",
    "normalized_names": f"select {sql_trim('''regexp_replace(agency_name_ko, '[\\s\\x{00A0}\\x{3000}\\x{2000}-\\x{200A}\\x{202F}\\x{205F}\\x{1680}\\x{0085}\\x{2028}\\x{2029}]+', ' ', 'g')''')} as name, count(*) as n from agencies group by 1",
    "division_labels": f"select {_SQL_DIVISION} as division, {_SQL_METHOD} as method, count(*) as n from tenders group by 1, 2",
    "controlled_terms": f"select case {sql_trim('business_div_name_ko')} when '물품' then 'goods' when '외자' then 'foreign' when '공사' then 'construction' when '용역' then 'service' else 'unknown(' || coalesce({sql_trim('business_div_name_ko')}, '') || ')' end as term, count(*) as n from award_outcomes group by 1",
    "unlinked_methods": f"""select case when m = '' then '알수없음 (unknown)' when starts_with(m, '수의계약') then '수의계약 (private_contract)' when starts_with(m, '제한경쟁') then '제한경쟁 (restricted_competitive)'
  when starts_with(m, '일반경쟁') then '일반경쟁 (general_competitive)' when starts_with(m, '지명경쟁') then '지명경쟁 (limited_competitive)' else m || ' (other)' end as method, count(*) as n
from (select coalesce({sql_trim('contract_method_ko')}, '') as m from contracts where coalesce({sql_trim('bid_notice_no')}, '') = '') group by 1""",
    "event_partitions": f"select coalesce(strftime(d, '%Y'), 'unknown') as year, coalesce(strftime(d, '%m'), '01') as month, count(*) as n from (select {sql_day('award_date')} as d from award_outcomes) group by 1, 2",
    "hidden_secrets": "select distinct unified_contract_no, case when contract_no is not null then contract_info_url || '?ServiceKey=[REDACTED]&type=json' end as url from contracts",
    "supplier_pseudonyms": f"select distinct supplier_id, {feeds.sql_pseudonym('b', _INNER, _OUTER)} as pseudonym from (select supplier_id, {feeds.sql_number_of('supplier_id')} as b from suppliers)",
    "submission_ids": f"""select 'BID_' || substr(sha256('{{"bid_amount_krw":' || {_sql_fixed('bid_amount_krw', 2)} || ',"bid_notice_no":' || {_sql_part('bid_notice_no')} || ',"bid_notice_round":' || {_sql_part('bid_notice_round')} || ',"bid_submission_time":' || {_sql_part('bid_submission_time')}
  || ',"bidder_supplier_id":' || {_sql_part('bidder_supplier_id')} || ',"disqualification_reason":' || {_sql_part('disqualification_reason_ko')} || ',"entity":"bid_submission","opening_rank":' || {_sql_fixed('opening_rank', 0)} || ',"version":1}}'), 1, 32) as id, count(*) as n from bidder_submissions group by 1""",
    "outcome_ids": f"""select 'AWD_' || substr(sha256('{{"award_amount_krw":' || {_sql_fixed('award_amount_krw', 2)} || ',"bid_notice_no":' || {_sql_part('bid_notice_no')} || ',"bid_notice_round":' || {_sql_part('bid_notice_round')} || ',"bid_submission_time":' || {_sql_part('bid_submission_time')}
  || ',"entity":"award_outcome","version":1,"winner_supplier_id":' || {_sql_part('winner_supplier_id')} || '}}'), 1, 32) as id, count(*) as n from award_outcomes group by 1""",
    "division_mix": f"select label, n, round(100 * n / sum(n) over (), 4) as share_pct from (select {_SQL_DIVISION} as label, count(*) as n from tenders group by 1)",
}
