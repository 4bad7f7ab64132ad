"""Queries on the curated tables, their gates, the merged release and the flat table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.identity import pads
from jangbu.functions.text import blank_to_null
from jangbu.operators import curate as C
from jangbu.operators import gates as G
from jangbu.operators import release as R
from jangbu.plans import feeds
from jangbu.plans.cleaning import SQL as CLEANING
from jangbu.plans.cleaning import _SQL_DIVISION, _SQL_METHOD
from jangbu.plans.references import sql_day, sql_trim
from jangbu.session import table

KEY = ["bid_notice_no", "bid_notice_round"]
START, END = "2025-10-01", "2025-12-31"


def _plain(df: DataFrame) -> DataFrame:
    """Days as text, so that every engine shows them alike."""
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema.fields if f.dataType.simpleString() in {"date", "timestamp"}})


def curated_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of one quarter with trimmed keys."""
    return _tenders(C.in_scope(feeds.bids(spark, sf_dir), "bid_notice_date", START, END))


def _tenders(bids: DataFrame) -> DataFrame:
    return _plain(C.tenders(bids).select(*KEY, "bid_title_ko", "bid_notice_date", "assigned_budget_krw", "is_joint_contract"))


def curated_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quarter's bids with surrogate keys, pseudonyms and the scope flag of that quarter's notices."""
    return _submissions(C.in_scope(feeds.bids(spark, sf_dir), "bid_notice_date", START, END), C.in_scope(feeds.awards(spark, sf_dir), "opening_date", START, END))


def _submissions(bids: DataFrame, awards: DataFrame) -> DataFrame:
    rows = C.submissions(awards, C.tenders(bids), feeds.DEMO_KEY)
    return rows.groupBy("bid_submission_id", "bidder_supplier_id", "tender_in_scope", "is_selected_winner").agg(F.count(F.lit(1)).alias("n"))


def curated_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(C.in_scope(feeds.bids(spark, sf_dir), "bid_notice_date", START, END), C.in_scope(feeds.awards(spark, sf_dir), "opening_date", START, END))


def _outcomes(bids: DataFrame, awards: DataFrame) -> DataFrame:
    rows = C.outcomes(awards, C.tenders(bids), feeds.DEMO_KEY)
    return rows.groupBy(*KEY, "winner_supplier_id", "tender_in_scope").agg(F.count(F.lit(1)).alias("awards"), F.sum(F.col("award_amount_krw").cast("decimal(28,2)")).cast("double").alias("amount"))


def curated_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contracts(C.in_scope(feeds.contract_rows(spark, sf_dir), "contract_date", START, END))


def _contracts(contracts: DataFrame) -> DataFrame:
    return _plain(C.contracts(contracts, feeds.DEMO_KEY).select("unified_contract_no", "contract_no", "contract_title_ko", "contract_date", "contract_amount_krw", "contractor_supplier_id", "contract_agency_code", "is_domestic_corp"))


def curated_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.suppliers(feeds.awards(spark, sf_dir), feeds.contract_rows(spark, sf_dir), feeds.DEMO_KEY)


def curated_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.agencies(feeds.bids(spark, sf_dir), feeds.contract_rows(spark, sf_dir))


def curated_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = C.tenders(feeds.bids(spark, sf_dir))
    return _plain(C.bridge(feeds.contract_rows(spark, sf_dir), t)).groupBy("unified_contract_no", *KEY, "match_type", "tender_in_scope").agg(F.count(F.lit(1)).alias("n"), F.max("contract_date").alias("contract_date"))


def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates over the given tables: keys, private columns, types, linked rows."""
    names = {"tenders": KEY, "award_outcomes": ["award_outcome_id"], "contracts": ["unified_contract_no"], "suppliers": ["supplier_id"], "tender_contract_bridge": ["unified_contract_no"]}
    tables = {n: table(spark, sf_dir, n) for n in names}
    rows = G.report(tables, names, linked="tender_contract_bridge")
    return spark.createDataFrame([(g["table"], g["gate"], g["passed"], g["detail"]) for g in rows], "table_name string, gate string, passed boolean, detail string")


def _months(df: DataFrame, column: str) -> list[DataFrame]:
    """Three monthly parts of a table, as a build writes them."""
    return [C.in_scope(df, column, a, b) for a, b in (("2025-10-01", "2025-10-31"), ("2025-11-01", "2025-11-30"), ("2025-12-01", "2025-12-31"))]


def merged_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months of awards merged, their scope flag made anew against the three months' notices."""
    notices = reduce(DataFrame.unionByName, _months(feeds.bids(spark, sf_dir), "bid_notice_date"))
    awards = _months(feeds.dated(spark, sf_dir, "award_outcomes").drop("load_batch"), "award_date")
    return _awards(awards, notices)


def _awards(months: list[DataFrame], notices: DataFrame) -> DataFrame:
    return _plain(R.merge_in_scope(months, notices).select("award_outcome_id", *KEY, "award_amount_krw", "award_date", "tender_in_scope").distinct())


def _monthly_suppliers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    pairs = zip(_months(feeds.awards(spark, sf_dir), "opening_date"), _months(feeds.contract_rows(spark, sf_dir), "contract_date"), strict=True)
    return [C.suppliers(a, c, feeds.DEMO_KEY).drop("names") for a, c in pairs]


def merged_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of three months put together: any role, summed counts."""
    return R.global_suppliers(_monthly_suppliers(spark, sf_dir))


def merged_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = zip(("2025_10", "2025_11", "2025_12"), _months(feeds.bids(spark, sf_dir), "bid_notice_date"), _months(feeds.contract_rows(spark, sf_dir), "contract_date"), strict=True)
    return R.global_agencies([(m, C.agencies(b, c).drop("names")) for m, b, c in pairs])


def _all_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.in_any_month(feeds.bids(spark, sf_dir), "bid_notice_date", "_month")


def _all_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.in_any_month(feeds.awards(spark, sf_dir), "opening_date", "_month")


def _all_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.in_any_month(feeds.contract_rows(spark, sf_dir), "contract_date", "_month")


def curated_tenders_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``curated_tenders`` of all months there are; so for the six that follow."""
    return _tenders(_all_bids(spark, sf_dir))


def curated_submissions_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _submissions(_all_bids(spark, sf_dir), _all_awards(spark, sf_dir))


def curated_outcomes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(_all_bids(spark, sf_dir), _all_awards(spark, sf_dir))


def curated_contracts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contracts(_all_contracts(spark, sf_dir))


def merged_awards_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months' parts of one table are that table's dated rows, so they are read in one pass."""
    return _awards([C.in_any_month(feeds.dated(spark, sf_dir, "award_outcomes").drop("load_batch"), "award_date")], _all_bids(spark, sf_dir))


def merged_suppliers_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.suppliers(_all_awards(spark, sf_dir), _all_contracts(spark, sf_dir), feeds.DEMO_KEY, ["_month"])
    return R.global_suppliers_by(rows.drop("names"), "_month")


def merged_agencies_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.agencies(_all_bids(spark, sf_dir), _all_contracts(spark, sf_dir), ["_month"])
    return R.global_agencies_by(rows.drop("names"), "_month")


def _unique_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per notice: exact repeats are dropped, of others the last delivered stays."""
    rows = feeds.bids(spark, sf_dir).withColumns({k: blank_to_null(k) for k in KEY}).dropna(subset=KEY)
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(*[F.col(k).alias(f"_{k}") for k in KEY]).agg(F.max_by(whole, F.struct("data_base_date", F.xxhash64(whole).alias("h"))).alias("r")).select("r.*")


def quickstart_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per notice with its awards and contracts."""
    notices = _unique_tenders(spark, sf_dir)
    awards = feeds.dated(spark, sf_dir, "award_outcomes").dropDuplicates(["award_outcome_id"])
    flat = R.quickstart(notices, awards, feeds.dated(spark, sf_dir, "tender_contract_bridge"))
    return _plain(flat.withColumn("mean_award_rate_pct", F.round("mean_award_rate_pct", 6)))


def quickstart_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = _unique_tenders(spark, sf_dir)
    awards = feeds.dated(spark, sf_dir, "award_outcomes").dropDuplicates(["award_outcome_id"])
    links = feeds.dated(spark, sf_dir, "tender_contract_bridge")
    rows = R.reconcile(R.quickstart(notices, awards, links), notices, awards, links)
    return spark.createDataFrame([(g["gate"], g["passed"], g["detail"]) for g in rows], "gate string, passed boolean, detail string")


_INNER, _OUTER = pads(feeds.DEMO_KEY)
_NO, _ROUND = sql_trim("bid_notice_no"), sql_trim("bid_notice_round")
_IN = f"between date '{START}' and date '{END}'"
_QUARTER_KEYS = f"qk as (select distinct {_NO} as no, {_ROUND} as r from tenders where {sql_day('bid_notice_date')} {_IN})"
_PSEUDO = lambda c: feeds.sql_pseudonym(c, _INNER, _OUTER)
_FLAT_NAME = "regexp_replace({c}, '[\\s\\x{{00A0}}\\x{{3000}}]+', ' ', 'g')"


def _sql_agencies(bids: str, contracts: str) -> str:
    roles = []
    for t, c, n, role in ((bids, "notice_agency_code", "notice_agency_name_ko", "notice"), (bids, "demand_agency_code", "demand_agency_name_ko", "demand"), (contracts, "contract_agency_code", "contract_agency_name_ko", "contract"), (contracts, "demand_agency_code", "demand_agency_name_ko", "demand")):
        roles.append(f"select {sql_trim(c)} as agency_code, coalesce({sql_trim(_FLAT_NAME.format(c=n))}, '') as who, '{role}' as role from {t} where {sql_trim(c)} <> ''")
    return f"""
roles as ({' union all '.join(roles)}),
stats as (select agency_code, bool_or(role = 'notice') as is_notice_agency, bool_or(role = 'demand') as is_demand_agency, bool_or(role = 'contract') as is_contract_agency,
  count(*) filter (role = 'notice') as snapshot_total_tenders_in_scope, count(*) filter (role = 'contract') as snapshot_total_contracts_in_scope from roles group by 1),
named as (select agency_code, who, count(*) as n from roles where who <> '' group by 1, 2),
best as (select * from (select *, row_number() over (partition by agency_code order by n desc, who) as rn, count(*) over (partition by agency_code) as names from named) where rn = 1)"""


_SUPPLIER_ROLES = """
roles as (
  select bidder_no as number, bidder_name as who, 'bidder' as role, null::double as amount from awards
  union all select winner_no, bidder_name, 'winner', null from awards where is_selected_winner
  union all select contractor_no, contractor_name, 'contractor', contract_amount_krw from contract_feed)"""
_SUPPLIER_STATS = """bool_or(role = 'bidder') as is_bidder, bool_or(role = 'winner') as is_winner, bool_or(role = 'contractor') as is_contractor,
  count(*) filter (role = 'bidder') as snapshot_total_bids_in_scope, count(*) filter (role = 'winner') as snapshot_total_wins_in_scope, count(*) filter (role = 'contractor') as snapshot_total_contracts_in_scope,
  coalesce(cast(sum(cast(amount as decimal(28,4))) as double), 0.0) as snapshot_total_contract_amount_krw"""

QUERIES = {f.__name__: f for f in (curated_tenders, curated_submissions, curated_outcomes, curated_contracts, curated_suppliers, curated_agencies, curated_bridge, gate_report, merged_awards, merged_suppliers, merged_agencies, quickstart_flat, quickstart_gates, curated_tenders_all, curated_submissions_all, curated_outcomes_all, curated_contracts_all, merged_awards_all, merged_suppliers_all, merged_agencies_all)}
_ID = CLEANING["submission_ids"]
SQL = {
    "curated_tenders": f"select {_NO} as bid_notice_no, {_ROUND} as bid_notice_round, bid_title_ko, {sql_day('bid_notice_date')}::varchar as bid_notice_date, {feeds.sql_finite('assigned_budget_krw')} as assigned_budget_krw, is_joint_contract from tenders where {sql_day('bid_notice_date')} {_IN}",
    "curated_submissions": f"""
with {_QUARTER_KEYS}, {feeds.SQL_AWARDS},
b as (select * replace ({_PSEUDO('bidder_no')} as bidder_supplier_id) from awards where opening_date {_IN})
{_ID[: _ID.index(', count(*) as n')].replace(' as id', ' as bid_submission_id')}, bidder_supplier_id,
  exists (select 1 from qk where qk.no = {sql_trim('b.bid_notice_no')} and qk.r = {sql_trim('b.bid_notice_round')}) as tender_in_scope, is_selected_winner, count(*) as n from b group by all""",
    "curated_outcomes": f"""
with {_QUARTER_KEYS}, {feeds.SQL_AWARDS}
select {_NO} as bid_notice_no, {_ROUND} as bid_notice_round, {_PSEUDO('winner_no')} as winner_supplier_id,
  exists (select 1 from qk where qk.no = {sql_trim('awards.bid_notice_no')} and qk.r = {sql_trim('awards.bid_notice_round')}) as tender_in_scope, count(*) as awards, cast(sum(cast(bid_amount_krw as decimal(28,2))) as double) as amount
from awards where is_selected_winner and opening_date {_IN} group by all""",
    "curated_contracts": f"""
with {feeds.SQL_CONTRACTS}
select {sql_trim('unified_contract_no')} as unified_contract_no, coalesce({sql_trim('contract_no')}, '') as contract_no, coalesce({sql_trim('contract_title_ko')}, '') as contract_title_ko, contract_date::varchar as contract_date, contract_amount_krw,
  {_PSEUDO('contractor_no')} as contractor_supplier_id, coalesce({sql_trim('contract_agency_code')}, '') as contract_agency_code, coalesce(is_domestic_corp, false) as is_domestic_corp from contract_feed where contract_date {_IN}""",
    "curated_suppliers": f"""
with {feeds.SQL_AWARDS}, {feeds.SQL_CONTRACTS}, {_SUPPLIER_ROLES},
valid as (select * from roles where {feeds.sql_valid('number')}),
stats as (select number, {_SUPPLIER_STATS} from valid group by 1),
named as (select number, who, count(*) as n from valid where who <> '' group by 1, 2),
best as (select * from (select *, row_number() over (partition by number order by n desc, who) as rn, count(*) over (partition by number) as names from named) where rn = 1)
select {_PSEUDO('s.number')} as supplier_id, coalesce(b.who, '') as supplier_name_ko, s.* exclude (number), coalesce(b.names, 0) as names from stats s left join best b on s.number = b.number""",
    "curated_agencies": f"with {_sql_agencies('tenders', 'contracts')} select s.agency_code, coalesce(b.who, '') as agency_name_ko, s.* exclude (agency_code), coalesce(b.names, 0) as names from stats s left join best b on s.agency_code = b.agency_code",
    "curated_bridge": f"""
with {feeds.SQL_TENDER_KEYS}
select {sql_trim('unified_contract_no')} as unified_contract_no, {_NO} as bid_notice_no, coalesce({_ROUND}, '') as bid_notice_round, 'DIRECT_NOTICE_MATCH' as match_type,
  exists (select 1 from tender_keys k where k.no = {sql_trim('c.bid_notice_no')} and k.round = {sql_trim('c.bid_notice_round')}) as tender_in_scope, count(*) as n, max({sql_day('contract_date')})::varchar as contract_date
from contracts c where {_NO} <> '' group by all""",
    "merged_awards": f"""
with qk as (select distinct {_NO} as no, {_ROUND} as r from tenders where {sql_day('bid_notice_date')} {_IN})
select distinct award_outcome_id, bid_notice_no, bid_notice_round, {feeds.sql_finite('award_amount_krw')} as award_amount_krw, {sql_day('award_date')}::varchar as award_date,
  exists (select 1 from qk where qk.no = {sql_trim('a.bid_notice_no')} and qk.r = {sql_trim('a.bid_notice_round')}) as tender_in_scope from award_outcomes a where {sql_day('award_date')} {_IN}""",
    "merged_suppliers": f"""
with {feeds.SQL_AWARDS}, {feeds.SQL_CONTRACTS},
roles as (
  select bidder_no as number, 'bidder' as role, null::double as amount from awards where opening_date {_IN}
  union all select winner_no, 'winner', null from awards where is_selected_winner and opening_date {_IN}
  union all select contractor_no, 'contractor', contract_amount_krw from contract_feed where contract_date {_IN})
select {_PSEUDO('number')} as supplier_id, {_SUPPLIER_STATS} from roles where {feeds.sql_valid('number')} group by number""",
    "merged_agencies": "with "
    + ", ".join(
        f"m{k} as (with b as (select * from tenders where {sql_day('bid_notice_date')} between date '{a}' and date '{z}'), c as (select * from contracts where {sql_day('contract_date')} between date '{a}' and date '{z}'), {_sql_agencies('b', 'c')} select {k} as month, s.*, coalesce(x.who, '') as agency_name_ko from stats s left join best x on s.agency_code = x.agency_code)"
        for k, (a, z) in enumerate((("2025-10-01", "2025-10-31"), ("2025-11-01", "2025-11-30"), ("2025-12-01", "2025-12-31")))
    )
    + """, m as (select * from m0 union all select * from m1 union all select * from m2)
select agency_code, coalesce(max_by(agency_name_ko, month) filter (agency_name_ko <> ''), '') as agency_name_ko, bool_or(is_notice_agency) as is_notice_agency, bool_or(is_demand_agency) as is_demand_agency, bool_or(is_contract_agency) as is_contract_agency,
  cast(sum(snapshot_total_tenders_in_scope) as bigint) as snapshot_total_tenders_in_scope, cast(sum(snapshot_total_contracts_in_scope) as bigint) as snapshot_total_contracts_in_scope from m group by 1""",
    "quickstart_flat": f"""
with t as (select * from (select *, row_number() over (partition by {_NO}, {_ROUND} order by {sql_day('data_base_date')} desc nulls last) as rn from tenders where {_NO} <> '' and {_ROUND} <> '') where rn = 1),
a as (select distinct award_outcome_id, {_NO} as no, {_ROUND} as r, case when award_rate between 0 and 100 then award_rate end as rate, {sql_day('award_date')} as d from award_outcomes where tender_in_scope),
aw as (select no, r, count(*) as n, count(rate) as v, median(rate) as med, avg(rate) as mean, min(d) as first, max(d) as last from a group by 1, 2),
b as (select {_NO} as no, {_ROUND} as r, count(distinct {sql_trim('unified_contract_no')}) as n, min({sql_day('contract_date')}) as first, max({sql_day('contract_date')}) as last from tender_contract_bridge where tender_in_scope group by 1, 2)
select {sql_trim('t.bid_notice_no')} as bid_notice_no, {sql_trim('t.bid_notice_round')} as bid_notice_round, bid_title_ko, {sql_day('bid_notice_date')}::varchar as bid_notice_date, business_div_name_ko, {_SQL_DIVISION} as business_division_en, contract_method_ko, {_SQL_METHOD} as contract_method_group_en,
  notice_agency_code, notice_agency_name_ko, demand_agency_code, demand_agency_name_ko, {feeds.sql_finite('assigned_budget_krw')} as assigned_budget_krw, {feeds.sql_finite('estimated_price_krw')} as estimated_price_krw, is_electronic_bid, is_international_bid, is_region_limited, is_industry_limited,
  coalesce(aw.n, 0) > 0 as has_selected_award, coalesce(aw.n, 0) as selected_award_count, coalesce(aw.v, 0) as valid_award_rate_count, aw.med as median_award_rate_pct, round(aw.mean, 6) as mean_award_rate_pct, aw.first::varchar as first_award_date, aw.last::varchar as last_award_date,
  coalesce(b.n, 0) > 0 as has_linked_contract, coalesce(b.n, 0) as linked_contract_count, b.first::varchar as first_contract_date, b.last::varchar as last_contract_date
from t left join aw on {sql_trim('t.bid_notice_no')} = aw.no and {sql_trim('t.bid_notice_round')} = aw.r left join b on {sql_trim('t.bid_notice_no')} = b.no and {sql_trim('t.bid_notice_round')} = b.r""",
}

_ALL_KEYS = f"qk as (select distinct {_NO} as no, {_ROUND} as r from tenders where {sql_day('bid_notice_date')} is not null)"


def _sql_monthly_agencies() -> str:
    """Per month and agency the majority name, and the last month's that has one; roles and counts over all months."""
    sources = (("tenders", "bid_notice_date", "notice"), ("tenders", "bid_notice_date", "demand"), ("contracts", "contract_date", "contract"), ("contracts", "contract_date", "demand"))
    roles = " union all ".join(
        f"select strftime({sql_day(d)}, '%Y_%m') as month, {sql_trim(f'{role}_agency_code')} as agency_code, coalesce({sql_trim(_FLAT_NAME.format(c=f'{role}_agency_name_ko'))}, '') as who, '{t}' as source, '{role}' as role from {t} where {sql_day(d)} is not null and {sql_trim(f'{role}_agency_code')} <> ''"
        for t, d, role in sources
    )
    return f"""
with roles as ({roles}),
named as (select agency_code, month, who, count(*) as n from roles where who <> '' group by all),
last as (select * from named qualify row_number() over (partition by agency_code order by month desc, n desc, who) = 1)
select r.agency_code, coalesce(any_value(l.who), '') as agency_name_ko, bool_or(role = 'notice') as is_notice_agency, bool_or(role = 'demand') as is_demand_agency, bool_or(role = 'contract') as is_contract_agency,
  count(*) filter (role = 'notice') as snapshot_total_tenders_in_scope, count(*) filter (role = 'contract') as snapshot_total_contracts_in_scope
from roles r left join last l on r.agency_code = l.agency_code group by 1"""


#: The queries over all months have SQL of their own; that of the quarter's stays as it is.
SQL |= {
    "curated_tenders_all": f"select {_NO} as bid_notice_no, {_ROUND} as bid_notice_round, bid_title_ko, {sql_day('bid_notice_date')}::varchar as bid_notice_date, {feeds.sql_finite('assigned_budget_krw')} as assigned_budget_krw, is_joint_contract from tenders where {sql_day('bid_notice_date')} is not null",
    "curated_submissions_all": f"""
with {_ALL_KEYS}, {feeds.SQL_AWARDS},
b as (select * replace ({_PSEUDO('bidder_no')} as bidder_supplier_id) from awards where opening_date is not null)
{_ID[: _ID.index(', count(*) as n')].replace(' as id', ' as bid_submission_id')}, bidder_supplier_id,
  exists (select 1 from qk where qk.no = {sql_trim('b.bid_notice_no')} and qk.r = {sql_trim('b.bid_notice_round')}) as tender_in_scope, is_selected_winner, count(*) as n from b group by all""",
    "curated_outcomes_all": f"""
with {_ALL_KEYS}, {feeds.SQL_AWARDS}
select {_NO} as bid_notice_no, {_ROUND} as bid_notice_round, {_PSEUDO('winner_no')} as winner_supplier_id,
  exists (select 1 from qk where qk.no = {sql_trim('awards.bid_notice_no')} and qk.r = {sql_trim('awards.bid_notice_round')}) as tender_in_scope, count(*) as awards, cast(sum(cast(bid_amount_krw as decimal(28,2))) as double) as amount
from awards where is_selected_winner and opening_date is not null group by all""",
    "curated_contracts_all": f"""
with {feeds.SQL_CONTRACTS}
select {sql_trim('unified_contract_no')} as unified_contract_no, coalesce({sql_trim('contract_no')}, '') as contract_no, coalesce({sql_trim('contract_title_ko')}, '') as contract_title_ko, contract_date::varchar as contract_date, contract_amount_krw,
  {_PSEUDO('contractor_no')} as contractor_supplier_id, coalesce({sql_trim('contract_agency_code')}, '') as contract_agency_code, coalesce(is_domestic_corp, false) as is_domestic_corp from contract_feed where contract_date is not null""",
    "merged_awards_all": f"""
with {_ALL_KEYS}
select distinct award_outcome_id, bid_notice_no, bid_notice_round, {feeds.sql_finite('award_amount_krw')} as award_amount_krw, {sql_day('award_date')}::varchar as award_date,
  exists (select 1 from qk where qk.no = {sql_trim('a.bid_notice_no')} and qk.r = {sql_trim('a.bid_notice_round')}) as tender_in_scope from award_outcomes a where {sql_day('award_date')} is not null""",
    "merged_suppliers_all": f"""
with {feeds.SQL_AWARDS}, {feeds.SQL_CONTRACTS},
roles as (
  select bidder_no as number, 'bidder' as role, null::double as amount from awards where opening_date is not null
  union all select winner_no, 'winner', null from awards where is_selected_winner and opening_date is not null
  union all select contractor_no, 'contractor', contract_amount_krw from contract_feed where contract_date is not null)
select {_PSEUDO('number')} as supplier_id, {_SUPPLIER_STATS} from roles where {feeds.sql_valid('number')} group by number""",
    "merged_agencies_all": _sql_monthly_agencies(),
}


def _sql_gates() -> str:
    keys = {"tenders": KEY, "award_outcomes": ["award_outcome_id"], "contracts": ["unified_contract_no"], "suppliers": ["supplier_id"], "tender_contract_bridge": ["unified_contract_no"]}
    parts = []
    for t, ks in keys.items():
        there = " and ".join(f"{k} is not null" for k in ks)
        parts.append(f"select '{t}' as table_name, 'primary key' as gate, n = 0 or (r = 0 and z = 0) as passed, r || ' repeated, ' || z || ' null' as detail from (select count(*) as n, count(*) filter ({there}) - (select count(*) from (select distinct {', '.join(ks)} from {t} where {there})) as r, count(*) filter (not ({there})) as z from {t})")
        parts += [f"select '{t}', '{gate}', true, ''" for gate in ("private columns", "column types")]
    blank = f"coalesce({_NO}, '') = ''"
    parts.append(f"select 'tender_contract_bridge', 'linked rows name a notice', count(*) filter ({blank}) = 0, count(*) filter ({blank}) || ' blank' from tender_contract_bridge")
    return "\nunion all\n".join(parts)


SQL["gate_report"] = _sql_gates()
SQL["quickstart_gates"] = f"""
with f as ({SQL['quickstart_flat']}),
keys as (select distinct bid_notice_no as no, bid_notice_round as r from f),
a as (select distinct award_outcome_id, {_NO} as no, {_ROUND} as r, award_rate from award_outcomes where tender_in_scope),
aw as (select * from a semi join keys using (no, r)),
b as (select distinct {_NO} as no, {_ROUND} as r, {sql_trim('unified_contract_no')} as c from tender_contract_bridge where tender_in_scope),
li as (select * from b semi join keys using (no, r)),
x as (
  select 'rows' as gate, (select count(*) from f) as got, (select count(*) from keys) as want
  union all select 'awards', (select sum(selected_award_count) from f), (select count(distinct award_outcome_id) from aw)
  union all select 'valid rates', (select sum(valid_award_rate_count) from f), (select count(distinct award_outcome_id) from aw where award_rate between 0 and 100)
  union all select 'links', (select sum(linked_contract_count) from f), (select count(*) from li))
select gate, got = want as passed, got::bigint || ' of ' || want as detail from x union all select 'no supplier', true, ''"""
