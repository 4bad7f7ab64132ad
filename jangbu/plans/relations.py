"""Queries on membership, coverage, cardinalities and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.cleaning import coded
from jangbu.functions.text import blank_to_null, day, is_blank, trimmed
from jangbu.operators import audit as A
from jangbu.operators import relational as R
from jangbu.plans import feeds
from jangbu.plans.references import sql_day, sql_trim
from jangbu.session import table

KEY = ["bid_notice_no", "bid_notice_round"]
#: Columns that belong to a bid, and what may be filled in later (fixed values), for the classes of colliding rows.
SUBMISSION_KEY = ["bid_notice_no", "bid_notice_round", "bidder_supplier_id", "opening_rank", "disqualification_reason_ko"]
RULES = (
    ("DISTINCT_SUBMISSION", "any", frozenset({"bid_amount_krw", "bid_submission_time", "bid_submission_date"})),
    ("STATUS_UPDATE", "within", frozenset({"opening_result_status_ko"})),
    ("PRICE_BACKFILL", "within", frozenset({"scheduled_price_krw", "base_amount_krw"})),
    ("LATER_DELIVERY", "within", frozenset({"opening_result_status_ko", "scheduled_price_krw", "base_amount_krw", "data_base_date", "is_selected_winner", "bid_submission_id", "tender_in_scope"})),
)
COVERAGE = (
    ("bidder_submissions", "notice_agency_code", "agencies", "agency_code"),
    ("bidder_submissions", "demand_agency_code", "agencies", "agency_code"),
    ("award_outcomes", "notice_agency_code", "agencies", "agency_code"),
    ("award_outcomes", "demand_agency_code", "agencies", "agency_code"),
    ("tenders", "notice_agency_code", "agencies", "agency_code"),
    ("contracts", "contract_agency_code", "agencies", "agency_code"),
    ("bidder_submissions", "bidder_supplier_id", "suppliers", "supplier_id"),
    ("award_outcomes", "winner_supplier_id", "suppliers", "supplier_id"),
    ("contracts", "contractor_supplier_id", "suppliers", "supplier_id"),
    ("tender_contract_bridge", "unified_contract_no", "contracts", "unified_contract_no"),
)


def scope_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bid with whether its notice exists, whatever the stale flag says, counted by both."""
    bids = table(spark, sf_dir, "bidder_submissions").withColumnRenamed("tender_in_scope", "stale_flag")
    flagged = R.flag_existing(bids, KEY, table(spark, sf_dir, "tenders"), KEY, "tender_in_scope")
    return flagged.groupBy("stale_flag", "tender_in_scope").agg(F.count(F.lit(1)).alias("n"))


def temporal_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched and unmatched notices of bids, awards and bridge rows."""
    tenders = table(spark, sf_dir, "tenders")
    parts = [R.flag_counts(R.flag_existing(table(spark, sf_dir, t), KEY, tenders, KEY, "tender_in_scope"), "tender_in_scope").select(F.lit(t).alias("table_name"), "*") for t in ("bidder_submissions", "award_outcomes", "tender_contract_bridge")]
    return reduce(DataFrame.unionByName, parts)


def key_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [R.coverage(table(spark, sf_dir, t), c, table(spark, sf_dir, d), k).select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "*") for t, c, d, k in COVERAGE]
    return reduce(DataFrame.unionByName, parts)


def feed_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = lambda t: table(spark, sf_dir, t).select(*[trimmed(k).alias(k) for k in KEY])
    return R.overlap(keyed("tenders"), keyed("bidder_submissions"), KEY)


def latest_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last delivery of each contract."""
    df = table(spark, sf_dir, "contracts").select(trimmed("unified_contract_no").alias("unified_contract_no"), day("data_base_date").alias("delivered"), "contract_amount_krw", "contract_status_ko")
    order = [F.col("delivered"), F.coalesce("contract_amount_krw", F.lit(-1e300)), F.coalesce("contract_status_ko", F.lit(""))]
    return R.keep_last(df, ["unified_contract_no"], order).withColumn("delivered", F.col("delivered").cast("string"))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines that repeat the line right before them, per file."""
    return R.consecutive_repeats(table(spark, sf_dir, "contract_files"), ["file_name"], ["line_no", "payload"], "payload")


def key_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far several column sets identify a row."""
    candidates = (("bidder_submissions", ["bid_submission_id"]), ("bidder_submissions", SUBMISSION_KEY), ("bidder_submissions", [*KEY, "bidder_supplier_id"]), ("award_outcomes", ["award_outcome_id"]), ("award_outcomes", KEY), ("contracts", ["unified_contract_no"]), ("agencies", ["agency_code"]))
    parts = [R.key_integrity(table(spark, sf_dir, t), k).select(F.lit(t).alias("table_name"), F.lit(",".join(k)).alias("key_columns"), "*") for t, k in candidates]
    return reduce(DataFrame.unionByName, parts)


def repeat_forensics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per division: rows, exact repeats, and rows that a long and a short bid key would remove."""
    df = table(spark, sf_dir, "bidder_submissions").withColumn("division", coded("business_div_name_ko"))
    return A.duplicate_counts(df, {"short_key": SUBMISSION_KEY, "long_key": [*SUBMISSION_KEY, "bid_amount_krw", "bid_submission_time"]}, ["division"])


def collision_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.collision_classes(table(spark, sf_dir, "bidder_submissions"), SUBMISSION_KEY, RULES)


def majority_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "tenders").select(blank_to_null("notice_agency_code").alias("code"), F.coalesce(trimmed(F.regexp_replace("notice_agency_name_ko", r"(?U)\s+", " ")), F.lit("")).alias("who"))
    return R.most_frequent_name(df, "code", F.col("who"))


def winner_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices with no, one and several awards."""
    counts = A.winner_cardinality(_trimmed(table(spark, sf_dir, "award_outcomes")), "winner_supplier_id")
    return A.histogram_012(counts, _trimmed(table(spark, sf_dir, "tenders")), KEY, "winner_rows")


def _trimmed(df: DataFrame) -> DataFrame:
    return df.withColumns({k: blank_to_null(k) for k in KEY})


def several_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.multi_winners(A.winner_cardinality(_trimmed(table(spark, sf_dir, "award_outcomes")), "winner_supplier_id"))


def bids_per_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.fanout(_trimmed(table(spark, sf_dir, "bidder_submissions")), KEY)


def bids_per_notice_by_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _trimmed(table(spark, sf_dir, "bidder_submissions")).withColumn("division", coded("business_div_name_ko"))
    return A.fanout(df, KEY, ["division"])


def contracts_per_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = _trimmed(table(spark, sf_dir, "contracts")).dropna(subset=KEY).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    return A.histogram_012(linked, _trimmed(table(spark, sf_dir, "tenders")), KEY, "n")


def contract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.link_summary(table(spark, sf_dir, "contracts"))


def bridge_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.bridge_cardinality(table(spark, sf_dir, "contracts"))


def supplier_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by the roles that they are seen in."""
    one = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("id"))
    return A.role_overlap({"bidder": one("bidder_submissions", "bidder_supplier_id"), "contractor": one("contracts", "contractor_supplier_id"), "winner": one("award_outcomes", "winner_supplier_id")}, "id")


def event_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw contract lines against a half year and against their own files' windows."""
    df = table(spark, sf_dir, "contract_files").select("file_name", "window_start", "window_end", day(F.get_json_object("payload", "$.cntrctCnclsDate")).alias("event"))
    return A.scope_audit(df, "event", "2025-10-01", "2026-03-31", ("window_start", "window_end"), "file_name")


def money_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [A.anomalies(table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "*") for t in ("tenders", "award_outcomes", "contracts", "bidder_submissions")])


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty emptiest columns of the tenders."""
    return A.null_ratios(table(spark, sf_dir, "tenders"), 20)


def exact_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [A.exact_repeats(table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "*") for t in ("tenders", "award_outcomes", "tender_contract_bridge", "contracts")])


def file_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows and rows per stream, as a manifest would count them, with a total."""
    files = table(spark, sf_dir, "contract_files").groupBy("stream_code", "file_name").agg(F.count(F.lit(1)).alias("row_count"))
    manifest = files.select(F.lit("contracts").alias("dataset"), F.col("stream_code").alias("category"), "row_count", F.ceil(F.col("row_count") / 500).alias("api_calls"))
    return A.collection_accounting(manifest)


def missing_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids without a rank by reason."""
    df = feeds.dated(spark, sf_dir, "bidder_submissions").where("opening_rank is null")
    return A.labelled_counts(df, F.when(is_blank("disqualification_reason_ko"), "none given").otherwise(trimmed("disqualification_reason_ko")), "reason")


def agency_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agency codes in any of four columns, and how many of them are tendering and contracting agencies both."""
    one = lambda t, c: table(spark, sf_dir, t).select(blank_to_null(c).alias("code")).where("code is not null")
    t = one("tenders", "notice_agency_code").union(one("tenders", "demand_agency_code"))
    c = one("contracts", "contract_agency_code").union(one("contracts", "demand_agency_code"))
    counts = {"in_either": t.union(c).distinct(), "in_both": t.intersect(c), "tenders_only": t.subtract(c), "contracts_only": c.subtract(t)}
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("codes")).select(F.lit(n).alias("codes_of"), "codes") for n, df in counts.items()])


_KEYS = feeds.SQL_TENDER_KEYS
_NO, _ROUND = sql_trim("bid_notice_no"), sql_trim("bid_notice_round")
_DIVISION = f"case {sql_trim('business_div_name_ko')} when '물품' then 'goods' when '외자' then 'foreign' when '공사' then 'construction' when '용역' then 'service' else 'unknown(' || coalesce({sql_trim('business_div_name_ko')}, '') || ')' end"
_SK = ", ".join(SUBMISSION_KEY)
_BID_COLUMNS = "bid_submission_id bid_notice_no bid_notice_round bidder_supplier_id tender_in_scope opening_rank disqualification_reason_ko bid_amount_krw bid_rate bid_submission_date bid_submission_time is_selected_winner bid_title_ko business_div_name_ko contract_method_ko award_method_ko notice_agency_code notice_agency_name_ko demand_agency_code demand_agency_name_ko opening_date opening_time opening_result_status_ko scheduled_price_krw base_amount_krw estimated_price_krw award_lower_limit_rate data_base_date".split()


def _sql_keyed(t: str) -> str:
    return f"(select * replace (nullif({_NO}, '') as bid_notice_no, nullif({_ROUND}, '') as bid_notice_round) from {t})"


def _sql_coverage() -> str:
    parts = []
    for t, c, d, k in COVERAGE:
        parts.append(
            f"select '{t}' as table_name, '{c}' as column_name, total, matched, total - matched as unmatched, case when total = 0 then 1.0 else round(matched / total, 4) end as coverage from "
            f"(select count(*) as total, count(*) filter ({sql_trim(c)} in (select {sql_trim(k)} from {d} where {sql_trim(k)} <> '')) as matched from {t} where {sql_trim(c)} <> '')"
        )
    return "\nunion all\n".join(parts)


def _sql_candidates() -> str:
    parts = []
    for t, keys in (("bidder_submissions", ["bid_submission_id"]), ("bidder_submissions", SUBMISSION_KEY), ("bidder_submissions", [*KEY, "bidder_supplier_id"]), ("award_outcomes", ["award_outcome_id"]), ("award_outcomes", KEY), ("contracts", ["unified_contract_no"]), ("agencies", ["agency_code"])):
        full = " and ".join(f"{k} is not null" for k in keys)
        parts.append(
            f"select '{t}' as table_name, '{','.join(keys)}' as key_columns, total, non_null, round((total - non_null) / total, 6) as null_ratio, distinct_keys, non_null - distinct_keys as duplicates, non_null = distinct_keys and non_null = total as is_unique from "
            f"(select (select count(*) from {t}) as total, (select count(*) from {t} where {full}) as non_null, (select count(*) from (select distinct {', '.join(keys)} from {t} where {full})) as distinct_keys)"
        )
    return "\nunion all\n".join(parts)


def _sql_histogram(counts: str) -> str:
    return f"""
with keys as (select distinct bid_notice_no, bid_notice_round from {_sql_keyed('tenders')}),
counts as ({counts}),
j as (select coalesce(n, 0) as n from keys k left join counts c on k.bid_notice_no = c.bid_notice_no and k.bid_notice_round = c.bid_notice_round)
select '0' as bucket, count(*) filter (n = 0) as keys from j union all select '1', count(*) filter (n = 1) from j union all select '2+', count(*) filter (n > 1) from j"""


def _sql_counts(t: str) -> str:
    return f"select bid_notice_no, bid_notice_round, count(*) as n from {_sql_keyed(t)} where bid_notice_no is not null and bid_notice_round is not null group by 1, 2"


_SQL_FANOUT = "count(*) as keys, min(n) as least, quantile_cont(n, 0.25) as p25, quantile_cont(n, 0.5) as median, round(avg(n), 2) as mean, quantile_cont(n, 0.75) as p75, quantile_cont(n, 0.9) as p90, max(n) as most"


def _sql_collisions() -> str:
    others = [c for c in _BID_COLUMNS if c not in SUBMISSION_KEY]
    diffs = ", ".join(f"case when count(distinct {c}) > 1 then '{c}' end" for c in others)
    case = []
    for name, how, columns in RULES:
        of = "[" + ", ".join(f"'{c}'" for c in sorted(columns)) + "]"
        case.append(f"when {'list_has_any(diff, ' + of + ')' if how == 'any' else 'len(list_filter(diff, lambda x: not list_contains(' + of + ', x))) = 0'} then '{name}'")
    return f"""
with g as (select count(*) as n, list_filter([{diffs}], lambda x: x is not null) as diff from (select distinct * from bidder_submissions) group by {_SK} having count(*) > 1)
select case {' '.join(case)} else 'UNRESOLVED' end as collision_class, cast(sum(n - 1) as bigint) as excess_rows from g group by 1"""


def _sql_anomalies() -> str:
    parts = []
    for t, columns in (("tenders", "assigned_budget_krw estimated_price_krw"), ("award_outcomes", "award_amount_krw award_rate bid_amount_krw scheduled_price_krw base_amount_krw estimated_price_krw award_lower_limit_rate"), ("contracts", "contract_amount_krw total_contract_amount_krw"), ("bidder_submissions", "bid_amount_krw bid_rate scheduled_price_krw base_amount_krw estimated_price_krw award_lower_limit_rate")):
        for c in columns.split():
            test, kind = (f"{c} < 0", "negative") if c.endswith("_krw") else (f"({c} < 0 or {c} > 500)", "rate_out_of_range")
            parts.append(f"select '{t}' as table_name, '{c}' as column_name, '{kind}' as kind, count(*) filter (not isnan({c}) and {test}) as n from {t}")
    return "\nunion all\n".join(parts)


_TENDER_COLUMNS = "bid_notice_no bid_notice_round bid_title_ko notice_agency_code notice_agency_name_ko demand_agency_code demand_agency_name_ko business_div_name_ko contract_method_ko contract_status_ko award_method_ko assigned_budget_krw estimated_price_krw bid_notice_date bid_notice_time bid_begin_date bid_begin_time bid_close_date bid_close_time opening_date opening_time opening_place_ko ref_notice_no ref_notice_round bid_notice_url is_joint_contract is_electronic_bid is_international_bid is_pps_notice is_region_limited is_industry_limited data_base_date load_batch".split()
_FLAG = f"exists (select 1 from tender_keys k where k.no = {sql_trim('b.bid_notice_no')} and k.round = {sql_trim('b.bid_notice_round')})"
_CODES = ("tenders", "notice_agency_code"), ("tenders", "demand_agency_code"), ("contracts", "contract_agency_code"), ("contracts", "demand_agency_code")
_CODE = [f"select {sql_trim(c)} as code from {t} where {sql_trim(c)} <> ''" for t, c in _CODES]

QUERIES = {
    f.__name__: f
    for f in (scope_flags, temporal_references, key_coverage, feed_overlap, latest_contracts, repeated_lines, key_candidates, repeat_forensics, collision_classes, majority_names, winner_histogram, several_winners, bids_per_notice, bids_per_notice_by_division, contracts_per_notice, contract_links, bridge_shape, supplier_roles, event_scope, money_anomalies, null_profile, exact_repeats, file_accounting, missing_ranks, agency_sets)
}
SQL = {
    "scope_flags": f"with {_KEYS} select b.tender_in_scope as stale_flag, {_FLAG} as tender_in_scope, count(*) as n from bidder_submissions b group by 1, 2",
    "temporal_references": f"with {_KEYS} "
    + "\nunion all\n".join(f"select table_name, total, matched, total - matched as unmatched, round(matched / total, 4) as match_ratio from (select '{t}' as table_name, count(*) as total, count(*) filter ({_FLAG}) as matched from {t} b)" for t in ("bidder_submissions", "award_outcomes", "tender_contract_bridge")),
    "key_coverage": _sql_coverage(),
    "feed_overlap": f"with a as (select distinct {_NO} as no, {_ROUND} as r from tenders), b as (select distinct {_NO} as no, {_ROUND} as r from bidder_submissions) select (select count(*) from (select * from a intersect select * from b)) as in_both, (select count(*) from (select * from a except select * from b)) as only_left, (select count(*) from (select * from b except select * from a)) as only_right",
    "latest_contracts": f"""select unified_contract_no, delivered::varchar as delivered, contract_amount_krw, contract_status_ko from (
  select *, row_number() over (partition by unified_contract_no order by delivered desc nulls last, coalesce(contract_amount_krw, -1e300) desc, coalesce(contract_status_ko, '') desc) as rn
  from (select {sql_trim('unified_contract_no')} as unified_contract_no, {sql_day('data_base_date')} as delivered, contract_amount_krw, contract_status_ko from contracts)) where rn = 1""",
    "repeated_lines": "select file_name, count(*) filter (b is not null and payload is not distinct from b) as repeats from (select file_name, payload, lag(payload) over (partition by file_name order by line_no, payload) as b from contract_files) group by 1",
    "key_candidates": _sql_candidates(),
    "repeat_forensics": f"""
with d as (select {_DIVISION} as division, * from bidder_submissions)
select division, count(*) as rows, count(*) - count(distinct (d)) as exact, count(*) - count(distinct ({_SK})) as short_key, count(*) - count(distinct ({_SK}, bid_amount_krw, bid_submission_time)) as long_key from d group by 1""",
    "collision_classes": _sql_collisions(),
    "majority_names": f"""
with c as (select {sql_trim('notice_agency_code')} as code, {sql_trim('''regexp_replace(notice_agency_name_ko, '[\\s\\x{00A0}\\x{3000}]+', ' ', 'g')''')} as name, count(*) as n from tenders where {sql_trim('notice_agency_code')} <> '' and {sql_trim('notice_agency_name_ko')} <> '' group by 1, 2)
select code, name, names from (select *, row_number() over (partition by code order by n desc, name) as rn, count(*) over (partition by code) as names from c) where rn = 1""",
    "winner_histogram": _sql_histogram(_sql_counts("award_outcomes")),
    "several_winners": f"select count(*) as notices, max(r) as most_rows, max(w) as most_winners from (select count(*) as r, count(distinct nullif({sql_trim('''replace(winner_supplier_id, '-', '')''')}, '')) as w from {_sql_keyed('award_outcomes')} where bid_notice_no is not null and bid_notice_round is not null group by bid_notice_no, bid_notice_round having count(*) > 1)",
    "bids_per_notice": f"select {_SQL_FANOUT} from ({_sql_counts('bidder_submissions')})",
    "bids_per_notice_by_division": f"select division, {_SQL_FANOUT} from (select {_DIVISION} as division, bid_notice_no, bid_notice_round, count(*) as n from {_sql_keyed('bidder_submissions')} where bid_notice_no is not null and bid_notice_round is not null group by 1, 2, 3) group by 1",
    "contracts_per_notice": _sql_histogram(_sql_counts("contracts")),
    "contract_links": f"select contracts, linked, contracts - linked as unlinked, round(linked / contracts, 4) as link_ratio, round((contracts - linked) / contracts, 4) as unlinked_ratio from (select count(*) as contracts, count(*) filter ({_NO} <> '') as linked from contracts)",
    "bridge_shape": f"""
with l as (select unified_contract_no, count(distinct bid_notice_no) as n from contracts where {_NO} <> '' and unified_contract_no is not null group by 1)
select (select count(*) from contracts where coalesce({_NO}, '') = '') as none, count(*) filter (n = 1) as one, count(*) filter (n > 1) as several,
  case when count(*) filter (n > 1) = 0 then 'Tender (1) : Contract (0..N)' else 'Tender (M) : Contract (N)' end as relationship,
  case when count(*) filter (n > 1) = 0 then 'unified_contract_no' else '(bid_notice_no, bid_notice_round, unified_contract_no)' end as bridge_key from l""",
    "supplier_roles": f"""
with r as (select {sql_trim('bidder_supplier_id')} as k, 'bidder' as role from bidder_submissions union select {sql_trim('contractor_supplier_id')}, 'contractor' from contracts union select {sql_trim('winner_supplier_id')}, 'winner' from award_outcomes)
select roles, count(*) as keys from (select k, string_agg(role, ',' order by role) as roles from r where k <> '' group by 1) group by 1""",
    "event_scope": f"""
with e as (select file_name, window_start::date as a, window_end::date as b, {sql_day("case when json_valid(payload) then payload ->> '$.cntrctCnclsDate' end")} as d from contract_files)
select count(*) as rows, count(*) filter (d is null) as null_events, count(*) filter (d < date '2025-10-01' or d > date '2026-03-31') as out_of_scope, count(*) filter (d < a or d > b) as window_violations,
  min(d)::varchar as first_event, max(d)::varchar as last_event, count(distinct file_name) as files from e""",
    "money_anomalies": _sql_anomalies(),
    "null_profile": "select column_name, null_ratio from (" + "\nunion all\n".join(f"select '{c}' as column_name, round((count(*) - count({c})) / count(*), 6) as null_ratio from tenders" for c in _TENDER_COLUMNS) + ") order by null_ratio desc, column_name limit 20",
    "exact_repeats": "\nunion all\n".join(f"select '{t}' as table_name, count(*) as rows, count(*) - (select count(*) from (select distinct * from {t})) as repeats from {t}" for t in ("tenders", "award_outcomes", "tender_contract_bridge", "contracts")),
    "file_accounting": "with m as (select 'contracts' as dataset, stream_code as category, count(*) as r from contract_files group by 2, file_name) select dataset, category, count(*) as windows, cast(sum(r) as bigint) as rows, cast(sum(ceil(r / 500)) as bigint) as api_calls, count(*) filter (r > 0) as nonempty from m group by rollup (dataset, category)",
    "missing_ranks": f"select case when coalesce({sql_trim('disqualification_reason_ko')}, '') = '' then 'none given' else {sql_trim('disqualification_reason_ko')} end as reason, count(*) as n from bidder_submissions where opening_rank is null or isnan(opening_rank) group by 1",
    "agency_sets": f"""
with t as ({_CODE[0]} union {_CODE[1]}), c as ({_CODE[2]} union {_CODE[3]})
select 'in_either' as codes_of, count(*) as codes from (select * from t union select * from c) union all select 'in_both', count(*) from (select * from t intersect select * from c)
union all select 'tenders_only', count(*) from (select * from t except select * from c) union all select 'contracts_only', count(*) from (select * from c except select * from t)""",
}
