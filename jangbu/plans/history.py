"""Queries on scopes, collected windows and what a build must reproduce."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.cleaning import award_method_label, valid_business_number
from jangbu.functions.text import blank_to_null, day
from jangbu.operators import audit as A
from jangbu.operators.features import days_between
from jangbu.operators.selection import exact_quantiles
from jangbu.plans import feeds
from jangbu.plans.references import sql_day, sql_trim
from jangbu.session import cut, shared_dir, table
from jangbu.sources import raw
from jangbu.sources.windows import fixed_windows

START, END = "2025-09-01", "2026-08-31"
FEEDS = (("tenders", "bid_notice_date", ("bid_notice_no", "bid_notice_round")), ("award_outcomes", "opening_date", ("bid_notice_no", "bid_notice_round", "winner_supplier_id")), ("contracts", "contract_date", ("unified_contract_no",)))


def history_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each feed's findings over a year, critical ones and warnings."""
    return reduce(DataFrame.unionByName, [A.feed_findings(feeds.dated(spark, sf_dir, t), t, event, keys, START, END) for t, event, keys in FEEDS])


def build_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.baselines(feeds.bids(spark, sf_dir), feeds.awards(spark, sf_dir), feeds.contract_rows(spark, sf_dir))


def null_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards without an amount by rank and group of award method."""
    df = feeds.dated(spark, sf_dir, "award_outcomes").where("award_amount_krw is null")
    return df.groupBy(F.col("opening_rank").cast("string").alias("opening_rank"), award_method_label("award_method_ko").alias("method")).agg(F.count(F.lit(1)).alias("n"))


def loose_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business numbers by length alone, beside those that are digits."""
    df = feeds.awards(spark, sf_dir).select(F.translate("bidder_business_registration_no", "-", "").alias("k"))
    return df.agg(F.count_if(F.length("k") == 10).alias("ten_long"), F.count_if(valid_business_number(F.col("k"))).alias("ten_digits"), F.count_distinct(F.when(F.length("k") == 10, F.col("k"))).alias("suppliers"))


def opening_to_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from a notice's first opening to each delivery of its contracts, counted."""
    key = [blank_to_null(c).alias(c) for c in ("bid_notice_no", "bid_notice_round")]
    opened = table(spark, sf_dir, "tenders").select(*key, day("opening_date").alias("opened")).groupBy("bid_notice_no", "bid_notice_round").agg(F.min("opened").alias("opened"))
    made = table(spark, sf_dir, "contracts").select(*key, day("contract_date").alias("made"))
    return made.join(opened, ["bid_notice_no", "bid_notice_round"]).groupBy(days_between(F.col("opened"), F.col("made")).cast("long").alias("days")).agg(F.count(F.lit(1)).alias("n"))


def median_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median of all possible award rates."""
    df = table(spark, sf_dir, "award_outcomes").where("award_rate between 0 and 100").select(F.lit("all").alias("label"), "award_rate")
    return exact_quantiles(df, ["label"], "award_rate", [0.5], continuous=True).select("label", F.col("n").alias("awards"), F.col("value").alias("median_rate"))


def scoped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract files of the first quarter by the days in their names, with their records of that quarter."""
    lines = table(spark, sf_dir, "contract_files")
    files = raw.files_in_scope(lines, "file_name", "2026-01-01", "2026-03-31")
    records = files.select("file_name", F.from_json("payload", "map<string,string>").alias("record"))
    inside = raw.records_in_scope(records, "cntrctCnclsDate", "2026-01-01", "2026-03-31")
    return files.groupBy("file_name").agg(F.count(F.lit(1)).alias("lines")).join(inside.groupBy("file_name").agg(F.count(F.lit(1)).alias("inside")), "file_name", "left").select("file_name", "lines", F.coalesce("inside", F.lit(0)).alias("inside"))


def _collected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The weeks that each stream should have files of, and the manifest of those it has; a file of few lines isn't complete."""
    lines = table(spark, sf_dir, "contract_files")
    key = lambda a, b: F.concat_ws("::", "stream_code", F.lit("all"), a, b)
    spans = lines.groupBy("stream_code").agg(F.date_sub(F.min("window_start").cast("date"), 7).alias("start"), F.max("window_end").cast("date").alias("end"))
    weeks = fixed_windows(spans, 7).select("stream_code", F.col("window_start").cast("string").alias("a"), F.col("window_end").cast("string").alias("b"))
    name = F.concat(F.lit("contracts_"), "stream_code", F.lit("_"), F.translate("a", "-", ""), F.lit("_"), F.translate("b", "-", ""), F.lit(".jsonl.gz"))
    plan = weeks.select(key(F.col("a"), F.col("b")).alias("manifest_key"), name.alias("file_name"))
    status = F.when(F.count(F.lit(1)) >= 20, "complete").otherwise("running")
    manifest = lines.groupBy("file_name", "stream_code", F.col("window_start").alias("start"), F.col("window_end").alias("end")).agg(status.alias("status"), F.count(F.lit(1)).alias("row_count"))
    return plan, manifest.withColumn("manifest_key", key(F.col("start"), F.col("end")))


def plan_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned weeks, the manifest and the files against each other, by name. The week before the first file is planned too."""
    plan, manifest = _collected(spark, sf_dir)
    return raw.plan_findings(plan, manifest, manifest.select("file_name"))


def manifest_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows and rows of the manifest within two months."""
    _, manifest = _collected(spark, sf_dir)
    inside = raw.manifest_in_scope(manifest, "2026-01-01", "2026-02-28")
    return inside.groupBy("stream_code").agg(F.count(F.lit(1)).alias("windows"), F.sum("row_count").alias("rows"))


def _written(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    folder = f"{shared_dir(spark).rstrip('/').removeprefix('file://').removeprefix('file:')}/jangbu-raw-{uuid4().hex}"
    lines = table(spark, sf_dir, "contract_files")
    return folder, cut(raw.write_window_files(lines, folder, "file_name", "line_no", "payload", "contracts"))


def window_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contract files as compressed window files, written and read again: lines, fields and window of each."""
    folder, _ = _written(spark, sf_dir)
    metas, records = raw.split_meta(raw.read_lines(spark, f"{folder}/*.jsonl.gz"))
    per = records.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("record")).alias("cells"))
    out = metas.join(per, "file", "left")
    return out.select(F.col("file").alias("file_name"), F.col("meta")["status"].alias("status"), F.col("meta")["window_start"].alias("window_start"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("cells", F.lit(0)).alias("cells"))


def checked_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window files against a plan that also has, for each stream, a week that was never collected."""
    folder, written = _written(spark, sf_dir)
    lines = table(spark, sf_dir, "contract_files")
    week = lines.select("file_name", F.lit("contracts").alias("feed"), F.lit(None).cast("string").alias("category"), "window_start", "window_end").distinct()
    never = week.groupBy("feed", "category").agg(F.min("window_start").alias("window_start"), F.min("window_end").alias("window_end")).select(F.lit("never.jsonl.gz").alias("file_name"), "feed", "category", "window_start", "window_end")
    return raw.check_windows(week.unionByName(never), folder)


def feed_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the manifest against rows that the written windows hold, and whether any was made up on the way."""
    _, written = _written(spark, sf_dir)
    _, manifest = _collected(spark, sf_dir)
    counted = manifest.select(F.lit("contracts").alias("dataset"), "row_count")
    return A.reconciliation(written.select(F.lit("contracts").alias("feed"), "rows"), counted)


def _sql_findings() -> str:
    money = {"tenders": "assigned_budget_krw estimated_price_krw", "award_outcomes": "award_amount_krw bid_amount_krw scheduled_price_krw base_amount_krw estimated_price_krw", "contracts": "contract_amount_krw total_contract_amount_krw"}
    rates = {"award_outcomes": "award_rate award_lower_limit_rate"}
    parts = []
    for t, event, keys in FEEDS:
        d = sql_day(event)
        each = {
            "no rows": "case when count(*) = 0 then 1 else 0 end", "null event": f"count(*) filter ({d} is null)", "out of scope": f"count(*) filter ({d} < date '{START}' or {d} > date '{END}')", "outside its window": "0 * count(*)",
            "repeated key": f"count(*) - (select count(*) from (select distinct {', '.join(keys)} from {t}))", "negative amount": " + ".join(f"count(*) filter ({c} < 0 and not isnan({c}))" for c in money[t].split()),
        }
        if t in rates:
            each["odd rate"] = " + ".join(f"count(*) filter (({c} < 0 or {c} > 500) and not isnan({c}))" for c in rates[t].split())
        parts += [f"select '{t}' as feed, '{k}' as finding, ({v})::bigint as n from {t}" for k, v in each.items()]
    critical = ", ".join(f"'{c}'" for c in A.CRITICAL)
    return f"select *, case when n = 0 then 'none' when finding in ({critical}) then 'critical' else 'warning' end as severity from (" + "\nunion all\n".join(parts) + ")"


_SQL_COLLECTED = """
with m as (select file_name, stream_code, window_start as a, window_end as b, stream_code || '::all::' || window_start || '::' || window_end as manifest_key, case when count(*) >= 20 then 'complete' else 'running' end as status, count(*) as row_count from contract_files group by all),
s as (select stream_code, min(a::date) - 7 as a, max(b::date) as b from m group by 1),
w as (select stream_code, x::date as a, least(b, (x + interval 6 day)::date) as b from (select stream_code, b, unnest(generate_series(a::timestamp, b::timestamp, interval 7 day)) as x from s)),
p as (select stream_code || '::all::' || a || '::' || b as manifest_key, 'contracts_' || stream_code || '_' || strftime(a, '%Y%m%d') || '_' || strftime(b, '%Y%m%d') || '.jsonl.gz' as file_name from w)
"""
_OBJECTS = "select * from contract_files where json_valid(payload) and json_type(payload) = 'OBJECT'"
QUERIES = {f.__name__: f for f in (history_audit, build_baselines, null_awards, loose_numbers, opening_to_contract, median_rate, scoped_files, plan_findings, manifest_scope, window_files, checked_windows, feed_reconciliation)}
SQL = {
    "history_audit": _sql_findings(),
    "build_baselines": f"""
with {feeds.SQL_AWARDS}, {feeds.SQL_CONTRACTS},
numbers as (select bidder_no as k from awards union select winner_no from awards union select contractor_no from contract_feed),
codes as (select {sql_trim('notice_agency_code')} as k from tenders union select {sql_trim('demand_agency_code')} from tenders union select {sql_trim('contract_agency_code')} from contracts union select {sql_trim('demand_agency_code')} from contracts)
select 'bids' as what, count(*) as n from tenders union all select 'awards', count(*) from awards union all select 'winners', count(*) from awards where is_selected_winner union all select 'contracts', count(*) from contracts
union all select 'linked_contracts', count(*) from contracts where coalesce({sql_trim('bid_notice_no')}, '') <> '' union all select 'unlinked_contracts', count(*) from contracts where coalesce({sql_trim('bid_notice_no')}, '') = ''
union all select 'suppliers', count(*) from numbers where {feeds.sql_valid('k')} union all select 'agencies', count(*) from codes where k <> ''""",
    "null_awards": "select opening_rank::varchar as opening_rank, case when contains(m, '적격심사') then 'qualification_review' when contains(m, '수의') then 'small_sum_private' when contains(m, '협상') then 'negotiation' when contains(m, '최저가') then 'lowest_price' when contains(m, '종합평가') then 'comprehensive_evaluation' else 'other' end as method, count(*) as n from (select case when not isnan(opening_rank) then opening_rank end as opening_rank, coalesce(award_method_ko, '') as m from award_outcomes where award_amount_krw is null or isnan(award_amount_krw)) group by 1, 2",
    "loose_numbers": f"select count(*) filter (length(k) = 10) as ten_long, count(*) filter ({feeds.sql_valid('k')}) as ten_digits, count(distinct case when length(k) = 10 then k end) as suppliers from (select replace({feeds.sql_number_of('bidder_supplier_id')}, '-', '') as k from bidder_submissions)",
    "opening_to_contract": f"""
with o as (select {sql_trim('bid_notice_no')} as no, {sql_trim('bid_notice_round')} as r, min({sql_day('opening_date')}) as opened from tenders group by 1, 2)
select date_diff('day', opened, made)::bigint as days, count(*) as n from (select {sql_trim('bid_notice_no')} as no, {sql_trim('bid_notice_round')} as r, {sql_day('contract_date')} as made from contracts) c join o on c.no = o.no and c.r = o.r where c.no <> '' and c.r <> '' group by 1""",
    "median_rate": "select 'all' as label, count(*) as awards, median(award_rate) as median_rate from award_outcomes where award_rate between 0 and 100",
    "scoped_files": f"""
with f as (select file_name, count(*) as lines from contract_files where regexp_extract(file_name, '([0-9]{{8}})_([0-9]{{8}})', 1) >= '20260101' and regexp_extract(file_name, '([0-9]{{8}})_([0-9]{{8}})', 2) between '00000000' and '20260331' and regexp_matches(file_name, '[0-9]{{8}}_[0-9]{{8}}') group by 1),
i as (select file_name, count(*) as inside from ({_OBJECTS}) where substr(payload ->> '$.cntrctCnclsDate', 1, 10) between '2026-01-01' and '2026-03-31' group by 1)
select file_name, lines, coalesce(inside, 0) as inside from f left join i using (file_name)""",
    "plan_findings": _SQL_COLLECTED + """
select 'missing_manifest' as finding, manifest_key as name from p where manifest_key not in (select manifest_key from m)
union all select 'missing_file', file_name from p where file_name not in (select file_name from m)
union all select 'not_complete', manifest_key from p where manifest_key in (select manifest_key from m where status <> 'complete')
union all select 'unplanned_manifest', manifest_key from m where manifest_key not in (select manifest_key from p)
union all select 'unplanned_file', file_name from m where file_name not in (select file_name from p)""",
    "manifest_scope": _SQL_COLLECTED + "select stream_code, count(*) as windows, sum(row_count)::bigint as rows from m where a >= '2026-01-01' and b <= '2026-02-28' group by 1",
    "window_files": f"select c.file_name, 'complete' as status, min(window_start) as window_start, coalesce(max(n), 0) as rows, coalesce(max(k), 0)::bigint as cells from contract_files c left join (select file_name, count(*) as n, sum(len(list_distinct(json_keys(payload)))) as k from ({_OBJECTS}) group by 1) o using (file_name) group by 1",
    "checked_windows": f"select c.file_name, true as ok, '' as reason, coalesce(max(n), 0)::bigint as rows from contract_files c left join (select file_name, count(*) as n from ({_OBJECTS}) group by 1) o using (file_name) group by 1 union all select 'never.jsonl.gz', false, 'missing file', 0",
    "feed_reconciliation": f"select 'contracts' as feed, (select count(*) from contract_files) as manifest_rows, count(*) as processed_rows, true as agrees from ({_OBJECTS})",
}
