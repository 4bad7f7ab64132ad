"""Queries on windows, raw lines, envelopes and normalisation."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.text import day
from jangbu.operators.normalize import normalized
from jangbu.plans.references import sql_day
from jangbu.session import cut, shared_dir, table
from jangbu.sources.envelope import from_json_envelope, from_xml_envelope
from jangbu.sources.sinks import write_partitioned
from jangbu.sources.windows import fixed_windows, month_windows, plan

FIRST, LAST = date(2025, 9, 1), date(2026, 8, 31)


def collection_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of all feeds over a year."""
    return plan(spark, FIRST, LAST).withColumns({"window_start": F.col("window_start").cast("string"), "window_end": F.col("window_end").cast("string")})


def agency_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each agency's time of activity cut at month ends."""
    spans = table(spark, sf_dir, "tenders").select("notice_agency_code", day("bid_notice_date").alias("d")).where("d is not null and notice_agency_code is not null").groupBy("notice_agency_code").agg(F.min("d").alias("start"), F.max("d").alias("end"))
    return month_windows(spans).select("notice_agency_code", F.col("window_start").cast("string").alias("window_start"), F.col("window_end").cast("string").alias("window_end"))


def stream_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weeks that each stream should have files of."""
    spans = table(spark, sf_dir, "contract_files").groupBy("stream_code").agg(F.min("window_start").cast("date").alias("start"), F.max("window_end").cast("date").alias("end"))
    return fixed_windows(spans, 7).select("stream_code", F.col("window_start").cast("string").alias("window_start"), F.col("window_end").cast("string").alias("window_end"))


def _contract_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "contract_files")
    records = lines.select(F.col("file_name").alias("file"), F.col("line_no").cast("long").alias("pos"), F.from_json("payload", "map<string,string>").alias("record")).where("record is not null")
    metas = lines.groupBy(F.col("file_name").alias("file")).agg(F.create_map(F.lit("window_start"), F.min("window_start"), F.lit("window_end"), F.min("window_end")).alias("meta"))
    return normalized(records, metas, "contracts")


def normalized_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw contract lines under the feed's own names, typed, the last line of each contract in each file."""
    rows = _contract_feed(spark, sf_dir)
    return rows.select("_source_file", "unified_contract_no", F.date_format("contract_date", "yyyy-MM-dd").alias("contract_date"), "contract_amount_krw", "total_contract_amount_krw", "is_joint_contract", "_window_start", "year", "month")


def built_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed table after three builds whose files share months: one half of the files, all of them, the first half again
    by force; read back from disk, rows and amounts per file and month."""
    path = f"{shared_dir(spark).rstrip('/')}/jangbu-built-{uuid4().hex}"
    rows = cut(_contract_feed(spark, sf_dir).select("_source_file", "unified_contract_no", "contract_amount_krw", "year", "month"))
    half = F.pmod(F.crc32("_source_file"), F.lit(2)) == 0
    for part, force in ((rows.where(half), False), (rows, False), (rows.where(half), True)):
        write_partitioned(part, path, force=force)
    return spark.read.parquet(path).groupBy("_source_file", F.col("year").cast("string").alias("year"), F.lpad(F.col("month").cast("string"), 2, "0").alias("month")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("unified_contract_no").alias("contracts"), F.count("contract_amount_krw").alias("amounts"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as the source would answer: the lines of a file in an envelope."""
    lines = table(spark, sf_dir, "contract_files")
    return lines.groupBy("file_name").agg(F.array_sort(F.collect_list(F.struct("line_no", "payload"))).alias("p"), F.count(F.lit(1)).alias("n"))


def json_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat_ws(",", F.transform("p", lambda x: x["payload"]))
    payload = F.concat(F.lit('{"response":{"header":{"resultCode":"00","resultMsg":"OK"},"body":{"items":{"item":['), body, F.lit(']},"totalCount":"'), F.col("n").cast("string"), F.lit('"}}}'))
    out = from_json_envelope(_pages(spark, sf_dir).select("file_name", payload.alias("payload")), "payload")
    return out.select("file_name", "total", "code", "message", F.size("items").cast("long").alias("items"), F.col("items")[0]["untyCntrctNo"].alias("first_contract"))


def xml_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.transform("p", lambda x: F.concat(F.lit("<item><untyCntrctNo>"), F.get_json_object(x["payload"], "$.untyCntrctNo"), F.lit("</untyCntrctNo></item>")))
    payload = F.concat(F.lit("<response><header><resultCode>00</resultCode><resultMsg>OK</resultMsg></header><body><items>"), F.concat_ws("", number), F.lit("</items><totalCount>"), F.col("n").cast("string"), F.lit("</totalCount></body></response>"))
    out = from_xml_envelope(_pages(spark, sf_dir).select("file_name", payload.alias("payload")), "payload")
    return out.select("file_name", "total", "code", F.size("items").cast("long").alias("items"), F.col("items")[0]["untyCntrctNo"].alias("first_contract"))


_FIRST_LINE = "select file_name, count(*) as total, '00' as code{message}, count(*) as items, arg_min(payload ->> '$.untyCntrctNo', line_no) as first_contract from contract_files group by 1"


def _sql_first_present(names: list[str]) -> str:
    cases = " ".join(f"when list_contains(fields, '{n}') then payload ->> '$.{n}'" for n in names)
    return f"case {cases} end"


def _sql_number(text: str) -> str:
    bare = f"trim(replace(replace({text}, ',', ''), '%', ''))"
    return f"case when regexp_matches({bare}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') then try_cast({bare} as double) end"


_SQL_MOMENT = "coalesce(" + ", ".join(f"case when length(d) = {n} then try_strptime(d, '{f}') end" for n, f in ((10, "%Y-%m-%d"), (8, "%Y%m%d"), (10, "%Y/%m/%d"), (10, "%Y.%m.%d"))) + ")"
QUERIES = {f.__name__: f for f in (collection_plan, agency_months, stream_weeks, normalized_contracts, built_contracts, json_envelopes, xml_envelopes)}
SQL = {
    "collection_plan": f"""
with m as (select greatest(x::date, date '{FIRST}') as a, least((x + interval 1 month - interval 1 day)::date, date '{LAST}') as b from generate_series(timestamp '2025-09-01', timestamp '2026-08-01', interval 1 month) t(x)),
d as (select x::date as a, x::date as b from generate_series(timestamp '{FIRST}', timestamp '{LAST}', interval 1 day) t(x)),
w as (select x::date as a, least((x + interval 6 day)::date, date '{LAST}') as b from generate_series(timestamp '{FIRST}', timestamp '{LAST}', interval 7 day) t(x)),
p as (
  select 'bids' as feed, 'getDataSetOpnStdBidPblancInfo' as operation, null::varchar as category, 'all' as label, a, b, true as minutes from m
  union all select 'awards', 'getDataSetOpnStdScsbidInfo', c, l, a, b, true from d, (values ('1', 'goods'), ('2', 'foreign'), ('3', 'construction'), ('5', 'service')) v(c, l)
  union all select 'contracts', 'getDataSetOpnStdCntrctInfo', null, 'all', a, b, false from w)
select feed, operation, category, label, a::varchar as window_start, b::varchar as window_end, strftime(a, '%Y%m%d') || case when minutes then '0000' else '' end as start_value, strftime(b, '%Y%m%d') || case when minutes then '2359' else '' end as end_value,
  feed || '_' || label || '_' || strftime(a, '%Y%m%d') || '_' || strftime(b, '%Y%m%d') || '.jsonl.gz' as file_name, feed || '::' || coalesce(category, 'all') || '::' || a || '::' || b as manifest_key from p""",
    "agency_months": f"""
with s as (select notice_agency_code, min(d) as a, max(d) as b from (select notice_agency_code, {sql_day('bid_notice_date')} as d from tenders) where d is not null and notice_agency_code is not null group by 1),
m as (select notice_agency_code, a, b, unnest(generate_series(date_trunc('month', a)::timestamp, b::timestamp, interval 1 month)) as x from s)
select notice_agency_code, greatest(a, x::date)::varchar as window_start, least(b, (x + interval 1 month - interval 1 day)::date)::varchar as window_end from m""",
    "stream_weeks": """
with s as (select stream_code, min(window_start)::date as a, max(window_end)::date as b from contract_files group by 1),
m as (select stream_code, b, unnest(generate_series(a::timestamp, b::timestamp, interval 7 day)) as x from s)
select stream_code, x::date::varchar as window_start, least(b, (x + interval 6 day)::date)::varchar as window_end from m""",
    "normalized_contracts": f"""
with l as (select * from contract_files where json_valid(payload) and json_type(payload) = 'OBJECT'),
f as (select file_name, list_distinct(flatten(list(json_keys(payload)))) as fields, min(window_start) as ws from l group by 1),
k as (select * from (select l.*, row_number() over (partition by file_name, payload ->> '$.untyCntrctNo' order by line_no desc) as rn from l) where rn = 1),
v as (select k.file_name, f.ws, k.payload ->> '$.untyCntrctNo' as no, {_sql_first_present(['cntrctCnclsDate'])} as d, {_sql_number(_sql_first_present(['cntrctAmt']))} as amt, {_sql_number(_sql_first_present(['ttalCntrctAmt', 'totCntrctAmt']))} as total, {_sql_first_present(['cmmnCntrctYn'])} as j
  from k join f on k.file_name = f.file_name),
t as (select *, {_SQL_MOMENT} as ts from v)
select file_name as _source_file, no as unified_contract_no, strftime(ts, '%Y-%m-%d') as contract_date, amt as contract_amount_krw, total as total_contract_amount_krw,
  case when j in ('Y', 'y', '1', '여', 'TRUE', 'True', 'true') then true when j in ('N', 'n', '0', '부', 'FALSE', 'False', 'false') then false end as is_joint_contract,
  ws as _window_start, coalesce(strftime(ts, '%Y'), substr(ws, 1, 4)) as year, coalesce(strftime(ts, '%m'), substr(ws, 6, 2)) as month from t""",
    "json_envelopes": _FIRST_LINE.replace("{message}", ", 'OK' as message"),
    "xml_envelopes": _FIRST_LINE.replace("{message}", ""),
}
SQL["built_contracts"] = f"select _source_file, year, month, count(*) as rows, count(distinct unified_contract_no) as contracts, count(contract_amount_krw) as amounts from ({SQL['normalized_contracts']}) group by all"
