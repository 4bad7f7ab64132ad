"""Queries that write what a build writes, a stream, a report, the flat file, receipts, and read it back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.operators import audit as A
from jangbu.plans import feeds, files
from jangbu.plans.curation import SQL as CURATION
from jangbu.plans.curation import quickstart_flat
from jangbu.plans.references import sql_day, sql_trim
from jangbu.session import shared_dir, table
from jangbu.sources import raw, sinks
from jangbu.sources.report import normalized_report, read_report
from jangbu.sources.schemas import BIDDER_REPORT
from jangbu.streaming.windows import stream_windows

COUNTED = ("tenders", "award_outcomes", "contracts", "suppliers", "agencies", "tender_contract_bridge")


def _folder(spark: SparkSession, what: str) -> str:
    """A new folder that all tasks share."""
    return f"{shared_dir(spark).rstrip('/').removeprefix('file://').removeprefix('file:')}/jangbu-{what}-{uuid4().hex}"


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contract files arriving as window files, half of them before a first run of the stream and half before a second,
    which does only what is new: rows, contracts and amounts per file and month."""
    base = _folder(spark, "stream")
    lines = table(spark, sf_dir, "contract_files")
    half = F.pmod(F.crc32("file_name"), F.lit(2))
    for k in (0, 1):
        raw.write_window_files(lines.where(half == k), f"{base}/raw", "file_name", "line_no", "payload", "contracts").count()
        stream_windows(spark, f"{base}/raw", "contracts", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    rows = spark.read.option("mergeSchema", True).parquet(f"{base}/out")
    month = F.lpad(F.col("month").cast("string"), 2, "0")
    return rows.groupBy("_source_file", F.col("year").cast("string").alias("year"), month.alias("month")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("unified_contract_no").alias("contracts"), F.count("contract_amount_krw").alias("amounts"))


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bids as a bidder report under its own Korean headers, written as one CSV, read and typed again."""
    header = {own: source for source, own in BIDDER_REPORT}
    df = feeds.dated(spark, sf_dir, "bidder_submissions")
    text = {"bid_notice_no": F.col("bid_notice_no"), "bid_notice_round": F.col("bid_notice_round"), "bid_title_ko": F.col("bid_title_ko"), "estimated_price_krw": F.format_number("estimated_price_krw", 0), "opening_rank": F.col("opening_rank").cast("int").cast("string"), "is_selected_winner": F.when(F.col("is_selected_winner"), "Y").when(~F.col("is_selected_winner"), "N"), "opening_date": F.date_format("opening_date", "yyyy/MM/dd")}
    path = f"{_folder(spark, 'report')}/report.csv"
    sinks.write_csv(df.select(*[v.alias(header[k]) for k, v in text.items()]), path)
    out = normalized_report(read_report(spark, path))
    return out.groupBy("is_selected_winner", F.date_format("opening_date", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("rows"), F.count("estimated_price_krw").alias("prices"), F.max("opening_rank").alias("last_rank"), F.count_distinct("bid_notice_no").alias("notices"))


def quickstart_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table as one CSV, read back by its header."""
    path = f"{_folder(spark, 'flat')}/quickstart.csv"
    flat = quickstart_flat(spark, sf_dir)
    sinks.write_csv(flat, path)
    sinks.require_header(path, flat.columns)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", "\\").csv(path)
    number = lambda c: F.sum(F.col(c).cast("long"))
    return back.groupBy("business_division_en").agg(F.count(F.lit(1)).alias("notices"), number("selected_award_count").alias("awards"), number("linked_contract_count").alias("contracts"), F.count("first_award_date").alias("awarded"))


def table_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of tables as written sorted and read back, as their receipts state them."""
    base, out = _folder(spark, "receipts"), []
    for name in COUNTED:
        df = table(spark, sf_dir, name)
        sinks.write_sorted(df, f"{base}/{name}", [df.columns[0]])
        back = spark.read.parquet(f"{base}/{name}")
        r, before = sinks.table_receipt(back, f"{base}/{name}"), sinks.table_receipt(df)
        out.append((name, r["rows"], r["columns"], r["content"] == before["content"] and r["bytes"] > 0))
    return spark.createDataFrame(out, "table_name string, rows long, columns long, same_content boolean")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report of a table, read from its file: rows, repeats and what is critical."""
    reports, critical = A.quality_of_files(spark, [f"{sf_dir}/award_outcomes.parquet", f"{sf_dir}/no_such_table.parquet"], ["award_outcome_id"])
    rows = [(r["source"].rsplit("/", 1)[1], r.get("rows"), r.get("repeats"), len(r["critical"]), (r.get("keys") or {}).get("award_outcome_id", {}).get("distinct_keys")) for r in reports]
    return spark.createDataFrame(rows, "source string, rows long, repeats long, critical long, distinct_keys long")


_MONEY = "award_amount_krw bid_amount_krw scheduled_price_krw base_amount_krw estimated_price_krw".split()
QUERIES = {f.__name__: f for f in (streamed_windows, report_rows, quickstart_file, table_receipts, quality_report)}
SQL = {
    "streamed_windows": files.SQL["built_contracts"],
    "report_rows": f"""
with b as (select *, {feeds.sql_finite('estimated_price_krw')} as price, {feeds.sql_finite('opening_rank')} as rank, strptime({sql_day('opening_date')}::varchar, '%Y-%m-%d') as d from bidder_submissions)
select is_selected_winner, strftime(d, '%Y-%m') as month, count(*) as rows, count(price) as prices, max(rank) as last_rank, count(distinct nullif({sql_trim('bid_notice_no')}, '')) as notices from b group by 1, 2""",
    "quickstart_file": f"select business_division_en, count(*) as notices, sum(selected_award_count)::bigint as awards, sum(linked_contract_count)::bigint as contracts, count(first_award_date) as awarded from ({CURATION['quickstart_flat']}) group by 1",
    "table_receipts": "\nunion all\n".join(f"select '{t}' as table_name, (select count(*) from {t}) as rows, (select count(*) from (describe {t})) as columns, true as same_content" for t in COUNTED),
    "quality_report": f"select 'award_outcomes.parquet' as source, count(*) as rows, count(*) - (select count(*) from (select distinct * from award_outcomes)) as repeats, {' + '.join(f'(count(*) filter ({c} < 0 and not isnan({c})) > 0)::bigint' for c in _MONEY)} as critical, count(distinct award_outcome_id) as distinct_keys from award_outcomes union all select 'no_such_table.parquet', null, null, 1, null",
}
