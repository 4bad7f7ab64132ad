"""Profiles of the procurement tables (problem 6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.text import trimmed
from jangbu.operators import profile
from jangbu.plans.references import sql_trim
from jangbu.session import cut, table

PROFILED = ("tenders", "award_outcomes")
MOST_NULLS, MOST_SHIFT = 0.4, 20.0


def bad_price(v: Column) -> Column:
    """Not finite, zero or less, 10^14 or more, or seven digits and more that are all nine."""
    digits = F.regexp_replace(F.regexp_replace(F.when(F.abs(v) < 1e14, v).cast("decimal(30,4)").cast("string"), r"\.0+$", ""), r"\.", "")
    return F.isnan(v) | (v <= 0) | (v >= 1e14) | F.coalesce(digits.rlike("^9{7,}$"), F.lit(False))


def bad_rate(v: Column) -> Column:
    return F.isnan(v) | (v < 0) | (v > 100)


def _checked() -> list[profile.Checked]:
    tender = F.concat_ws("-", trimmed("bid_notice_no"), trimmed("bid_notice_round"))
    return [
        *[profile.Checked("tenders", c, bad_price, tender, "load_batch", 0.0, 1e14, open_low=True) for c in ("estimated_price_krw", "assigned_budget_krw")],
        profile.Checked("award_outcomes", "award_rate", bad_rate, F.col("award_outcome_id"), "load_batch", 0.0, 100.0),
    ]


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in PROFILED}


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.violations(_tables(spark, sf_dir), _checked(), MOST_NULLS, MOST_SHIFT)


def p6_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What gave the wrong values of p6_found away: rows by expression, range and repeated digit."""
    wrong, _, _ = profile.suspects(_tables(spark, sf_dir), _checked())
    return wrong.groupBy("column_name", "off_expression", "off_range", "one_digit").agg(F.count(F.lit(1)).alias("rows"))


def _tagged(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("table_name"), "*")


def p6_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard aggregates of every column of the profiled tables."""
    parts = []
    for name in PROFILED:
        df = table(spark, sf_dir, name)
        parts.append(_tagged(profile.aggregates(df, df.columns), name))
    return reduce(DataFrame.unionByName, parts)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct values of every column of the profiled tables per load, under ``table.column``."""
    parts = []
    for name, df in _tables(spark, sf_dir).items():
        counts = profile.value_counts(df, [c for c in df.columns if c != "load_batch"], "load_batch")
        parts.append(counts.withColumn("column_name", F.concat(F.lit(f"{name}."), "column_name")))
    return cut(reduce(DataFrame.unionByName, parts))


def _split(df: DataFrame) -> DataFrame:
    both = F.split("column_name", r"\.", 2)
    return df.select(both[0].alias("table_name"), both[1].alias("column_name"), *[c for c in df.columns if c != "column_name"])


def p6_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The induced expression of every column, one row per alternative."""
    return _split(profile.patterns(profile.induce(_counts(spark, sf_dir))))


def p6_load_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null rates and expression coverage of every column per load, and their change from the load before."""
    counts = _counts(spark, sf_dir)
    return _split(profile.coverage(counts, profile.expressions(profile.induce(counts))))


def p6_load_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and distinct values of every column per load."""
    per = F.col("value").isNull()
    return _split(_counts(spark, sf_dir).groupBy("column_name", "load").agg(F.sum("n").alias("rows"), F.sum(F.when(per, F.col("n")).otherwise(0)).alias("nulls"), F.count("value").alias("distinct_values")))


def _sql_found() -> str:
    price = "(not isfinite({c}) or {c} <= 0 or {c} >= 1e14 or coalesce(regexp_matches(replace(regexp_replace(cast(try_cast(case when isfinite({c}) and abs({c}) < 1e14 then {c} end as decimal(30,4)) as varchar), '[.]0+$', ''), '.', ''), '^9{{7,}}$'), false))"
    rate = "(not isfinite({c}) or {c} < 0 or {c} > 100)"
    tender = f"{sql_trim('bid_notice_no')} || '-' || {sql_trim('bid_notice_round')}"
    parts = []
    for t, c, bad, key in (("tenders", "estimated_price_krw", price, tender), ("tenders", "assigned_budget_krw", price, tender), ("award_outcomes", "award_rate", rate, "award_outcome_id")):
        bad = bad.format(c=c)
        head = f"select distinct '{t}' as table_name, '{c}' as column_name"
        parts += [
            f"{head}, 'bad_value' as issue, {key} as case_key from {t} where {c} is not null and {bad}",
            f"{head}, 'load_nulls', load_batch from {t} where load_batch is not null group by load_batch having count(*) filter ({c} is null) >= {MOST_NULLS} * count(*)",
            f"{head}, 'load_shift', load_batch from (select load_batch, quantile_disc({c}, 0.5) as m, (select quantile_disc({c}, 0.5) from {t} where {c} is not null and not {bad}) as w from {t} where {c} is not null and not {bad} and load_batch is not null group by load_batch) where m * {MOST_SHIFT} < w or m > w * {MOST_SHIFT}",
        ]
    return "\nunion all\n".join(parts)


_COLUMNS = {
    "tenders": "bid_notice_no s, bid_notice_round s, bid_title_ko s, notice_agency_code s, notice_agency_name_ko s, demand_agency_code s, demand_agency_name_ko s, business_div_name_ko s, contract_method_ko s, contract_status_ko s, award_method_ko s, assigned_budget_krw d, estimated_price_krw d, bid_notice_date s, bid_notice_time s, bid_begin_date s, bid_begin_time s, bid_close_date s, bid_close_time s, opening_date s, opening_time s, opening_place_ko s, ref_notice_no s, ref_notice_round s, bid_notice_url s, is_joint_contract b, is_electronic_bid b, is_international_bid b, is_pps_notice b, is_region_limited b, is_industry_limited b, data_base_date s, load_batch s",
    "award_outcomes": "award_outcome_id s, bid_notice_no s, bid_notice_round s, winner_supplier_id s, tender_in_scope b, award_amount_krw d, award_rate d, award_date s, bid_submission_time s, bid_amount_krw d, opening_rank d, bid_title_ko s, business_div_name_ko s, contract_method_ko s, award_method_ko s, notice_agency_code s, notice_agency_name_ko s, demand_agency_code s, demand_agency_name_ko s, opening_date s, scheduled_price_krw d, base_amount_krw d, estimated_price_krw d, award_lower_limit_rate d, data_base_date s, load_batch s",
}


def _sql_columns() -> str:
    parts = []
    for t, columns in _COLUMNS.items():
        for c, kind in (x.split() for x in columns.split(", ")):
            blank = f"cast(coalesce(sum(case when {sql_trim(c)} = '' then 1 else 0 end), 0) as bigint)" if kind == "s" else "cast(0 as bigint)"
            text = (f"min({c})", f"max({c})") if kind == "s" else ("null::varchar",) * 2
            number = (f"min({c}) filter (isfinite({c}))", f"max({c}) filter (isfinite({c}))") if kind == "d" else ("null::double",) * 2
            parts.append(
                f"select '{t}' as table_name, '{c}' as column_name, count(*) as rows, count(*) filter ({c} is null) as nulls, {blank} as blanks, count(distinct {c}) as distinct_values, "
                f"{text[0]} as low_text, {text[1]} as high_text, {number[0]} as low, {number[1]} as high from {t}"
            )
    return "\nunion all\n".join(parts)


def _sql_load_nulls() -> str:
    return "\nunion all\n".join(
        f"select '{t}' as table_name, '{c}' as column_name, load_batch as load, count(*) as rows, count(*) filter ({c} is null) as nulls, count(distinct {c}) as distinct_values from {t} group by load_batch"
        for t, columns in _COLUMNS.items() for c, _ in (x.split() for x in columns.split(", ")) if c != "load_batch"
    )


QUERIES = {"p6_found": p6_found, "p6_evidence": p6_evidence, "p6_columns": p6_columns, "p6_patterns": p6_patterns, "p6_load_coverage": p6_load_coverage, "p6_load_nulls": p6_load_nulls}
SQL = {"p6_found": _sql_found(), "p6_columns": _sql_columns(), "p6_load_nulls": _sql_load_nulls()}
