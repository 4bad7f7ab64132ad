"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.text import WHITE_SPACE, blank_to_null
from jangbu.llm.agencies import LEAST_TRUST, MONTHLY, agency_survivors
from jangbu.llm.leakage import leaks, without_leaks
from jangbu.llm.packing import faults, fill_report, measured, packed
from jangbu.llm.percentiles import merged, percentiles, summarise
from jangbu.llm.surrogates import collisions, entities, pii_found, protected, redacted
from jangbu.operators.selection import exact_quantiles
from jangbu.session import cut, table

PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)
RATE_ERROR = 0.0005


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Possible award rates with the notice's division; the division is null where the notice or its division isn't there."""
    key = [blank_to_null("bid_notice_no").alias("no"), blank_to_null("bid_notice_round").alias("round")]
    notices = table(spark, sf_dir, "tenders").select(*key, blank_to_null("business_div_name_ko").alias("business_div_name_ko"))
    divisions = notices.where("no is not null and round is not null").groupBy("no", "round").agg(F.min("business_div_name_ko").alias("business_div_name_ko"))
    awards = table(spark, sf_dir, "award_outcomes").select(*key, "award_rate", "load_batch").where("award_rate between 0 and 100")
    return awards.join(divisions, ["no", "round"], "left").select("business_div_name_ko", "load_batch", "award_rate")


def p1_award_rate_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles per division over all loads, put together from the loads' summaries."""
    keys = ["business_div_name_ko"]
    per_load = summarise(_rates(spark, sf_dir), [*keys, "load_batch"], "award_rate", RATE_ERROR)
    return percentiles(merged([per_load], keys), keys, PROBS, RATE_ERROR)


def p1_award_rate_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["business_div_name_ko", "load_batch"]
    return percentiles(summarise(_rates(spark, sf_dir), keys, "award_rate", RATE_ERROR), keys, PROBS, RATE_ERROR)


def p1_award_rate_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentiles per division beside the exact ones of the raw values, selected by refined histograms: ``exact`` and
    whether the percentile is within its stated error of it."""
    key = "business_div_name_ko"
    rates = _rates(spark, sf_dir)
    near = percentiles(merged([summarise(rates, [key, "load_batch"], "award_rate", RATE_ERROR)], [key]), [key], PROBS, RATE_ERROR)
    exact = exact_quantiles(rates, [key], "award_rate", PROBS).select(F.col(key).alias("_key"), F.col("prob").alias("_prob"), F.col("value").alias("exact"))
    both = near.join(exact, F.col(key).eqNullSafe(F.col("_key")) & (F.col("prob") == F.col("_prob")))
    return both.select(key, "prob", "n", "exact", (F.abs(F.col("value") - F.col("exact")) <= F.col("error") + 1e-9).alias("within_error"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agency_survivors(table(spark, sf_dir, "agencies")).select("field_name", F.col("best.record_id").alias("record_id"))


def p4_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per agency: the surviving code and name, as their records spell them."""
    records = table(spark, sf_dir, "agencies")
    won = cut(agency_survivors(records)).select("agency", "field_name", F.col("best.record_id").alias("record_id"))
    spelt = won.join(records.select("record_id", "agency_code", "agency_name_ko"), "record_id")
    pick = lambda field: F.max(F.when(F.col("field_name") == field, F.col(field))).alias(field)
    return spelt.groupBy("agency").agg(pick("agency_code"), pick("agency_name_ko"))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(measured(table(spark, sf_dir, "documents"), "agency_code"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's place; the writing agency is the source that containers mix."""
    return _placed(spark, sf_dir).drop("source", "cluster")


def p7_fill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(_placed(spark, sf_dir))


def p7_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and texts that break the packing's rules: no rows."""
    return faults(_placed(spark, sf_dir), table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, its leaked passages cut out."""
    return without_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


#: Key of the surrogates in the named queries; a real run passes a secret of its own.
DEMO_KEY = b"jangbu demonstration key, not a secret"


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_found(table(spark, sf_dir, "documents"), DEMO_KEY)


def p9_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with typed placeholders, and with surrogates in their place."""
    return redacted(table(spark, sf_dir, "documents"), DEMO_KEY)


def p9_surrogate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values there are of each type, and how many surrogates collide or disagree (none)."""
    return collisions(cut(entities(table(spark, sf_dir, "documents"), DEMO_KEY)))


def p9_left_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose redacted texts still hold a found value, or in which two values share a stand-in: no rows."""
    return protected(table(spark, sf_dir, "documents"), DEMO_KEY, texts=False).where("left <> 0").select("doc_id", "left")


_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def _trim(column: str) -> str:
    return f"trim({column}, {_CHARS})"


def _sql_percentiles(keys: str) -> str:
    return f"""
with divisions as (
  select {_trim('bid_notice_no')} as no, {_trim('bid_notice_round')} as round, min(nullif({_trim('business_div_name_ko')}, '')) as business_div_name_ko
  from tenders where {_trim('bid_notice_no')} <> '' and {_trim('bid_notice_round')} <> '' group by 1, 2),
rates as (
  select d.business_div_name_ko, a.load_batch, round(award_rate / (2.0 * {RATE_ERROR})::double)::bigint as bin
  from award_outcomes a left join divisions d on {_trim('a.bid_notice_no')} = d.no and {_trim('a.bid_notice_round')} = d.round
  where award_rate between 0 and 100),
ranked as (select *, row_number() over (partition by {keys} order by bin) as rn, count(*) over (partition by {keys}) as n from rates)
select {keys}, prob, n, bin * (2.0 * {RATE_ERROR})::double as value, {RATE_ERROR}::double as error
from ranked, (values {', '.join(f'({p}::double)' for p in PROBS)}) t(prob)
where rn = greatest(1, ceil(round(prob * n, 9)))
"""


_SQL_MEMBERS = f"""
with known as (
  select *, regexp_replace(regexp_replace(upper(translate({_trim('agency_code')}, '０１２３４５６７８９Ｂ－．', '0123456789B-.')), '[.]0+$', ''), '[^0-9A-Z]', '', 'g') as bare,
    regexp_replace(nfc_normalize(agency_name_ko), '[' || {_CHARS} || ']+', '', 'g') as flat
  from agencies),
keyed as (
  select *, case when bare <> '' then lpad(bare, greatest(length(bare), 7)::integer, '0') end as key,
    case when upper(flat) not in ('', '-', '--', '.', '?', 'N/A', 'NA', '#N/A', 'NAN', 'NULL', 'NONE', '미상', '미정', '불명', '없음', '해당없음', '알수없음') and not regexp_matches(flat, '(…|[.][.]+)$') and not contains(flat, chr(65533)) then flat end as norm_name
  from known),
named as (select norm_name, min(key) as owner from keyed where key is not null and norm_name is not null group by 1 having min(key) = max(key)),
members as (select coalesce(k.key, n.owner) as agency, k.* from keyed k left join named n on k.key is null and k.norm_name = n.norm_name),
grouped as (select *, count(*) over (partition by agency) as size from members where agency is not null),
fields as (
  select agency, 'agency_code' as field_name, agency_code as v, record_id, source_month, source_feed from grouped where size > 1 and regexp_matches(agency_code, '^([0-9]{{7}}|B[0-9]{{6}})$')
  union all
  select agency, 'agency_name_ko', norm_name, record_id, source_month, source_feed from grouped where size > 1 and norm_name is not null),
dated as (select agency, source_month[:4]::integer * 12 + source_month[6:]::integer as m from members where agency is not null),
last as (select agency, max(m) as last from dated group by 1),
votes as (
  select f.agency, field_name, v, round(sum(pow({MONTHLY}, source_month[:4]::integer * 12 + source_month[6:]::integer - last) * case when source_feed = 'bidder_report' then {LEAST_TRUST} else 1 end), 9) as w,
    min((source_feed = 'bidder_report', -(source_month[:4]::integer * 12 + source_month[6:]::integer), record_id)) as best
  from fields f join last using (agency) group by 1, 2, 3),
won as (
  select *, row_number() over (partition by agency, field_name order by w desc, best) as rn, (best)[3] as record_id from votes)
"""

QUERIES = {
    "p1_award_rate_percentiles": p1_award_rate_percentiles,
    "p1_award_rate_by_load": p1_award_rate_by_load,
    "p1_award_rate_bounds": p1_award_rate_bounds,
    "p4_found": p4_found,
    "p4_survivors": p4_survivors,
    "p7_containers": p7_containers,
    "p7_fill_report": p7_fill_report,
    "p7_faults": p7_faults,
    "p8_found": p8_found,
    "p8_decontaminated": p8_decontaminated,
    "p9_found": p9_found,
    "p9_redacted": p9_redacted,
    "p9_surrogate_checks": p9_surrogate_checks,
    "p9_left_over": p9_left_over,
}
SQL = {
    "p7_faults": "select '' as fault, '' as name from documents where false",
    "p1_award_rate_bounds": f"""
with divisions as (
  select {_trim('bid_notice_no')} as no, {_trim('bid_notice_round')} as round, min(nullif({_trim('business_div_name_ko')}, '')) as business_div_name_ko
  from tenders where {_trim('bid_notice_no')} <> '' and {_trim('bid_notice_round')} <> '' group by 1, 2),
rates as (select d.business_div_name_ko, award_rate from award_outcomes a left join divisions d on {_trim('a.bid_notice_no')} = d.no and {_trim('a.bid_notice_round')} = d.round where award_rate between 0 and 100),
ranked as (select *, row_number() over (partition by business_div_name_ko order by award_rate) as rn, count(*) over (partition by business_div_name_ko) as n from rates)
select business_div_name_ko, prob, n, award_rate as exact, true as within_error from ranked, (values {', '.join(f'({p}::double)' for p in PROBS)}) t(prob) where rn = greatest(1, ceil(round(prob * n, 9)))""",
    "p9_left_over": 'select doc_id, 0::bigint as "left" from documents where false',
    "p1_award_rate_percentiles": _sql_percentiles("business_div_name_ko"),
    "p1_award_rate_by_load": _sql_percentiles("business_div_name_ko, load_batch"),
    "p4_found": _SQL_MEMBERS + "select field_name, record_id from won where rn = 1",
    "p4_survivors": _SQL_MEMBERS
    + "select w.agency, max(case when field_name = 'agency_code' then agency_code end) as agency_code, max(case when field_name = 'agency_name_ko' then agency_name_ko end) as agency_name_ko from won w join agencies a using (record_id) where rn = 1 group by w.agency",
}
