"""Months put together: facts merged under one schema, the scope flag made anew, dimensions aggregated, one flat table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jangbu.functions.cleaning import division_label, method_label
from jangbu.functions.text import blank_to_null, is_blank, trimmed
from jangbu.operators.relational import column_or, flag_existing, require_unique

#: Company names stay out of a release; amounts are floating numbers in it (fixed values).
PRIVATE = ("supplier_name_ko", "bidder_name_ko", "winner_name_ko", "contractor_name_ko")
KEY = ["bid_notice_no", "bid_notice_round"]


def merge(months: Sequence[DataFrame], columns: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """All rows of all months under one schema (the first month's, or ``columns``), without private columns, money as
    double. A column that a month lacks is null there; further ones fall away."""
    wanted = columns or [(f.name, f.dataType.simpleString()) for f in months[0].schema.fields]
    kinds = [(n, "double" if n.endswith("_krw") else k) for n, k in wanted if n not in PRIVATE]
    return reduce(DataFrame.unionByName, [m.select(*[column_or(m, n, None, k).cast(k).alias(n) for n, k in kinds]) for m in months])


def merge_in_scope(months: Sequence[DataFrame], tenders: DataFrame) -> DataFrame:
    """Merged facts whose ``tender_in_scope`` is made anew against all months' notices."""
    return flag_existing(merge(months), KEY, tenders, KEY, "tender_in_scope")


def global_suppliers(months: Sequence[DataFrame]) -> DataFrame:
    """Roles by any month, counts and amounts by sum. A blank or, within a month, repeated id is an error."""
    for m in months:
        require_unique(m.select(blank_to_null("supplier_id").alias("supplier_id")), ["supplier_id"], "suppliers of a month")
    return _suppliers(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), months))


def global_suppliers_by(rows: DataFrame, month: str) -> DataFrame:
    """``global_suppliers`` of any number of months that lie in one table and are told by a column: one pass, not one a month."""
    require_unique(rows.select(month, blank_to_null("supplier_id").alias("supplier_id")), [month, "supplier_id"], "suppliers of a month")
    return _suppliers(rows)


def _suppliers(rows: DataFrame) -> DataFrame:
    return rows.groupBy("supplier_id").agg(*[F.bool_or(c).alias(c) for c in ("is_bidder", "is_winner", "is_contractor")], *_sums(rows))


def _sums(rows: DataFrame) -> list:
    return [(F.sum(F.col(c).cast("decimal(28,4)")).cast("double") if c.endswith("_krw") else F.sum(c)).alias(c) for c in rows.columns if c.startswith("snapshot_")]


def global_agencies(months: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Roles by any month, counts by sum, and the name of the last month that has a non-blank one."""
    return global_agencies_by(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [m.withColumn("_month", F.lit(name)) for name, m in months]), "_month")


def global_agencies_by(rows: DataFrame, month: str) -> DataFrame:
    """``global_agencies`` of months that lie in one table and are told by a column."""
    named = F.when(~is_blank("agency_name_ko"), F.struct(month, "agency_name_ko"))
    return rows.groupBy("agency_code").agg(F.coalesce(F.max(named)["agency_name_ko"], F.lit("")).alias("agency_name_ko"), *[F.bool_or(c).alias(c) for c in ("is_notice_agency", "is_demand_agency", "is_contract_agency")], *_sums(rows))


def award_summary(outcomes: DataFrame) -> DataFrame:
    """Per notice in scope: awards, valid rates (0 to 100), their median and mean, first and last day."""
    rate = F.when(F.col("award_rate").between(0, 100), F.col("award_rate"))
    return outcomes.where(F.coalesce("tender_in_scope", F.lit(False))).groupBy(*[trimmed(k).alias(k) for k in KEY]).agg(
        F.count(F.lit(1)).alias("selected_award_count"), F.count(rate).alias("valid_award_rate_count"), F.median(rate).alias("median_award_rate_pct"), F.avg(rate).alias("mean_award_rate_pct"),
        F.min("award_date").alias("first_award_date"), F.max("award_date").alias("last_award_date"),
    )


def contract_summary(bridge: DataFrame) -> DataFrame:
    return bridge.where(F.coalesce("tender_in_scope", F.lit(False))).groupBy(*[trimmed(k).alias(k) for k in KEY]).agg(
        F.count_distinct(trimmed("unified_contract_no")).alias("linked_contract_count"), F.min("contract_date").alias("first_contract_date"), F.max("contract_date").alias("last_contract_date")
    )


#: Columns of the flat table in their order (fixed values).
FLAT = "bid_notice_no bid_notice_round bid_title_ko bid_notice_date business_div_name_ko business_division_en contract_method_ko contract_method_group_en notice_agency_code notice_agency_name_ko demand_agency_code demand_agency_name_ko assigned_budget_krw estimated_price_krw is_electronic_bid is_international_bid is_region_limited is_industry_limited has_selected_award selected_award_count valid_award_rate_count median_award_rate_pct mean_award_rate_pct first_award_date last_award_date has_linked_contract linked_contract_count first_contract_date last_contract_date".split()


def quickstart(tenders: DataFrame, outcomes: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row per notice with its award and contract summaries; the summaries are aggregated before they are joined, so
    no notice fans out. ``tenders`` must be unique by its trimmed key (see ``require_unique``)."""
    base = tenders.withColumns({k: trimmed(k) for k in KEY})
    wide = base.join(award_summary(outcomes), KEY, "left").join(contract_summary(bridge), KEY, "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("selected_award_count", "valid_award_rate_count", "linked_contract_count")}
    out = wide.withColumns(counts).withColumns({
        "business_division_en": division_label("business_div_name_ko"), "contract_method_group_en": method_label("contract_method_ko"),
        "has_selected_award": F.col("selected_award_count") > 0, "has_linked_contract": F.col("linked_contract_count") > 0,
    })
    return out.select(*FLAT)


def reconcile(flat: DataFrame, tenders: DataFrame, outcomes: DataFrame, bridge: DataFrame) -> list[dict[str, object]]:
    """Gates of the flat table: grain, no supplier column, and totals that agree with the facts."""
    notices = tenders.select(*[trimmed(k).alias(k) for k in KEY]).distinct()
    scoped = outcomes.where("tender_in_scope").select(*[trimmed(k).alias(k) for k in KEY], "award_rate").join(notices, KEY, "left_semi")
    linked = bridge.where("tender_in_scope").select(*[trimmed(k).alias(k) for k in KEY], trimmed("unified_contract_no").alias("c")).join(notices, KEY, "left_semi").distinct()
    f = flat.agg(F.count(F.lit(1)).alias("n"), F.sum("selected_award_count").alias("a"), F.sum("valid_award_rate_count").alias("v"), F.sum("linked_contract_count").alias("c")).first()
    want = {"rows": (f.n, tenders.count()), "awards": (f.a or 0, scoped.count()), "valid rates": (f.v or 0, scoped.where("award_rate between 0 and 100").count()), "links": (f.c or 0, linked.count())}
    gates = [{"gate": g, "table": "flat", "passed": a == b, "detail": f"{a} of {b}"} for g, (a, b) in want.items()]
    named = [c for c in flat.columns if "supplier" in c]
    return [*gates, {"gate": "no supplier", "table": "flat", "passed": not named, "detail": ", ".join(named)}]
