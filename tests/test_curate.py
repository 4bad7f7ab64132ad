from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from jangbu.operators import curate as C
from jangbu.operators import gates as G
from jangbu.operators import release as R
from tests.conftest import rows

KEY = b"test_supplier_pseudonymization_key_0123456789"
T = "bid_notice_no string, bid_notice_round string, bid_notice_date string, notice_agency_code string, notice_agency_name_ko string, demand_agency_code string, demand_agency_name_ko string, opening_date string, assigned_budget_krw double"
A = "bid_notice_no string, bid_notice_round string, opening_date string, opening_rank double, bidder_business_registration_no string, bidder_name_ko string, bid_amount_krw double, is_selected_winner boolean, winner_business_registration_no string, winner_name_ko string, award_amount_krw double, award_date string, disqualification_reason_ko string, bid_submission_time string"
K = "unified_contract_no string, contract_date string, bid_notice_no string, bid_notice_round string, contract_agency_code string, contract_agency_name_ko string, demand_agency_code string, demand_agency_name_ko string, contractor_business_registration_no string, contractor_name_ko string, contract_amount_krw double"


@pytest.fixture(scope="module")
def feeds(spark):
    bids = spark.createDataFrame([("N1", "000", "2026-08-01", "G1", "Agency One", "D1", "Demand", "2026-08-05", 10.0), (" N2 ", "000", "2026-08-02", "G2", "Agency Two", "G1", "Agency One", "2026-08-06", 20.0)], T)
    awards = spark.createDataFrame([
        ("N1", "000", "2026-08-05", 1.0, "123-45-67890", "Acme", 9.0, True, "1234567890", "Acme", None, None, None, "10:00"),
        ("N1", "000", "2026-08-05", 2.0, "0000000002", "Beta", 9.5, None, None, None, None, None, "late", "10:01"),
        ("N9", "000", "2026-08-05", 1.0, "ABCDEFGHIJ", "Gone", 1.0, True, "0000000003", "Gamma", 1.0, None, None, ""),
    ], A)
    contracts = spark.createDataFrame([
        ("C1", "2026-08-10", "N1", "000", "G1", "Agency One", "D2", "Other", "1234567890", "Acme Ltd", 5.0),
        ("C2", "2026-08-11", "N9", "000", "G3", "Agency Three", None, None, "0000000004", "Delta", None),
        ("C3", "2026-08-12", "  ", None, "G3", "Agency Three", "D2", "Other", "x", "None", 7.0),
    ], K)
    dated = lambda df, *cs: df.withColumns({c: F.to_date(c) for c in cs})
    return dated(bids, "bid_notice_date", "opening_date"), dated(awards, "opening_date", "award_date"), dated(contracts, "contract_date")


def test_seven_tables(feeds):
    c = C.curated(*feeds, KEY)
    assert [t.count() for t in (c.tenders, c.submissions, c.outcomes, c.contracts, c.suppliers, c.agencies, c.bridge)] == [2, 3, 2, 3, 4, 5, 2]
    assert c.submissions.where("tender_in_scope").count() == 2
    assert c.outcomes.where("tender_in_scope").count() == 1
    assert c.bridge.where("tender_in_scope").count() == 1
    assert c.submissions.where("bidder_supplier_id = ''").count() == 1
    assert c.tenders.where("bid_notice_no = 'N2'").count() == 1
    s = c.suppliers.where("supplier_name_ko like 'Acme%'").first()
    assert (s.supplier_name_ko, s.is_bidder, s.is_winner, s.is_contractor, s.snapshot_total_contract_amount_krw, s.names) == ("Acme", True, True, True, 5.0, 2)
    g1 = c.agencies.where("agency_code = 'G1'").first()
    assert (g1.is_notice_agency, g1.is_demand_agency, g1.is_contract_agency, g1.snapshot_total_tenders_in_scope, g1.snapshot_total_contracts_in_scope) == (True, True, True, 1, 1)


def test_empty_feeds(feeds):
    c = C.curated(*[f.limit(0) for f in feeds], KEY)
    assert [t.count() for t in (c.tenders, c.submissions, c.outcomes, c.contracts, c.suppliers, c.agencies, c.bridge)] == [0] * 7


def test_scope_filter(feeds):
    assert C.in_scope(feeds[0], "bid_notice_date", "2026-08-02", "2026-08-31").count() == 1


def test_gates(feeds, spark):
    c = C.curated(*feeds, KEY)
    tables, keys = {"tenders": c.tenders, "bridge": c.bridge}, {"tenders": C.TENDER_KEY, "bridge": ["unified_contract_no"]}
    gates = G.report(tables, keys, {"tenders": 2}, "bridge")
    G.require(gates)
    with pytest.raises(ValueError, match="row count"):
        G.require(G.report(tables, keys, {"tenders": 3}))
    bad = c.tenders.withColumn("ceo_name", F.lit("x")).withColumn("assigned_budget_krw", F.lit("text"))
    failed = [g["gate"] for g in G.report({"tenders": bad.union(bad)}, keys) if not g["passed"]]
    assert failed == ["primary key", "private columns", "column types"]


def test_forbidden_names():
    assert G.forbidden_columns(["bidder_business_registration_no", "bidder_ceo_name", "contractor_address", "bid_notice_no", "masked_biz_no"]) == ["bidder_business_registration_no", "bidder_ceo_name", "contractor_address", "masked_biz_no"]
    assert G.forbidden_columns(["bidder_business_registration_no", "masked_biz_no", "ceo_name"], strict=False) == ["masked_biz_no", "ceo_name"]


def test_merge_and_scope(spark):
    a = spark.createDataFrame([("N1", "000", False, 1)], "bid_notice_no string, bid_notice_round string, tender_in_scope boolean, amount_krw long").withColumn("bidder_name_ko", F.lit("x"))
    b = spark.createDataFrame([("N2", "000", True, 2.5, 1)], "bid_notice_no string, bid_notice_round string, tender_in_scope boolean, amount_krw double, extra int")
    tenders = spark.createDataFrame([("N1", "000")], "bid_notice_no string, bid_notice_round string")
    out = R.merge_in_scope([a, b], tenders)
    assert "bidder_name_ko" not in out.columns and "extra" not in out.columns
    assert rows(out.select("bid_notice_no", "amount_krw", "tender_in_scope")) == [("N1", 1.0, True), ("N2", 2.5, False)]


S = "supplier_id string, is_bidder boolean, is_winner boolean, is_contractor boolean, snapshot_total_bids_in_scope long, snapshot_total_contract_amount_krw double"


def test_global_dimensions(spark):
    months = [spark.createDataFrame([("S1", True, False, False, 2, 1.0)], S), spark.createDataFrame([("S1", False, True, False, 3, 0.5)], S)]
    assert rows(R.global_suppliers(months)) == [("S1", True, True, False, 5, 1.5)]
    with pytest.raises(ValueError):
        R.global_suppliers([months[0].union(months[0])])
    schema = "agency_code string, agency_name_ko string, is_notice_agency boolean, is_demand_agency boolean, is_contract_agency boolean, snapshot_total_tenders_in_scope long"
    a = [("2026_01", spark.createDataFrame([("G", "Old Name", True, False, False, 1)], schema)), ("2026_02", spark.createDataFrame([("G", "New Name", False, True, False, 2)], schema)), ("2026_03", spark.createDataFrame([("G", " ", False, False, False, 2)], schema))]
    assert rows(R.global_agencies(a)) == [("G", "New Name", True, True, False, 5)]


def test_quickstart(spark):
    t = spark.createDataFrame([("N1", "000"), ("N2", "000")], "bid_notice_no string, bid_notice_round string")
    for c in ("bid_title_ko", "business_div_name_ko", "contract_method_ko", "notice_agency_code", "notice_agency_name_ko", "demand_agency_code", "demand_agency_name_ko"):
        t = t.withColumn(c, F.lit("용역"))
    t = t.withColumns({"bid_notice_date": F.current_date(), "assigned_budget_krw": F.lit(1.0), "estimated_price_krw": F.lit(1.0), **{f"is_{x}": F.lit(True) for x in ("electronic_bid", "international_bid", "region_limited", "industry_limited")}})
    o = spark.createDataFrame([("N1", "000", 90.0, True), ("N1", "000", 150.0, True), ("N1", "000", 80.0, False)], "bid_notice_no string, bid_notice_round string, award_rate double, tender_in_scope boolean").withColumn("award_date", F.lit("2026-01-01").cast("date"))
    b = spark.createDataFrame([("C1", "N1", "000", True), ("C2", "N1", "000", True), ("C2", "N1", "000", True), ("C3", "N2", "000", None)], "unified_contract_no string, bid_notice_no string, bid_notice_round string, tender_in_scope boolean").withColumn("contract_date", F.lit("2026-01-01").cast("date"))
    flat = R.quickstart(t, o, b)
    assert flat.columns == R.FLAT and len(R.FLAT) == 29
    got = {r.bid_notice_no: (r.selected_award_count, r.valid_award_rate_count, r.median_award_rate_pct, r.linked_contract_count, r.has_linked_contract, r.business_division_en) for r in flat.collect()}
    assert got == {"N1": (2, 1, 90.0, 2, True, "Services"), "N2": (0, 0, None, 0, False, "Services")}
    assert all(g["passed"] for g in R.reconcile(flat, t, o, b))
