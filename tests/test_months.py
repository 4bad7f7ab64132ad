"""The curated and merged queries over all months there are."""

from __future__ import annotations

from jangbu.operators import curate as C
from jangbu.operators import release as R
from jangbu.plans import catalogue, curation
from tests.conftest import SMALL, rows

BIDS = "bid_notice_no string, bid_notice_round string, bid_notice_date date, notice_agency_code string, notice_agency_name_ko string, demand_agency_code string, demand_agency_name_ko string"
CONTRACTS = "contract_date date, contract_agency_code string, contract_agency_name_ko string, demand_agency_code string, demand_agency_name_ko string, contractor_business_registration_no string, contractor_name_ko string, contract_amount_krw double"
AWARDS = "opening_date date, bid_notice_no string, bid_notice_round string, bidder_business_registration_no string, bidder_name_ko string, winner_business_registration_no string, winner_name_ko string, is_selected_winner boolean, bid_amount_krw double"


def day(text):
    from datetime import date

    return date.fromisoformat(text) if text else None


def bids(spark):
    days = ("2025-09-01", "2025-11-15", "2026-10-31", None)
    return spark.createDataFrame([(f" N{k}", "0", day(d), "A1", f"이름{k}", None, None) for k, d in enumerate(days)], BIDS)


def awards(spark):
    days = ("2026-10-31", "2026-01-02", "2025-09-01", "2026-02-03", None)
    notices = ("N0", "N1", "N2", "N3", "N0")
    return spark.createDataFrame([(day(d), n, "0", "1234567890", "업체", "1234567890" if k == 0 else None, "업체", k == 0, 10.0) for k, (d, n) in enumerate(zip(days, notices, strict=True))], AWARDS)


def contracts(spark):
    return spark.createDataFrame([(day(d), "A1", "", None, None, "1234567890", "업체", 5.0) for d in ("2025-09-01", "2026-10-31", None)], CONTRACTS)


def test_first_to_last_month_and_no_null_day(spark):
    got = C.in_any_month(bids(spark), "bid_notice_date", "month").select("bid_notice_no", "month")
    assert rows(got) == [(" N0", "2025_09"), (" N1", "2025_11"), (" N2", "2026_10")]


def test_notices_of_any_month_are_in_scope(spark):
    t = C.tenders(C.in_any_month(bids(spark), "bid_notice_date"))
    got = C.submissions(C.in_any_month(awards(spark), "opening_date"), t, b"key").select("bid_notice_no", "tender_in_scope")
    assert rows(got) == [("N0", True), ("N1", True), ("N2", True), ("N3", False)]


def test_suppliers_and_agencies_of_all_months(spark):
    a, c, b = C.in_any_month(awards(spark), "opening_date", "m"), C.in_any_month(contracts(spark), "contract_date", "m"), C.in_any_month(bids(spark), "bid_notice_date", "m")
    per_month = C.suppliers(a, c, b"key", ["m"])
    assert per_month.count() == 4
    s = R.global_suppliers_by(per_month.drop("names"), "m").collect()
    assert [(r.snapshot_total_bids_in_scope, r.snapshot_total_wins_in_scope, r.snapshot_total_contracts_in_scope, r.snapshot_total_contract_amount_krw) for r in s] == [(4, 1, 2, 10.0)]
    g = R.global_agencies_by(C.agencies(b, c, ["m"]).drop("names"), "m").collect()
    assert [(r.agency_name_ko, r.snapshot_total_tenders_in_scope, r.snapshot_total_contracts_in_scope, r.is_demand_agency) for r in g] == [("이름2", 3, 2, False)]


def test_queries_hold_the_rows_outside_the_quarter(spark):
    queries = catalogue.queries()
    for name, column in (("curated_tenders", "bid_notice_date"), ("curated_contracts", "contract_date"), ("merged_awards", "award_date")):
        whole, quarter = queries[f"{name}_all"](spark, SMALL), queries[name](spark, SMALL)
        inside = whole.where(f"{column} between '{curation.START}' and '{curation.END}'")
        assert whole.count() > quarter.count() == inside.count()
    n = queries["curated_submissions_all"](spark, SMALL).agg({"n": "sum"}).first()[0]
    assert n == curation._all_awards(spark, SMALL).count() > queries["curated_submissions"](spark, SMALL).agg({"n": "sum"}).first()[0]
