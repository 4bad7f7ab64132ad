from __future__ import annotations

import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jangbu.llm.agencies import agency_survivors, members
from jangbu.llm.survivors import consensus, merged, survivors, tokens
from tests.conftest import rows


def test_consensus_votes():
    assert consensus(["서울시청", "서울 시청", "서을시청"], [2, 1, 1]) == "서울시청"
    assert consensus(["abc 1", "xyz 2", "xyz 1"], [1, 1, 1]) == "xyz 1"
    assert consensus(["가나다라", "가다라", "가다라"], [1, 1, 1]) == "가다라"
    assert consensus([], []) == ""


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("가나a 1", min_size=1, max_size=8), min_size=1, max_size=5, unique=True), st.integers(0, 4))
def test_a_majority_decides(values, k):
    k %= len(values)
    weights = [1.0] * len(values)
    weights[k] = 2.0 * len(values)
    assert consensus(values, weights) == values[k]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("가나다", min_size=1, max_size=6), st.integers(1, 5)), min_size=1, max_size=6))
def test_no_vote_is_lost(values):
    whole, seen = merged([([{t: float(w)} for t in tokens(v)], float(w)) for v, w in values])
    assert seen == sum(w for _, w in values)
    assert all(abs(sum(cell.values()) - seen) < 1e-9 for cell in whole)


G = "g string, field_name string, norm string, w double, id long"


def test_the_vote_changes_the_winner(spark):
    """The heaviest value loses where the others agree against it, and a value that nobody voted most wins by its tokens."""
    data = [("g", "f", "서울시청 남관", 2.0, 1), ("g", "f", "부산시청 북관", 1.5, 2), ("g", "f", "부산시청 동관", 1.5, 3), ("h", "f", "하나", 1.0, 4), ("h", "f", "둘", 1.0, 5), ("h", "f", "둘", 1.0, 6)]
    got = {r.g: (r.norm, r.best.id) for r in survivors(spark.createDataFrame(data, G), "g", F.col("w"), [F.col("id")]).collect()}
    assert got == {"g": ("부산시청 북관", 2), "h": ("둘", 5)}


def test_large_groups_are_aligned_in_chunks(spark):
    df = spark.range(3000).select(F.lit("g").alias("g"), F.lit("f").alias("field_name"), F.concat(F.lit("value "), F.col("id") % 700, F.when(F.col("id") % 3 == 0, " old").otherwise("")).alias("norm"), F.lit(1.0).alias("w"), F.col("id"))
    df = df.unionByName(spark.range(3000, 9000).select(F.lit("g").alias("g"), F.lit("f").alias("field_name"), F.lit("value 7").alias("norm"), F.lit(1.0).alias("w"), F.col("id")))
    for chunk in (8, 1000):
        got = survivors(df, "g", F.col("w"), [F.col("id")], chunk=chunk).collect()
        assert [(r.norm, r.best.id) for r in got] == [("value 7", 7)]


def test_empty_and_blank_candidates(spark):
    assert survivors(spark.createDataFrame([], G), "g", F.col("w"), [F.col("id")]).count() == 0
    assert survivors(spark.createDataFrame([("g", "f", "", 1.0, 1), ("g", "f", None, 1.0, 2)], G), "g", F.col("w"), [F.col("id")]).count() == 0
    assert [r.norm for r in survivors(spark.createDataFrame([("g", "f", "a", None, 1), ("g", "f", "b", None, 2)], G), "g", F.col("w"), [F.col("id")]).collect()] == ["a"]


A = "record_id long, agency_code string, agency_name_ko string, source_month string, source_feed string, agency string, norm string"


def records(spark, data):
    return spark.createDataFrame([(i, c, n, m, f, "clash", "clash") for i, c, n, m, f in data], A)


def test_agencies(spark):
    nfd = unicodedata.normalize("NFD", "새 시청")
    data = [
        (1, "1234567", "옛시청", "2026-01", "bids"), (2, "123-4567", nfd, "2026-03", "awards"), (3, "１２３４５６７", "새시청", "2026-03", "bids"), (4, "1234567", "최신시…", "2026-05", "bids"),
        (5, None, "옛　시청", "2026-06", "bids"), (6, "-", "모르는 곳", "2026-06", "bids"), (7, "1234567", "보고서시청", "2026-09", "bidder_report"),
        (8, "0000012", "혼자", "2026-01", "bids"), (9, "12.0", "보고만", "2026-02", "bidder_report"), (10, "b123456", "N/A", "2026-01", "bids"), (11, "B123456 ", "깨��", "2026-01", "bids"), (12, None, None, None, None),
    ]
    got = {(r.agency, r.field_name): r.best.record_id for r in agency_survivors(records(spark, data)).collect()}
    assert got == {("1234567", "agency_code"): 4, ("1234567", "agency_name_ko"): 5, ("0000012", "agency_code"): 8, ("0000012", "agency_name_ko"): 8}
    assert sorted(r.record_id for r in members(records(spark, data)).where("agency = '1234567'").collect()) == [1, 2, 3, 4, 5, 7]


def test_ties_and_untrusted_only(spark):
    data = [(5, "1234567", "가", "2026-01", "bids"), (3, "1234567", "나", "2026-01", "bids"), (9, "7654321", "다", "2026-01", "bidder_report"), (8, "7654321", "라", "2026-02", "bidder_report")]
    got = {(r.agency, r.field_name): r.best.record_id for r in agency_survivors(records(spark, data)).collect()}
    assert got == {("1234567", "agency_code"): 3, ("1234567", "agency_name_ko"): 3, ("7654321", "agency_code"): 8, ("7654321", "agency_name_ko"): 8}
    assert agency_survivors(records(spark, [])).count() == 0


def test_hot_agency(spark):
    df = spark.range(5000).select(F.col("id").alias("record_id"), F.lit("1234567").alias("agency_code"), F.concat(F.lit("시청 "), (F.col("id") % 100)).alias("agency_name_ko"), F.lit("2026-01").alias("source_month"), F.lit("bids").alias("source_feed"))
    assert rows(agency_survivors(df).select("field_name", "best.record_id")) == [("agency_code", 0), ("agency_name_ko", 0)]
