from __future__ import annotations

import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from jangbu.functions import cleaning as C
from jangbu.functions import identity as I
from jangbu.functions.text import blank_to_null, day, trimmed
from tests.conftest import rows


def each(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_numbers(spark):
    assert each(spark, ["1,000", " 250 ", "88.5%", "invalid", None, "", "1d", "NaN", "inf", "-3", "1e3", ".5"], C.number) == [1000.0, 250.0, 88.5, None, None, None, None, None, None, -3.0, 1000.0, 0.5]


def test_flags(spark):
    assert each(spark, ["Y", "N", "여", "부", "1", "0", None, "", "invalid", "TRUE", "false", " Y "], C.flag) == [True, False, True, False, True, False, None, None, None, True, False, True]


def test_moments(spark):
    got = each(spark, ["2026-09-01 10:00:00", "2026-09-01", "20260901", None, "", "invalid", "09:30", "2026/09/01", "202609010900", "2026-02-30"], C.moment)
    assert [str(x) if x else None for x in got] == ["2026-09-01 10:00:00", "2026-09-01 00:00:00", "2026-09-01 00:00:00", None, None, None, None, "2026-09-01 00:00:00", "2026-09-01 09:00:00", None]


def test_days(spark):
    got = each(spark, ["2026-01-05", "2026/1/5", "2026.01.05", "20260105", "2026년 1월 5일", "2026-01-05 00:00:00", "202601051230", "2026-13-01", "", None, "x", "　2026-01-05\t"], day)
    assert [str(x) if x else None for x in got] == ["2026-01-05"] * 7 + [None, None, None, None, "2026-01-05"]


def test_trim_takes_all_white_space(spark):
    assert each(spark, ["\t　a b\xa0 ", "", "　", None], trimmed) == ["a b", "", "", None]
    assert each(spark, ["\xa0", "x"], blank_to_null) == [None, "x"]


def test_business_numbers(spark):
    assert each(spark, ["123-45-67890", "abcdefghij", None, "12345", "１２３４５６７８９０"], C.masked_business_number) == ["123-45-*****", "", "", "", ""]


def test_labels(spark):
    assert each(spark, ["일반 용역", "공사", "", None, "기타"], C.division_label) == ["Services", "Construction", "Unknown", "Unknown", "기타"]
    assert each(spark, ["수의(소액)", "제한 경쟁", "일반경쟁", "지명경쟁", "제한", None], C.method_label) == ["Direct / negotiated", "Restricted competition", "Open competition", "Selective competition", "제한", "Unknown"]
    assert each(spark, ["1", "용역", "x"], C.coded) == ["goods", "service", "unknown(x)"]
    assert each(spark, ["수의계약(긴급)", "협상", " "], C.method_prefix_label) == ["수의계약 (private_contract)", "협상 (other)", "알수없음 (unknown)"]
    assert each(spark, ["abc"], lambda c: C.labelled(c, ((("^a",), "starts"),), mode="regex")) == ["starts"]


def test_keys_in_logs():
    assert [C.shown_key(k) for k in ("short", "0123456789012345678", None)] == ["********", "0123********5678", "<none>"]


def test_secrets(spark):
    assert each(spark, ["u?serviceKey=abc&x=1", "u?ServiceKEY=%2B", "none"], C.secrets_hidden) == ["u?serviceKey=[REDACTED]&x=1", "u?ServiceKEY=[REDACTED]", "none"]


@pytest.mark.parametrize("key", [b"k", b"x" * 64, b"y" * 100])
def test_keyed_hash_is_hmac(spark, key):
    got = each(spark, ["0123456789", "가나다"], lambda c: I.keyed_hash(c, key))
    assert got == [hmac.new(key, t.encode(), hashlib.sha256).hexdigest() for t in ("0123456789", "가나다")]
    with pytest.raises(TypeError):
        I.pads("text")


def test_submission_id(spark):
    df = spark.createDataFrame([("N1", " 000 ", "S", 2.0, None, 1500.0, "")], "bid_notice_no string, bid_notice_round string, s string, opening_rank double, disqualification_reason_ko string, bid_amount_krw double, bid_submission_time string")
    want = {"entity": "bid_submission", "version": 1, "bid_notice_no": "N1", "bid_notice_round": "000", "bidder_supplier_id": "S", "opening_rank": "2", "disqualification_reason": "__NULL__", "bid_amount_krw": "1500.00", "bid_submission_time": "__NULL__"}
    text = json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert df.select(I.submission_id(F.col("s"))).first()[0] == "BID_" + hashlib.sha256(text.encode()).hexdigest()[:32]


def test_content_hash_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    b = spark.createDataFrame([(2, None), (1, "x")], "a int, b string")
    assert rows(I.content_hash(a)) == rows(I.content_hash(b))
    assert rows(I.content_hash(a)) != rows(I.content_hash(a.union(b)))


def test_ratio_of_nothing(spark):
    assert spark.createDataFrame([(0, 0), (1, 3)], "a int, b int").select(C.ratio(F.col("a"), F.col("b"), 4)).collect() == [(0.0,), (0.3333,)]


def test_moments_in_every_notation(spark):
    good = {"2026-01-05T10:00:00": "2026-01-05 10:00:00", "2026/1/5": "2026-01-05 00:00:00", "2026.01.05 10:00": "2026-01-05 10:00:00", "2026-1-5": "2026-01-05 00:00:00", "2026년 1월 5일": "2026-01-05 00:00:00", "20260105": "2026-01-05 00:00:00", "202601051030": "2026-01-05 10:30:00", "2026-01": "2026-01-01 00:00:00", "2026": "2026-01-01 00:00:00", " 2026-01-05 ": "2026-01-05 00:00:00", "2026-01-05T10:00:00.123Z": "2026-01-05 10:00:00", "2026. 1. 5.": "2026-01-05 00:00:00"}
    bad = ["2026-02-30", "10:00", "2026-13-01", "26-1-5", "2026-01-05 25:00", "", "x", None, "2026-01-05 and more"]
    got = spark.createDataFrame([(x,) for x in [*good, *bad]], "x string").select("x", F.date_format(C.moment("x"), "yyyy-MM-dd HH:mm:ss").alias("m"))
    assert {r.x: r.m for r in got.collect()} == good | dict.fromkeys(bad)


def test_award_methods_and_keys(spark):
    df = spark.createDataFrame([("적격심사제",), ("소액수의 견적",), ("협상에 의한 계약",), ("x",), (None,)], "m string")
    assert [r[0] for r in df.select(C.award_method_label("m")).collect()] == ["qualification_review", "small_sum_private", "negotiation", "other", "other"]
    assert C.decoded_key(" a%2Bb%3D%3D ") == "a+b==" and C.decoded_key("plain") == "plain"
