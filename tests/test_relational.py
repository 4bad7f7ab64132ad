from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from jangbu.operators import audit as A
from jangbu.operators import features as X
from jangbu.operators import relational as R
from tests.conftest import rows


def test_keep_last(spark):
    df = spark.createDataFrame([("f", 1, "a", 1), ("f", 2, "b", 2), ("f", 3, "c", 3), ("f", 4, "a", 4), ("g", 1, "a", 5), ("f", 5, None, 6), ("f", 6, None, 7)], "file string, pos int, k string, v int")
    assert rows(R.keep_last(df, ["k"], [F.col("pos")], ["file"]).select("file", "k", "v")) == [("f", None, 7), ("f", "a", 4), ("f", "b", 2), ("f", "c", 3), ("g", "a", 5)]
    assert R.keep_last(df.limit(0), ["k"], [F.col("pos")], ["file"]).count() == 0


def test_consecutive_repeats(spark):
    df = spark.createDataFrame([("f", 1, "a"), ("f", 2, "a"), ("f", 3, "b"), ("f", 4, None), ("f", 5, None), ("g", 1, "a")], "file string, pos int, v string")
    assert rows(R.consecutive_repeats(df, ["file"], ["pos"], "v")) == [("f", 2), ("g", 0)]
    long = spark.range(1000).selectExpr("case when id < 900 then 'hot' else 'cold' end as file", "id as pos", "cast(id / 10 as int) as v")
    assert rows(R.consecutive_repeats(long, ["file"], ["pos"], "v")) == [("cold", 90), ("hot", 810)]
    assert R.consecutive_repeats(long.limit(0), ["file"], ["pos"], "v").count() == 0


def test_existence_flag_keeps_rows(spark):
    df = spark.createDataFrame([("N1", "000", 1), (" N1\t", "000", 2), ("N2", "000", 3), (None, "000", 4), ("", "", 5)], "no string, round string, tender int")
    others = spark.createDataFrame([("N1", "000", "x"), ("N1", "000", "y"), ("", "", "z")], "no string, round string, tender string")
    got = R.flag_existing(df, ["no", "round"], others, ["no", "round"], "there")
    assert sorted((r.tender, r.there) for r in got.collect()) == [(1, True), (2, True), (3, False), (4, False), (5, False)]
    assert rows(R.flag_counts(got, "there")) == [(5, 2, 3, 0.4)]
    assert rows(R.flag_counts(got.limit(0), "there")) == [(0, 0, 0, 0.0)]


def test_coverage(spark):
    df = spark.createDataFrame([("a",), ("b",), (" ",), (None,), ("a",)], "k string")
    dim = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(R.coverage(df, "k", dim, "k")) == [(3, 2, 1, 0.6667)]
    assert rows(R.coverage(df.where("k is null"), "k", dim, "k")) == [(0, 0, 0, 1.0)]


def test_overlap_and_integrity(spark):
    a = spark.createDataFrame([(1, None), (2, 1), (2, 1)], "a int, b int")
    b = spark.createDataFrame([(1, None), (3, 1)], "a int, b int")
    assert rows(R.overlap(a, b, ["a", "b"])) == [(1, 1, 1)]
    assert rows(R.key_integrity(a, ["a", "b"])) == [(3, 2, 0.333333, 1, 1, False)]
    assert rows(R.key_integrity(a.limit(0), ["a"])) == [(0, 0, 0.0, 0, 0, True)]
    with pytest.raises(ValueError, match="1 repeated and 1 null"):
        R.require_unique(a, ["a", "b"], "table")


def test_majority_names(spark):
    df = spark.createDataFrame([("1", "A"), ("1", "A"), ("1", "B"), ("2", "Zeta"), ("2", "Alpha"), ("3", "")], "k string, n string")
    assert rows(R.most_frequent_name(df, "k", F.col("n"))) == [("1", "A", 2), ("2", "Alpha", 2)]


def test_collision_classes(spark):
    df = spark.createDataFrame([("k", 1, "x", 1), ("k", 1, "x", 1), ("k", 2, "x", 1), ("m", 1, "a", 1), ("m", 1, "b", 1), ("n", 1, None, 1), ("n", 1, "b", 1), ("o", 1, "a", 1), ("o", 1, "a", 2)], "key string, amount int, status string, other int")
    rules = (("DISTINCT", "any", frozenset({"amount"})), ("STATUS", "within", frozenset({"status"})))
    assert rows(A.collision_classes(df, ["key"], rules)) == [("DISTINCT", 1), ("STATUS", 2), ("UNRESOLVED", 1)]


def test_duplicates_fanout_histogram(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "2"), ("b", None), (None, "3")], "k string, v string")
    assert rows(A.duplicate_counts(df, {"by_k": ["k"]})) == [(5, 1, 2)]
    f = A.fanout(df, ["k"]).first()
    assert (f["keys"], f.least, f.median, f["mean"], f.most) == (2, 1, 2.0, 2.0, 3)
    counts = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert rows(A.histogram_012(counts, keys, ["k"], "n")) == [("0", 1), ("1", 1), ("2+", 1)]


def test_scope_audit(spark):
    df = spark.createDataFrame([("2026-01-01", "2026-01-01", "2026-01-31", "f"), ("2026-02-01", "2026-01-01", "2026-01-31", "f"), (None, "2026-01-01", "2026-01-31", "g")], "d string, a string, b string, file string").withColumn("d", F.to_date("d"))
    assert rows(A.scope_audit(df, "d", "2026-01-01", "2026-01-31", ("a", "b"), "file")) == [(3, 1, 1, 1, "2026-01-01", "2026-02-01", 2)]


def test_quality(spark, tmp_path):
    df = spark.createDataFrame([(-1.0, 600.0, "k"), (float("nan"), float("nan"), "k"), (1.0, 50.0, None)], "a_krw double, b_rate double, key string")
    r = A.quality(df, ["key"], "t")
    assert r["anomalies"] == {"a_krw": 1, "b_rate": 1} and r["critical"] == ["a_krw: 1 negative"]
    assert r["keys"]["key"]["duplicates"] == 1
    assert A.quality(df.limit(0), ["key"], "t")["critical"] == ["no rows"]
    bad = tmp_path / "x.parquet"
    bad.write_text("nothing")
    reports, critical = A.quality_of_files(spark, [str(bad)], [])
    assert critical and reports[0]["critical"][0].startswith("unreadable")


def test_history_excludes_the_same_moment(spark):
    df = spark.createDataFrame([("s", 1, True), ("s", 1, False), ("s", 2, False), ("t", 5, True)], "k string, d int, won boolean")
    got = X.history(df, "k", "d", "won").select("k", "d", "prior_bids", "prior_wins", "prior_win_rate")
    assert rows(got) == [("s", 1, 0, 0, None), ("s", 1, 0, 0, None), ("s", 2, 2, 1, 0.5), ("t", 5, 0, 0, None)]


def test_concentration_and_shares(spark):
    df = spark.createDataFrame([("m", "a"), ("m", "a"), ("m", "b"), ("n", "a")], "m string, s string")
    assert rows(X.concentration(df, "m", "s")) == [("m", 3, 2, 0.55555556), ("n", 1, 1, 1.0)]
    assert rows(X.shares(df, F.col("m"))) == [("m", 3, 75.0), ("n", 1, 25.0)]
    assert rows(X.top_values(df, "s", 1)) == [("a", 3)]
