"""The core's operators for training data against brute force, and on what breaks naive ones."""

from __future__ import annotations

import random
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jangbu.operators import drift as D
from jangbu.operators import profile as P
from jangbu.operators.references import Parent, Reference, orphan_counts, orphan_rows, orphans
from jangbu.operators.selection import exact_quantiles, heavy_keys
from jangbu.plans.profile import bad_price, bad_rate
from tests.conftest import rows


def refs(spark, child, parent, **kw):
    c = spark.createDataFrame(child, "id string, fk string, d string, ref string")
    p = spark.createDataFrame(parent, "key string, d string, status string, ref string")
    found = orphans({"c": c, "p": p}, [Reference("c", ("fk",), "p", ("id",), "d", late=True)], [Parent("p", ("key",), "d", "status", "gone")])
    return found


def test_orphans(spark):
    child = [("1", "a", "2026-01-05", "x"), ("1", "a", "2026-01-05", "x"), ("2", "　b\t", "2026-01-05", None), ("3", "zz", None, None), ("4", None, "2026-01-05", None), ("5", " ", "2026-01-05", None), ("6", "a", None, None)]
    parent = [("a", "20260106", "", None), ("a", "2026-01-09", "", None), ("b", "2026-01-01", "", None), ("b", "2026/01/02", "gone", None), (None, "2026-01-01", "", None)]
    found = refs(spark, child, parent)
    assert rows(orphan_rows(found)) == [("c", "fk", "1", "late"), ("c", "fk", "2", "deleted"), ("c", "fk", "3", "missing")]
    assert rows(orphan_counts(found)) == [("c", "fk", "deleted", "2026-01", 1, 1), ("c", "fk", "late", "2026-01", 2, 1), ("c", "fk", "missing", None, 1, 1)]


def test_orphans_of_empty_tables(spark):
    assert refs(spark, [], []).count() == 0
    assert rows(orphan_rows(refs(spark, [("1", "a", "2026-01-05", None)], []))) == [("c", "fk", "1", "missing")]
    assert refs(spark, [], [("a", None, None, None)]).count() == 0


def test_a_deleted_key_that_came_back(spark):
    assert refs(spark, [("1", "a", "2026-03-01", None)], [("a", "2026-01-01", "gone", None), ("a", "2026-02-01", "new", None)]).count() == 0


def test_hot_orphan(spark):
    child = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("fk"), F.lit("2026-01-01").alias("d"))
    parent = spark.range(50).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    found = orphans({"c": child, "p": parent}, [Reference("c", ("fk",), "p", ("id",), "d")], [Parent("p", ("key",))])
    assert rows(orphan_counts(found)) == [("c", "fk", "missing", "2026-01", 6667, 1)]


LINES = "stream_code string, file_name string, window_start string, line_no int, payload string"


def drifted(spark, files):
    data = [("s", f"f{k}", f"2026-01-0{k}", i, p) for k, lines in enumerate(files, 1) for i, p in enumerate(lines)]
    return D.cells(spark.createDataFrame(data, LINES), "stream_code", "file_name", "window_start", "payload", "id", "line_no")


def test_drift(spark):
    one = ['{"id": "A", "amt": "1,200원", "total": 1200, "flag": "Y", "gone": 1}', '{"id": "B", "amt": "3,000원", "total": 5000, "flag": "N", "gone": 2}', '{"id": "C", "amt": "미정", "total": 7.0, "flag": null}', "broken", "[1]", '{"id": "A", "id": "A"}', ""]
    two = ['{"id": "A", "금액": {"value": 1200, "unit": "KRW"}, "total": "1200", "yn": true, "new": null}', '{"id": "B", "금액": {"value": 3000, "unit": "KRW"}, "total": "5,000", "yn": false, "fresh": "x"}']
    changes, _ = D.drift(drifted(spark, [one, two]))
    assert rows(changes.drop("stream")) == sorted([
        ("f2", "added", "fresh", ""), ("f2", "removed", "gone", ""), ("f2", "renamed", "yn", "flag"), ("f2", "renamed", "금액", "amt"),
        ("f2", "type_changed", "total", ""), ("f2", "type_changed", "yn", ""), ("f2", "type_changed", "금액", ""),
    ])


def test_drift_with_a_renamed_key(spark):
    one = ['{"id": "A1", "amt": 100, "x": 1}', '{"id": "B1", "amt": 200, "x": 2}', '{"id": "C1", "amt": 300}']
    two = ['{"no": "A1", "amount": 100}', '{"no": "B1", "amount": 200}', '{"no": "C1", "amount": 300}', '{"no": "D1", "amount": 5}']
    three = ['{"no": "A1", "sum": 100}', '{"no": "D1", "sum": 5}', '{"no": "B1", "sum": 200}']
    data = [("s", f"f{k}", f"2026-01-0{k}", i, p) for k, lines in enumerate((one, two, three), 1) for i, p in enumerate(lines)]
    lines = spark.createDataFrame(data, LINES)
    make = lambda keys: D.cells(lines, "stream_code", "file_name", "window_start", "payload", keys, "line_no")
    changes, _ = D.drift(make("id"), key="id", again=make)
    assert rows(changes.drop("stream")) == sorted([("f2", "renamed", "no", "id"), ("f2", "renamed", "amount", "amt"), ("f2", "removed", "x", ""), ("f3", "renamed", "sum", "amount")])


def test_sketches_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(D, "SKETCH", 20)
    one = ['{"id": "K%d", "a": %d, "b": "t%d"}' % (i, i * 7, i) for i in range(300)]
    two = ['{"id": "K%d", "c": %d, "d": "t%d"}' % (i, i * 7, i) for i in range(150, 450)]
    found = drifted(spark, [one, two])
    profile = D.field_profile(found)
    of = D.presence(profile, D.neighbours(profile)).where("type is null").select("stream", F.col("before").alias("file"), "field")
    assert D.sketches(found, of).groupBy("field").count().agg(F.max("count")).first()[0] == 20
    changes, _ = D.drift(found)
    assert {(r.old_name, r.field_name) for r in changes.where("change_kind = 'renamed'").collect()} == {("a", "c"), ("b", "d")}


def test_orphans_beyond_the_broadcast(spark, monkeypatch):
    from jangbu.operators import references

    child, parent = [(str(i), f"k{i % 7}", "2026-01-05", "x") for i in range(40)], [("k1", "2026-01-01", "", None), ("k2", "2026-02-01", "gone", None)]
    want = rows(orphan_rows(refs(spark, child, parent)))
    monkeypatch.setattr(references, "BROADCAST_KEYS", 0)
    assert rows(orphan_rows(refs(spark, child, parent))) == want and len(want) > 30


def test_drift_of_nothing(spark):
    assert D.drift(drifted(spark, []))[0].count() == 0
    assert D.drift(drifted(spark, [['{"id": "A", "x": 1}']]))[0].count() == 0
    assert D.drift(drifted(spark, [["broken"], [""]]))[0].count() == 0


def test_same_values_under_two_names_go_by_name(spark):
    one = ['{"id": "%s", "cntrctAmt": %d, "ttalCntrctAmt": %d}' % (k, v, v) for k, v in (("A", 1), ("B", 2), ("C", 3))]
    two = ['{"id": "%s", "ttal_cntrct_amt": %d, "cntrct_amt": %d}' % (k, v, v) for k, v in (("A", 1), ("B", 2), ("C", 3))]
    changes, _ = D.drift(drifted(spark, [one, two]))
    assert {(r.old_name, r.field_name) for r in changes.where("change_kind = 'renamed'").collect()} == {("cntrctAmt", "cntrct_amt"), ("ttalCntrctAmt", "ttal_cntrct_amt")}


def test_unify(spark):
    one = ['{"id": "A", "amt": "1,200원", "when": "2026.01.02", "yn": "Y", "x": 1}']
    two = ['{"id": "A", "금액": {"value": 1200, "unit": "KRW"}, "when": 20260102, "yn": 1}', '{"id": "B", "금액": "모름"}', "broken"]
    lines = spark.createDataFrame([("s", f"f{k}", f"2026-01-0{k}", i, p) for k, ps in ((1, one), (2, two)) for i, p in enumerate(ps)], LINES)
    out = D.unify(lines, "payload", {"amt": ["amt", "금액"]}, {"no": ("id", "text"), "amount": ("amt", "number"), "day": ("when", "day"), "joint": ("yn", "flag")}, ["file_name", "line_no"])
    got = [(r.file_name, r.no, r.amount, str(r.day), r.joint, r.other_fields) for r in out.orderBy("file_name", "line_no").collect()]
    assert got == [("f1", "A", 1200.0, "2026-01-02", True, {"x": "1"}), ("f2", "A", 1200.0, "2026-01-02", True, {}), ("f2", "B", None, "None", None, {}), ("f2", None, None, "None", None, None)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4).flatmap(lambda n: st.integers(1, 4).flatmap(lambda m: st.lists(st.lists(st.integers(0, 9), min_size=m, max_size=m), min_size=n, max_size=n))))
def test_matching_is_the_best(weights):
    n, m = len(weights), len(weights[0])
    size = max(n, m)
    full = [[weights[i][j] if i < n and j < m else 0 for j in range(size)] for i in range(size)]
    best = max(sum(full[i][p[i]] for i in range(size)) for p in permutations(range(size)))
    got = D.assign([[float(x) for x in r] for r in weights])
    assert sum(weights[i][j] for i, j in enumerate(got) if j >= 0) == best
    used = [j for j in got if j >= 0]
    assert len(used) == len(set(used))


def test_heavy_keys(spark):
    data = [("hot",)] * 40 + [(" hot ",)] * 10 + [(f"k{i}",) for i in range(945)] + [(None,)] * 5
    df = spark.createDataFrame(data, "k string")
    assert rows(heavy_keys(df, {"k": F.trim("k")}, 0.02).select("key_value", "n", "total")) == [("hot", 50, 1000)]
    assert rows(heavy_keys(df, {"k": F.trim("k")}, 0.02, bins=3).select("key_value", "n")) == [("hot", 50)]
    assert heavy_keys(df.limit(0), {"k": F.col("k")}, 0.02).count() == 0


def test_exact_quantiles(spark):
    rng = random.Random(1)
    data = [(k, rng.choice([float("nan"), None, rng.lognormvariate(10, 4), 5.0, -rng.random()]), "x") for k in ["hot"] * 3000 + ["cold"] * 50 + [None] * 40]
    df = spark.createDataFrame(data, "k string, v double, n string")
    probs = [0.0, 0.1, 0.5, 0.99, 1.0]
    for share in (0.5, 0.001):
        got = {(r.k, r.prob): (r.n, r.value) for r in exact_quantiles(df, ["k"], "v", probs, share=share, bins=16).collect()}
        for k in ("hot", "cold", None):
            v = np.sort([x for kk, x, _ in data if kk == k and x is not None and x == x])
            for p in probs:
                assert got[k, p] == (len(v), v[max(1, int(np.ceil(round(p * len(v), 9)))) - 1])
        for r in exact_quantiles(df, ["k"], "v", [0.1, 0.5], share=share, bins=16, continuous=True).collect():
            v = np.array([x for kk, x, _ in data if kk == r.k and x is not None and x == x])
            assert abs(r.value - np.quantile(v, r.prob)) <= 1e-9 * abs(r.value)
    assert exact_quantiles(df.limit(0), ["k"], "v", [0.5]).count() == 0
    assert exact_quantiles(df.where("v is null"), ["k"], "v", [0.5]).count() == 0


def test_bad_values(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 0.0, -1.0, float("nan"), float("inf"), 1e14, 999999.0, 9999999.0, 99999.99, 99999.9, None)], "v double")
    assert [r.x for r in df.select(bad_price(F.col("v")).alias("x")).collect()] == [False, True, True, True, True, True, False, True, False, False, None]
    rates = spark.createDataFrame([(v,) for v in (0.0, 100.0, 100.1, -0.1, float("nan"), None)], "v double")
    assert [r.x for r in rates.select(bad_rate(F.col("v")).alias("x")).collect()] == [False, False, True, True, True, None]


def test_violations(spark):
    data = [("L1", float(v), f"a{v}") for v in range(100, 110)] + [("L2", float(v) * 1000, f"b{v}") for v in range(100, 110)] + [("L3", None, "c")] * 4 + [("L3", 100.0, f"c{i}") for i in range(6)] + [("L1", -1.0, "bad"), ("L1", -1.0, "bad"), (None, 5.0, "d")] + [("L4", float(v), f"e{v}") for v in range(100, 120)]
    df = spark.createDataFrame(data, "load string, v double, id string")
    watched = [P.Checked("t", "v", lambda v: v <= 0, F.col("id"), "load", 0.0, 1e9, open_low=True)]
    got = P.violations({"t": df}, watched, 0.4, 20.0)
    assert rows(got) == [("t", "v", "bad_value", "bad"), ("t", "v", "load_nulls", "L3"), ("t", "v", "load_shift", "L2")]
    assert P.violations({"t": df.limit(0)}, watched, 0.4, 20.0).count() == 0


def test_expressions(spark):
    data = [(f"R26BK{i:08d}", "L1") for i in range(200)] + [("??", "L1"), (None, "L1")] + [(f"R26BK{i:08d}", "L2") for i in range(5)] + [(f"x-{i}", "L2") for i in range(5)]
    df = spark.createDataFrame(data, "v string, load string")
    counts = P.value_counts(df, ["v"], "load")
    induced = P.induce(counts)
    assert ("v", "^[A-Z][0-9]{2}[A-Z]{2}[0-9]{8}$") in {(r.column_name, r.pattern) for r in P.patterns(induced).collect()}
    got = {r.load: (r.rows, r.nulls, r.conforming, r.nonconforming) for r in P.coverage(counts, P.expressions(induced)).collect()}
    assert got["L1"] == (202, 1, 200, 1)
    assert P.induce(counts.limit(0)).count() == 0


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1.5, True), (" ", float("inf"), None), (None, None, None), ("a", -2.0, False)], "column_name string, v double, b boolean")
    got = {r.column_name: tuple(r)[1:] for r in P.aggregates(df, df.columns).collect()}
    assert got["column_name"] == (4, 1, 1, 2, " ", "a", None, None)
    assert got["v"] == (4, 1, 0, 3, None, None, -2.0, 1.5)
    assert got["b"] == (4, 2, 0, 2, None, None, None, None)
