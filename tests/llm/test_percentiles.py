from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jangbu.llm.percentiles import merged, percentiles, summarise
from tests.conftest import rows

S = "g string, load string, v double, bin string, n string, task string"


def data():
    rng = random.Random(3)
    return [(g, rng.choice("ab"), rng.choice([rng.gauss(50, 20), 5.0, None, float("nan"), float("inf")]), "x", "y", "z") for g in ["hot"] * 2000 + ["cold"] * 20 + [None] * 30 + ["one"]] + [("one", "a", 1.0, None, None, None)]


@pytest.mark.parametrize("error", [0.0005, 0.5])
@pytest.mark.parametrize("tasks", [1, 7])
def test_against_sorting(spark, error, tasks):
    d = data()
    df = spark.createDataFrame(d, S)
    whole = merged([summarise(df.where("load = 'a'"), ["g", "load"], "v", error), summarise(df.where("load = 'b'"), ["g", "load"], "v", error)], ["g"])
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {(r.g, r.prob): r for r in percentiles(whole, ["g"], probs, error, tasks).collect()}
    for g in ("hot", "cold", None):
        v = np.sort([x for gg, _, x, *_ in d if gg == g and x is not None and np.isfinite(x)])
        for p in probs:
            exact = v[max(1, int(np.ceil(round(p * len(v), 9)))) - 1]
            assert got[g, p].n == len(v) and abs(got[g, p].value - exact) <= error * 1.0001


def test_without_groups_and_empty(spark):
    df = spark.createDataFrame(data(), S)
    assert percentiles(summarise(df, [], "v", 0.1), [], [0.5], 0.1).count() == 1
    assert percentiles(summarise(df.limit(0), ["g"], "v", 0.1), ["g"], [0.5], 0.1).count() == 0
    assert percentiles(summarise(df.withColumn("v", F.lit(None).cast("double")), ["g"], "v", 0.1), ["g"], [0.5], 0.1).count() == 0


def test_all_values_equal(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), F.lit(2.0).alias("v"))
    assert rows(percentiles(summarise(df, ["g"], "v", 0.5), ["g"], [0.01, 0.99], 0.5)) == [("g", 0.01, 1000, 2.0, 0.5), ("g", 0.99, 1000, 2.0, 0.5)]
