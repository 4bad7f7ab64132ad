"""Percentiles of very large numeric columns, from summaries that add up.

A summary holds group-value counts: values on a grid of step ``2 * error``, and how often each occurs. Summaries of
separate partitions, loads or days are put together by adding counts, and a percentile of the whole is within ``error``
of the exact one. Percentiles come from SQL cumulative frequencies: the counts are range-sorted by group and value over
all tasks, each task's running sums are shifted by the totals of the tasks before it, and the first value that reaches
a target rank is taken. A group's values may lie in any number of tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from jangbu.session import cut


def summarise(df: DataFrame, keys: Sequence[str], value: str, error: float) -> DataFrame:
    """``*keys, bin, n``: the rows whose value rounds to ``bin`` grid steps.

    Null, NaN and infinite values are left out. Null keys are a group. Equal values are counted, so ties and repeated
    rows keep their weight. An empty table gives an empty summary. Partial counts are made before the shuffle, and a
    group's share of the shuffle is at most its number of grid steps.
    """
    v = F.col(value).cast("double")
    step = F.round(v / F.lit(2.0 * error)).cast("long")
    return df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))).groupBy(*keys, step.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merged(summaries: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One summary of several, of the same error, that all have ``keys``; further columns fall away."""
    rows = reduce(DataFrame.unionByName, [s.select(*keys, "bin", "n") for s in summaries])
    return rows.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))


def percentiles(summary: DataFrame, keys: Sequence[str], probs: Sequence[float], error: float, tasks: int | None = None) -> DataFrame:
    """``*keys, prob, n, value, error``: the value of rank ``ceil(prob * n)`` per group, at most ``error`` off."""
    keys = list(keys)
    tasks = tasks or int(summary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    counted = cut(summary.select(group.alias("g"), "bin", "n"))  # placing samples it first, which would count everything twice
    ranged = counted.repartitionByRange(tasks, "g", "bin").withColumn("task", F.spark_partition_id())
    placed = cut(ranged)  # both uses below must see the same placement, also after a lost executor
    per_task = placed.groupBy("g", "task").agg(F.sum("n").alias("here"))
    before = W.partitionBy("g").orderBy("task")
    offsets = per_task.select(
        "g",
        "task",
        (F.sum("here").over(before) - F.col("here")).alias("offset"),
        F.sum("here").over(W.partitionBy("g")).alias("total"),
    )
    running = F.sum("n").over(W.partitionBy("g", "task").orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    upto = placed.withColumn("run", running).join(offsets, ["g", "task"]).withColumn("upto", F.col("run") + F.col("offset"))
    each = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    target = F.greatest(F.lit(1), F.ceil(F.round(F.col("prob") * F.col("total"), 9)))
    hit = upto.select("*", each).withColumn("rank", target).where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
    return hit.select(*[F.col("g")[k].alias(k) for k in keys], "prob", F.col("total").alias("n"), (F.col("bin") * F.lit(2.0 * error)).alias("value"), F.lit(error).alias("error"))
