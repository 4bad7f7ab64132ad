"""Per-key results where a few keys hold most rows.

Nothing here gathers a key's rows. Values are selected by rank with refined histograms: a first pass counts each key's rows
by coarse bin, each further pass counts, in equal-width bins, only the rows inside the bin that holds a target rank, until
that bin holds one value. Every pass is a sum of counts, made where the rows lie before anything moves. Heavy keys come
from the same selection: a key that holds a share of all rows holds a value of every so many-th rank.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from jangbu.session import cut

#: Intervals of keys with at least this share of all rows go to every task; there are at most one over it of such keys.
HEAVY_SHARE = 0.001
BINS = 4096
_HASH_BITS, _COARSE_BITS = 52, 12


def coarse(v: Column) -> Column:
    """A bin that keeps the order of finite numbers: the sign and a sixteenth of the binary order of magnitude."""
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * (F.floor(F.log2(F.abs(v)) * 16) + 20_000)).cast("int")


def selected(rows: DataFrame, targets: Callable[[DataFrame], DataFrame], which: Sequence[str], bins: int = BINS, share: float = HEAVY_SHARE) -> DataFrame:
    """The values of asked ranks: ``k, *which, n, value``.

    ``rows`` has ``k`` (any type), ``v`` (a finite number) and ``b``, a bin of it that keeps its order, of which a key has a
    bounded number; rows with a null ``b`` hold no value but count in ``total``; with a column ``w`` each row stands for so
    many. ``targets`` gives, for the rows ``k, n,
    total`` of all keys, the rows ``k, *which, n, rank`` with 1-based ranks among the ``n`` values.

    Intervals of keys with at least ``share`` of all rows are broadcast, as their number is bounded by that, and their rows
    are counted where they lie; intervals of the other keys are joined by key and bin.
    """
    many = (F.sum("w") if "w" in rows.columns else F.count(F.lit(1))).alias("c")
    first = cut(rows.groupBy("k", "b").agg(many, F.min("v").alias("lo"), F.max("v").alias("hi")))
    counts = first.groupBy("k").agg(F.coalesce(F.sum(F.when(F.col("b").isNotNull(), F.col("c"))), F.lit(0)).alias("n"), F.sum("c").alias("total"))
    heavy = (first.agg(F.sum("c")).first()[0] or 0) * share
    up = W.partitionBy("k").orderBy("b").rowsBetween(W.unboundedPreceding, 0)
    upto = first.where("b is not null").withColumn("upto", F.sum("c").over(up))
    reached = (F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("c") < F.col("left"))
    keep = ["k", *which, "n", "b"]
    left = F.col("left") - (F.col("upto") - F.col("c"))
    asked = targets(counts).select("k", *which, "n", F.col("rank").alias("left"))
    open_ = cut(asked.join(upto, "k").where(reached).select(*keep, left.alias("left"), "lo", "hi"))
    done: list[DataFrame] = []
    while True:
        done.append(open_.where("lo = hi").select("k", *which, "n", F.col("lo").alias("value")))
        open_ = open_.where("lo < hi")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)
        hot = open_.where(F.col("n") >= heavy).select("k", "b", "lo", "hi").distinct()
        cold = open_.where(F.col("n") < heavy).select("k", "b", "lo", "hi").distinct()
        inside = rows.join(F.broadcast(hot), ["k", "b"]).where("v between lo and hi")
        if not cold.isEmpty():
            inside = inside.unionByName(rows.join(cold, ["k", "b"]).where("v between lo and hi"))
        place = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).alias("bin")
        hist = inside.groupBy("k", "b", "lo", "hi", place).agg(many, F.min("v").alias("least"), F.max("v").alias("most"))
        up = W.partitionBy("k", "b", "lo", "hi").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
        finer = hist.withColumn("upto", F.sum("c").over(up))
        hit = open_.join(finer, ["k", "b", "lo", "hi"]).where(reached)
        open_ = cut(hit.select(*keep, left.alias("left"), F.col("least").alias("lo"), F.col("most").alias("hi")))


def heavy_keys(df: DataFrame, columns: dict[str, Column], share: float, bins: int = BINS) -> DataFrame:
    """Keys that at least ``share`` of all rows hold: ``column_name, key_value, n, total``, exact.

    ``columns`` maps a report name to the key expression; rows whose key is null hold no key but count in the total.
    With keys in the order of their hashes, a key of ``share * total`` rows covers a rank that is a multiple of that number,
    so the hashes at these ranks, at most ``1 / share`` a column, are selected by refined histograms; the keys of these
    hashes are then counted, which leaves out those that merely stood at such a rank. An empty table gives no rows.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(name).alias("column_name"), key.cast("string").alias("key_value")) for name, key in columns.items()]))
    long = df.select(keys.alias("x")).select("x.*")
    placed = long.withColumn("h", F.when(F.col("key_value").isNotNull(), F.shiftrightunsigned(F.xxhash64("key_value"), 64 - _HASH_BITS)))
    rows = placed.select(F.col("column_name").alias("k"), F.shiftright("h", _HASH_BITS - _COARSE_BITS).cast("int").alias("b"), F.col("h").cast("double").alias("v"))
    step = F.greatest(F.lit(1), F.ceil(F.round(F.col("total") * share, 6))).cast("long")

    def every(counts: DataFrame) -> DataFrame:
        return counts.where(F.col("n") >= step).select("k", "n", "total", F.explode(F.sequence(step, F.col("n"), step)).alias("rank"))

    stood = selected(rows, every, ["total"], bins).select(F.col("k").alias("column_name"), F.col("value").cast("long").alias("h"), "total").distinct()
    inside = placed.join(F.broadcast(stood), ["column_name", "h"])  # at most 1 / share rows a column
    return inside.groupBy("column_name", "key_value", "total").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= F.col("total") * share).select("column_name", "key_value", "n", "total")


def _targets(counts: DataFrame, probs: Sequence[float], continuous: bool) -> DataFrame:
    """Target ranks, 1-based: the smallest rank that covers the share ``prob`` of ``n`` values; or, if ``continuous``, the two
    ranks (``side`` 0 and 1) that the position ``prob * (n - 1)`` lies between."""
    out = counts.select("k", "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    if not continuous:
        return out.withColumns({"side": F.lit(0), "rank": F.greatest(F.lit(1), F.ceil(F.round(F.col("prob") * F.col("n"), 9))).cast("long")})
    place = F.round(F.col("prob") * (F.col("n") - 1), 9)
    return out.select("*", F.posexplode(F.array(F.floor(place) + 1, F.ceil(place) + 1)).alias("side", "rank"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], bins: int = BINS, continuous: bool = False, share: float = HEAVY_SHARE, weight: str | None = None) -> DataFrame:
    """Exact quantiles per key: ``*keys, prob, n, value``; the value of rank ``ceil(prob * n)`` among the key's ``n`` values,
    or, if ``continuous``, the interpolated one (so that 0.5 is the median). No key may be named prob, n or value.

    Null, NaN and infinite values are left out; a key without values gives no row; a null key is a key of its own. Ties
    and repeated rows count as often as they occur, or as ``weight`` says. Every key is refined by histogram and none is gathered; ``share`` only
    says which keys' intervals are broadcast. The shuffle of a pass is at most ``bins`` counts per heavy key, interval and
    task, and the rows in open intervals of the other keys.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    weight = [F.col(weight).alias("w")] if weight else []
    rows = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))).select(F.struct(*keys).alias("k"), v.alias("v"), *weight).withColumn("b", coarse(F.col("v")))
    out = selected(rows, lambda counts: _targets(counts, probs, continuous), ["prob", "side"], bins, share)
    if continuous:
        place = F.round(F.col("prob") * (F.col("n") - 1), 9)
        sides = out.groupBy("k", "prob", "n").agg(F.min("value").alias("a"), F.max("value").alias("b"))
        out = sides.withColumn("value", F.col("a") + (F.col("b") - F.col("a")) * (place - F.floor(place)))
    return out.select(*[F.col("k")[c].alias(c) for c in keys], "prob", "n", "value")
