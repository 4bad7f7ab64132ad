"""Joins, membership and keys: keep-last, existence flags, coverage, overlap, uniqueness, optional columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from jangbu.functions.cleaning import ratio
from jangbu.functions.text import blank_to_null, trimmed
from jangbu.session import cut


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column], within: Sequence[str] = ()) -> DataFrame:
    """The last row by ``order`` of each key within each group of ``within`` (a file, say). Null keys are equal.

    ``order`` must be total for the result to be fixed. Without keys, whole rows are compared.
    """
    by = [*within, *(keys or [c for c in df.columns if c not in within])]
    struct = F.struct(*[F.col(c) for c in df.columns])
    last = F.max_by(struct, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    grouped = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]).agg(last.alias("_row"))
    return grouped.select("_row.*")


def consecutive_repeats(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Per group, how many rows say the same as the row right before them: ``*group, repeats``.

    Rows are range-sorted over all tasks, so a group of any size is several tasks; each task's first row is compared with
    the last row of the task before it, which are two rows a task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*[F.col(c) for c in [*group, *order]])
    ranged = cut(df.select(place.alias("place"), F.struct(*[F.col(c) for c in group]).alias("g"), F.col(value).alias("v")).repartitionByRange(tasks, "place").withColumn("task", F.spark_partition_id()))
    inner = W.partitionBy("task").orderBy("place")
    before = F.lag(F.struct("g", "v")).over(inner)
    near = ranged.select("g", "v", before.alias("b"))
    ends = ranged.groupBy("task").agg(F.min_by(F.struct("g", "v"), "place").alias("first"), F.max_by(F.struct("g", "v"), "place").alias("last"))
    seams = ends.select(F.col("first.g").alias("g"), F.col("first.v").alias("v"), F.lag("last").over(W.orderBy("task")).alias("b"))
    same = (F.col("b") == F.struct("g", "v")).cast("long")
    inside = near.groupBy("g").agg(F.coalesce(F.sum(F.when(F.col("b").isNotNull(), same)), F.lit(0)).alias("n"))
    across = seams.where("b is not null").groupBy("g").agg(F.sum(same).alias("n"))
    return inside.unionByName(across).groupBy("g").agg(F.sum("n").alias("repeats")).select(*[F.col("g")[c].alias(c) for c in group], "repeats")


def flag_existing(df: DataFrame, on: Sequence[str], others: DataFrame, other_on: Sequence[str], name: str) -> DataFrame:
    """``df`` with a boolean: whether its trimmed key is among the keys of ``others``. No row is added or lost.

    The keys come to distinct first; which side is broadcast, if any, is decided by their measured size.
    """
    pairs = list(zip(on, other_on, strict=True))
    keys = others.select(*[blank_to_null(o).alias(f"_e{i}") for i, (_, o) in enumerate(pairs)]).dropna().distinct().withColumn("_exists", F.lit(True))
    match = None
    for i, (c, _) in enumerate(pairs):
        same = blank_to_null(df[c]) == keys[f"_e{i}"]
        match = same if match is None else match & same
    columns = [df[c] for c in df.columns if c != name]
    return df.join(keys, match, "left").select(*columns, F.coalesce(keys["_exists"], F.lit(False)).alias(name))


def flag_counts(df: DataFrame, name: str, digits: int = 4) -> DataFrame:
    """``total, matched, unmatched, match_ratio`` of a boolean column; 0.0 for an empty table."""
    n, hit = F.count(F.lit(1)), F.count_if(F.coalesce(F.col(name), F.lit(False)))
    return df.agg(n.alias("total"), hit.alias("matched"), (n - hit).alias("unmatched"), ratio(hit, n, digits).alias("match_ratio"))


def coverage(df: DataFrame, column: str, dimension: DataFrame, key: str, digits: int = 4, count_blank: bool = False) -> DataFrame:
    """How many non-blank references find their key: ``total, matched, unmatched, coverage``; 1.0 where there are none."""
    refs = df.select(blank_to_null(column).alias("_ref"))
    if not count_blank:
        refs = refs.where("_ref is not null")
    counted = refs.groupBy("_ref").agg(F.count(F.lit(1)).alias("_n"))  # before the join: hot keys become one row
    keys = dimension.select(blank_to_null(key).alias("_ref")).dropna().distinct().withColumn("_hit", F.lit(True))
    n, hit = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0))
    return counted.join(keys, "_ref", "left").agg(n.alias("total"), hit.alias("matched"), (n - hit).alias("unmatched"), ratio(hit, n, digits, 1.0).alias("coverage"))


def overlap(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys in both, only in the left, only in the right."""
    a = left.select(*keys).distinct().withColumn("_l", F.lit(True))
    b = right.select(*keys).distinct().withColumn("_r", F.lit(True))
    match = None
    for k in keys:
        same = a[k].eqNullSafe(b[k])
        match = same if match is None else match & same
    both = a.join(b, match, "full")
    return both.agg(F.count_if(F.col("_l") & F.col("_r")).alias("in_both"), F.count_if(F.col("_r").isNull()).alias("only_left"), F.count_if(F.col("_l").isNull()).alias("only_right"))


def key_integrity(df: DataFrame, keys: Sequence[str], digits: int = 6) -> DataFrame:
    """``total, non_null, null_ratio, distinct_keys, duplicates, is_unique`` of a (composite) key; any null part makes a key null."""
    whole = None
    for k in keys:
        whole = F.col(k).isNotNull() if whole is None else whole & F.col(k).isNotNull()
    key = F.when(whole, F.struct(*keys))
    per_key = df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    there = F.when(F.col("k").isNotNull(), F.col("n"))
    n, full, distinct = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(there), F.lit(0)), F.count("k")
    return per_key.agg(n.alias("total"), full.alias("non_null"), ratio(n - full, n, digits).alias("null_ratio"), distinct.alias("distinct_keys"), (full - distinct).alias("duplicates"), ((full == distinct) & (full == n)).alias("is_unique"))


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` itself, if its key is unique and never null; else an error that says how often it isn't."""
    r = key_integrity(df, keys).first()
    if r.total and not r.is_unique:
        raise ValueError(f"{what}: {r.duplicates} repeated and {r.total - r.non_null} null keys of {', '.join(keys)}")
    return df


def column_or(df: DataFrame, name: str, default: object, kind: str) -> Column:
    """A column if the table has it, else a typed default."""
    return F.col(name) if name in df.columns else F.lit(default).cast(kind)


def text_or_blank(df: DataFrame, name: str, trim: bool = True) -> Column:
    c = F.coalesce(column_or(df, name, "", "string").cast("string"), F.lit(""))
    return (trimmed(c) if trim else c).alias(name)


def most_frequent_name(df: DataFrame, key: str, name: Column, other: str = "names", by: Sequence[str] = ()) -> DataFrame:
    """Per key (within ``by``, a month say) its most frequent non-blank name (ties: the smallest) and how many it has:
    ``*by, key, name, names``.

    Counts per (key, name) come first, so a key with very many rows is a few rows when it is decided on.
    """
    counted = df.select(*by, key, name.alias("_name")).where(F.col(key).isNotNull() & (F.col("_name") != "")).groupBy(*by, key, "_name").agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_name").alias("name")))
    return counted.groupBy(*by, key).agg(best["name"].alias("name"), F.count(F.lit(1)).alias(other))
