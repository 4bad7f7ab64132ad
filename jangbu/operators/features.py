"""Market queries and history features. History is strictly before the event: rows of the same moment don't see each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from jangbu.operators.selection import exact_quantiles


def shares(df: DataFrame, label: Column, name: str = "label") -> DataFrame:
    """Counts per label and their percentage of all rows. The total is one row, sent to where the counts are."""
    n = df.groupBy(label.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return n.join(F.broadcast(total)).withColumn("share_pct", F.round(100 * F.col("n") / F.col("_total"), 4)).drop("_total")


def monthly(df: DataFrame, day: Column) -> DataFrame:
    return df.where(day.isNotNull()).groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def rates_by(df: DataFrame, label: Column, rate: str, top: int | None = None) -> DataFrame:
    """n, exact median and mean of the rates from 0 to 100 per label, most frequent first (ties by label).

    There may be few labels with very many rates each, so the medians are selected by refined histograms.
    """
    valid = df.where(F.col(rate).between(0, 100)).select(label.alias("label"), F.col(rate).alias("rate"))
    means = valid.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rate"), 6).alias("mean_rate"))
    medians = exact_quantiles(valid, ["label"], "rate", [0.5], continuous=True).select(F.col("label").alias("_label"), F.col("value").alias("median_rate"))
    out = means.join(medians, F.col("label").eqNullSafe(F.col("_label"))).select("label", "n", "median_rate", "mean_rate")
    return out.orderBy(F.desc("n"), "label").limit(top) if top else out


def top_values(df: DataFrame, column: str, top: int) -> DataFrame:
    """The most frequent values, nulls left out, ties by value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(top)


def history(events: DataFrame, key: str, day: str, won: str) -> DataFrame:
    """Adds ``prior_bids, prior_wins, prior_win_rate`` of the key before the event's day.

    Events come to one row per key and day first, so the ordered window runs over days, not over the events of a hot key.
    """
    per_day = events.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(won)).alias("_w"))
    before = W.partitionBy(key).orderBy(day).rowsBetween(W.unboundedPreceding, -1)
    run = per_day.select(key, day, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("prior_bids"), F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("prior_wins"))
    return events.join(run, [key, day]).withColumn("prior_win_rate", F.try_divide("prior_wins", "prior_bids"))


def concentration(df: DataFrame, market: str, supplier: str) -> DataFrame:
    """Per market its rows, suppliers and the sum of their squared shares."""
    per = df.groupBy(market, supplier).agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy(market).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("suppliers"), F.sum(F.col("n") * F.col("n")).alias("_s"))
    return out.select(market, "rows", "suppliers", F.round(F.col("_s") / (F.col("rows").cast("double") * F.col("rows")), 8).alias("hhi"))


def price_ratios(df: DataFrame) -> DataFrame:
    """Award against bid and scheduled price; null where the divisor is zero or either is missing."""
    r = lambda a, b: F.round(F.try_divide(F.col(a), F.col(b)), 6)
    return df.withColumns({"award_to_bid": r("award_amount_krw", "bid_amount_krw"), "award_to_scheduled": r("award_amount_krw", "scheduled_price_krw"), "bid_to_scheduled": r("bid_amount_krw", "scheduled_price_krw")})


def days_between(a: Column, b: Column) -> Column:
    return F.date_diff(b, a)
