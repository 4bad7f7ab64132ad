"""Collection windows as rows: which intervals of which feed are to be read, under which file names."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Division codes of a feed that is collected per division (fixed values).
DIVISIONS = {"1": "goods", "2": "foreign", "3": "construction", "5": "service"}


@dataclass(frozen=True)
class Feed:
    """A source: its operation, the parameters that bound it, and how its time is cut. ``days`` None and not monthly: one window."""

    name: str
    operation: str
    start_param: str
    end_param: str
    minutes: bool = True
    days: int | None = None
    monthly: bool = False
    divided: bool = False


FEEDS = {
    f.name: f
    for f in (
        Feed("bids", "getDataSetOpnStdBidPblancInfo", "bidNtceBgnDt", "bidNtceEndDt", monthly=True),
        Feed("awards", "getDataSetOpnStdScsbidInfo", "opengBgnDt", "opengEndDt", days=1, divided=True),
        Feed("contracts", "getDataSetOpnStdCntrctInfo", "cntrctCnclsBgnDate", "cntrctCnclsEndDate", minutes=False, days=7),
    )
}


def month_windows(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Each row's interval cut at month ends: adds ``window_start, window_end``; none for a reversed interval."""
    first = F.explode(F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month")))
    cut = df.where(F.col(start) <= F.col(end)).withColumn("_m", first)
    return cut.withColumns({"window_start": F.greatest("_m", start), "window_end": F.least(F.last_day("_m"), end)}).drop("_m")


def fixed_windows(df: DataFrame, days: int | Column, start: str = "start", end: str = "end") -> DataFrame:
    """Each row's interval cut every ``days`` days from its start; the last window is shorter if need be."""
    n = F.lit(days) if isinstance(days, int) else days
    offsets = F.sequence(F.lit(0), F.floor(F.date_diff(F.col(end), F.col(start)) / n).cast("int"))
    cut = df.where(F.col(start) <= F.col(end)).withColumn("_k", F.explode(offsets))
    begin = F.date_add(F.col(start), (F.col("_k") * n).cast("int"))
    return cut.withColumns({"window_start": begin, "window_end": F.least(F.date_add(begin, (n - 1).cast("int")), F.col(end))}).drop("_k")


def boundary(day: Column, minutes: bool, is_end: bool) -> Column:
    """A window's bound as the source wants it: by the minute from 0000 to 2359, or by the day."""
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lit("2359" if is_end else "0000")) if minutes else F.date_format(day, "yyyyMMdd")


def file_name(feed: Column, label: Column, start: Column, end: Column) -> Column:
    return F.concat(feed, F.lit("_"), label, F.lit("_"), F.date_format(start, "yyyyMMdd"), F.lit("_"), F.date_format(end, "yyyyMMdd"), F.lit(".jsonl.gz"))


def manifest_key(feed: Column, category: Column, start: Column, end: Column) -> Column:
    return F.concat_ws("::", feed, F.coalesce(category, F.lit("all")), F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd"))


def plan(spark: SparkSession, start: date, end: date, feeds: tuple[str, ...] = tuple(FEEDS)) -> DataFrame:
    """All windows between two days: ``feed, operation, category, label, window_start, window_end, start_value, end_value,
    file_name, manifest_key``. Only the interval is on the driver; the windows are made by expressions."""
    if start > end:
        raise ValueError("the interval ends before it starts")
    out = None
    for name in feeds:
        f = FEEDS[name]
        one = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
        cut = month_windows(one) if f.monthly else fixed_windows(one, f.days) if f.days else one.withColumns({"window_start": F.col("start"), "window_end": F.col("end")})
        codes = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(t).alias("label")) for c, t in DIVISIONS.items()]) if f.divided else F.array(F.struct(F.lit(None).cast("string").alias("category"), F.lit("all").alias("label")))
        rows = cut.withColumn("c", F.explode(codes)).select(F.lit(name).alias("feed"), F.lit(f.operation).alias("operation"), "c.category", "c.label", "window_start", "window_end", boundary(F.col("window_start"), f.minutes, False).alias("start_value"), boundary(F.col("window_end"), f.minutes, True).alias("end_value"))
        out = rows if out is None else out.unionByName(rows)
    return out.withColumns({"file_name": file_name(F.col("feed"), F.col("label"), F.col("window_start"), F.col("window_end")), "manifest_key": manifest_key(F.col("feed"), F.col("category"), F.col("window_start"), F.col("window_end"))})


def month_scopes(start: str, end: str) -> list[tuple[str, str]]:
    """Inclusive (first day, last day) texts of each month between two days, clipped; an error for a reversed range."""
    a, b = date.fromisoformat(start), date.fromisoformat(end)
    if a > b:
        raise ValueError("the range ends before it starts")
    out = []
    while a <= b:
        after = date(a.year + a.month // 12, a.month % 12 + 1, 1)
        last = min(b, date.fromordinal(after.toordinal() - 1))
        out.append((a.isoformat(), last.isoformat()))
        a = after
    return out
