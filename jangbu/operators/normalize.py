"""Raw records to typed columns: deduplication per file, aliases, types by name, provenance, event partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jangbu.functions.cleaning import flag, moment, number, year_month
from jangbu.functions.text import trimmed
from jangbu.operators.relational import keep_last
from jangbu.sources.schemas import ALIASES, DEDUPE_KEYS, EVENT_COLUMNS, kind_of


def dedupe_records(records: DataFrame, feed: str) -> DataFrame:
    """Per file the last record of each key, on the source's own texts; ``records`` has file, pos, record (a map).

    A key field that a file lacks is null there, and nulls are equal. A file that lacks all of them keeps the last of each
    whole record. Records of different files never replace each other.
    """
    keys = DEDUPE_KEYS.get(feed, [])
    of_key = F.to_json(F.array(*[F.coalesce(F.col("record")[k], F.lit("\0")) for k in keys])) if keys else F.lit(None).cast("string")
    whole = F.to_json(F.array_sort(F.map_entries("record")))
    has_keys = records.groupBy("file").agg(F.bool_or(F.exists(F.map_keys("record"), lambda k: k.isin(keys) if keys else F.lit(False))).alias("_keyed"))
    keyed = records.join(has_keys, "file").withColumn("_key", F.when(F.col("_keyed"), of_key).otherwise(whole))
    return keep_last(keyed.withColumn("_entries", F.map_entries("record")).drop("record"), ["_key"], [F.col("pos")], ["file"]).withColumn("record", F.map_from_entries("_entries")).select("file", "pos", "record")


def aliased(records: DataFrame, feed: str, by_value: bool = False) -> DataFrame:
    """One text column per own name of the feed. In each file the first source field that the file holds at all gives it,
    also where its value is null; with ``by_value`` the first that has a value in the row.

    Which fields a file holds is one truth value a field and file, found by one aggregate.
    """
    sources: dict[str, list[str]] = {}
    for source, own in ALIASES[feed]:
        sources.setdefault(own, []).append(source)
    names = sorted({n for ns in sources.values() for n in ns})
    held = {n: F.bool_or(F.coalesce(F.map_contains_key("record", F.lit(n)), F.lit(False))).alias(f"_has_{i}") for i, n in enumerate(names)}
    place = {n: F.col(f"_has_{i}") for i, n in enumerate(names)}
    rows = records.join(records.groupBy("file").agg(*held.values()), "file")
    columns = []
    for own, of in sources.items():
        if by_value:
            value = F.coalesce(*[F.col("record")[n] for n in of])
        else:
            value = F.when(F.lit(False), F.lit(None).cast("string"))
            for n in of:
                value = value.when(place[n], F.col("record")[n])
        columns.append(value.alias(own))
    return rows.select("file", "pos", "record", *columns)


def typed(df: DataFrame) -> DataFrame:
    """Text columns to the types that their names stand for; other columns stay."""

    def one(name: str) -> Column:
        kind = kind_of(name)
        value = {"number": number, "moment": moment, "flag": flag, "identifier": trimmed}.get(kind, F.col)(name)
        return value.alias(name)

    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.select(*[one(c) if c in text and c not in {"file"} else F.col(c) for c in df.columns])


def normalized(records: DataFrame, metas: DataFrame, feed: str, hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Typed rows of a feed with ``_source_file, _window_start, _window_end, _business_code`` and ``year, month`` of the event.

    The event's month comes from the first event column that the feed has; a row without one takes its window's month, and
    ``unknown`` / 01 where the window has none. ``hold`` may store the deduplicated records, which are needed twice.
    """
    rows = typed(aliased(hold(dedupe_records(records, feed)), feed).drop("record"))
    info = metas.select("file", *[F.col("meta")[k].alias(c) for c, k in (("_window_start", "window_start"), ("_window_end", "window_end"), ("_business_code", "business_code"))])
    out = rows.join(info, "file", "left").withColumnRenamed("file", "_source_file")
    event = next((F.col(c) for c in EVENT_COLUMNS.get(feed, []) if c in rows.columns), F.lit(None).cast("timestamp"))
    start = F.col("_window_start")
    default_year = F.when(start.rlike(r"^\d{4}"), F.substring(start, 1, 4)).otherwise("unknown")
    default_month = F.when(start.rlike(r"^.{5}\d{2}"), F.substring(start, 6, 2)).otherwise("01")
    year, month = year_month(event, default_year, default_month)
    return out.withColumns({"year": year, "month": month})
