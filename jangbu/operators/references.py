"""References to records that do not exist.

Distinct non-null foreign keys are anti-joined against the distinct keys of the parent table; what is left over is
joined back to the referring rows, which are then reported one by one or counted per table and period. All references
into one parent share the pass, so each parent's keys are shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jangbu.functions.text import blank_to_null, day, trimmed
from jangbu.session import cut

#: Failing keys of a parent up to which they are sent to every task; more of them meet the rows by a shuffle.
BROADCAST_KEYS = 200_000


@dataclass(frozen=True)
class Reference:
    """``table.columns`` names a row of ``parent``; ``report_as`` is the column the report shows.

    ``row_key`` makes the referring row's name, ``period`` its day. ``late`` compares that day with the parent's.
    """

    table: str
    columns: tuple[str, ...]
    parent: str
    row_key: tuple[str, ...]
    period: str
    report_as: str = ""
    late: bool = False

    @property
    def name(self) -> str:
        return self.report_as or self.columns[0]


@dataclass(frozen=True)
class Parent:
    """A table that is referred to. ``period`` dates its rows; the latest row whose ``status`` equals ``deleted`` deletes the key."""

    name: str
    keys: tuple[str, ...]
    period: str | None = None
    status: str | None = None
    deleted: str | None = None


def _key(columns: Sequence[str]) -> Column:
    """One comparable key: a struct of trimmed parts, null if any part is null or blank."""
    parts = [blank_to_null(c) for c in columns]
    whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(whole, F.concat_ws("\x1f", *parts))


def _parent_keys(df: DataFrame, parent: Parent) -> DataFrame:
    """One row per key: its first day and whether its latest row deletes it (a tie of days deletes)."""
    when = day(parent.period) if parent.period else F.lit(None).cast("date")
    gone = trimmed(parent.status).eqNullSafe(F.lit(parent.deleted)) if parent.status else F.lit(False)
    return (
        df.select(_key(parent.keys).alias("ref"), when.alias("parent_day"), gone.alias("gone"))
        .where("ref is not null")
        .groupBy("ref")
        .agg(F.min("parent_day").alias("first_day"), F.max(F.struct(F.coalesce("parent_day", F.lit("0001-01-01").cast("date")), "gone"))["gone"].alias("gone"))
    )


def _referring(df: DataFrame, ref: Reference) -> DataFrame:
    return df.select(
        F.lit(ref.table).alias("ref_table"),
        F.lit(ref.name).alias("ref_column"),
        _key(ref.columns).alias("ref"),
        F.concat_ws("-", *[trimmed(c) for c in ref.row_key]).alias("row_key"),
        day(ref.period).alias("row_day"),
        F.lit(ref.late).alias("dated"),
    ).where("ref is not null")


def orphans(tables: Mapping[str, DataFrame], references: Sequence[Reference], parents: Sequence[Parent], counted: bool = False) -> DataFrame:
    """Every referring row whose reference fails: ``ref_table, ref_column, ref, row_key, row_day, kind``. With ``counted`` rows
    of one reference and day are put together before they are joined: ``n`` stands in place of ``row_key``, and a key that
    very many rows refer to is one row a day.

    ``kind`` is ``missing`` (no such key), ``deleted`` (the key's latest row deletes it) or ``late`` (the key's first
    day lies behind the row's). A null or blank reference is none and makes no row; a missing day is never late.
    Repeated rows come out as often as they go in. Up to ``BROADCAST_KEYS`` failing keys of a parent are sent to the rows, so
    that a hot one isn't gathered; more are joined by key, where adaptive execution splits what is skewed. Empty tables give no rows, or only missing ones if the parent is
    empty. Extra columns are not read.
    """
    out = []
    for parent in parents:
        own = [r for r in references if r.parent == parent.name]
        if not own:
            continue
        keys = _parent_keys(tables[parent.name], parent)
        rows = reduce(DataFrame.unionByName, [_referring(tables[r.table], r) for r in own])
        if counted:
            rows = rows.groupBy("ref_table", "ref_column", "ref", "row_day", "dated").agg(F.count(F.lit(1)).alias("n"))
        named = rows.select("ref").distinct()
        failing = named.join(keys, "ref", "left_anti").select("ref", F.lit("missing").alias("kind"))
        if parent.status:
            failing = failing.unionByName(named.join(keys.where("gone"), "ref", "left_semi").select("ref", F.lit("deleted").alias("kind")))
        failing = cut(failing)  # few beside the rows, which then stay where they lie
        out.append(rows.join(F.broadcast(failing) if failing.count() <= BROADCAST_KEYS else failing, "ref"))
        if any(r.late for r in own):
            dated = rows.where("dated").join(keys.where("first_day is not null"), "ref").where("first_day > row_day")
            out.append(dated.select(*rows.columns, F.lit("late").alias("kind")))
    return reduce(DataFrame.unionByName, out).select("ref_table", "ref_column", "ref", "n" if counted else "row_key", "row_day", "kind")


def orphan_rows(found: DataFrame) -> DataFrame:
    """Each failing reference once, as ``ref_table, ref_column, row_key, kind``."""
    return found.select("ref_table", "ref_column", "row_key", "kind").distinct()


def orphan_counts(found: DataFrame) -> DataFrame:
    """Failing rows and keys per table, column, kind and month of the referring row (month null where the day is), of what
    ``orphans`` found, counted or not."""
    month = F.date_format("row_day", "yyyy-MM").alias("month")
    each = F.sum("n") if "n" in found.columns else F.count(F.lit(1))
    per_key = found.groupBy("ref_table", "ref_column", "kind", month, "ref").agg(each.alias("n"))
    return per_key.groupBy("ref_table", "ref_column", "kind", "month").agg(F.sum("n").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
