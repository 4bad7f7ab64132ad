"""Audits: what deduplication would remove and why, cardinalities between the feeds, completeness against scope, nulls."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.functions.cleaning import business_number, ratio, valid_business_number
from jangbu.functions.text import blank_to_null, is_blank
from jangbu.operators.relational import key_integrity

KEY = ["bid_notice_no", "bid_notice_round"]


def duplicate_counts(df: DataFrame, keys: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """Per group ``by``: rows, exact repeats, and for each named key the rows beyond its first: ``rows, exact, <name>...``.

    Nulls are equal, as in a struct. Exact repeats come to counts first, so hot repeats are one row in what follows.
    """
    whole = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    out = whole.groupBy(*by).agg(F.sum("_n").alias("rows"), (F.sum("_n") - F.count(F.lit(1))).alias("exact"), *[F.count_distinct(F.struct(*k)).alias(f"_d_{n}") for n, k in keys.items()])
    return out.select(*by, "rows", "exact", *[(F.col("rows") - F.col(f"_d_{n}")).alias(n) for n in keys])


def collision_classes(df: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, str, frozenset[str]]], unresolved: str = "UNRESOLVED") -> DataFrame:
    """Rows that share ``keys`` but aren't exact repeats, by what differs: ``collision_class, excess_rows``.

    A rule is (class, kind, columns): ``any`` holds if one of the columns differs, ``within`` if no other does. Rules are
    tried in order. A null is no difference from a value. Groups count one row less than they have.
    """
    others = [c for c in df.columns if c not in keys and not c.startswith("_")]
    distinct = df.distinct()
    # more than one value: the least isn't the greatest (nulls aside), which needs no sets of values
    differs = F.array_compact(F.array(*[F.when(F.min(c) < F.max(c), F.lit(c)) for c in others])) if others else F.array().cast("array<string>")
    groups = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), differs.alias("diff")).where("n > 1")
    kind = F.when(F.lit(False), "")
    for name, how, columns in rules:
        of = F.array(*[F.lit(c) for c in sorted(columns)])
        kind = kind.when(F.arrays_overlap("diff", of) if how == "any" else F.size(F.array_except("diff", of)) == 0, name)
    return groups.groupBy(kind.otherwise(unresolved).alias("collision_class")).agg(F.sum(F.col("n") - 1).alias("excess_rows"))


def histogram_012(counts: DataFrame, keys: DataFrame, on: Sequence[str], n: str) -> DataFrame:
    """How many of ``keys`` have 0, 1, 2 and more: ``bucket, keys``, every bucket a row."""
    joined = keys.select(*on).distinct().join(counts.select(*on, n), list(on), "left")
    got = joined.agg(*[F.count_if(test).alias(b) for b, test in (("0", F.coalesce(n, F.lit(0)) == 0), ("1", F.col(n) == 1), ("2+", F.col(n) > 1))])
    return got.select(F.explode(F.array(*[F.struct(F.lit(b).alias("bucket"), F.col(f"`{b}`").alias("keys")) for b in ("0", "1", "2+")])).alias("h")).select("h.*")


def fanout(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per key: min, quartiles, 90th percentile, max (interpolated) and mean; null keys are left out.

    Percentiles are of the counts per key, one row a key.
    """
    counts = df.dropna(subset=list(keys)).groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n"))
    if by:
        counts = counts.dropna(subset=list(by))
    p = lambda q: F.percentile("n", F.lit(q))
    return counts.groupBy(*by).agg(F.count(F.lit(1)).alias("keys"), F.min("n").alias("least"), p(0.25).alias("p25"), p(0.5).alias("median"), F.round(F.avg("n"), 2).alias("mean"), p(0.75).alias("p75"), p(0.9).alias("p90"), F.max("n").alias("most"))


def winner_cardinality(awards: DataFrame, winner: str) -> DataFrame:
    """Per notice its winner rows and different winners (blank ones aside): ``*key, winner_rows, winners``."""
    return awards.dropna(subset=KEY).groupBy(*KEY).agg(F.count(F.lit(1)).alias("winner_rows"), F.count_distinct(blank_to_null(F.regexp_replace(winner, "-", ""))).alias("winners"))


def multi_winners(cardinality: DataFrame) -> DataFrame:
    return cardinality.where("winner_rows > 1").agg(F.count(F.lit(1)).alias("notices"), F.max("winner_rows").alias("most_rows"), F.max("winners").alias("most_winners"))


def link_summary(contracts: DataFrame) -> DataFrame:
    n, linked = F.count(F.lit(1)), F.count_if(~is_blank("bid_notice_no"))
    return contracts.agg(n.alias("contracts"), linked.alias("linked"), (n - linked).alias("unlinked"), ratio(linked, n, 4).alias("link_ratio"), ratio(n - linked, n, 4).alias("unlinked_ratio"))


def bridge_cardinality(contracts: DataFrame) -> DataFrame:
    """Contracts by how many notices they name, and what that makes the bridge: ``none, one, several, relationship, bridge_key``."""
    linked = contracts.where(~is_blank("bid_notice_no")).groupBy("unified_contract_no").agg(F.count_distinct("bid_notice_no").alias("n"))
    some = linked.where("unified_contract_no is not null").agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") > 1).alias("several"))
    none = contracts.agg(F.count_if(is_blank("bid_notice_no")).alias("none"))
    plain = F.col("several") == 0
    return none.join(F.broadcast(some)).select("none", "one", "several", F.when(plain, "Tender (1) : Contract (0..N)").otherwise("Tender (M) : Contract (N)").alias("relationship"), F.when(plain, "unified_contract_no").otherwise("(bid_notice_no, bid_notice_round, unified_contract_no)").alias("bridge_key"))


def role_overlap(roles: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Distinct keys by the set of roles that they have: ``roles`` (comma-joined, sorted), ``keys``."""
    rows = reduce(DataFrame.unionByName, [df.select(blank_to_null(key).alias("k"), F.lit(r).alias("role")) for r, df in roles.items()]).where("k is not null")
    return rows.groupBy("k").agg(F.concat_ws(",", F.array_sort(F.collect_set("role"))).alias("roles")).groupBy("roles").agg(F.count(F.lit(1)).alias("keys"))


def scope_audit(df: DataFrame, event: str, start: str, end: str, window: tuple[str, str] | None = None, file: str | None = None) -> DataFrame:
    """One row: ``rows, null_events, out_of_scope, window_violations, first_event, last_event, files``.

    An event outside its own file's window counts as a violation only if all three days are known.
    """
    day, null_long = F.col(event).cast("date"), F.lit(0).cast("long")
    outside = (day < F.lit(start).cast("date")) | (day > F.lit(end).cast("date"))
    violated = F.count_if((day < F.col(window[0]).cast("date")) | (day > F.col(window[1]).cast("date"))) if window else null_long
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(day.isNull()).alias("null_events"), F.count_if(outside).alias("out_of_scope"), violated.alias("window_violations"), F.min(day).cast("string").alias("first_event"), F.max(day).cast("string").alias("last_event"), (F.count_distinct(file) if file else null_long).alias("files"))


def effective_keys(keys: Sequence[str], schemas: Sequence[Sequence[str]]) -> list[str]:
    """Key columns that every file has."""
    return [k for k in keys if all(k in s for s in schemas)]


def anomalies(df: DataFrame, rate_limit: float = 500.0) -> DataFrame:
    """Per money or rate column: negative amounts, rates below 0 or above the limit; NaN is neither. ``column_name, kind, n``."""
    checks = []
    for f in df.schema.fields:
        v = F.nanvl(F.col(f.name).cast("double"), F.lit(None).cast("double")) if isinstance(f.dataType, T.NumericType) else None
        if v is not None and f.name.endswith("_krw"):
            checks.append((f.name, "negative", F.count_if(v < 0)))
        elif v is not None and f.name.endswith("_rate"):
            checks.append((f.name, "rate_out_of_range", F.count_if((v < 0) | (v > rate_limit))))
    if not checks:
        return df.sparkSession.createDataFrame([], "column_name string, kind string, n long")
    wide = df.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(checks)])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("kind"), F.col(f"c{i}").alias("n")) for i, (n, k, _) in enumerate(checks)])).alias("x")).select("x.*")


def null_ratios(df: DataFrame, top: int | None = None, digits: int = 6) -> DataFrame:
    """Null share per column, the emptiest first (ties by name): ``column_name, null_ratio``; all columns or the ``top``."""
    n = F.count(F.lit(1))
    wide = df.agg(*[ratio(n - F.count(F.col(c)), n, digits).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_ratio")) for i, c in enumerate(df.columns)])).alias("x")).select("x.*")
    return rows.orderBy(F.desc("null_ratio"), "column_name").limit(top) if top else rows


def exact_repeats(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("repeats"))


def quality(df: DataFrame, keys: Sequence[str], source: str) -> dict[str, object]:
    """A file's report: repeats, key columns, emptiest columns, anomalies and what of it is critical (no rows, negative money)."""
    r = exact_repeats(df).first()
    odd = anomalies(df).collect()
    return {
        "source": source, "rows": r.rows, "repeats": r.repeats,
        "keys": {k: key_integrity(df, [k]).first().asDict() for k in keys if k in df.columns},
        "null_ratios": {x.column_name: x.null_ratio for x in null_ratios(df, 20).collect()},
        "anomalies": {x.column_name: x.n for x in odd if x.n},
        "critical": (["no rows"] if not r.rows else []) + [f"{x.column_name}: {x.n} negative" for x in odd if x.kind == "negative" and x.n],
    }


def quality_of_files(spark, paths: Sequence[str], keys: Sequence[str]) -> tuple[list[dict[str, object]], bool]:
    """(reports, whether any is critical); a file that can't be read makes a critical report, not an error."""
    out = []
    for p in paths:
        try:
            out.append(quality(spark.read.parquet(p), keys, p))
        except Exception as e:
            out.append({"source": p, "critical": [f"unreadable: {type(e).__name__}"]})
    return out, any(r["critical"] for r in out)


def collection_accounting(manifest: DataFrame) -> DataFrame:
    """Windows, rows, calls and windows with rows per dataset and category, with totals (null: all)."""
    return manifest.rollup("dataset", "category").agg(F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"), F.coalesce(F.sum("api_calls"), F.lit(0)).alias("api_calls"), F.count_if(F.col("row_count") > 0).alias("nonempty"))


def reconciliation(processed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows by feed in the processed files and in the manifest, and whether processing lost or made any."""
    m = manifest.groupBy(F.col("dataset").alias("feed")).agg(F.sum("row_count").alias("manifest_rows"))
    p = processed.groupBy("feed").agg(F.sum("rows").alias("processed_rows"))
    return m.join(p, "feed", "full").withColumn("agrees", F.col("manifest_rows") >= F.coalesce("processed_rows", F.lit(0)))


#: Findings that make a processed feed unfit for release; the others are kept as the source's anomalies and warned of.
CRITICAL = ("no rows", "no event column", "null event", "out of scope", "outside its window", "repeated key")


def feed_findings(df: DataFrame, feed: str, event: str, keys: Sequence[str], start: str, end: str, window: tuple[str, str] | None = None) -> DataFrame:
    """What is wrong with a processed feed: ``feed, finding, n, severity``, a row per finding, also where ``n`` is 0.

    Critical are those of ``CRITICAL``; negative amounts and rates off 0 to 500 are warnings. Key columns that the table lacks
    are left out of the key; without any, and without an event column, what depends on them isn't counted. Null key parts are
    equal. Counting comes before any comparison of keys, so a hot key is a few rows.
    """
    own = effective_keys(keys, [df.columns])
    repeated = df.groupBy(*own).agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n")) if own else None
    odd = anomalies(df)
    parts = [odd.groupBy(F.when(F.col("kind") == "negative", "negative amount").otherwise("odd rate").alias("finding")).agg(F.sum("n").alias("n"))]
    if repeated is not None:
        parts.append(repeated.select(F.lit("repeated key").alias("finding"), "n"))
    if event in df.columns:
        wide = scope_audit(df, event, start, end, window)
        named = {"no rows": (F.col("rows") == 0).cast("long"), "null event": F.col("null_events"), "out of scope": F.col("out_of_scope"), "outside its window": F.col("window_violations")}
        parts.append(wide.select(F.explode(F.array(*[F.struct(F.lit(k).alias("finding"), v.alias("n")) for k, v in named.items()])).alias("x")).select("x.*"))
    else:
        parts.append(df.sparkSession.range(1).select(F.lit("no event column").alias("finding"), F.lit(1).cast("long").alias("n")))
    severity = F.when(F.col("n") == 0, "none").when(F.col("finding").isin(*CRITICAL), "critical").otherwise("warning")
    return reduce(DataFrame.unionByName, parts).select(F.lit(feed).alias("feed"), "finding", F.col("n").cast("long").alias("n"), severity.alias("severity"))


def baselines(bids: DataFrame, awards: DataFrame, contracts: DataFrame) -> DataFrame:
    """The eight counts that a curated build must reproduce: ``what, n``."""
    winners = awards.where("is_selected_winner")
    linked = contracts.where(~is_blank("bid_notice_no"))
    number = lambda df, c: df.select(business_number(c).alias("k")).where(valid_business_number(F.col("k")))
    suppliers = number(awards, "bidder_business_registration_no").union(number(winners, "winner_business_registration_no")).union(number(contracts, "contractor_business_registration_no")).distinct()
    code = lambda df, c: df.select(blank_to_null(c).alias("k")).where("k is not null")
    agencies = code(bids, "notice_agency_code").union(code(bids, "demand_agency_code")).union(code(contracts, "contract_agency_code")).union(code(contracts, "demand_agency_code")).distinct()
    whole = {"bids": bids, "awards": awards, "winners": winners, "contracts": contracts, "linked_contracts": linked, "unlinked_contracts": contracts.where(is_blank("bid_notice_no")), "suppliers": suppliers, "agencies": agencies}
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(w).alias("what"), "n") for w, df in whole.items()])


def labelled_counts(df: DataFrame, label: Column, name: str = "label") -> DataFrame:
    return df.groupBy(label.alias(name)).agg(F.count(F.lit(1)).alias("n"))


