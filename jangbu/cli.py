"""Command line: python -m jangbu.cli COMMAND ...; exit codes 0 done, 1 failed, 2 key refused, 3 no calls left."""

from __future__ import annotations

import argparse
import importlib
import json
import logging
import os
import re
import sys
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.functions.cleaning import shown_key
from jangbu.operators import audit, curate, gates, release
from jangbu.operators.normalize import normalized
from jangbu.session import build_session
from jangbu.sources import sinks
from jangbu.sources.feed import AuthError, Collector, QuotaError, http_fetcher
from jangbu.sources.raw import Manifest, check_windows, files_in_scope, manifest_in_scope, plan_findings, read_lines, select_planned, split_meta
from jangbu.sources.report import normalized_report, read_report
from jangbu.sources.schemas import ALIASES, DEDUPE_KEYS
from jangbu.sources.windows import FEEDS, month_scopes, plan

log = logging.getLogger("jangbu")


class Redacting(logging.Filter):
    """Keeps service keys out of logs."""

    def filter(self, record: logging.LogRecord) -> bool:
        record.msg = re.sub(r"(?i)(serviceKey=)([^&\s]+)", r"\1[REDACTED]", record.getMessage())
        record.args = ()
        return True


def secret(name: str) -> bytes:
    """A key from the environment; there is no default, so nothing is built with a known key by accident."""
    value = os.environ.get(name)
    if not value:
        raise SystemExit(f"{name} is not set")
    return value.encode()


def planned_files(spark: SparkSession, raw: str, feed: str, start: str | None, end: str | None) -> list[str]:
    """With a scope exactly the planned files, an error if some are missing; without, all files of the feed."""
    if bool(start) != bool(end):
        raise SystemExit("give both ends of the scope or none")
    folder = Path(raw) / feed
    there = sorted(p for p in folder.glob("*.jsonl.gz"))
    if not start:
        return [str(p) for p in there]
    wanted = plan(spark, date.fromisoformat(start), date.fromisoformat(end), (feed,))
    present = spark.createDataFrame([(p.name,) for p in there], "file_name string")
    names = {r.file_name for r in select_planned(wanted, present).select("file_name").collect()}  # as many as windows
    return [str(folder / n) for n in sorted(names)]


def build(spark: SparkSession, a: argparse.Namespace) -> int:
    """Raw windows to partitioned typed Parquet, per feed, with a report."""
    reports = []
    for feed in a.feeds:
        files = planned_files(spark, a.raw, feed, a.start, a.end)
        if not files:
            log.warning("no files of %s", feed)
            continue
        metas, records = split_meta(read_lines(spark, files))
        rows = normalized(records, metas, feed)
        parts = sinks.write_partitioned(rows, f"{a.out}/{feed}", force=a.force)
        columns = sorted({f for r in records.select(F.map_keys("record").alias("k")).distinct().collect() for f in r.k})
        after, written = rows.count(), sinks.rows_of(spark, f"{a.out}/{feed}", [Path(f).name for f in files])
        if written != after:
            raise ValueError(f"{feed}: {written} rows written of {after}; files that changed since they were built need --force")
        reports.append({"feed": feed, "raw_files": len(files), "partitions_written": parts, "rows_before": records.count(), "rows_after": written, "columns_seen": columns} | sinks.sizes(files, f"{a.out}/{feed}", spark))
    sinks.write_json(f"{a.out}/build_report.json", reports)
    return 0


def _scoped(spark: SparkSession, folder: str, feed: str, day: str, start: str, end: str) -> DataFrame:
    """A feed's rows of a scope; whole month partitions outside it aren't opened."""
    months = [s[:7] for s, _ in month_scopes(start, end)]
    rows = spark.read.option("mergeSchema", True).parquet(f"{folder}/{feed}").where(F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0")).isin(months))
    return curate.in_scope(rows, day, start, end)


EVENTS = {"bids": "bid_notice_date", "awards": "opening_date", "contracts": "contract_date"}


def own_keys(feed: str) -> list[str]:
    """The feed's key under the names that processed tables have."""
    own = dict(ALIASES[feed])
    return list(dict.fromkeys(own[k] for k in DEDUPE_KEYS.get(feed, []) if k in own))


KEYS = {"tenders": curate.TENDER_KEY, "submissions": ["bid_submission_id"], "outcomes": ["award_outcome_id"], "contracts": ["unified_contract_no"], "suppliers": ["supplier_id"], "agencies": ["agency_code"], "bridge": ["unified_contract_no"]}


def curate_scope(spark: SparkSession, processed: str, out: str, start: str, end: str, key: bytes, force: bool) -> dict[str, object]:
    """One scope's seven tables, gated before they are written; a scope whose metrics are there already is left."""
    metrics = Path(out) / "metrics.json"
    if metrics.exists() and not force:
        return json.loads(metrics.read_text())
    bids = _scoped(spark, processed, "bids", "bid_notice_date", start, end)
    awards = _scoped(spark, processed, "awards", "opening_date", start, end)
    contracts = _scoped(spark, processed, "contracts", "contract_date", start, end)
    tables = vars(curate.curated(bids, awards, contracts, key))
    base = {r.what: r.n for r in audit.baselines(bids, awards, contracts).collect()}
    expected = {"tenders": base["bids"], "submissions": base["awards"], "outcomes": base["winners"], "contracts": base["contracts"], "bridge": base["linked_contracts"], "suppliers": base["suppliers"], "agencies": base["agencies"]}
    publishable = {n: df.drop("names") for n, df in tables.items()}
    checks = gates.report(publishable, KEYS, expected, "bridge")
    unlinked = publishable["contracts"].count() - publishable["bridge"].count()
    checks.append({"gate": "unlinked contracts", "table": "bridge", "passed": unlinked == base["unlinked_contracts"], "detail": f"{unlinked} of {base['unlinked_contracts']}"})
    gates.require(checks)
    for name, df in publishable.items():
        sinks.write_sorted(df, f"{out}/{name}", KEYS[name])
    result = {"start": start, "end": end, "rows": {g["table"]: g["detail"] for g in checks if g["gate"] == "row count"}, "gates": checks}
    sinks.write_json(metrics, result)
    return result


def curate_months(spark: SparkSession, a: argparse.Namespace) -> int:
    """Month by month, with a summary after each, so that a broken run goes on where it stopped."""
    done = []
    for start, end in month_scopes(a.start, a.end)[: a.max_months]:
        done.append(curate_scope(spark, a.processed, f"{a.out}/{start[:7].replace('-', '_')}", start, end, secret("JANGBU_HMAC_KEY"), a.force))
        sinks.write_json(f"{a.out}/summary.json", {"months": done, "all_passed": all(g["passed"] for m in done for g in m["gates"])})
    return 0


def release_(spark: SparkSession, a: argparse.Namespace) -> int:
    """Months put together, gated, written with receipts and the flat CSV."""
    names = [s[:7].replace("-", "_") for s, _ in month_scopes(a.start, a.end)]
    missing = [n for n in names if not (Path(a.curated) / n / "metrics.json").exists()]
    if missing:
        raise SystemExit(f"months that are not there: {', '.join(missing)}")
    read = lambda t: [spark.read.parquet(f"{a.curated}/{n}/{t}") for n in names]
    tenders = release.merge(read("tenders"))
    tables = {"tenders": tenders, "contracts": release.merge(read("contracts")), "suppliers": release.global_suppliers(read("suppliers")), "agencies": release.global_agencies(list(zip(names, read("agencies"), strict=True)))}
    tables |= {t: release.merge_in_scope(read(t), tenders) for t in ("submissions", "outcomes", "bridge")}
    tables = {n: df.drop(*release.PRIVATE) for n, df in tables.items()}
    expected = {t: sum(df.count() for df in read(t)) for t in ("tenders", "submissions", "outcomes", "contracts", "bridge")}
    gates.require(gates.report(tables, KEYS, expected) + gates.no_company_names(tables))
    receipts = {}
    for name, df in tables.items():
        sinks.write_sorted(df, f"{a.out}/{name}", KEYS[name])
        receipts[name] = sinks.table_receipt(spark.read.parquet(f"{a.out}/{name}"), f"{a.out}/{name}")
    back = {n: spark.read.parquet(f"{a.out}/{n}") for n in ("tenders", "outcomes", "bridge")}
    flat = release.quickstart(release.require_unique(back["tenders"], curate.TENDER_KEY, "tenders"), back["outcomes"], back["bridge"])
    gates.require(release.reconcile(flat, back["tenders"], back["outcomes"], back["bridge"]))
    sinks.write_csv(flat.orderBy(*curate.TENDER_KEY), f"{a.out}/quickstart.csv")
    sinks.write_json(f"{a.out}/release_report.json", {"months": names, "tables": receipts})
    return 0


def quality(spark: SparkSession, a: argparse.Namespace) -> int:
    reports, critical = audit.quality_of_files(spark, a.paths, a.keys)
    sinks.write_json(a.out, reports)
    return int(critical and a.strict)


def report(spark: SparkSession, a: argparse.Namespace) -> int:
    normalized_report(read_report(spark, a.path)).write.mode("overwrite").parquet(a.out)
    return 0


def plan_(spark: SparkSession, a: argparse.Namespace) -> int:
    """The windows of a collection, counted; nothing is called."""
    counts = plan(spark, date.fromisoformat(a.start), date.fromisoformat(a.end)).groupBy("feed").count().collect()
    print(json.dumps({r.feed: r["count"] for r in sorted(counts)}))
    return 0


def check(spark: SparkSession, a: argparse.Namespace) -> int:
    bad = []
    for feed in FEEDS:
        wanted = plan(spark, date.fromisoformat(a.start), date.fromisoformat(a.end), (feed,))
        bad += check_windows(wanted, f"{a.raw}/{feed}").where("not ok").collect()  # as many as windows at most
    for r in bad:
        log.error("%s: %s", r.file_name, r.reason)
    return int(bool(bad))


def collect(spark: SparkSession, a: argparse.Namespace) -> int:
    """Collect windows with a fetcher given as module:function (it has the network; this has the order)."""
    module, _, name = a.fetcher.partition(":")
    log.info("key %s", shown_key(os.environ.get("JANGBU_SERVICE_KEY")))
    fetch = http_fetcher() if a.fetcher == "http" else getattr(importlib.import_module(module), name)
    c = Collector(fetch, Path(a.raw), Manifest(Path(a.raw) / "manifest.json", a.raw), receipts=True)
    rows = plan(spark, date.fromisoformat(a.start), date.fromisoformat(a.end), tuple(a.feeds)).orderBy("feed", "window_start", "category").collect()
    try:
        for feed in a.feeds:
            windows = [(str(r.window_start), str(r.window_end), r.category) for r in rows if r.feed == feed]
            log.info("%s: %s", feed, c.run(FEEDS[feed], windows, a.max_windows, a.max_calls, progress=lambda n, of, what: log.info("%d of %d: %s", n, of, what), force=a.force, dry_run=a.dry_run))
    except AuthError:
        return 2
    except QuotaError:
        return 3
    return 0


def _windows(spark: SparkSession, raw: str, start: str, end: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan, manifest entries, files that are there) of a scope."""
    wanted = plan(spark, date.fromisoformat(start), date.fromisoformat(end))
    entries = Manifest(Path(raw) / "manifest.json", raw).entries
    kind = "manifest_key string, dataset string, category string, start string, end string, status string, row_count long, api_calls long"
    manifest = spark.createDataFrame([(k, e.dataset, e.category, e.start, e.end, e.status, e.row_count, e.api_calls) for k, e in entries.items()], kind)
    files = spark.createDataFrame([(p.name,) for p in sorted(Path(raw).rglob("*.jsonl.gz"))], "file_name string")
    return wanted, manifest_in_scope(manifest, start, end), files_in_scope(files, "file_name", start, end)


def audit_history(spark: SparkSession, a: argparse.Namespace) -> int:
    """A scope's plan, manifest, files and processed rows against each other; fails on critical findings with --strict."""
    wanted, manifest, files = _windows(spark, a.raw, a.start, a.end)
    off_plan = [r.asDict() for r in plan_findings(wanted, manifest, files).orderBy("finding", "name").collect()]  # as many as windows
    critical = [f"plan: {len(off_plan)} findings"] if off_plan else []
    built = Path(a.processed) / "build_report.json"
    reports = {r["feed"]: r for r in json.loads(built.read_text())} if built.exists() else {}
    findings, rows = [], []
    for feed in FEEDS:
        try:
            df = spark.read.option("mergeSchema", True).parquet(f"{a.processed}/{feed}")
        except Exception as e:
            critical.append(f"{feed}: unreadable ({type(e).__name__})")
            continue
        rows.append((feed, df.count()))
        findings += [r.asDict() for r in audit.feed_findings(df, feed, EVENTS[feed], own_keys(feed), a.start, a.end, ("_window_start", "_window_end")).collect()]
    there = audit.reconciliation(spark.createDataFrame(rows, "feed string, rows long"), manifest)
    matched = []
    for r in there.collect():
        report_ = reports.get(r.feed, {})
        matched.append(r.asDict() | {"build_rows_before": report_.get("rows_before"), "build_rows_after": report_.get("rows_after")})
        if report_.get("rows_before") != r.manifest_rows:
            critical.append(f"{r.feed}: the manifest and the build differ in rows read")
        if report_.get("rows_after") != r.processed_rows:
            critical.append(f"{r.feed}: the build and the files differ in rows")
    critical += [f"{f['feed']}: {f['n']} {f['finding']}" for f in findings if f["severity"] == "critical"]
    warnings = [f"{f['feed']}: {f['n']} {f['finding']}" for f in findings if f["severity"] == "warning"]
    accounting = [r.asDict() for r in audit.collection_accounting(manifest).collect()]
    sinks.write_json(a.out, {"start": a.start, "end": a.end, "plan": off_plan, "findings": findings, "reconciliation": matched, "accounting": accounting, "warnings": warnings, "critical": critical})
    return int(bool(critical) and a.strict)


def catalogue_(spark: SparkSession, a: argparse.Namespace) -> int:
    """Descriptions and types of a release's tables; the flat file's header must be the flat table's."""
    describe = json.loads(Path(a.descriptions).read_text(encoding="utf-8"))
    tables = {p.name: spark.read.parquet(str(p)) for p in sorted(Path(a.release).iterdir()) if p.is_dir() and not p.name.startswith((".", "_"))}
    flat = Path(a.release) / "quickstart.csv"
    if flat.exists():
        sinks.require_header(flat, release.quickstart(tables["tenders"], tables["outcomes"], tables["bridge"]).columns)
    owner = a.owner or os.environ.get("JANGBU_OWNER", "")
    sinks.write_json(a.out, sinks.catalogue(tables, owner, a.slug, describe))
    return 0


def quickstart_(spark: SparkSession, a: argparse.Namespace) -> int:
    """The flat file alone, of the latest release below a folder."""
    found = sinks.releases(spark, a.releases, ["tenders", "outcomes", "bridge"])
    if not found:
        raise FileNotFoundError(f"{a.releases}: no folder with tenders, outcomes and bridge")
    back = {n: spark.read.parquet(f"{found[0]}/{n}") for n in ("tenders", "outcomes", "bridge")}
    flat = release.quickstart(release.require_unique(back["tenders"], curate.TENDER_KEY, "tenders"), back["outcomes"], back["bridge"])
    gates.require(release.reconcile(flat, back["tenders"], back["outcomes"], back["bridge"]))
    sinks.write_csv(flat.orderBy(*curate.TENDER_KEY), a.out)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="jangbu")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, run: object, *options: str, **flags: bool) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        for o in options:
            p.add_argument(f"--{o}", required=True)
        for f in flags:
            p.add_argument(f"--{f.replace('_', '-')}", action="store_true")
        return p

    command("plan", plan_, "start", "end")
    command("check", check, "raw", "start", "end")
    p = command("collect", collect, "raw", "start", "end", "fetcher", force=True, dry_run=True)
    p.add_argument("--feeds", nargs="+", default=list(FEEDS))
    p.add_argument("--max-windows", type=int)
    p.add_argument("--max-calls", type=int)
    p = command("build", build, "raw", "out", force=True)
    p.add_argument("--feeds", nargs="+", default=list(FEEDS))
    p.add_argument("--start")
    p.add_argument("--end")
    p = command("curate", curate_months, "processed", "out", "start", "end", force=True)
    p.add_argument("--max-months", type=int)
    command("release", release_, "curated", "out", "start", "end")
    command("audit", audit_history, "raw", "processed", "out", "start", "end", strict=True)
    p = command("catalogue", catalogue_, "release", "descriptions", "slug", "out")
    p.add_argument("--owner")
    command("quickstart", quickstart_, "releases", "out")
    p = command("quality", quality, "out", strict=True)
    p.add_argument("paths", nargs="+")
    p.add_argument("--keys", nargs="*", default=[])
    p = command("report", report, "out")
    p.add_argument("path")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    logging.basicConfig(level=logging.INFO)
    log.addFilter(Redacting())
    a = parser().parse_args(argv)
    try:
        return a.run(spark or build_session("jangbu"), a)
    except (ValueError, FileNotFoundError) as e:
        log.error("%s", e)
        return 1


if __name__ == "__main__":
    sys.exit(main())
