"""Raw window files: gzip lines of JSON whose first and last lines describe the window; their plan, manifest and checks."""

from __future__ import annotations

import gzip
import json
import os
import shutil
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass
from functools import reduce
from itertools import chain, groupby
from operator import itemgetter
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

META = "__collector_meta__"
RECORD = "map<string,string>"


def read_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """``file, pos, value`` of every non-blank line. ``pos`` rises within a file."""
    lines = spark.read.text(paths, wholetext=False).select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("pos"), "value")
    return lines.where(F.trim("value") != "")


def split_meta(lines: DataFrame, hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(one row a file with the merged meta map, records ``file, pos, record``). Later meta lines win over earlier.
    ``hold`` may store the parsed lines, which both are made of."""
    meta = F.get_json_object("value", f"$.{META}")
    tagged = hold(lines.select("file", "pos", meta.alias("meta"), F.when(meta.isNull(), F.from_json("value", RECORD)).alias("record")))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "meta"))), lambda x: F.from_json(x["meta"], RECORD))
    merged = F.aggregate(ordered, F.create_map().cast(RECORD), lambda acc, m: F.map_concat(F.map_filter(acc, lambda k, _: ~F.map_contains_key(m, k)), m))
    metas = tagged.where("meta is not null").groupBy("file").agg(merged.alias("meta"))
    records = tagged.where("meta is null").select("file", "pos", "record")
    return metas, records


class WindowWriter:
    """Writes a window record by record into a part file, which gets its name only when it is whole."""

    def __init__(self, path: str | Path, meta: dict) -> None:
        self.path, self.meta, self.rows = Path(path), meta, 0
        self.path.parent.mkdir(parents=True, exist_ok=True)
        self.part = self.path.with_name(self.path.name + ".part")
        self.out = gzip.open(self.part, "wt", encoding="utf-8")
        self._line({META: meta | {"status": "running"}})

    def _line(self, value: dict) -> None:
        self.out.write(json.dumps(value, ensure_ascii=False) + "\n")

    def add(self, items: Iterable[dict]) -> None:
        for item in items:
            self._line(item)
            self.rows += 1

    def finish(self, meta: dict | None = None) -> None:
        self._line({META: self.meta | (meta or {}) | {"status": "complete", "rows": self.rows}})
        self.out.close()
        os.replace(self.part, self.path)

    def abandon(self) -> None:
        self.out.close()
        self.part.unlink(missing_ok=True)


def write_window(path: str | Path, items: Iterable[dict], meta: dict) -> int:
    """A complete window file under its name, or none: it is renamed when it is whole. The number of its records."""
    w = WindowWriter(path, meta)
    try:
        w.add(items)
    except BaseException:
        w.abandon()
        raise
    w.finish()
    return w.rows


def write_window_files(lines: DataFrame, folder: str, file: str, order: str, payload: str, feed: str) -> DataFrame:
    """Window files made of lines, each by one task: ``file_name, rows``. A line that is no JSON object is left out. ``folder`` is
    one that all tasks see; a file that a lost task left half written never gets its name."""

    def items(texts: Iterable[str]) -> Iterator[dict]:
        for text in texts:
            try:
                item = json.loads(text)
            except (TypeError, ValueError):
                continue
            if isinstance(item, dict):
                yield item

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = []
        rows = (r for pdf in batches for r in pdf.itertuples(index=False, name=None))
        for name, own in groupby(rows, key=itemgetter(0)):  # a file may go on in the next batch
            first = next(own)
            meta = {"feed": feed, "window_start": str(first[2]), "window_end": str(first[3])}
            done.append((name, write_window(Path(folder) / name, items(r[1] for r in chain([first], own)), meta)))
            if len(done) == 1000:
                yield pd.DataFrame(done, columns=["file_name", "rows"])
                done = []
        yield pd.DataFrame(done, columns=["file_name", "rows"])

    together = lines.select(file, order, payload, "window_start", "window_end").repartition(file).sortWithinPartitions(F.col(file), F.col(order).asc_nulls_last())
    return together.select(file, payload, "window_start", "window_end").mapInPandas(write, "file_name string, rows long")


def check_windows(plan: DataFrame, folder: str) -> DataFrame:
    """``file_name, ok, reason, rows`` of every planned window, one file a task row, so a broken archive is a reason and
    not a failure. ``plan`` has file_name, feed, category, window_start, window_end; ``folder`` is one that all tasks see."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [_check(Path(folder) / r.file_name, r) for r in pdf.itertuples()]
            yield pd.DataFrame(rows, columns=["file_name", "ok", "reason", "rows"])

    wanted = plan.select("file_name", "feed", "category", F.col("window_start").cast("string").alias("window_start"), F.col("window_end").cast("string").alias("window_end"))
    return wanted.mapInPandas(check, "file_name string, ok boolean, reason string, rows long")


def _check(path: Path, want: object) -> tuple[str, bool, str, int]:
    if not path.exists():
        return path.name, False, "missing file", 0
    meta: dict = {}
    rows = 0
    try:
        with gzip.open(path, "rt", encoding="utf-8") as lines:
            for line in lines:
                if not line.strip():
                    continue
                item = json.loads(line)
                if META in item:
                    meta |= item[META]
                else:
                    rows += 1
    except (OSError, EOFError, UnicodeDecodeError):
        return path.name, False, "unreadable archive", 0
    except ValueError:
        return path.name, False, "a line is not JSON", 0
    category = None if pd.isna(want.category) else want.category
    for bad, reason in (
        (not meta, "no meta line"),
        (meta.get("status") != "complete", "window not complete"),
        (meta.get("feed") != want.feed, "other feed"),
        (meta.get("window_start") != want.window_start, "other start"),
        (meta.get("window_end") != want.window_end, "other end"),
        (meta.get("business_code") != category, "other category"),
        (meta.get("rows", rows) != rows, "row count differs"),
    ):
        if bad:
            return path.name, False, reason, rows
    return path.name, True, "", rows


def select_planned(plan: DataFrame, present: DataFrame) -> DataFrame:
    """Planned files that are there; an error that names up to five of those that are not."""
    missing = plan.select("file_name").join(present.select("file_name").distinct(), "file_name", "left_anti")
    n = missing.count()
    if n:
        names = [r.file_name for r in missing.orderBy("file_name").limit(5).collect()]
        raise FileNotFoundError(f"missing: {', '.join(names)}" + (f" and {n - 5} more" if n > 5 else ""))
    return plan.join(present.select("file_name").distinct(), "file_name", "left_semi")


def plan_audit(plan: DataFrame, manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Counts of windows by finding: planned, missing in manifest, missing file, not complete, unplanned manifest entries and files."""
    p = plan.select("manifest_key", "file_name").distinct()
    m = manifest.select("manifest_key", "status").distinct()
    f = present.select("file_name").distinct()
    findings = {
        "planned_windows": p,
        "missing_manifest": p.join(m, "manifest_key", "left_anti"),
        "missing_file": p.join(f, "file_name", "left_anti"),
        "not_complete": p.join(m.where("status <> 'complete'"), "manifest_key", "left_semi"),
        "unplanned_manifest": m.join(p, "manifest_key", "left_anti"),
        "unplanned_file": f.join(p, "file_name", "left_anti"),
    }
    out = None
    for what, rows in findings.items():
        one = rows.agg(F.count(F.lit(1)).alias("windows")).select(F.lit(what).alias("finding"), "windows")
        out = one if out is None else out.unionByName(one)
    return out


def plan_findings(plan: DataFrame, manifest: DataFrame, present: DataFrame) -> DataFrame:
    """The windows and files behind the counts of ``plan_audit``, by name: ``finding, name``."""
    p = plan.select("manifest_key", "file_name").distinct()
    m = manifest.select("manifest_key", "status").distinct()
    f = present.select("file_name").distinct()
    findings = {
        "missing_manifest": p.join(m, "manifest_key", "left_anti").select("manifest_key"),
        "missing_file": p.join(f, "file_name", "left_anti").select("file_name"),
        "not_complete": p.join(m.where("status <> 'complete'"), "manifest_key", "left_semi").select("manifest_key"),
        "unplanned_manifest": m.join(p, "manifest_key", "left_anti").select("manifest_key"),
        "unplanned_file": f.join(p, "file_name", "left_anti").select("file_name"),
    }
    return reduce(DataFrame.unionByName, [df.toDF("name").select(F.lit(w).alias("finding"), "name") for w, df in findings.items()])


def manifest_in_scope(manifest: DataFrame, start: str, end: str) -> DataFrame:
    """Entries whose window lies wholly within the scope; days are compared as texts, so entries without one are out."""
    return manifest.where((F.col("start") >= start) & (F.col("end") <= end))


def files_in_scope(files: DataFrame, name: str, start: str, end: str) -> DataFrame:
    """Files whose name states two days, wholly within the scope; others are out."""
    days = [F.regexp_extract(name, r"(\d{8})_(\d{8})", k) for k in (1, 2)]
    return files.where((days[0] != "") & (days[0] >= start.replace("-", "")) & (days[1] <= end.replace("-", "")))


def records_in_scope(records: DataFrame, field: str, start: str, end: str) -> DataFrame:
    """Raw records whose own text in ``field`` begins with a day of the scope; records without the field are out."""
    return records.where(F.substring(F.col("record")[field], 1, 10).between(start, end))


@dataclass
class Entry:
    """What is known of a collected window."""

    dataset: str
    endpoint: str
    start: str
    end: str
    category: str | None
    download_timestamp: str
    row_count: int
    total_expected: int | None
    api_calls: int
    status: str
    source_filename: str

    @property
    def key(self) -> str:
        return f"{self.dataset}::{self.category or 'all'}::{self.start}::{self.end}"


class Manifest:
    """Collected windows by key, in one JSON file that is replaced as a whole. A broken file is set aside and the manifest
    rebuilt from the window files that check out."""

    def __init__(self, path: str | Path, raw_folder: str | Path | None = None) -> None:
        self.path = Path(path)
        self.entries: dict[str, Entry] = {}
        if self.path.exists():
            try:
                self.entries = {e.key: e for e in (Entry(**r) for r in json.loads(self.path.read_text(encoding="utf-8")))}
            except (ValueError, TypeError):
                shutil.copy(self.path, self.path.with_name(self.path.name + ".bad"))
                for file in sorted(Path(raw_folder).rglob("*.jsonl.gz")) if raw_folder else []:
                    if entry := entry_of(file):
                        self.entries[entry.key] = entry
                self.save()

    def save(self) -> None:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        part = self.path.with_name(self.path.name + ".part")
        part.write_text(json.dumps([asdict(e) for e in self.entries.values()], ensure_ascii=False, indent=1), encoding="utf-8")
        os.replace(part, self.path)

    def completed(self, dataset: str, start: str, end: str, category: str | None = None) -> bool:
        entry = self.entries.get(f"{dataset}::{category or 'all'}::{start}::{end}")
        return bool(entry and entry.status == "complete")

    def record(self, entry: Entry) -> None:
        self.entries[entry.key] = entry
        self.save()

    def remove(self, key: str) -> None:
        if self.entries.pop(key, None):
            self.save()


def entry_of(path: Path) -> Entry | None:
    """The manifest entry that a whole window file stands for; None if it isn't whole."""
    meta: dict = {}
    rows = 0
    try:
        with gzip.open(path, "rt", encoding="utf-8") as lines:
            for line in filter(str.strip, lines):
                item = json.loads(line)
                meta, rows = (meta | item[META], rows) if META in item else (meta, rows + 1)
    except (OSError, EOFError, ValueError):
        return None
    if meta.get("status") != "complete" or meta.get("rows", rows) != rows:
        return None
    return Entry(meta["feed"], meta.get("operation", ""), meta["window_start"], meta["window_end"], meta.get("business_code"), meta.get("collected_at_utc", ""), rows, meta.get("total_expected"), meta.get("api_calls", 0), "complete", path.name)
