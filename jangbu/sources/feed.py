"""A paged feed as a Spark data source, over HTTP or any fetcher that is passed in; and the resumable collector around it."""

from __future__ import annotations

import json
import os
import random
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen
from uuid import uuid4
from xml.etree import ElementTree

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from jangbu.functions.cleaning import decoded_key
from jangbu.functions.identity import page_receipt
from jangbu.sources.raw import Entry, Manifest, WindowWriter, entry_of
from jangbu.sources.windows import DIVISIONS, Feed


class FeedError(Exception):
    """Base of what a feed can go wrong with."""


class AuthError(FeedError):
    """The key isn't accepted."""


class QuotaError(FeedError):
    """No calls are left."""


class PermanentError(FeedError):
    """Asking again won't help."""


class TransientError(FeedError):
    """Asking again may help."""


# Response codes of the source and statuses worth another try.
OK_CODES = frozenset({"00", "000", "0"})
EMPTY_CODES = frozenset({"03", "NODATA_ERROR"})
AUTH_CODES = frozenset({"20", "30", "31", "SERVICE_KEY_IS_NULL", "SERVICE_KEY_IS_NOT_REGISTERED_ERROR"})
QUOTA_CODES = frozenset({"22", "23", "LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR"})
RETRY_STATUS = frozenset({429, 500, 502, 503, 504})

#: (operation, parameters) to (HTTP status, items, total, code, message); raises for what has no status.
Fetcher = Callable[[str, dict[str, object]], tuple[int, list[dict], int, str, str]]


def envelope(text: str) -> tuple[list[dict], int, str, str]:
    """Items, total, code and message of an answer in JSON, or in XML where it isn't JSON; ``PermanentError`` for JSON of
    another form, which asking again won't mend."""
    try:
        doc = json.loads(text)
    except ValueError:
        return _xml_envelope(text)
    whole = doc.get("response", doc) if isinstance(doc, dict) else None
    if not isinstance(whole, dict) or not isinstance(whole.get("header"), dict):
        raise PermanentError("the answer has neither response nor header")
    body = whole.get("body") or {}
    items = body.get("items") or []
    items = items.get("item", items) if isinstance(items, dict) else items
    items = [items] if isinstance(items, dict) else items or []
    if not isinstance(items, list) or not all(isinstance(i, dict) for i in items):
        raise PermanentError("items of another form")
    total = str(body.get("totalCount", "")).strip()
    head = whole["header"]
    return items, int(total) if total.isdigit() else len(items), str(head.get("resultCode") or "").strip(), str(head.get("resultMsg") or "")


def _xml_envelope(text: str) -> tuple[list[dict], int, str, str]:
    try:
        root = ElementTree.fromstring(text.strip())  # noqa: S314
    except ElementTree.ParseError as e:
        raise TransientError("the answer is neither JSON nor XML") from e
    said = lambda *names: next((x.text.strip() for n in names for x in root.iter(n) if x.text and x.text.strip()), "")
    error = next(root.iter("cmmMsgHeader"), None)
    if error is not None:
        return [], 0, said("returnReasonCode"), said("returnAuthMsg", "errMsg")
    items = [{f.tag: f.text for f in item} for item in root.iter("item")]
    total = said("totalCount")
    return items, int(total) if total.isdigit() and int(total) else len(items), said("resultCode"), said("resultMsg")


@dataclass
class HttpFetcher:
    """Reads pages over HTTP: ``base/operation?serviceKey=...&type=json&...``. Counts its calls, waits ``pause`` seconds after
    each, and never shows its key: errors name the status or the exception's class. Can be sent to executors."""

    base: str
    key: str = field(repr=False)
    timeout: float = 45.0
    pause: float = 0.08
    agent: str = "jangbu"
    calls: int = 0

    def __call__(self, operation: str, params: dict[str, object]) -> tuple[int, list[dict], int, str, str]:
        query = urlencode({"serviceKey": decoded_key(self.key), "type": "json"} | {k: str(v) for k, v in params.items()})
        request = Request(f"{self.base.rstrip('/')}/{operation}?{query}", headers={"User-Agent": self.agent})  # noqa: S310
        self.calls += 1
        try:
            with urlopen(request, timeout=self.timeout) as answer:  # noqa: S310
                status, text = answer.status, answer.read().decode("utf-8", "replace")
        except HTTPError as e:
            return e.code, [], 0, "", ""
        time.sleep(self.pause)
        items, total, code, message = envelope(text)
        return status, items, total, code or ("00" if items else ""), message


def http_fetcher() -> HttpFetcher:
    """A fetcher for the address and key that the environment names."""
    return HttpFetcher(os.environ["JANGBU_FEED_URL"], os.environ["JANGBU_SERVICE_KEY"])


def get_page(fetch: Fetcher, operation: str, params: dict[str, object], attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> tuple[list[dict], int]:
    """Items and stated total of a page. Transient trouble is tried again with growing pauses, the rest never."""
    last: Exception = TransientError("no attempt")
    for n in range(attempts):
        try:
            status, items, total, code, message = fetch(operation, params)
        except TransientError as e:
            last = e
        except FeedError:
            raise
        except Exception as e:
            last = TransientError(type(e).__name__)
        else:
            if status in RETRY_STATUS:
                last = TransientError(f"status {status}")
            elif code in AUTH_CODES:
                raise AuthError(message or code)
            elif code in QUOTA_CODES:
                raise QuotaError(message or code)
            elif status >= 400:
                raise PermanentError(f"status {status}")
            elif code in EMPTY_CODES:
                return [], 0
            elif code not in OK_CODES:
                raise PermanentError(message or code)
            else:
                return items, total
        if n + 1 < attempts:
            sleep(min(30.0, 2.0**n + random.uniform(0.1, 1.0)))
    raise last


def pages(fetch: Fetcher, operation: str, params: dict[str, object], size: int, **kw: object) -> Iterator[tuple[int, list[dict], int]]:
    """Pages until one is empty or short, or all rows that the latest page states are there."""
    rows, page = 0, 1
    while True:
        items, total = get_page(fetch, operation, params | {"pageNo": page, "numOfRows": size}, **kw)
        rows += len(items)
        yield page, items, total
        if not items or rows >= total or len(items) < size:
            return
        page += 1


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


@dataclass
class WindowPartition(InputPartition):
    operation: str
    params: dict

    def __init__(self, operation: str, params: dict) -> None:
        self.operation, self.params, self.value = operation, params, operation


def feed_source(fetch: Fetcher, windows: Sequence[tuple[str, dict[str, object]]], size: int = 500) -> type[DataSource]:
    """A data source class to register: one partition a window, read on the executors, each row a window and a record."""

    class Reader(DataSourceReader):
        def partitions(self) -> Sequence[InputPartition]:
            return [WindowPartition(op, dict(p)) for op, p in windows]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            for page, items, total in pages(fetch, partition.operation, partition.params, size):
                for item in items:
                    yield (partition.operation, page, total, {k: None if v is None else str(v) for k, v in item.items()})

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged_feed"

        def schema(self) -> str:
            return "operation string, page int, total long, record map<string,string>"

        def reader(self, schema: object) -> DataSourceReader:
            return Reader()

    return Source


@dataclass
class Collector:
    """Collects windows into raw files. What is there, whole and recorded is skipped; what is whole but not recorded is
    recorded; what is recorded but gone, or broken, is fetched again.

    Pages go to disk as they come, so a window of any length needs one page of memory. With ``receipts`` each page, and the
    outcome of each attempt at a window, is one line appended to ``receipts.jsonl`` as it happens, with the run, the attempt
    and the time; a crash loses none."""

    fetch: Fetcher
    folder: Path
    manifest: Manifest
    page_size: int = 500
    receipts: bool = False
    run_id: str = field(default_factory=lambda: uuid4().hex)

    def _note(self, kind: str, **what: object) -> None:
        if self.receipts:
            Path(self.folder).mkdir(parents=True, exist_ok=True)
            with (Path(self.folder) / "receipts.jsonl").open("a", encoding="utf-8") as out:
                out.write(json.dumps({"kind": kind, "run_id": self.run_id, "at_utc": _now()} | what, ensure_ascii=False) + "\n")

    def collect(self, feed: Feed, start: str, end: str, category: str | None = None, force: bool = False, dry_run: bool = False) -> tuple[int, int, str]:
        """(rows, calls, what was done) for one window."""
        label = DIVISIONS.get(category, category) if category else "all"
        path = Path(self.folder) / feed.name / f"{feed.name}_{label}_{start.replace('-', '')}_{end.replace('-', '')}.jsonl.gz"
        key = f"{feed.name}::{category or 'all'}::{start}::{end}"
        if not force:
            known = self.manifest.completed(feed.name, start, end, category)
            found = entry_of(path) if path.exists() else None
            if found and found.key == key:
                if known:
                    return 0, 0, "skipped"
                if not dry_run:
                    self.manifest.record(found)
                return 0, 0, "recorded"
            if not dry_run:
                if known:
                    self.manifest.remove(key)
                path.unlink(missing_ok=True)
        if dry_run:
            return 0, 0, "planned"
        params: dict[str, object] = {feed.start_param: start.replace("-", "") + ("0000" if feed.minutes else ""), feed.end_param: end.replace("-", "") + ("2359" if feed.minutes else "")}
        if category:
            params["bsnsDivCd"] = category
        calls, expected, attempt = 0, None, uuid4().hex
        writer = WindowWriter(path, {"feed": feed.name, "operation": feed.operation, "window_start": start, "window_end": end, "business_code": category, "business_label": label, "page_size": self.page_size})
        try:
            for page, items, total in pages(self.fetch, feed.operation, params, self.page_size):
                calls += 1
                expected = total if expected is None else expected
                writer.add(items)
                self._note("page", attempt_id=attempt, window=key, page_no=page, reported_total_count=total, **page_receipt(items))
        except BaseException as e:
            writer.abandon()
            self._note("attempt", attempt_id=attempt, window=key, status="failed", error=type(e).__name__)
            raise
        now = _now()
        writer.finish({"total_expected": expected, "api_calls": calls, "collected_at_utc": now})
        self.manifest.record(Entry(feed.name, feed.operation, start, end, category, now, writer.rows, expected, calls, "complete", path.name))
        self._note("attempt", attempt_id=attempt, window=key, status="complete", row_count=writer.rows, total_expected=expected)
        return writer.rows, calls, "fetched"

    def run(self, feed: Feed, windows: Sequence[tuple[str, str, str | None]], max_windows: int | None = None, max_calls: int | None = None, progress: Callable[[int, int, str], None] | None = None, **kw: bool) -> dict[str, int]:
        """All windows, or as many as the bounds allow; the bound on calls is looked at before each window."""
        stats = {"windows": 0, "rows": 0, "calls": 0, "skipped": 0}
        for start, end, category in windows:
            if (max_windows is not None and stats["windows"] >= max_windows) or (max_calls is not None and stats["calls"] >= max_calls):
                break
            rows, calls, done = self.collect(feed, start, end, category, **kw)
            stats["windows"] += 1
            stats["rows"] += rows
            stats["calls"] += calls
            stats["skipped"] += done == "skipped"
            if progress:
                progress(stats["windows"], len(windows), f"{start} {category or 'all'} {done}, {rows} rows")
        return stats
