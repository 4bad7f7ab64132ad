from __future__ import annotations

import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from jangbu.operators.normalize import aliased, dedupe_records, normalized, typed
from jangbu.sources import feed as S
from jangbu.sources import raw as W
from jangbu.sources import sinks
from jangbu.sources.envelope import from_json_envelope, from_xml_envelope
from jangbu.sources.report import detect_encoding, normalized_report, read_report
from jangbu.sources.schemas import kind_of
from jangbu.sources.windows import FEEDS, fixed_windows, month_scopes, month_windows, plan
from tests.conftest import rows


def span(spark, a, b):
    return spark.createDataFrame([(date.fromisoformat(a), date.fromisoformat(b))], "start date, end date")


def test_windows(spark):
    assert plan(spark, date(2026, 8, 1), date(2026, 8, 31)).count() == 130
    months = [(str(a), str(b)) for a, b in rows(month_windows(span(spark, "2026-01-15", "2026-03-02")).select("window_start", "window_end"))]
    assert months == [("2026-01-15", "2026-01-31"), ("2026-02-01", "2026-02-28"), ("2026-03-01", "2026-03-02")]
    weeks = [(str(a), str(b)) for a, b in rows(fixed_windows(span(spark, "2026-01-01", "2026-01-16"), 7).select("window_start", "window_end"))]
    assert weeks == [("2026-01-01", "2026-01-07"), ("2026-01-08", "2026-01-14"), ("2026-01-15", "2026-01-16")]
    assert month_windows(span(spark, "2026-02-01", "2026-01-01")).count() == 0
    p = plan(spark, date(2026, 9, 1), date(2026, 9, 1), ("awards", "contracts"))
    got = {r.feed: (r.start_value, r.end_value, r.file_name, r.manifest_key) for r in p.where("coalesce(category, '1') = '1'").collect()}
    assert got["awards"] == ("202609010000", "202609012359", "awards_goods_20260901_20260901.jsonl.gz", "awards::1::2026-09-01::2026-09-01")
    assert got["contracts"] == ("20260901", "20260901", "contracts_all_20260901_20260901.jsonl.gz", "contracts::all::2026-09-01::2026-09-01")


def test_month_scopes():
    assert len(month_scopes("2025-09-01", "2026-08-31")) == 12
    assert month_scopes("2026-01-15", "2026-03-07") == [("2026-01-15", "2026-01-31"), ("2026-02-01", "2026-02-28"), ("2026-03-01", "2026-03-07")]
    with pytest.raises(ValueError):
        month_scopes("2026-02-01", "2026-01-01")


def window(path, rows_, feed="bids", start="2026-08-01", end="2026-08-31", code=None):
    W.write_window(path, rows_, {"feed": feed, "operation": "op", "window_start": start, "window_end": end, "business_code": code})


def test_raw_round_trip_and_checks(spark, tmp_path):
    good, bad, cut = (tmp_path / f"bids_{n}_20260801_20260831.jsonl.gz" for n in ("all", "bad", "cut"))
    window(good, [{"a": "1"}, {"a": "2", "b": None}])
    bad.write_bytes(b"no gzip")
    with gzip.open(cut, "wt") as f:
        f.write(json.dumps({W.META: {"feed": "bids", "status": "running", "window_start": "2026-08-01", "window_end": "2026-08-31"}}) + "\n\n" + '{"a": "1"}\n')
    metas, records = W.split_meta(W.read_lines(spark, str(good)))
    assert metas.first().meta["status"] == "complete" and metas.first().meta["rows"] == "2"
    assert [r.record for r in records.orderBy("pos").collect()] == [{"a": "1"}, {"a": "2", "b": None}]
    wanted = spark.createDataFrame([(p.name, "bids", None, "2026-08-01", "2026-08-31") for p in (good, bad, cut)] + [("gone.jsonl.gz", "bids", None, "2026-08-01", "2026-08-31"), (good.name, "awards", None, "2026-08-01", "2026-08-31")], "file_name string, feed string, category string, window_start string, window_end string")
    got = sorted((r.ok, r.reason) for r in W.check_windows(wanted, str(tmp_path)).collect())
    assert got == [(False, "missing file"), (False, "other feed"), (False, "unreadable archive"), (False, "window not complete"), (True, "")]
    present = spark.createDataFrame([(good.name,)], "file_name string")
    with pytest.raises(FileNotFoundError, match="gone"):
        W.select_planned(wanted, present)


def test_manifest_recovery(tmp_path):
    window(tmp_path / "raw" / "bids_all_20260801_20260831.jsonl.gz", [{"a": 1}])
    path = tmp_path / "manifest.json"
    path.write_text("{broken")
    m = W.Manifest(path, tmp_path / "raw")
    assert m.completed("bids", "2026-08-01", "2026-08-31") and (tmp_path / "manifest.json.bad").exists()
    m.remove("bids::all::2026-08-01::2026-08-31")
    assert not W.Manifest(path).entries


def test_plan_audit(spark):
    p = spark.createDataFrame([("k1", "f1"), ("k2", "f2")], "manifest_key string, file_name string")
    m = spark.createDataFrame([("k1", "failed"), ("k9", "complete")], "manifest_key string, status string")
    f = spark.createDataFrame([("f1",), ("f9",), ("f8",)], "file_name string")
    assert dict(rows(W.plan_audit(p, m, f))) == {"planned_windows": 2, "missing_manifest": 1, "missing_file": 1, "not_complete": 1, "unplanned_manifest": 1, "unplanned_file": 2}


def test_json_envelopes(spark):
    body = lambda items, total="3": '{"response": {"header": {"resultCode": "00", "resultMsg": "OK"}, "body": {"items": ' + items + ', "totalCount": ' + total + "}}}"
    cases = [body('[{"a": "1"}]'), body('{"item": [{"a": 1}, {"a": 2}]}', '"2"'), body('{"item": {"a": "x"}}', '"many"'), body("null", "0"), '{"header": {"resultCode": "03"}}', "[1]", '{"other": 1}', body('"text"'), None]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, p string")
    got = [(len(r["items"]), r.total, r.code, r.fault) for r in from_json_envelope(df, "p").orderBy("i").collect()]
    assert got == [(1, 3, "00", None), (2, 2, "00", None), (1, 1, "00", None), (0, 0, "00", None), (0, 0, "03", None), (0, 0, "", "not an object"), (0, 0, "", "neither response nor header"), (0, 3, "00", "items of another shape"), (0, 0, "", "not an object")]


def test_xml_envelopes(spark):
    error = "<OpenAPI_ServiceResponse><cmmMsgHeader><errMsg>SERVICE ERROR</errMsg><returnAuthMsg>NOT REGISTERED</returnAuthMsg><returnReasonCode>30</returnReasonCode></cmmMsgHeader></OpenAPI_ServiceResponse>"
    usual = "<response><header><resultCode>00</resultCode><resultMsg>OK</resultMsg></header><body><items><item><a>1</a></item><item><a> 2 </a><b/></item></items><totalCount>7</totalCount></body></response>"
    df = spark.createDataFrame([(0, error), (1, usual), (2, "no xml")], "i int, p string")
    got = from_xml_envelope(df, "p").orderBy("i").collect()
    assert [(r.code, r.total, len(r["items"]), r.fault) for r in got] == [("30", 0, 0, None), ("00", 7, 2, None), ("", 0, 0, "not an envelope")]
    assert got[0].message == "NOT REGISTERED" and got[1]["items"][0]["a"] == "1"


def records(spark, data):
    return spark.createDataFrame(data, "file string, pos long, record map<string,string>")


def test_dedupe_within_files(spark):
    data = [("f", 1, {"untyCntrctNo": "A", "x": "1"}), ("f", 2, {"untyCntrctNo": "A", "x": "2"}), ("f", 3, {"x": "9"}), ("f", 4, {"x": "8"}), ("g", 5, {"untyCntrctNo": "A"}), ("h", 6, {"x": "1"}), ("h", 7, {"x": "1"}), ("h", 8, {"x": "2"})]
    assert sorted(r.pos for r in dedupe_records(records(spark, data), "contracts").collect()) == [2, 4, 5, 7, 8]


def test_first_present_alias(spark):
    r = records(spark, [("f", 1, {"dmndInsttCd": None, "dminsttCd": "B"}), ("f", 2, {"dmndInsttCd": "A"}), ("g", 3, {"dminsttCd": "C"})])
    assert [x.demand_agency_code for x in aliased(r, "bids").orderBy("pos").collect()] == [None, "A", "C"]
    assert [x.demand_agency_code for x in aliased(r, "bids", by_value=True).orderBy("pos").collect()] == ["B", "A", "C"]


def test_typing_by_name(spark):
    assert [kind_of(c) for c in ("a_krw", "x_rate", "opening_rank", "d_date", "bidNtceDt", "is_x", "cmmnCntrctYn", "bid_notice_no", "z")] == ["number", "number", "number", "moment", "moment", "flag", "flag", "identifier", "text"]
    df = typed(spark.createDataFrame([("1,000", "2026-01-01", "Y", " 007 ", " t ")], "a_krw string, b_date string, is_c string, bid_notice_no string, z string"))
    assert [f.dataType.simpleString() for f in df.schema] == ["double", "timestamp", "boolean", "string", "string"]
    assert df.first().bid_notice_no == "007" and df.first().z == " t "


def test_normalized_partitions(spark, tmp_path):
    r = records(spark, [("f", 1, {"bidNtceNo": "1", "bidNtceDate": "2026-08-31"}), ("f", 2, {"bidNtceNo": "2", "bidNtceDate": "2026-09-01"}), ("f", 3, {"bidNtceNo": "3"})])
    metas = spark.createDataFrame([("f", {"window_start": "2026-08-01", "window_end": "2026-08-31"})], "file string, meta map<string,string>")
    out = normalized(r, metas, "bids")
    assert rows(out.select("bid_notice_no", "year", "month")) == [("1", "2026", "08"), ("2", "2026", "09"), ("3", "2026", "08")]
    path = str(tmp_path / "bids")
    assert sinks.write_partitioned(out, path) == 2
    assert sinks.write_partitioned(out, path) == 0
    assert spark.read.parquet(path).count() == 3 == sinks.rows_of(spark, path, ["f"])
    assert sinks.write_partitioned(out.where("month = '09'"), path, force=True) == 1
    assert rows(spark.read.parquet(path).select("bid_notice_no", "year", "month")) == [("2", "2026", "09")]


def test_files_of_one_month_keep_and_replace_their_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda *data: spark.createDataFrame(list(data), "id int, _source_file string, year string, month string")
    shown = lambda: rows(spark.read.parquet(path).select("id", "_source_file", "month"))
    a, b = make((1, "a", "2026", "08"), (4, "a", "2026", "09")), make((2, "b", "2026", "08"), (3, "b", "2026", "08"))
    assert sinks.write_partitioned(a, path) == 2
    assert sinks.write_partitioned(b, path) == 1
    assert shown() == [(1, "a", "08"), (2, "b", "08"), (3, "b", "08"), (4, "a", "09")]
    assert sinks.write_partitioned(make((9, "a", "2026", "08"), (2, "b", "2026", "08")), path) == 0
    assert sinks.write_partitioned(make((5, "a", "2026", "08")), path, force=True) == 1
    assert shown() == [(2, "b", "08"), (3, "b", "08"), (5, "a", "08")]
    assert sinks.write_partitioned(make((6, None, "2026", "08"), (7, "x=/ y.gz", "2026", "08")), path) == 2
    assert sinks.write_partitioned(make((6, None, "2026", "08"), (7, "x=/ y.gz", "2026", "08")), path) == 0
    assert sinks.rows_of(spark, path, ["b"]) == 2 and sinks.rows_of(spark, str(tmp_path / "none"), ["b"]) == 0
    assert sinks.write_partitioned(a.limit(0), path) == 0


def test_windows_and_releases(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, _source_file string")
    assert sinks.write_windows(df, str(tmp_path / "w")) == 2
    assert rows(spark.read.parquet(str(tmp_path / "w")).groupBy("source").count()) == [("a", 1), ("b", 2)]
    for name, tables in (("r_2026_01", ("tenders", "agencies")), ("r_2026_02", ("tenders",)), ("r_2026_03", ("tenders", "agencies"))):
        for t in tables:
            (tmp_path / "rel" / name / t).mkdir(parents=True)
    assert [r.rsplit("/", 1)[1] for r in sinks.releases(spark, str(tmp_path / "rel"), ["tenders", "agencies"])] == ["r_2026_03", "r_2026_01"]
    assert sinks.releases(spark, str(tmp_path / "nowhere"), ["x"]) == []


HEAD = "입찰공고번호,입찰공고차수,공고명,추정가격,개찰순위,낙찰자선정여부,업체사업자등록번호,투찰금액,투찰율"


@pytest.mark.parametrize("encoding", ["utf-8-sig", "cp949", "utf-8"])
def test_report_csv(spark, tmp_path, encoding):
    path = tmp_path / "report.csv"
    path.write_bytes((HEAD + '\n001,000,"가, 나","1,500",1,Y,0123456789,"1,200",88.0%\n').encode(encoding))
    raw = read_report(spark, path)
    assert raw.columns[0] == "입찰공고번호"
    r = normalized_report(raw).first()
    assert (r.bid_notice_no, r.estimated_price_krw, r.is_selected_winner, r.bidder_business_registration_no, r.bid_rate, r["공고명"]) == ("001", 1500.0, True, "0123456789", 88.0, "가, 나")
    with pytest.raises(ValueError, match="neither"):
        read_report(spark, tmp_path / "x.txt")


def test_encoding_is_that_of_the_whole_file(tmp_path):
    path = tmp_path / "late.csv"
    path.write_bytes(b"a,b\n" + b"1,2\n" * 400_000 + "가,나\n".encode("cp949"))
    assert detect_encoding(path) == "cp949"
    path.write_bytes(b"x" * ((1 << 20) - 1) + "가".encode() + b"\n")
    assert detect_encoding(path) == "utf-8-sig"
    path.write_bytes(b"\xff\xff\xff")
    with pytest.raises(ValueError, match="none of"):
        detect_encoding(path)


def test_report_workbook(spark, tmp_path):
    pytest.importorskip("openpyxl")
    import pandas as pd

    path = tmp_path / "report.xlsx"
    pd.DataFrame([["001", "1,500"]], columns=["입찰공고번호", "추정\n가격"]).to_excel(path, index=False)
    assert normalized_report(read_report(spark, path)).first().estimated_price_krw == 1500.0


def fetcher(script):
    calls = []

    def fetch(operation, params):
        calls.append(params)
        x = script[min(len(calls), len(script)) - 1]
        if isinstance(x, Exception):
            raise x
        return x

    return fetch, calls


@pytest.mark.parametrize("trouble", [(500, [], 0, "", ""), (429, [], 0, "", ""), TimeoutError()])
def test_transient_trouble_is_tried_again(trouble):
    fetch, calls = fetcher([trouble, (200, [{"a": 1}], 1, "00", "OK")])
    assert S.get_page(fetch, "op", {}, sleep=lambda _: None) == ([{"a": 1}], 1) and len(calls) == 2


@pytest.mark.parametrize("answer,error", [((404, [], 0, "", ""), S.PermanentError), ((200, [], 0, "02", "bad"), S.PermanentError), ((200, [], 0, "30", "key"), S.AuthError), ((200, [], 0, "22", "quota"), S.QuotaError)])
def test_other_trouble_is_not(answer, error):
    fetch, calls = fetcher([answer])
    with pytest.raises(error):
        S.get_page(fetch, "op", {}, sleep=lambda _: None)
    assert len(calls) == 1


def test_no_data_and_giving_up():
    assert S.get_page(fetcher([(200, [], 0, "03", "none")])[0], "op", {}) == ([], 0)
    fetch, calls = fetcher([(503, [], 0, "", "")])
    with pytest.raises(S.TransientError):
        S.get_page(fetch, "op", {}, sleep=lambda _: None)
    assert len(calls) == 5


def test_paging_stops():
    full = (200, [{"a": 1}] * 2, 5, "00", "")
    fetch, _ = fetcher([full, full, (200, [{"a": 1}], 5, "00", "")])
    assert [(p, len(i)) for p, i, _ in S.pages(fetch, "op", {}, 2)] == [(1, 2), (2, 2), (3, 1)]


def test_collector_cases(tmp_path):
    m = W.Manifest(tmp_path / "m.json")
    fetch, calls = fetcher([(200, [{"a": 1}], 1, "00", "")])
    c = S.Collector(fetch, tmp_path / "raw", m, receipts=True)
    f, w = FEEDS["bids"], ("2026-08-01", "2026-08-31")
    assert c.collect(f, *w, dry_run=True) == (0, 0, "planned") and not calls
    assert c.collect(f, *w) == (1, 1, "fetched")
    assert c.collect(f, *w) == (0, 0, "skipped")
    m.remove("bids::all::2026-08-01::2026-08-31")
    assert c.collect(f, *w) == (0, 0, "recorded")
    path = next((tmp_path / "raw").rglob("*.jsonl.gz"))
    path.unlink()
    assert c.collect(f, *w) == (1, 1, "fetched")
    path.write_bytes(b"broken")
    assert c.collect(f, *w) == (1, 1, "fetched")
    assert c.collect(f, *w, force=True) == (1, 1, "fetched")
    noted = [json.loads(x) for x in (tmp_path / "raw" / "receipts.jsonl").read_text().splitlines()]
    assert [x["kind"] for x in noted] == ["page", "attempt"] * 4 and noted[0]["page_row_count"] == 1
    assert len({x["run_id"] for x in noted}) == 1 and len({x["attempt_id"] for x in noted}) == 4
    seen = []
    c.run(f, [(*w, None)], progress=lambda *x: seen.append(x))
    assert seen == [(1, 1, "2026-08-01 all skipped, 0 rows")]
    assert c.run(f, [(*w, None)] * 3, max_windows=2) == {"windows": 2, "rows": 0, "calls": 0, "skipped": 2}
    assert c.run(f, [(*w, None)] * 3, max_calls=1, force=True)["windows"] == 1


def test_failed_attempt_names_only_the_error(tmp_path):
    fetch, _ = fetcher([(200, [{"a": 1}] * 2, 9, "00", ""), S.PermanentError("secret text")])
    c = S.Collector(fetch, tmp_path / "raw", W.Manifest(tmp_path / "m.json"), page_size=2, receipts=True)
    with pytest.raises(S.PermanentError):
        c.collect(FEEDS["bids"], "2026-08-01", "2026-08-31")
    text = (tmp_path / "raw" / "receipts.jsonl").read_text()
    last = json.loads(text.splitlines()[-1])
    assert (last["kind"], last["status"], last["error"]) == ("attempt", "failed", "PermanentError") and "secret" not in text and len(text.splitlines()) == 2
    assert not [p for p in (tmp_path / "raw").rglob("*") if p.suffix in {".gz", ".part"}]
    c.fetch, _ = fetcher([(200, [{"a": 1}] * 2, 3, "00", ""), (200, [{"a": 1}], 3, "00", "")])
    c.collect(FEEDS["bids"], "2026-08-01", "2026-08-31")
    lines = [json.loads(x) for x in (tmp_path / "raw" / "receipts.jsonl").read_text().splitlines()]
    assert [x["kind"] for x in lines] == ["page", "attempt", "page", "page", "attempt"] and len({x["run_id"] for x in lines}) == 1 and len({x["attempt_id"] for x in lines}) == 2


def test_pages_go_to_disk_as_they_come(tmp_path):
    sizes = []

    def fetch(operation, params):
        part = next((tmp_path / "raw").rglob("*.part"), None)
        sizes.append(part is not None)
        return 200, [{"n": params["pageNo"], "x": "y" * 50}] * 3, 9, "00", ""

    assert S.Collector(fetch, tmp_path / "raw", W.Manifest(tmp_path / "m.json"), page_size=3).collect(FEEDS["bids"], "2026-08-01", "2026-08-31")[:2] == (9, 3)
    assert sizes == [True, True, True]


@pytest.fixture
def server():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    answers, asked = [], []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append((self.path, self.headers["User-Agent"]))
            status, text = answers.pop(0)
            self.send_response(status)
            self.end_headers()
            self.wfile.write(text.encode())

        def log_message(self, *_):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}/svc", answers, asked
    http.shutdown()
    http.server_close()


PAGE = '{"response": {"header": {"resultCode": "00", "resultMsg": "OK"}, "body": {"items": %s, "totalCount": "%d"}}}'


def test_http(server, tmp_path):
    base, answers, asked = server
    fetch = S.HttpFetcher(base, " a%2Bb%3D ", pause=0)
    answers += [(500, "oops"), (200, PAGE % ('[{"a": 1}, {"a": 2}]', 3)), (200, PAGE % ('{"item": {"a": 3}}', 3))]
    assert [(p, len(i), t) for p, i, t in S.pages(fetch, "op", {"from": "x y"}, 2, sleep=lambda _: None)] == [(1, 2, 3), (2, 1, 3)]
    assert fetch.calls == 3 and "serviceKey=a%2Bb%3D" in asked[0][0] and "type=json" in asked[0][0] and "from=x+y" in asked[0][0] and asked[0][1] == "jangbu" and "a+b" not in repr(fetch)
    answers += [(200, "<OpenAPI_ServiceResponse><cmmMsgHeader><errMsg>E</errMsg><returnAuthMsg>no key</returnAuthMsg><returnReasonCode>30</returnReasonCode></cmmMsgHeader></OpenAPI_ServiceResponse>")]
    with pytest.raises(S.AuthError, match="no key"):
        S.get_page(fetch, "op", {})
    for status, text, error in ((404, "gone", S.PermanentError), (200, '{"x": 1}', S.PermanentError), (200, PAGE % ('"text"', 1), S.PermanentError)):
        answers.append((status, text))
        before = fetch.calls
        with pytest.raises(error):
            S.get_page(fetch, "op", {}, sleep=lambda _: None)
        assert fetch.calls == before + 1
    answers += [(200, "neither"), (200, "<response><header><resultCode>00</resultCode></header><body><items><item><a>1</a></item></items><totalCount>1</totalCount></body></response>")]
    assert S.get_page(fetch, "op", {}, sleep=lambda _: None) == ([{"a": "1"}], 1)
    answers += [(200, PAGE % ("null", 0))]
    assert S.get_page(fetch, "op", {}) == ([], 0)
    answers += [(200, PAGE % ('[{"a": 1}]', 1))]
    assert S.Collector(fetch, tmp_path / "raw", W.Manifest(tmp_path / "m.json")).collect(FEEDS["bids"], "2026-08-01", "2026-08-31") == (1, 1, "fetched")


def test_scopes_and_names(spark):
    m = spark.createDataFrame([("a", "2026-01-01", "2026-01-31"), ("b", "2026-01-01", "2026-02-01"), ("c", None, None)], "k string, start string, end string")
    assert rows(W.manifest_in_scope(m, "2026-01-01", "2026-01-31").select("k")) == [("a",)]
    f = spark.createDataFrame([("x_20260101_20260131.jsonl.gz",), ("x_20260101_20260201.jsonl.gz",), ("x.gz",)], "n string")
    assert [r.n for r in W.files_in_scope(f, "n", "2026-01-01", "2026-01-31").collect()] == ["x_20260101_20260131.jsonl.gz"]
    r = records(spark, [("f", 1, {"d": "2026-01-05 10:00"}), ("f", 2, {"d": "2026-02-05"}), ("f", 3, {"e": "1"})])
    assert [x.pos for x in W.records_in_scope(r, "d", "2026-01-01", "2026-01-31").collect()] == [1]


def test_feed_as_data_source(spark):
    def fetch(operation, params):
        return 200, [{"id": params["start"], "n": None}], 1, "00", ""

    spark.dataSource.register(S.feed_source(fetch, [("op", {"start": "1"}), ("op", {"start": "2"})]))
    assert sorted(r.record["id"] for r in spark.read.format("paged_feed").load().collect()) == ["1", "2"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2.0), ("a", None)], "k string, v_krw double")
    sinks.write_csv(df.orderBy("k"), tmp_path / "x.csv")
    assert (tmp_path / "x.csv").read_text() == "k,v_krw\na,\nb,2.0\n"
    sinks.require_header(tmp_path / "x.csv", ["k", "v_krw"])
    with pytest.raises(ValueError):
        sinks.require_header(tmp_path / "x.csv", ["k"])
    sinks.write_sorted(df, str(tmp_path / "t"), ["k"])
    r = sinks.table_receipt(spark.read.parquet(str(tmp_path / "t")), tmp_path / "t")
    assert (r["rows"], r["columns"]) == (2, 2) and r["bytes"] > 0 and all(len(x) == 64 for x in r["files"].values())
    assert sinks.catalogue({"t": df}, "owner-x", "slug-x", {"k": "key", "v_krw": "amount"})["resources"][0]["schema"]["fields"][1]["type"] == "number"
    with pytest.raises(ValueError, match="no description"):
        sinks.catalogue({"t": df}, "owner-x", "slug-x", {"k": "key"})
    with pytest.raises(ValueError, match="owner"):
        sinks.catalogue({}, "x y", "slug-x", {})
    sinks.write_json(tmp_path / "r.json", {"가": 1})
    assert json.loads((tmp_path / "r.json").read_text()) == {"가": 1}
    assert [sinks.catalogue_type(f.dataType) for f in spark.createDataFrame([], "a boolean, b bigint, c double, d timestamp, e string").schema] == ["boolean", "integer", "number", "datetime", "string"]


def test_stream_picks_up_new_files_once(spark, tmp_path):
    from jangbu.streaming.windows import stream_windows

    folder, out = tmp_path / "raw", str(tmp_path / "out")
    row = lambda n: {"bidNtceNo": n, "bidNtceDate": "2026-08-02"}
    window(folder / "bids_all_20260801_20260831.jsonl.gz", [row("1"), row("2"), row("1")])
    run = lambda: stream_windows(spark, str(folder), "bids", out, str(tmp_path / "cp")).awaitTermination(60)
    run()
    run()
    assert spark.read.parquet(out).count() == 2
    window(folder / "bids_all_20260901_20260930.jsonl.gz", [row("1")], start="2026-09-01", end="2026-09-30")
    run()
    assert rows(spark.read.parquet(out).select("bid_notice_no")) == [("1",), ("1",), ("2",)]


def test_stream_takes_many_files_a_batch(spark, tmp_path):
    from jangbu.streaming.windows import stream_windows

    folder, before = tmp_path / "raw", spark.conf.getAll
    for k in range(70):
        window(folder / f"bids_{k}_20260801_20260831.jsonl.gz", [{"bidNtceNo": "1", "bidNtceDate": "2026-08-02"}, {"bidNtceNo": str(k + 2), "bidNtceDate": "2026-09-02"}, {"bidNtceNo": "1", "bidNtceDate": "2026-08-03"}])
    run = lambda name, **size: stream_windows(spark, str(folder), "bids", str(tmp_path / name), str(tmp_path / f"{name}-cp"), **size).awaitTermination(120)
    of = lambda name: rows(spark.read.parquet(str(tmp_path / name)).select("_source_file", "bid_notice_no", F.col("bid_notice_date").cast("string"), "year", "month"))
    run("whole")
    assert [p.name for p in (tmp_path / "whole").iterdir()] == ["batch=0"]
    run("cut", batch_files=40)
    assert sorted(p.name for p in (tmp_path / "cut").iterdir()) == ["batch=0", "batch=1"]
    assert len(of("whole")) == 140 and of("whole") == of("cut")
    assert not spark.sparkContext._jsc.getPersistentRDDs() and spark.conf.getAll == before


def test_window_files_of_lines(spark, tmp_path):
    days = ("2026-08-01", "2026-08-07")
    lines = [("a.gz", k, f'{{"n": {k}}}', *days) for k in range(9, 0, -1)] + [("a.gz", 10, "no JSON", *days), ("a.gz", None, '{"n": "last"}', *days), ("b.gz", 1, "[1]", *days), ("b.gz", 2, None, *days), ("c.gz", 1, '{"가": 1.50}', *days)]
    df = spark.createDataFrame(lines, "f string, k int, p string, window_start string, window_end string")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)  # a file spans batches
    try:
        assert rows(W.write_window_files(df, str(tmp_path), "f", "k", "p", "contracts")) == [("a.gz", 10), ("b.gz", 0), ("c.gz", 1)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    read = {p.name: [json.loads(x) for x in gzip.open(p, "rt", encoding="utf-8")] for p in tmp_path.iterdir()}
    assert [x["n"] for x in read["a.gz"][1:-1]] == [*range(1, 10), "last"] and read["b.gz"][1:-1] == [] and read["c.gz"][1:-1] == [{"가": 1.5}]
    assert all(x[-1][W.META] == {"feed": "contracts", "window_start": days[0], "window_end": days[1], "status": "complete", "rows": len(x) - 2} for x in read.values())


def test_streamed_event_counts(spark, tmp_path):
    from jangbu.streaming.windows import event_counts

    spark.createDataFrame([(1, "2026-01-01 00:00:00", "a"), (1, "2026-01-01 00:00:00", "a"), (2, "2026-01-02 00:00:00", "a"), (3, "2026-02-01 00:00:00", "b")], "event_id long, t string, k string").select("event_id", F.to_timestamp("t").alias("ts"), "k").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id long, ts timestamp, k string").parquet(str(tmp_path / "in"))
    q = event_counts(stream, "ts", "k").writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.k, r.n) for r in spark.table("counts").collect()) == [("a", 2), ("b", 1)]
