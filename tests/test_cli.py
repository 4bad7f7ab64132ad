from __future__ import annotations

import json
import logging

import pytest

from jangbu.cli import Redacting, main
from jangbu.sources.feed import AuthError, QuotaError

NOTICE = {"bidNtceNo": "N1", "bidNtceOrd": "000", "bidNtceDate": "2026-08-03", "bidNtceNm": "t", "ntceInsttCd": "G1", "ntceInsttNm": "Agency", "dmndInsttCd": "D1", "dmndInsttNm": "Demand", "bsnsDivNm": "용역", "cntrctCnclsMthdNm": "제한경쟁", "asignBdgtAmt": "1,000", "presmPtce": "900", "elctrnBidYn": "Y", "intrntnlBidYn": "N", "rgnLmtYn": "N", "indstrytyLmtYn": "N"}
AWARD = {"bidNtceNo": "N1", "bidNtceOrd": "000", "opengDate": "2026-08-05", "bidprcCorpBizrno": "1234567890", "bidprcCorpNm": "Acme", "opengRank": "1", "bidprcAmt": "800", "bidprcTm": "10:00", "sucsfYn": "Y", "fnlSucsfAmt": "800", "fnlSucsfRt": "88.5%", "fnlSucsfDate": "2026-08-06", "fnlSucsfCorpNm": "Acme", "fnlSucsfCorpBizrno": "1234567890"}
CONTRACT = {"untyCntrctNo": "C1", "cntrctCnclsDate": "2026-08-07", "bidNtceNo": "N1", "bidNtceOrd": "000", "cntrctInsttCd": "G1", "cntrctInsttNm": "Agency", "rprsntCorpBizrno": "1234567890", "rprsntCorpNm": "Acme", "cntrctAmt": "800", "ttalCntrctAmt": "800"}


def fetch(operation, params):
    items = []
    if "BidPblanc" in operation and "202608" in str(params):
        items = [NOTICE]
    elif "Scsbid" in operation and params["opengBgnDt"] == "202608050000" and params["bsnsDivCd"] == "5":
        items = [AWARD]
    elif "Cntrct" in operation and params["cntrctCnclsBgnDate"] <= "20260807" <= params["cntrctCnclsEndDate"]:
        items = [CONTRACT]
    return 200, items, len(items), "00", "OK"


def refuse(operation, params):
    raise AuthError("key")


def exhausted(operation, params):
    raise QuotaError("none left")


SCOPE = ["--start", "2026-08-01", "--end", "2026-08-09"]


def test_from_collection_to_release(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("JANGBU_HMAC_KEY", "a key for tests")
    raw, processed, curated, out = (str(tmp_path / n) for n in ("raw", "processed", "curated", "out"))
    run = lambda *a: main(list(a), spark)
    assert run("plan", *SCOPE) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"awards": 36, "bids": 1, "contracts": 2}
    assert run("check", "--raw", raw, *SCOPE) == 1
    assert run("build", "--raw", raw, "--out", processed, *SCOPE) == 1
    assert run("collect", "--raw", raw, *SCOPE, "--fetcher", "tests.test_cli:fetch") == 0
    assert run("check", "--raw", raw, *SCOPE) == 0
    assert run("build", "--raw", raw, "--out", processed, *SCOPE) == 0
    assert {r["feed"]: r["rows_after"] for r in json.loads((tmp_path / "processed" / "build_report.json").read_text())} == {"bids": 1, "awards": 1, "contracts": 1}
    assert run("curate", "--processed", processed, "--out", curated, *SCOPE) == 0
    assert json.loads((tmp_path / "curated" / "summary.json").read_text())["all_passed"]
    assert run("release", "--curated", curated, "--out", out, *SCOPE) == 0
    lines = (tmp_path / "out" / "quickstart.csv").read_text().splitlines()
    assert len(lines) == 2 and "N1" in lines[1] and "88.5" in lines[1]
    audit = ["audit", "--raw", raw, "--processed", processed, *SCOPE, "--strict", "--out", str(tmp_path / "audit.json")]
    assert run(*audit) == 0
    said = json.loads((tmp_path / "audit.json").read_text())
    assert said["critical"] == [] and said["plan"] == [] and {r["feed"]: r["build_rows_after"] for r in said["reconciliation"]} == {"bids": 1, "awards": 1, "contracts": 1}
    next((tmp_path / "raw" / "bids").glob("*.gz")).rename(tmp_path / "gone")
    assert run(*audit) == 1
    assert {x["finding"] for x in json.loads((tmp_path / "audit.json").read_text())["plan"]} == {"missing_file"}
    assert run("quickstart", "--releases", str(tmp_path), "--out", str(tmp_path / "again.csv")) == 0
    assert (tmp_path / "again.csv").read_text() == (tmp_path / "out" / "quickstart.csv").read_text()
    assert run("quickstart", "--releases", str(tmp_path / "raw"), "--out", str(tmp_path / "x.csv")) == 1
    columns = {c for t in (tmp_path / "out").iterdir() if t.is_dir() for c in spark.read.parquet(str(t)).columns}
    (tmp_path / "d.json").write_text(json.dumps(dict.fromkeys(columns, "a column")))
    catalogue = ["catalogue", "--release", out, "--descriptions", str(tmp_path / "d.json"), "--slug", "some-slug", "--out", str(tmp_path / "c.json")]
    assert run(*catalogue, "--owner", "an-owner") == 0 and len(json.loads((tmp_path / "c.json").read_text())["resources"]) == 7
    (tmp_path / "d.json").write_text("{}")
    assert run(*catalogue, "--owner", "an-owner") == 1
    assert run("quality", "--out", str(tmp_path / "q.json"), "--strict", f"{out}/tenders", f"{out}/none") == 1


def test_a_changed_file_needs_force(spark, tmp_path, monkeypatch):
    from jangbu.sources.raw import write_window

    meta = {"feed": "bids", "window_start": "2026-08-01", "window_end": "2026-08-09"}
    path = tmp_path / "raw" / "bids" / "bids_all_20260801_20260809.jsonl.gz"
    build = ["build", "--raw", str(tmp_path / "raw"), "--out", str(tmp_path / "p"), "--feeds", "bids"]
    write_window(path, [NOTICE], meta)
    assert main(build, spark) == 0
    write_window(path, [NOTICE, NOTICE | {"bidNtceNo": "N2"}], meta)
    assert main(build, spark) == 1 and main([*build, "--force"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "p" / "bids")).count() == 2


@pytest.mark.parametrize("fetcher,code", [("refuse", 2), ("exhausted", 3)])
def test_exit_codes(spark, tmp_path, fetcher, code):
    assert main(["collect", "--raw", str(tmp_path), *SCOPE, "--feeds", "bids", "--fetcher", f"tests.test_cli:{fetcher}"], spark) == code


def test_no_key_no_build(spark, tmp_path, monkeypatch):
    monkeypatch.delenv("JANGBU_HMAC_KEY", raising=False)
    with pytest.raises(SystemExit):
        main(["curate", "--processed", str(tmp_path), "--out", str(tmp_path), *SCOPE], spark)
    with pytest.raises(SystemExit):
        main(["build", "--raw", str(tmp_path), "--out", str(tmp_path), "--start", "2026-08-01"], spark)


def test_logs_hide_keys():
    record = logging.LogRecord("x", logging.INFO, "f", 1, "GET ?serviceKey=%s&x=1", ("secret",), None)
    Redacting().filter(record)
    assert record.getMessage() == "GET ?serviceKey=[REDACTED]&x=1"
