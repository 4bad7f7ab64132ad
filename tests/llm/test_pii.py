from __future__ import annotations

import pytest

from jangbu.llm.pii import find_pii
from jangbu.llm.surrogates import pii_found
from tests.conftest import rows

KEY = b"0123456789abcdef"


def kinds(text):
    return [(s.kind, text[s.start : s.end]) for s in find_pii(text)]


@pytest.mark.parametrize(
    "text,want",
    [
        ("연락은 kim.saebom+bid@mail.example으로", [("email", "kim.saebom+bid@mail.example")]),
        ("write to NURI_PM@EXAMPLE.COM.", [("email", "NURI_PM@EXAMPLE.COM")]),
        ("daon_pm＠post.example 이용", [("email", "daon_pm＠post.example")]),
        ("haru at corp dot example으로", [("email", "haru at corp dot example")]),
        ("siul.261[at]corp.example;", [("email", "siul.261[at]corp.example")]),
        ("copied to saebompm (at) post.example and", [("email", "saebompm (at) post.example")]),
        ("yerin.775 골뱅이 mail.example;", [("email", "yerin.775 골뱅이 mail.example")]),
        ("회신 계정은 @help 표기만", []),
        ("Visit https://notice.example/R26TA00000001 for", []),
        ("We meet at noon dot and go", []),
    ],
)
def test_mails(text, want):
    assert kinds(text) == want


@pytest.mark.parametrize(
    "text,want",
    [(f"전화 {n}번", [("phone", n)]) for n in ("010-1234-5678", "010 1234 5678", "010.1234.5678", "010–1234–5678", "01012345678", "０１０－１２３４－５６７８", "+82-10-1234-5678", "+82 10 1234 5678", "+821012345678", "02) 123-4567", "031-123-4567", "064) 026-6036")]
    + [("관리번호 010-1234-5678 물품", []), ("문서번호 2026-6639-6071에", []), ("사업자등록번호 704-70-02404는", []), ("010-****-5678는", []), ("Item number 02-123-4567 appears", []), ("금액 1,010-1234", []), ("2026-08-10 10:00", [])],
)
def test_phones(text, want):
    assert kinds(text) == want


@pytest.mark.parametrize(
    "text,want",
    [(f"신분 번호는 {n}이며", [("id_number", n)]) for n in ("900101-1234567", "900101 - 5234567", "900101–1234567", "9001011234567", "26-18-919378-46", "M42988486", "M072B4495")]
    + [("물품분류번호 9001011234567 품목", []), ("Product code 9001011234567 remains", []), ("번호 901301-1234567", []), ("900101-1******", []), ("도면번호 863305-4 외", []), ("R26BK28650301 건", [])],
)
def test_identity_numbers(text, want):
    assert kinds(text) == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("물품은 마루도 하결구 은하수길 156-27, 110동 413호에 사는", ["마루도 하결구 은하수길 156-27, 110동 413호"]),
        ("주소 금빛군 솔샘동 산 292번지", ["금빛군 솔샘동 산 292번지"]),
        ("송부처: 누리특별자치도 참밭구 참샘로 179-20\n개찰 결과", ["누리특별자치도 참밭구 참샘로 179-20"]),
        ("주소 라온도 푸별군 푸른들길 186 9층", ["라온도 푸별군 푸른들길 186 9층"]),
        ("lives at 71 Galaxy-gil, Daram-si, Unit 2352.", ["71 Galaxy-gil, Daram-si, Unit 2352"]),
        ("sent to 390 Byeolnae-ro, Haeul-gun and", ["390 Byeolnae-ro, Haeul-gun"]),
        ("금빛군 새솔로 45.25km 구간", []),
        ("별고돌시 별내음로 일원에서", []),
        ("하결시 은하수길 확포장공사 7공구", []),
        ("가강군 무정전으로 2,458,700원", []),
    ],
)
def test_addresses(text, want):
    assert [v for k, v in kinds(text) if k == "address"] == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("민원인 제갈서운님은", ["제갈서운"]),
        ("담당자 강 도 솔 / x", ["강 도 솔"]),
        ("현장대리인은 권다늘이고", ["권다늘"]),
        ("문의는 환경과 안 하린 감독관(", ["안 하린"]),
        ("참석: 남 궁 나 람, 제갈소찬, 황서봄 (이상", ["남 궁 나 람", "제갈소찬", "황서봄"]),
        ("신청인 성명 류 서담, 주민", ["류 서담"]),
        ("유한회사 김가네유통 홍온늘 귀하", ["홍온늘"]),
        ("서유율 사무관이 들길시 현장을", ["서유율"]),
        ("담당자 최○○의 연락처", []),
        ("정보화담당관에서는 수의계약으로", []),
        ("도로과 실무자는", []),
        ("Questions go to SEO Dodam at", ["SEO Dodam"]),
        ("The site manager is Kim, Saebom (mobile", ["Kim, Saebom"]),
        ("signed for by Sol-bit Yoon.", ["Sol-bit Yoon"]),
        ("Lee, Si-ul of Ieum Systems asked", ["Lee, Si-ul"]),
        ("Hanul Supply quoted", []),
        ("A consortium led by Park Engineering will", []),
    ],
)
def test_names(text, want):
    assert [v for k, v in kinds(text) if k == "name"] == want


def test_operator(spark):
    t = "담당자 김새봄 / a@b.example / 010-1234-5678, 다시 010-1234-5678"
    df = spark.createDataFrame([(1, t, "x"), (2, None, "x"), (3, "", "x"), (4, "글 " * 100_000 + t, "x")], "doc_id long, text string, pii_type string")
    assert rows(pii_found(df, KEY).where("doc_id = 1")) == [(1, "email", "a@b.example"), (1, "name", "김새봄"), (1, "phone", "010-1234-5678")]
    assert sorted(r.doc_id for r in pii_found(df, KEY).select("doc_id").distinct().collect()) == [1, 4]
    assert pii_found(df.limit(0), KEY).count() == 0


def test_lists_are_read_to_the_end_of_the_line():
    names = lambda t: [v for k, v in kinds(t) if k == "name"]
    assert names("참석: 김가나(총무과), 이다라(계약과. 2층), 박마바 (이상 3차 회의) 소음, 전기료, 민원") == ["김가나", "이다라", "박마바"]
    assert names("참석: 김가나. 이다라. 회의는, 전기료, 순으로\n박마바, 최사아") == ["김가나", "이다라"]
    assert names("출석: 총무과, 김가나 과장(총무과), 참석: 이다라<br>") == ["김가나", "이다라"]
    many = [f"김{a}{b}" for a in "가나다라마바사아자차" for b in "하거너더러머버서어저"]
    assert names("참석: " + ", ".join(many)) == many


@pytest.mark.parametrize(
    "text,want",
    [
        ("문의는 허준 과장에게", ["허준"]),
        ("작성자: 이산", ["이산"]),
        ("작성자:이산이고 담당자: 김빛나라 /", ["이산", "김빛나라"]),
        ("김빛나라 주무관과 허준님은", ["김빛나라", "허준"]),
        ("참석: 허준, 김빛나라(총무과), 이다라, 위원, 총무과", ["허준", "김빛나라", "이다라"]),
        ("담당자: 김새봄이 왔다", ["김새봄"]),
        ("현장 소장, 공사 감독관, 안전관리 팀장, 기술지원 과장, 전기 기사, 심사 위원, 도로과 과장", []),
        ("고객님은 선생님께, 소장님이 이사님을", []),
        ("담당자 지정, 담당자 지정하여 통보", []),
    ],
)
def test_names_of_one_and_three_given_syllables(text, want):
    assert [v for k, v in kinds(text) if k == "name"] == want


def test_names_outside_the_lists():
    """A third of the families is taken from the lists; their names must still be found by what stands around them."""
    import random
    import re
    import sys
    import types
    from pathlib import Path

    import pyarrow.parquet as pq

    from jangbu.llm import pii

    rng = random.Random(5)
    ones, romanised = pii.FAMILY_ONE.split(), pii.FAMILY_ROMANISED.split(", ")
    away = {"김", *rng.sample(ones, len(ones) // 3)}
    source = Path(pii.__file__).read_text(encoding="utf-8")
    source = source.replace(f'"{pii.FAMILY_ONE}"', repr(" ".join(x for x in ones if x not in away))).replace(f'"{pii.FAMILY_ROMANISED}"', repr(", ".join(x for x in romanised if x.split()[0] not in away)))
    fewer = types.ModuleType("fewer_families")
    sys.modules["fewer_families"] = fewer
    exec(compile(source, "fewer_families", "exec"), fewer.__dict__)  # noqa: S102
    latin = {f for x in romanised for f in x.split()[1:] if x.split()[0] in away}
    known = found = extra = 0
    for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist():
        if not t:
            continue
        names = {t[s.start : s.end] for s in find_pii(t) if s.kind == "name"}
        again = {t[s.start : s.end] for s in fewer.find_pii(t) if s.kind == "name"}
        withheld = {n for n in names if n[0] in away or any(w.capitalize() in latin for w in re.findall("[A-Za-z]+", n))}
        known, found, extra = known + len(withheld), found + len(withheld & again), extra + len(again - names)
    assert known > 50 and found >= 0.9 * known and extra <= 0.02 * known


@pytest.mark.parametrize("text", ["The River Park opened.", "Section Two Round File", "Questions go to the office.", "담당자 연락처를 확인", "시설 관리 소장", "담당자: 미정"])
def test_what_is_no_name(text):
    assert [s for s in find_pii(text) if s.kind == "name"] == []
