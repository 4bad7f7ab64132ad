"""Personal information inside free text: mail addresses, telephone and identity numbers, street addresses, names.

Each kind has a cheap trigger that is searched over the whole text, and a full pattern that is tried only around the
triggers. Spans never overlap: a longer or more certain one wins. Texts are scanned in Arrow batches where they lie.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

# Korean family names, their usual romanised forms, titles, and words that follow a label.
FAMILY_TWO = "남궁 제갈 황보 선우 사공 독고 서문 동방"
FAMILY_ONE = "김 이 박 최 정 강 조 윤 장 임 한 오 서 신 권 황 안 송 류 유 홍 전 고 문 양 손 배 백 허 남 심 노 하 곽 성 차 주 우 구 민 진 나 지 엄 채 원 천 방 공 현 함 변 염 여 추 도 소 석 선 설 마 길 연 위 표 명 기 반 왕 금 옥 육 인 맹 제 모 탁 국 어 은 편 용"
FAMILY_ROMANISED = "김 Kim, 이 Lee Yi Rhee, 박 Park Pak, 최 Choi Choe, 정 Jung Jeong Chung, 강 Kang, 조 Cho Jo, 윤 Yoon Yun, 장 Jang Chang, 임 Lim Im, 한 Han, 오 Oh, 서 Seo Suh, 신 Shin Sin, 권 Kwon, 황 Hwang, 안 Ahn An, 송 Song, 류 Ryu, 유 Yoo Yu, 홍 Hong, 전 Jeon, 고 Ko Koh, 문 Moon Mun, 양 Yang, 손 Son Sohn, 배 Bae, 백 Baek Paik, 허 Heo Hur, 남 Nam, 심 Shim Sim, 노 Noh Roh, 하 Ha, 곽 Kwak, 성 Sung, 차 Cha, 주 Joo Ju, 우 Woo, 구 Koo Ku, 민 Min, 진 Jin, 나 Na, 지 Ji, 엄 Eom Um, 채 Chae, 원 Won, 남궁 Namgung, 제갈 Jegal, 황보 Hwangbo, 선우 Seonwoo, 사공 Sagong"
TITLES = "사무관 주무관 서기관 감독관 조사관 소장 팀장 과장 부장 차장 실장 국장 계장 반장 본부장 대리 주임 사원 대표 대표이사 이사 위원 위원장 교수 박사 기사 선생 선생님 여사 씨 님 귀하 귀중"
LABELS = "담당자 작성자 신청인 성명 이름 민원인 현장대리인 대표자 수령인 수신인 발신인 연락인 책임자 보호자 예금주 고객명"
NOT_NAMES = "Call Reply Contact Applicant Mr Ms Mrs Dr By To From The And Or Of In On At For With Questions Minutes Section Lot Round File Item Product Unit Tender Notice Mail Phone Mobile Attn Dear Hello Only Because Bids"
#: Ordinary words that begin like a family name; with a title behind them, or inside a longer word, they name a post or a firm.
ORDINARY = "현장 공사 공무 공정 공장 공동 공인 공공 기술 기획 기계 기관 기타 전기 전기료 전산 전략 전담 전문 전임 전무 전체 전국 전자 전직 안전 안내 도로 도시 도청 조사 조달 조경 조직 조정 구매 구청 구조 구역 심사 심의 선임 선정 선생 설계 설비 설치 인사 인증 정보 정책 정비 정산 방재 방송 방호 임시 임원 임명 마을 마음 고객 고모 고문 고용 하나 하수 하자 이사 이모 이전 이하 이상 이용 신임 신규 신청 신축 명예 문화 문서 민원 민간 주민 주택 주차 주임 주인 주무 주관 주요 지원 지방 지역 지점 지도 지정 지사 지적 국가 국제 국립 국토 국내 경영 경리 교육 관리 감독 감리 운영 사업 시설 시공 품질 환경 건설 건축 토목 총무 회계 재무 영업 개발 연구 계약 위생 위탁 위촉 표준 소방 소속 서울 서무 석면 용역 우수 원가 원장 원격 유지 유통 유역 육성 옥외 장비 차량 차기 차석 천안 추진 추천 추가 오전 오후 양측 양사 성능 노무 노동 남부 강남 강서 권역 금융 금속 연락 연구 여성 여객 배수 배관 백화 변호 변리 송무 허가 홍보 나머 반장 당사 미정 해당 현황 현직 함께 황색 진행 진단 편집 편의 제조 제품 제작 제출 모든 모집 탁송 어린 은행 맹인 왕복 길이 마감 기록 기재 기존 명의 주소 전화 지급 성별 소유 박물 한국 한전 오류"
#: Given syllables that names are made of.
GIVEN = "가 강 건 겸 경 고 관 교 구 국 규 근 기 길 나 남 다 단 담 대 덕 도 동 두 라 란 람 래 로 름 리 린 마 명 무 문 미 민 배 범 별 병 보 봄 빈 빛 상 새 서 석 선 설 성 세 소 솔 수 숙 순 슬 승 시 식 신 아 안 양 연 열 영 예 오 온 완 용 우 운 울 원 유 윤 율 은 의 이 인 일 자 장 재 전 정 제 조 종 주 준 중 지 진 찬 창 채 철 초 춘 충 치 태 택 평 필 하 한 해 행 향 현 형 혜 호 홍 화 환 훈 휘 희 결 늘 루 누"
TOP_LEVELS = "com org net edu gov mil int info biz name kr co jp cn us uk eu de fr ru io ai app dev test example invalid localhost local"
FIRMS = "Systems Supply Engineering Works Co Ltd Inc Corp Corporation Group Foods Construction River Bridge Street Station Office"

#: Each romanised family name with the Hangul one, and each Hangul one with its first romanised form.
FAMILY_OF = {latin: ko for ko, *forms in (x.split() for x in FAMILY_ROMANISED.split(", ")) for latin in forms}
LATIN_OF = {x.split()[0]: x.split()[1] for x in FAMILY_ROMANISED.split(", ")}
_LATIN = list(FAMILY_OF)
_FAMILY_WORDS = frozenset({*_LATIN, *(s.upper() for s in _LATIN)})
_FAMILY = rf"(?:{'|'.join(FAMILY_TWO.split())}|[{FAMILY_ONE.replace(' ', '')}])"
_FAMILY_APART = rf"(?:{'|'.join(' '.join(f) for f in FAMILY_TWO.split())}|[{FAMILY_ONE.replace(' ', '')}])"
#: 김가나, 김 가나, 김 가 나 and the same with family names of two syllables.
_NAME = rf"(?:{_FAMILY} ?[가-힣]{{2}}|{_FAMILY_APART} [가-힣] [가-힣])"
#: One or three given syllables, which only a title, a label with a colon or a place in a list makes a name.
_RARE_NAME = rf"{_FAMILY}(?:[가-힣]|[가-힣]{{3}})"
_TITLE = "|".join(sorted(TITLES.split(), key=len, reverse=True))

_AT_SIGN = re.compile(r"[@＠]|골뱅이|[\[(（{]\s?(?:at|AT)\s?[\])）}]|\s(?:at|AT)\s(?=[A-Za-z0-9-]+(?:\s?[\[(]?(?:dot|DOT)|\.[A-Za-z]))")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"\s?[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:(?:\.|\s?[\[(](?:dot|DOT)[\])]\s?|\s(?:dot|DOT|점|닷)\s)[A-Za-z0-9-]+)*(?:\.|\s?[\[(](?:dot|DOT)[\])]\s?|\s(?:dot|DOT|점|닷)\s)[A-Za-z]{2,}(?![A-Za-z0-9_+]|-[A-Za-z0-9]| ?[@＠]| ?[\[(](?:at|AT)[\])]|\s골뱅이|\s(?:at|AT)\s[A-Za-z0-9-]+\s(?:dot|DOT)\s)")

_GAP = r"[-–—‐‑－.\s]?"
_DASH = r"[-–—‐‑－.]"
_PHONE = re.compile(
    rf"(?<![\d.,+＋])(?<!\d[-–—‐‑－])(?:[+＋]82{_GAP}(?:\(0\))?1[016789]{_GAP}\d{{3,4}}{_GAP}\d{{4}}|[+＋]82{_GAP}[2-6]\d?{_DASH}\d{{3,4}}{_DASH}\d{{4}}"
    rf"|01[016789]{_GAP}\d{{3,4}}{_GAP}\d{{4}}|0(?:2|[3-6][1-5]|70|50\d?)(?:\)\s?|{_DASH}|\s)\d{{3,4}}[-–—‐‑－.\s]\d{{4}}|[０][１][０１６-９]{_GAP}\d{{3,4}}{_GAP}\d{{4}})(?!\d|[-–—‐‑－.]\d)"
)
_ID = re.compile(
    r"(?<![\dA-Za-z.,])(?<!\d[-–—‐－])(?:(?P<birth>\d{6})\s?[-–—‐－]?\s?[1-8]\d{6}|\d{2}[-–—‐－]\d{2}[-–—‐－]\d{6}[-–—‐－]\d{2}|[MSRGDOPT](?:\d{8}|\d{3}[A-Z]\d{4}))(?![\dA-Za-z]|[-–—‐－]\d)"
)
#: Where such numbers can begin; the full patterns are tried only there.
_PHONE_START, _ID_START = re.compile(r"[+＋0０]"), re.compile(r"[0-9](?:\d{5}|\d[-–—‐－]\d{2}[-–—‐－])|[MSRGDOPT]\d{3}")
_LABELLED = re.compile(r"(?:(?P<ko>[가-힣 ]*?(?:번호|코드))|(?P<en>[Nn]umber|[Cc]ode|[Ff]ile|[Ii]tem))\s*[:：.]?\s*(?:은|는)?\s*\Z")
_OWN_NUMBER = re.compile(r"(?:주민|외국인|여권|면허|신분|생년|등록증|전화|연락|휴대|핸드폰|팩스|비상|identity|ID|passport|licen[cs]e|phone|mobile|contact)[가-힣 A-Za-z]*\Z", re.I)
_FIRM_NUMBER = re.compile(r"(?:사업자|법인|물품|문서|도면|관리|공고|계약|발급|접수|제품|품목|분류|계좌|송장|product|item|file|tender|notice)[가-힣 A-Za-z]*\Z", re.I)

_STREET_NUMBER = re.compile(r"(?:로|길|동|리|읍|면)\s((?:산\s?)?\d{1,5}(?:-\d{1,4})?)(번지)?(?![\d%:/]|[,.-]\d|\s?k?m\b|(?:mm|년|월|일|시|분|원|명|건|개|회|점|톤|부|쪽|차|조|항|호선|공구)|\s\d+:)")
_STREET_BEFORE = re.compile(r"(?:(?<![가-힣])[가-힣]{1,6}(?:특별자치도|특별자치시|특별시|광역시|도)\s)?(?<![가-힣])(?:[가-힣]{1,6}(?:시|군|구)\s){1,2}(?:[가-힣]{1,6}(?:읍|면)\s)?[가-힣0-9]{1,10}(?:대로|로|길|동|리|읍|면)(?:\s\d+번길)?\Z")
_DETAIL = re.compile(r"(?:,?\s(?:지하\s?)?\d{1,4}(?:동|층|호)(?![가-힣0-9]*(?:호선|공구))){1,3}")
_ADDRESS = re.compile(
    r"(?<![\d.,-])(?:(?:Unit|Apt\.?|Room|Suite)\s\d+,\s)?\d{1,5}(?:-\d{1,4})?\s[A-Z][A-Za-z]*(?:-[a-z]+)?-(?:ro|gil|daero|dong)(?:\s\d+(?:beon)?-gil)?(?:,\s[A-Z][A-Za-z]*(?:-[a-z]+)?-(?:si|gun|gu|do|dong|eup|myeon))+(?:,\s(?:Unit|Apt\.?|Room|Suite|Floor)\s\d+)?"
)

_TITLED = re.compile(rf"(?P<name>(?<![가-힣]){_NAME})(?:\s(?:{_TITLE})|(?:님|씨))(?![가-힣]*(?:담당관|실무자))")
_TITLED_RARE = re.compile(rf"(?P<name>(?<![가-힣]){_RARE_NAME})(?:\s(?:{_TITLE})|(?:님|씨))(?![가-힣]*(?:담당관|실무자))")
_TITLE_NEAR = re.compile(rf"[가-힣](?:\s(?:{_TITLE})|(?:님|씨)(?=[은는이가을를께의,.\s]))")
_LABELED_NAME = re.compile(rf"(?:{'|'.join(LABELS.split())})(?:은|는|이|가)?\s?[:：]?\s(?:성명\s?[:：]?\s?)?(?P<name>{_NAME})(?=이고|이며|이다|입니다|님|씨|은|는|이|가|을|를|의|에게|께|\s?[/|,.)(;]|\s?$|\s)")
_PRESENT = re.compile(r"(?:참석자?|출석자?|위원|배석자?)\s?[:：]\s?")
_LABELED_RARE = re.compile(rf"(?:{'|'.join(LABELS.split())})\s?(?:성명\s?)?[:：]\s?(?P<name>{_RARE_NAME})(?=이고|이며|이다|입니다|에게|(?:님|씨|은|는|이|가|을|를|의|께)(?![가-힣])|\s?[/|,.)(;]|\s?$|\s)")
#: One entry of such a list: a name, perhaps with a title or a bracket behind it; anything else up to the next mark; what parts entries.
_LISTED = re.compile(rf"\s*(?P<name>{_NAME})(?=\s*(?:\Z|[,、·.<(（]|{_TITLE}))")
_LISTED_RARE = re.compile(rf"\s*(?P<name>{_RARE_NAME})(?=\s*(?:\Z|[,、·.<(（])|\s(?:{_TITLE}))")
_ENTRY_REST = re.compile(r"[^,、·.<(（]*(?:[(（][^()（）]*[)）]\s*)*")
_PARTED = re.compile(r"[,、·.]")
#: Three syllables of any family, which only their neighbours can make a name, and what may stand behind them.
_ANY_NAME = r"(?P<name>(?<![가-힣])(?:[가-힣] ?[가-힣]{2}|[가-힣] [가-힣] [가-힣]))"
_ANY_TITLED = re.compile(rf"{_ANY_NAME}(?:\s(?:{_TITLE})|(?:님|씨))(?![가-힣]*(?:담당관|실무자))")
_ANY_LABELLED = re.compile(rf"(?:{'|'.join(LABELS.split())})(?:(?:은|는|이|가)?\s(?:성명\s?)?|\s?(?:성명\s?)?[:：]\s?){_ANY_NAME}(?=이고|이며|이다|입니다|에게|(?:님|씨|은|는|이|가|을|를|의|께)(?![가-힣])|\s?[/|,.)(;]|\s?$|\s(?:{_TITLE}))")
_ANY_LISTED = re.compile(rf"\s*(?P<name>[가-힣] ?[가-힣]{{2}}|[가-힣] [가-힣] [가-힣])(?=\s*(?:\Z|[,、·.<(（])|\s(?:{_TITLE}))")
#: Two capitalised words, and what speaks for a person before and behind them.
_JOINED = re.compile(r"[A-Za-z@._+-]")
_TWO_WORDS = re.compile(r"(?P<a>[A-Z][a-z]+(?:-[a-z]+)?|[A-Z]{2,}),? (?P<b>[A-Z][a-z]+(?:-[a-z]+)?)(?![A-Za-z@_+-])(?!\.[A-Za-z])")
_PERSON_BEFORE = re.compile(r"(?:\b(?:[Mm]anager|[Oo]fficer|[Ii]nspector|[Ee]ngineer|[Cc]ontact|[Aa]pplicant|[Cc]lerk|[Dd]irector|[Ss]upervisor|[Ss]ecretary|[Ww]itness)(?:\s(?:is|was))?:?\s|\b(?:Mr|Ms|Mrs|Dr)\.?\s|\b(?:Dear|Attn:?|Regards,|Sincerely,)\s|\b(?:taken|signed|signed for|written|prepared|approved|checked|received|inspected|reported|issued)\sby\s|\b(?:[Qq]uestions|[Ii]nquiries|[Rr]eplies|[Mm]ail)\s(?:go|to go|are|should go)\sto\s)\Z")
_PERSON_BEHIND = re.compile(r"\s?\((?:mobile|phone|tel)|,\sID\s|;\scopied\sto|\sor\sby\sphone|\s(?:of|from)\s[A-Z][A-Za-z]+(?:\s[A-Z][A-Za-z]+)*\s(?:asked|said|wrote|replied|reported|confirmed|called|signed)\b|\s(?:asked|said|wrote|replied|called)\b|\sat\s\S+\s?(?:@|\(at\)|\[at\])|\s<[^<>@\s]+@")
_ONE_NAME = re.compile(rf"{_NAME}\Z")
_CAPITAL = re.compile(r"(?<![A-Za-z@._+-])[A-Z][A-Za-z]+(?![A-Za-z@_+])")
_GIVEN_AFTER = re.compile(r"(?P<gap>,? )(?P<given>[A-Z][a-z]+(?:-[a-z]+)?)(?![A-Za-z@_+-])(?!\.[A-Za-z])")
_GIVEN_BEFORE = re.compile(r"(?<![A-Za-z@._+-])(?P<given>[A-Z][a-z]+(?:-[a-z]+)?) \Z")
_DEPARTMENT = re.compile(r"[과팀실국청]\Z")
_STOP, _FIRM, _TOP = frozenset(NOT_NAMES.split()), frozenset(FIRMS.split()), frozenset(TOP_LEVELS.split())
_GIVEN = frozenset(GIVEN.split())
_ORDINARY, _TITLES = frozenset(ORDINARY.split()), frozenset(TITLES.split())
_DIGITS = re.compile(r"\d")


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str


def _birthday(digits: str) -> bool:
    return 1 <= int(digits[2:4]) <= 12 and 1 <= int(digits[4:6]) <= 31


def _of_a_thing(text: str, start: int) -> bool:
    """Whether a label in front says that the number is of a firm, product, file or notice."""
    before = text[max(0, start - 24) : start]
    label = _LABELLED.search(before)
    if not label:
        return False
    head = before[: label.end()].rstrip(" :：.은는")
    stem = re.sub(r"(?:번호|코드|[Nn]umber|[Cc]ode)\Z", "", head).rstrip()
    if _OWN_NUMBER.search(stem):
        return False
    return bool(_FIRM_NUMBER.search(stem) or label.group("ko") or label.group("en"))


def _mails(text: str) -> Iterator[Span]:
    for at in _AT_SIGN.finditer(text):
        gap = at.start() > 0 and text[at.start() - 1].isspace()
        start = end = at.start() - gap
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        while start < end and not text[start].isalnum():
            start += 1
        domain = _DOMAIN.match(text, at.end())
        if start == end or not domain:
            continue
        spoken = at.group().strip().lower() == "at"
        if spoken and (re.search(r"[A-Za-z]+\Z", domain.group()).group().lower() not in _TOP or not (re.search(r"\s(?:dot|DOT)\s|[\[(](?:dot|DOT)", domain.group()) or re.search(r"[._+\d]", text[start:end]))):
            continue
        if gap and at.group()[0].isspace():
            continue
        yield Span(start, domain.end(), "email")


def _tried(start: re.Pattern[str], full: re.Pattern[str], text: str) -> Iterator[re.Match[str]]:
    """The matches of ``full`` that begin where ``start`` does, none within another."""
    last = 0
    for x in start.finditer(text):
        if x.start() >= last and (m := full.match(text, x.start())):
            last = m.end()
            yield m


def _phones(text: str) -> Iterator[Span]:
    for m in _tried(_PHONE_START, _PHONE, text):
        if not _of_a_thing(text, m.start()):
            yield Span(m.start(), m.end(), "phone")


def _ids(text: str) -> Iterator[Span]:
    for m in _tried(_ID_START, _ID, text):
        if m.group("birth") and not _birthday(m.group("birth")):
            continue
        if not _of_a_thing(text, m.start()):
            yield Span(m.start(), m.end(), "id_number")


def _addresses(text: str) -> Iterator[Span]:
    for m in _STREET_NUMBER.finditer(text):
        head = _STREET_BEFORE.search(text, max(0, m.start() - 90), m.start(1) - 1)  # longer than any match
        if head:
            end = m.end()
            more = _DETAIL.match(text, end)
            yield Span(head.start(), more.end() if more else end, "address")
    if "-ro" in text or "-gil" in text or "-daero" in text or "-dong" in text:
        for m in _ADDRESS.finditer(text):
            yield Span(m.start(), m.end(), "address")


def _rare(name: str) -> bool:
    """Whether a spelling of one or three given syllables may be a name: neither a title or a department, nor made of ordinary words."""
    parts = {name, name[:2], name[2:]} if len(name) == 4 else {name}
    return not (parts & (_ORDINARY | _TITLES) or _DEPARTMENT.search(name))


def _ordinary(name: str) -> bool:
    """Whether a spelling of a listed family is an ordinary word with something behind it rather than a name."""
    name = name.replace(" ", "")
    return name[:2] in _ORDINARY and not all(c in _GIVEN for c in name[1:])


def _likely(name: str) -> bool:
    """Whether three syllables of an unlisted family may be a name: both given syllables are ones that names are made of, and
    no part is an ordinary word, a title or a department."""
    name = name.replace(" ", "")
    return name[1] in _GIVEN and name[2] in _GIVEN and not ({name, name[:2], name[1:]} & (_ORDINARY | _TITLES) or _DEPARTMENT.search(name))


def _unlisted_names(text: str, known: set[int]) -> Iterator[Span]:
    """Names of families outside the lists, by what stands around them: a title, a label, or for Latin ones words that only go
    with a person. ``known`` are the places of names found by the lists."""
    for near in _TITLE_NEAR.finditer(text):
        end = near.start() + 1
        for back in (5, 4, 3):  # three syllables, the longest spelling first
            m = _ANY_TITLED.match(text, end - back) if end >= back else None
            if m and m.end("name") == end and m.start("name") not in known and _likely(m.group("name")):
                yield Span(m.start("name"), end, "name")
                break
    for m in _ANY_LABELLED.finditer(text):
        if m.start("name") not in known and _likely(m.group("name")):
            yield Span(m.start("name"), m.end("name"), "name")
    at = 0
    while m := _TWO_WORDS.search(text, at):
        a, b = m.group("a"), m.group("b")
        at = m.end("a")  # the second word may be the first of a name
        if m.start() and _JOINED.match(text[m.start() - 1]):
            continue
        if m.start() in known or a in _STOP or a in _FIRM or b in _STOP or b in _FIRM:
            continue
        firm = re.match(r" ([A-Z][A-Za-z]+)", text[m.end() : m.end() + 40])
        if firm and firm.group(1) in _FIRM:
            continue
        if _PERSON_BEFORE.search(text, max(0, m.start() - 40), m.start()) or _PERSON_BEHIND.match(text, m.end()):
            at = m.end()
            yield Span(m.start(), m.end(), "name")


def _names(text: str) -> Iterator[Span]:
    for near in _TITLE_NEAR.finditer(text):
        for back in (8, 7, 6, 5, 4, 3):  # the longest spelling that ends at the title
            start = near.start() + 1 - back
            if start < 0:
                continue
            m = _TITLED.match(text, start)
            if m and m.end("name") == near.start() + 1:
                if not (_DEPARTMENT.search(m.group("name")) or _ordinary(m.group("name"))):
                    yield Span(start, m.end("name"), "name")
                break
        else:
            for back in (5, 4, 2):
                start = near.start() + 1 - back
                m = _TITLED_RARE.match(text, start) if start >= 0 else None
                if m and m.end("name") == near.start() + 1 and _rare(m.group("name")):
                    yield Span(start, m.end("name"), "name")
                    break
    labelled = set()
    for m in _LABELED_NAME.finditer(text):
        if _ordinary(m.group("name")):
            continue
        labelled.add(m.start("name"))
        yield Span(m.start("name"), m.end("name"), "name")
    for m in _LABELED_RARE.finditer(text):
        if m.start("name") not in labelled and _rare(m.group("name")):
            yield Span(m.start("name"), m.end("name"), "name")
    yield from _listed_names(text)
    yield from _latin_names(text)


def _all_names(text: str) -> Iterator[Span]:
    found = list(_names(text))
    yield from found
    yield from _unlisted_names(text, {s.start for s in found})


def _listed_names(text: str) -> Iterator[Span]:
    """Names of those present, entry by entry to the end of the line; text behind a bracket or a full stop that isn't a
    further entry ends the list."""
    heads = list(_PRESENT.finditer(text))
    for k, head in enumerate(heads):
        line = text.find("\n", head.end())
        end = min(len(text) if line < 0 else line, heads[k + 1].start() if k + 1 < len(heads) else len(text))
        at, stopped = head.end(), False
        while at < end:
            m = _LISTED.match(text, at, end)
            if not m and not stopped:
                m = _LISTED_RARE.match(text, at, end)
                m = m if m and _rare(m.group("name")) else None
                if not m and (m := _ANY_LISTED.match(text, at, end)) and not _likely(m.group("name")):
                    m = None
            if m:
                yield Span(m.start("name"), m.end("name"), "name")
            elif stopped:
                break
            at = _ENTRY_REST.match(text, m.end() if m else at, end).end()
            parted = _PARTED.match(text, at, end)
            if not parted:
                break
            at, stopped = parted.end(), parted.group() == "."


def _latin_names(text: str) -> Iterator[Span]:
    """KIM Saebom; Kim, Saebom; Saebom Kim; Kim Saebom. A word in front or behind that makes it a firm or a sentence does not count."""
    at = 0
    for m in _CAPITAL.finditer(text):
        if m.group() not in _FAMILY_WORDS or m.start() < at:
            continue
        after = _GIVEN_AFTER.match(text, m.end())
        if after and (after.group("given") in _FIRM or after.group("given") in _STOP):
            after = None
        before = None if m.group().isupper() else _GIVEN_BEFORE.search(text, max(at, m.start() - 60), m.start())
        if before and (before.group("given") in _STOP or before.group("given") in _FIRM):
            before = None
        if after and (m.group().isupper() or after.group("gap") == ", "):
            span = Span(m.start(), after.end(), "name")
        elif before:
            span = Span(before.start("given"), m.end(), "name")
        elif after:
            span = Span(m.start(), after.end(), "name")
        else:
            continue
        firm = re.match(r" ([A-Z][A-Za-z]+)", text[span.end : span.end + 24])
        if firm and firm.group(1) in _FIRM:
            continue
        at = span.end
        yield span


_RANK = {"email": 0, "id_number": 1, "address": 2, "phone": 3, "name": 4}


def find_pii(text: str) -> list[Span]:
    """All spans in order, without overlaps; the kind that is more certain wins, then the longer span."""
    spans = [*_mails(text), *_all_names(text)]
    if _DIGITS.search(text):
        spans += [*_phones(text), *_ids(text), *_addresses(text)]
    taken: list[Span] = []
    for s in sorted(spans, key=lambda s: (_RANK[s.kind], s.start - s.end, s.start)):
        if all(s.end <= t.start or s.start >= t.end for t in taken):
            taken.append(s)
    return sorted(taken, key=lambda s: s.start)
