"""Replacements for personal information: typed placeholders, and keyed surrogates that look like the originals.

A surrogate is a keyed permutation of the original within its own type, script and format (a Feistel network over mixed
radices, walked until the result is valid). Being a permutation it can't give two values one surrogate, so distinctness
holds over the whole corpus without any exchange between tasks, and one value gets one surrogate everywhere, however it
is spelt. ``collisions`` checks both on the corpus itself.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jangbu.llm.pii import FAMILY_OF, FAMILY_ONE, FAMILY_TWO, GIVEN, LATIN_OF, Span, find_pii

# Vowels and consonants.
VOWELS, CONSONANTS = "aeiouy", "bcdfghjklmnpqrstvwxz"
#: Last given syllables by the sex they usually show; a name with another one shows none. Letters of a syllable's initial, vowel
#: and final as they are romanised. Syllables that place names are made of.
FEMALE, MALE = "미 희 숙 순 자 아 란 화 혜 나 린 라 은", "호 철 식 훈 석 준 태 구 용 환 규 범 근 건 길 덕 동 남"
INITIALS = "g kk n d tt r m b pp s ss - j jj ch k t p h"
MEDIALS = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i"
FINALS = "- k k k n n n t l k m l l l p l m p p t t ng t t k t p t"
PLACE_SYLLABLES = "가 강 거 검 경 계 고 곡 곤 공 관 광 구 군 궁 금 기 길 김 나 남 내 노 논 다 단 달 담 당 대 덕 도 동 두 둔 등 라 락 람 랑 량 령 로 룡 류 림 마 만 매 면 명 모 목 무 문 미 박 반 발 방 배 백 벌 범 별 병 보 복 봉 부 북 비 사 산 삼 상 새 서 석 선 성 세 소 속 솔 송 수 순 숭 시 신 심 안 암 압 양 여 연 영 예 오 옥 온 완 왕 용 우 운 울 원 월 위 유 윤 율 은 을 음 의 이 익 인 일 임 자 장 재 전 정 제 조 종 주 죽 중 증 지 진 창 천 철 청 초 촌 춘 충 칠 탄 태 택 토 통 파 판 평 포 풍 하 학 한 함 합 해 향 현 형 호 홍 화 황 회 횡 효 후 흥 희 햇 빛 꽃 달 샘 봄 들 뫼 누 리 루 랑 담 비 슬 늘 름 터 골 여울 벼 람".replace("여울 ", "여 울 ")
_SYLLABLES = {c: i for i, c in enumerate(GIVEN.split())}
_SEX = [[c for c in GIVEN.split() if (c in FEMALE.split(), c in MALE.split()) == sex] for sex in ((True, False), (False, True), (False, False))]
_PLACE_WORDS = {c: i for i, c in enumerate(dict.fromkeys(PLACE_SYLLABLES.split()))}
#: Syllables of place names, by rule: every initial and simple vowel with the finals that such names have.
_RARER = [chr(0xAC00 + (i * 21 + v) * 28 + f) for i, v, f in ((i, v, f) for i in range(19) for v in (0, 1, 4, 6, 8, 13, 18, 20) for f in (0, 1, 4, 7, 8, 16, 17, 19, 21, 23, 25, 26))]
_PLACES = {c: k for k, c in enumerate(dict.fromkeys([*_PLACE_WORDS, *_RARER]))}
_ROUNDS = 6


def permute(value: Sequence[int], radices: Sequence[int], key: bytes, tweak: str, valid: Callable[[Sequence[int]], bool] | None = None) -> list[int]:
    """A keyed permutation of mixed-radix digits; with ``valid`` also a permutation of the valid ones among them.

    ``value`` itself must be valid. Two unequal halves of the whole number take turns to be shifted by a hash of the
    other, modulo their own size, which can be undone, so no two values meet.
    """
    size = 1
    for r in radices:
        size *= r
    if size < 2:
        return list(value)
    cutoff = 1
    for r in radices[: max(1, len(radices) // 2)]:
        cutoff *= r
    if cutoff in (1, size):  # one place alone: rotate by a keyed amount
        shift = int.from_bytes(blake2b(tweak.encode(), key=key, digest_size=8).digest(), "big")
        out = list(value)
        while True:
            for k, r in enumerate(radices):
                out[k] = (out[k] + shift % r) % r
            if valid is None or valid(out):
                return out
    rest = size // cutoff
    whole = 0
    for d, r in zip(value, radices, strict=True):
        whole = whole * r + d
    while True:
        a, b = divmod(whole, rest)
        for k in range(_ROUNDS):
            of, size_k = (b, cutoff) if k % 2 == 0 else (a, rest)
            h = int.from_bytes(blake2b(f"{tweak}|{k}|{of}".encode(), key=key, digest_size=16).digest(), "big") % size_k
            if k % 2 == 0:
                a = (a + h) % cutoff
            else:
                b = (b + h) % rest
        whole = a * rest + b
        out, left = [], whole
        for r in reversed(radices):
            left, d = divmod(left, r)
            out.append(d)
        out.reverse()
        if valid is None or valid(out):
            return out


def _digits(text: str) -> str:
    return "".join(str(int(c)) for c in text if c.isdigit())


def _fill(text: str, digits: str) -> str:
    """``text`` with its digits replaced one by one, wide ones by wide ones."""
    it = iter(digits)
    return "".join((chr(0xFF10 + int(next(it))) if "０" <= c <= "９" else next(it)) if c.isdigit() else c for c in text)


def canonical(kind: str, text: str) -> str:
    """What a value means, whatever its spelling: two spellings of one number, address or person agree."""
    flat = unicodedata.normalize("NFKC", text)
    if kind == "phone":
        d = _digits(flat)
        return "0" + d[2:].removeprefix("0") if flat.lstrip().startswith("+82") or d.startswith("8210") else d
    if kind == "id_number":
        return re.sub(r"[^0-9A-Z]", "", flat.upper())
    if kind == "email":
        flat = re.sub(r"\s*[\[({]?\s*(?:골뱅이|@|(?<![a-z0-9])at(?![a-z0-9]))\s*[\])}]?\s*", "@", flat.lower(), count=1)
        return re.sub(r"\s*[\[({]?\s*(?<![a-z0-9])(?:dot|점|닷)(?![a-z0-9])\s*[\])}]?\s*", ".", flat)
    if kind == "name" and re.search(r"[A-Za-z]", flat):
        family, given, _ = _latin_parts(flat)
        of, syllables = FAMILY_OF.get(family.capitalize()), spelt(given)
        return of + syllables if of and syllables else f"{family} {given}"
    return re.sub(r"\s+", " " if kind == "address" else "", flat).replace(" ,", ",")


_DAYS = [f"{m:02}{d:02}" for m, last in enumerate((31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31), 1) for d in range(1, last + 1)]
_DAY_NO = {d: k for k, d in enumerate(_DAYS)}


def _usual(number: str) -> bool:
    """Whether thirteen digits begin with a day and have no valid check digit, so that nobody can have them."""
    check = (11 - sum(int(a) * b for a, b in zip(number, (2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5), strict=False)) % 11) % 10
    return number[2:6] in _DAY_NO and check != int(number[12])


def _identity(canon: str, key: bytes) -> str:
    """Letters stay letters, digits digits. Of thirteen digits the seventh (century, nationality, sex) stays, and numbers of
    the usual form stay among themselves, as do the others, so neither meets the other."""
    if len(canon) != 13 or not canon.isdigit():
        radices = [10 if c.isdigit() else 26 for c in canon]
        new = permute([int(c) if c.isdigit() else ord(c) - 65 for c in canon], radices, key, f"id {radices}")
        return "".join(str(d) if r == 10 else chr(65 + d) for d, r in zip(new, radices, strict=True))
    sex = canon[6]
    if _usual(canon):
        shown = lambda v: f"{v[0]:02}{_DAYS[v[1]]}{sex}{v[2]:06}"
        return shown(permute([int(canon[:2]), _DAY_NO[canon[2:6]], int(canon[7:])], [100, len(_DAYS), 1_000_000], key, f"id {sex}", lambda v: _usual(shown(v))))
    shown = lambda v: f"{v[0]:06}{sex}{v[1]:06}"
    return shown(permute([int(canon[:6]), int(canon[7:])], [1_000_000, 1_000_000], key, f"odd id {sex}", lambda v: not _usual(shown(v))))


def _cased(like: str, letters: str) -> str:
    it = iter(letters)
    return "".join((c2.upper() if c.isupper() else c2) if c.isascii() and c.isalpha() and (c2 := next(it)) else c for c in like)


def roman(syllable: str) -> str:
    """A syllable in Latin letters."""
    code = ord(syllable) - 0xAC00
    parts = INITIALS.split()[code // 588], MEDIALS.split()[code % 588 // 28], FINALS.split()[code % 28]
    return "".join(p for p in parts if p != "-")


_ROMAN = {roman(c): c for c in reversed(GIVEN.split())}


@lru_cache(maxsize=1 << 16)
def spelt(given: str) -> str:
    """The two syllables that a romanised given name stands for; nothing if there are none. Of several readings the one with
    the longest first syllable counts."""
    for k in range(len(given) - 1, 0, -1):
        if given[:k] in _ROMAN and given[k:] in _ROMAN:
            return _ROMAN[given[:k]] + _ROMAN[given[k:]]
    return ""


def _latin_parts(text: str) -> tuple[str, str, bool]:
    """Family, given name (both in small letters, without hyphens) and whether the family stands first."""
    words = re.findall(r"[A-Za-z-]+", text)
    if len(words) == 1:
        return "", words[0].lower().replace("-", ""), False
    first = words[0].isupper() or "," in text or words[-1].capitalize() not in FAMILY_OF
    family, given = (words[0], words[-1]) if first else (words[-1], words[0])
    return family.lower(), given.lower().replace("-", ""), first


def _letters(text: str, key: bytes, tweak: str, valid: Callable[[str], bool] | None = None) -> str:
    """Latin letters and digits permuted in place: vowels stay vowels, consonants consonants, digits digits."""
    flat = text.lower()
    value, radices = [], []
    for c in flat:
        pool = VOWELS if c in VOWELS else CONSONANTS if c in CONSONANTS else "0123456789"
        value.append(pool.index(c))
        radices.append(len(pool))
    pools = {6: VOWELS, 20: CONSONANTS, 10: "0123456789"}
    shown = lambda v: "".join(pools[r][d] for d, r in zip(v, radices, strict=True))
    return shown(permute(value, radices, key, f"{tweak}|{radices}", valid and (lambda v: valid(shown(v))))) if value else ""


def _hangul(syllables: str, key: bytes, tweak: str, *pools: dict[str, int]) -> str:
    """Syllables permuted within the first of ``pools`` that has them all, but for those that an earlier pool has; without
    such a pool among all other texts."""
    if not all("가" <= c <= "힣" for c in syllables):
        return syllables
    everything = {chr(0xAC00 + k): k for k in range(11172)} if not any(all(c in p for c in syllables) for p in pools) else {}
    earlier: list[dict[str, int]] = []
    for pool in [*pools, everything]:
        if pool and all(c in pool for c in syllables):
            names = list(pool)
            outside = lambda v: not any(all(names[d] in e for d in v) for e in earlier)  # noqa: E731, B023
            new = permute([pool[c] for c in syllables], [len(names)] * len(syllables), key, f"{tweak}|{len(earlier)}", outside)
            return "".join(names[d] for d in new)
        earlier.append(pool)
    return syllables


def _family(family: str, key: bytes) -> str:
    """Families stay among those of as many syllables that are, or aren't, usually romanised; unlisted ones among themselves."""
    twos, ones = FAMILY_TWO.split(), FAMILY_ONE.split()
    for length, pool in ((1, ones), (2, twos)):
        for romanised in (True, False):
            among = [f for f in pool if (f in LATIN_OF) == romanised]
            if family in among:
                return among[permute([among.index(family)], [len(among)], key, f"family {length} {romanised}")[0]]
    unlisted = {c: k for k, c in enumerate(c for c in GIVEN.split() if c not in ones)}
    return _hangul(family, key, "family", unlisted)


def _given(given: str, key: bytes, family: str) -> str:
    """Given syllables permuted; the last stays among those that show the same sex, and a name that can be read back from
    Latin letters stays one, so that both spellings of a person get one stand-in."""
    if not all(c in _SYLLABLES for c in given):
        return _hangul(given, key, f"given {family}", _SYLLABLES)
    stable = lambda text: spelt("".join(map(roman, text))) == text
    sex = next(k for k, pool in enumerate(_SEX) if given[-1] in pool)
    names, last, same = GIVEN.split(), _SEX[sex], stable(given)
    shown = lambda v: "".join(names[d] for d in v[:-1]) + last[v[-1]]
    value, radices = [*[_SYLLABLES[c] for c in given[:-1]], last.index(given[-1])], [*[len(names)] * (len(given) - 1), len(last)]
    return shown(permute(value, radices, key, f"given {family} {sex} {same} {len(given)}", lambda v: stable(shown(v)) == same))


def _name(text: str, key: bytes) -> str:
    if not re.search(r"[A-Za-z]", text):
        flat = re.sub(r"\s", "", text)
        long = flat[:2] in FAMILY_TWO.split() and len(flat) > 2
        family, given = (flat[:2], flat[2:]) if long else (flat[:1], flat[1:])
        letters = iter(_family(family, key) + (_given(given, key, family) if given else ""))
        return "".join(c if c.isspace() else next(letters) for c in text)
    family, given, first = _latin_parts(text)
    known = FAMILY_OF.get(family.capitalize())
    if known and (syllables := spelt(given)):
        of, stand = _family(known, key), _given(syllables, key, known)
        new_family, new_given = [LATIN_OF[of].lower()], list(map(roman, stand))
    else:
        of = LATIN_OF[_family(known, key)].lower() if known else _letters(family, key, "family", lambda x: x.capitalize() not in FAMILY_OF)
        unread = _letters(given, key, f"given {known or family}", (lambda x: not spelt(x)) if known else None)
        new_family, new_given = [of], [unread]
    words = re.findall(r"[A-Za-z-]+", text)
    shaped = []
    for k, w in enumerate(words[:1] if len(words) == 1 else (words[0], words[-1])):
        parts = new_family if family and (k == 0) == first else new_given
        whole = ("-" if "-" in w and len(parts) > 1 else "").join(parts)
        if "-" in w and len(parts) == 1:
            whole = f"{whole[: w.index('-')]}-{whole[w.index('-') :]}"
        shaped.append(whole.upper() if w.isupper() else whole[:1].upper() + whole[1:])
    if len(words) == 1:
        return text.replace(words[0], shaped[0])
    between = text[text.index(words[0]) + len(words[0]) : text.rindex(words[-1])]
    return shaped[0] + between + shaped[1]


def _address(text: str, key: bytes) -> str:
    """Place names and numbers permuted; the words for what they are (city, road, floor and the like) stay."""

    def place(m: re.Match[str]) -> str:
        return _hangul(m.group(1), key, f"place {m.group(2)}", _PLACE_WORDS, _PLACES) + m.group(2) if re.search(r"[가-힣]", m.group(1)) else _cased(m.group(1), _letters(m.group(1), key, f"place {m.group(2)}")) + m.group(2)

    def number(m: re.Match[str]) -> str:
        n = m.group()
        return n[0] + _fill(n[1:], "".join(map(str, permute([int(c) for c in _digits(n[1:])], [10] * (len(n) - 1), key, f"number {len(n)}")))) if len(n) > 1 else str(int(permute([int(n) % 9], [9], key, "number")[0]) + (0 if int(n) == 0 else 1)) if n != "0" else n

    text = re.sub(r"([가-힣]+?)((?:특별자치도|특별자치시|특별시|광역시|[도시군구로길동읍면리])(?=[\s,]|$))", place, text)
    text = re.sub(r"([A-Z][A-Za-z]*?)((?:-[a-z]+)+)", place, text)
    return re.sub(r"\d+", number, text)


@lru_cache(maxsize=1 << 16)
def surrogate(kind: str, text: str, key: bytes) -> str:
    """The keyed stand-in of one value, in its own spelling. Mail domains, the area and mobile prefixes of numbers and the
    sex digit of identity numbers stay; identity numbers never get a valid check digit."""
    if kind == "phone":
        canon = canonical(kind, text)
        own = canon[-8:] if canon.startswith("01") else canon[-7:]
        new = "".join(map(str, permute([int(c) for c in own], [10] * len(own), key, f"phone {canon[: -len(own)]}")))
        digits = _digits(unicodedata.normalize("NFKC", text))
        return _fill(text, digits[: -len(own)] + new)
    if kind == "id_number":
        it = iter(_identity(canonical(kind, text), key))
        return "".join((_fill(c, d) if c.isdigit() else d) if unicodedata.normalize("NFKC", c).isalnum() and (d := next(it)) else c for c in text)
    if kind == "email":
        local = re.match(r"[A-Za-z0-9._%+-]+", text).group()
        flat = re.sub(r"[^A-Za-z0-9]", "", local)
        domain = canonical(kind, text).partition("@")[2]
        layout = re.sub(r"[A-Za-z]", "a", re.sub(r"[0-9]", "9", local))
        it = iter(_letters(flat, key, f"mail {domain} {layout}"))
        return "".join((x.upper() if c.isupper() else x) if c.isalnum() and (x := next(it)) else c for c in local) + text[len(local) :]
    return _name(text, key) if kind == "name" else _address(text, key)


PLACEHOLDER = {"name": "[NAME]", "email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]"}


#: What stands behind a name of two syllables where it isn't the beginning of a longer word.
_PARTICLE = r"(?![가-힣])|(?=(?:에게|에|은|는|이|가|을|를|의|께|과|와|도|님|씨|로|만|측|및|이며|이고|입니다|이다|한테|께서|라고|이라고)(?![가-힣]))"


def _again(kind: str, value: str) -> re.Pattern[str]:
    """Where a found value stands again, whatever is around it there."""
    bare = re.escape(value)
    if kind == "name" and "가" <= value[0] <= "힣":
        return re.compile(rf"(?<![가-힣]){bare}" + ("" if len(re.sub(r"\s", "", value)) > 2 else f"(?:{_PARTICLE})"))
    if kind == "name":
        return re.compile(rf"(?<![A-Za-z]){bare}(?![A-Za-z])")
    return re.compile(rf"(?<![0-9A-Za-z]){bare}(?![0-9A-Za-z])")


def mentions(text: str, spans: Sequence[Span]) -> list[Span]:
    """The spans and every further place where one of their values stands."""
    values: dict[tuple[str, str], int] = {}
    for s in spans:
        values[s.kind, text[s.start : s.end]] = values.get((s.kind, text[s.start : s.end]), 0) + 1
    more = []
    for (kind, value), n in sorted(values.items(), key=lambda x: -len(x[0][1])):
        if text.count(value) > n:
            for m in _again(kind, value).finditer(text):
                if all(m.end() <= s.start or m.start() >= s.end for s in (*spans, *more)):
                    more.append(Span(m.start(), m.end(), kind))
    return sorted([*spans, *more], key=lambda s: s.start)


@dataclass(frozen=True)
class Protected:
    """A text's values with their stand-ins, the text with placeholders and with stand-ins, the places replaced, and how many
    values still stand in either text or share a stand-in (none)."""

    values: list[tuple[str, str, str]]
    placeholders: str
    surrogates: str
    places: int
    left: int


def protect(text: str, key: bytes) -> Protected:
    """Finds the values, gives each its stand-in, replaces every mention and checks the outcome.

    Placeholders are numbered per text so that mentions of one value agree. A stand-in that happens to be another value of
    the text, or that of another meaning in it, is drawn again under a derived key.
    """
    spans = mentions(text, find_pii(text))
    if not spans:
        return Protected([], text, text, 0, 0)
    meaning = {(s.kind, v): canonical(s.kind, v) for s in spans for v in [text[s.start : s.end]]}
    own = {(k, m) for (k, _), m in meaning.items()}
    taken: dict[tuple[str, str], str] = {}
    stand: dict[tuple[str, str], str] = {}
    for (kind, value), m in meaning.items():
        for k in range(100):
            new = surrogate(kind, value, key if not k else blake2b(key + bytes([k]), digest_size=32).digest())
            c = canonical(kind, new)
            if (kind, c) not in own and taken.setdefault((kind, c), m) == m and new not in text:
                break
        stand[kind, value] = new
    numbers: dict[tuple[str, str], int] = {}
    count: dict[str, int] = {}
    marked, stood, at = [], [], 0
    for s in spans:
        known = (s.kind, text[s.start : s.end])
        of = (s.kind, meaning[known])
        if of not in numbers:
            numbers[of] = count[s.kind] = count.get(s.kind, 0) + 1
        marked += [text[at : s.start], f"{PLACEHOLDER[s.kind][:-1]}_{numbers[of]}]"]
        stood += [text[at : s.start], stand[known]]
        at = s.end
    a, b = "".join([*marked, text[at:]]), "".join([*stood, text[at:]])
    left = sum(bool(v in out and _again(k, v).search(out)) for k, v in meaning for out in (a, b))
    left += len({(k, meaning[k, v]) for k, v in stand}) - len({(k, canonical(k, x)) for (k, _), x in stand.items()})
    return Protected([(k, v, x) for (k, v), x in stand.items()], a, b, len(spans), left)


def protected(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text", texts: bool = True) -> DataFrame:
    """``doc_id, found, placeholder_text, surrogate_text, replacements, left`` for every row; ``found`` has each value once, with
    ``pii_type``, ``pii_text`` exactly as it stands and ``stand_in``.

    A null text stays null; a text without personal information stays as it is. Masked values, and numbers whose label names
    a firm, product, file or notice, are none. Without ``texts`` both are null. No shuffle; whole texts are scanned where
    they lie.
    """

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [protect(t, key) if isinstance(t, str) else None for t in pdf[text]]
            column = lambda f, done=done, pdf=pdf: pd.Series([None if p is None else f(p) for p in done], dtype=object, index=pdf.index)
            yield pd.DataFrame({
                "doc_id": pdf[doc_id],
                "found": column(lambda p: [{"pii_type": k, "pii_text": v, "stand_in": x} for k, v, x in p.values]),
                "placeholder_text": column(lambda p: p.placeholders if texts else None),
                "surrogate_text": column(lambda p: p.surrogates if texts else None),
                "replacements": pd.Series([p.places if p else 0 for p in done], dtype="int64", index=pdf.index),
                "left": pd.Series([p.left if p else 0 for p in done], dtype="int64", index=pdf.index),
            })

    kind = "doc_id long, found array<struct<pii_type string, pii_text string, stand_in string>>, placeholder_text string, surrogate_text string, replacements long, left long"
    return docs.select(doc_id, text).mapInPandas(rewrite, kind)


def pii_found(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, pii_type, pii_text``: each value that ``protected`` replaces, once per document row."""
    return protected(docs, key, doc_id, text, texts=False).select("doc_id", F.explode("found").alias("x")).select("doc_id", "x.pii_type", "x.pii_text")


def redacted(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, placeholder_text, surrogate_text, replacements`` of ``protected``."""
    return protected(docs, key, doc_id, text).select("doc_id", "placeholder_text", "surrogate_text", "replacements")


def entities(docs: DataFrame, key: bytes) -> DataFrame:
    """Distinct values of all texts with ``meaning``, their spelling-free form, and ``stand_in``, that of their surrogate."""

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({
                "pii_type": pdf.pii_type,
                "meaning": [canonical(k, t) for k, t in zip(pdf.pii_type, pdf.pii_text, strict=True)],
                "stand_in": [canonical(k, surrogate(k, t, key)) for k, t in zip(pdf.pii_type, pdf.pii_text, strict=True)],
            })

    return pii_found(docs, key).select("pii_type", "pii_text").distinct().mapInPandas(name, "pii_type string, meaning string, stand_in string").distinct()


def collisions(named: DataFrame) -> DataFrame:
    """Per type: values, surrogates that stand for several values, and values with several surrogates; both must be 0."""
    shared = named.groupBy("pii_type", "stand_in").agg(F.count_distinct("meaning").alias("n"))
    split = named.groupBy("pii_type", "meaning").agg(F.count_distinct("stand_in").alias("n"))
    a = shared.groupBy("pii_type").agg(F.count_if(F.col("n") > 1).alias("shared_surrogates"))
    b = split.groupBy("pii_type").agg(F.count(F.lit(1)).alias("persons_or_values"), F.count_if(F.col("n") > 1).alias("split_values"))
    return b.join(a, "pii_type")
