from __future__ import annotations

from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jangbu.llm.surrogates import FEMALE, GIVEN, MALE, canonical, collisions, entities, mentions, permute, pii_found, protect, protected, redacted, roman, spelt, surrogate
from tests.conftest import rows

KEY = b"0123456789abcdef"


@pytest.mark.parametrize("radices", [[10], [10, 10], [3, 7], [2, 3, 5], [6, 20, 10], [1, 5]])
def test_permutations_reach_everything_once(radices):
    every = [tuple(p) for p in product(*map(range, radices))]
    assert sorted(tuple(permute(p, radices, KEY, "t")) for p in every) == sorted(every)
    good = [p for p in every if sum(p) % 2 == 0]
    assert sorted(tuple(permute(p, radices, KEY, "t", lambda v: sum(v) % 2 == 0)) for p in good) == sorted(good)


def test_format_and_coreference():
    a, b, c = (surrogate("phone", t, KEY) for t in ("010-1234-5678", "+82 10 1234 5678", "０１０－１２３４－５６７８"))
    assert a[:4] == "010-" and b.startswith("+82 10 ") and c.startswith("０１０－")
    assert canonical("phone", a) == canonical("phone", b) == canonical("phone", c) != "01012345678"
    x, y = surrogate("name", "김 새 봄", KEY), surrogate("name", "김새봄", KEY)
    assert x.replace(" ", "") == y and len(x) == 5 and y != "김새봄"
    u, v, w = (surrogate("name", t, KEY) for t in ("KIM Saebom", "Kim, Saebom", "Saebom Kim"))
    assert canonical("name", u) == canonical("name", v) == canonical("name", w) and ", " in v and u.split()[0].isupper()
    assert surrogate("name", "KIM Saebom", b"another key 1234") != u


def test_identity_numbers_stay_plausible_but_invalid():
    for n in ("900101-1234567", "851231-2345678", "M072B4495", "26-18-919378-46"):
        s = surrogate("id_number", n, KEY)
        assert len(s) == len(n) and [c for c in s if not c.isalnum()] == [c for c in n if not c.isalnum()]
        if n[6] == "-":
            d = [int(c) for c in s if c.isdigit()]
            assert 1 <= int(s[2:4]) <= 12 and 1 <= int(s[4:6]) <= 31 and s[7] == n[7]
            assert (11 - sum(a * b for a, b in zip(d, (2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5), strict=False)) % 11) % 10 != d[12]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.from_regex(r"[a-z]{2,6}[._]?[a-z0-9]{1,4}", fullmatch=True), min_size=2, max_size=20, unique=True))
def test_mails_stay_distinct(locals_):
    mails = [f"{x}@mail.example" for x in locals_]
    new = [surrogate("email", m, KEY) for m in mails]
    assert len(set(new)) == len(mails) and all(n.endswith("@mail.example") and len(n) == len(m) for n, m in zip(new, mails, strict=True))


def test_places_keep_their_kind():
    s = surrogate("address", "마루도 하결구 은하수길 156-27, 110동 413호", KEY)
    assert s.split()[0].endswith("도") and s.split()[1].endswith("구") and s.split()[2].endswith("길") and "동" in s and s.endswith("호")
    assert surrogate("address", "71 Galaxy-gil, Daram-si, Unit 2352", KEY).count("-") == 2


def test_replacing():
    t = "담당자 김새봄 / a@b.example / 010-1234-5678. 김새봄 팀장은 010.1234.5678로. 이누리 과장"
    p = protect(t, KEY)
    marked, stood = p.placeholders, p.surrogates
    assert marked == "담당자 [NAME_1] / [EMAIL_1] / [PHONE_1]. [NAME_1] 팀장은 [PHONE_1]로. [NAME_2] 과장"
    assert "김새봄" not in stood and "1234" not in stood and stood.startswith("담당자 ") and stood.endswith(" 과장")


def test_every_mention_is_replaced():
    t = "연락처는 김새봄 과장(010-1234-5678)입니다. 김새봄에게 보내십시오. Questions go to Kim Saebom at a@b.example; 허준 과장. 허준은 왔다. 허준호텔"
    p = protect(t, KEY)
    assert p.left == 0 and p.places == 7 and "김새봄" not in p.surrogates and "Saebom" not in p.surrogates and p.surrogates.endswith("호텔") and p.placeholders.endswith("허준호텔")
    assert p.placeholders.count("[NAME_1]") == 3 and p.placeholders.count("[NAME_2]") == 2
    stand = {v: x for _, v, x in p.values}
    assert canonical("name", stand["김새봄"]) == canonical("name", stand["Kim Saebom"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("김이박 가나준영Kim.@-0123456789과장", max_size=14), max_size=8))
def test_no_value_stays(parts):
    p = protect("담당자 김새봄 / " + " 담당자: ".join(parts) + " 과장", KEY)
    assert p.left == 0


def test_people_keep_sex_and_script():
    names = ["".join(x) for x in product(GIVEN.split()[::7], GIVEN.split()[::3])]
    new = [surrogate("name", "김" + n, KEY)[1:] for n in names]
    assert len(set(new)) == len(names)
    for a, b in zip(names, new, strict=True):
        assert (a[-1] in FEMALE.split(), a[-1] in MALE.split()) == (b[-1] in FEMALE.split(), b[-1] in MALE.split())
    both = [n for n in names if spelt("".join(map(roman, n))) == n]
    assert both and all(canonical("name", surrogate("name", "Kim " + "".join(map(roman, n)).capitalize(), KEY)) == surrogate("name", "김" + n, KEY) for n in both)


@pytest.mark.parametrize("name", ["Maria Gonzalez", "Cher", "뇌영수", "김뷁뷁", "허준", "독고영", "KIM X"])
def test_odd_names_get_one_too(name):
    assert surrogate("name", name, KEY) != name and mentions("", []) == []


def test_operators(spark):
    data = [(1, "담당자 김새봄 / a@b.example / 010-1234-5678"), (2, None), (3, ""), (4, "그대로"), (5, "작성자: 김 새 봄 | 연락처: +82-10-1234-5678")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    out = {r.doc_id: r for r in redacted(df, KEY).collect()}
    assert out[1].replacements == 3 and out[2].placeholder_text is None and out[3].surrogate_text == "" and out[4].surrogate_text == "그대로"
    assert all(r.left == 0 for r in protected(df, KEY).collect()) and pii_found(df, KEY).count() == 5
    checked = rows(collisions(entities(df, KEY)))
    assert checked == [("email", 1, 0, 0), ("name", 1, 0, 0), ("phone", 1, 0, 0)]
