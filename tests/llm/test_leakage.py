from __future__ import annotations

import random

from jangbu.llm.leakage import _letter_places, fold, leaks, letters, prepare, scan, without_leaks
from tests.conftest import rows

WORDS = "공사 구간 배수로 정비 계약 금액 조정 검수 결과 결함 확인 재납품 요청 보증 기간 준공 이후 주민 설명회 소음 통행 불편 우려 입찰 제출 마감 접수 무효 처리 기술 점수 가격 합산 순위 결정".split()


def passage(seed, n=40):
    rng = random.Random(seed)
    return [rng.choice(WORDS) + str(rng.randint(10, 9999)) * (rng.random() < 0.3) for _ in range(n)]


ITEMS = [(i, " ".join(passage(i))) for i in range(20)]
FILLER = " ".join(passage(999, 60))


def found(texts, share=0.5):
    prepared = prepare(ITEMS, share)
    return {(d, prepared.ids[i]) for d, i, *_ in scan(list(range(len(texts))), texts, prepared)}


def test_whole_half_and_less():
    w = passage(3)
    texts = [f"{FILLER} {' '.join(part)} {FILLER}" for part in (w, w[:20], w[20:], w[10:30], w[:17], w[23:])] + [FILLER, "", " "]
    assert found(texts) == {(0, 3), (1, 3), (2, 3), (3, 3)}


def test_disguises():
    w = passage(5)
    t = " ".join(w)
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in t)
    import unicodedata

    texts = [t.replace(" ", ""), t.replace(" ", "<br/>\n> "), "<b>" + "</b> <b>".join(w) + "</b>", wide, unicodedata.normalize("NFD", t), "&nbsp;".join(w), ", ".join(w).upper()]
    assert found(texts) == {(k, 5) for k in range(len(texts))}


def test_mistyped_letters():
    rng = random.Random(7)
    for seed in range(10):
        w = passage(seed)
        for k in rng.sample(range(2, 38), 3):
            x = w[k]
            w[k] = rng.choice([x[:1] + x[:1] + x[1:], x[1:], x[1:2] + x[:1] + x[2:]])
        assert (0, seed) in found([f"{FILLER} {' '.join(w)} {FILLER}"])


def test_other_figures_are_another_passage():
    rng = random.Random(8)
    w = ["".join(rng.choice("0123456789") if c.isdigit() else c for c in x) for x in passage(4)]
    assert found([" ".join(w)]) == set()


def test_items_that_share_most_of_their_text():
    w = passage(30)
    items = [(1, " ".join(w)), (2, " ".join([*w[:34], *passage(31)[:6]])), (3, " ".join(w[:30]))]
    prepared = prepare(items, 0.5)
    got = lambda t: sorted(prepared.ids[i] for _, i, *_ in scan([0], [t], prepared))
    assert got(f"{FILLER} {' '.join(w[:25])} {FILLER}") == [1, 2, 3]
    assert got(f"{FILLER} {' '.join(w[18:])} {FILLER}") == [1]
    assert got(FILLER) == []


def test_against_brute_force():
    rng = random.Random(11)
    texts, want = [], set()
    for d in range(60):
        seed, n = rng.randrange(20), rng.randint(8, 40)
        start = rng.randint(0, 40 - n)
        texts.append(f"{' '.join(passage(1000 + d, 15))} {' '.join(passage(seed)[start : start + n])} {' '.join(passage(2000 + d, 15))}")
        if n >= 20:
            want.add((d, seed))
    assert found(texts) == want


D, E = "doc_id long, text string, item_id string, owner string", "item_id long, text string, doc_id string"


def test_operator(spark):
    w = passage(2)
    docs = spark.createDataFrame([(1, " ".join(w), "x", "y"), (2, None, "x", "y"), (3, "", None, None), (1, " ".join(w), "x", "y"), (4, FILLER * 50, "x", "y")], D)
    items = spark.createDataFrame([(i, t, "z") for i, t in ITEMS] + [(100, "", "z"), (101, None, "z"), (102, "!!", "z"), (103, ITEMS[2][1], "repeat")], E)
    assert sorted(tuple(r) for r in leaks(docs, items).collect()) == [(1, 2), (1, 2), (1, 103), (1, 103)]
    assert leaks(docs, items.limit(0)).count() == 0
    assert leaks(docs.limit(0), items).count() == 0


def test_cutting(spark):
    w = " ".join(passage(2))
    docs = spark.createDataFrame([(1, f"앞 글 {FILLER} <b>{w}</b> {FILLER} 뒷글", "x", "y"), (2, w, "x", "y"), (3, "그대로", "x", "y"), (4, None, "x", "y")], D)
    got = {r.doc_id: r for r in without_leaks(docs, spark.createDataFrame([(i, t, "z") for i, t in ITEMS], E)).collect()}
    assert got[1].items == 1 and got[1].text.startswith("앞 글 ") and got[1].text.endswith(" 뒷글") and w not in got[1].text
    assert found([got[1].text]) == set()
    assert (got[2].text, got[2].items, got[2].removed) == (None, 1, 1.0)
    assert (got[3].text, got[3].items, got[4].text) == ("그대로", 0, None)


def test_letter_places():
    for t in ("a<b>b</b>&nbsp;c&amp;d １ 가", "한글 <i>x", "&#44032;나"):
        assert len(_letter_places(t)) == len(letters(t))
    assert fold("<p>A&amp;B</p>").strip() == "a&b"


def test_letters_of_escaped_mark_up_are_placed():
    for t, want in (("x &lt;b&gt;word&lt;/b&gt; y", "x" + "word" + "y"), ("&lt;p class=&quot;a&quot;&gt;가&amp;나", "가나"), ("A&ampB &notit", "Abit"), ("ㄱㅏ &#x30;", "가0")):
        assert letters(t) == fold(want)
        assert len(_letter_places(t)) == len(letters(t))
    t = "x &lt;b&gt;word&lt;/b&gt; y"
    assert "".join(t[p] for p in _letter_places(t)) == "xwordy"


def test_a_short_leak_beside_escaped_mark_up(spark):
    w = " ".join(passage(2))
    long = " ".join(" ".join(passage(500 + k, 60)) for k in range(10))
    docs = spark.createDataFrame([(1, f"앞 &lt;b&gt;굵은&lt;/b&gt; 글 {long} {w} {long} 뒤 &lt;i&gt;글&lt;/i&gt;", "x", "y")], D)
    got = without_leaks(docs, spark.createDataFrame([(i, t, "z") for i, t in ITEMS], E)).first()
    assert got.items == 1 and 0 < got.removed < 0.1
    assert got.text is not None and got.text.startswith("앞 &lt;b&gt;굵은") and got.text.endswith("뒤 &lt;i&gt;글&lt;/i&gt;") and w not in got.text
    assert found([got.text]) == set()


def test_cutting_for_many_blocks_is_as_for_one(spark, monkeypatch):
    from jangbu.llm import leakage

    long = " ".join(" ".join(passage(500 + k, 60)) for k in range(8))
    a, b = " ".join(passage(2)), " ".join(passage(7))
    docs = spark.createDataFrame([(1, f"{long} {a} {long} {b} 끝", "x", "y"), (1, f"{long} {a}", "x", "y"), (2, a, "x", "y"), (3, "그대로", "x", "y"), (4, None, "x", "y"), (5, a, "x", "y")], D)
    items = spark.createDataFrame([(i, t, "z") for i, t in ITEMS] + [(103, ITEMS[2][1], "repeat")], E)
    one = rows(without_leaks(docs, items))
    monkeypatch.setattr(leakage, "BLOCK_BYTES", 4 * max(len(t) for _, t in ITEMS))
    assert len(list(leakage._blocks(items, "item_id", "text"))) > 5
    many = rows(without_leaks(docs, items))
    assert many == one
    assert {r[0]: r[2] for r in many if r[1] and r[1].endswith("끝")} == {1: 3} and len(many) == 6


def test_items_shorter_than_an_n_gram(spark):
    items = spark.createDataFrame([(1, "가나 다"), (2, "a long item with many words in it, indeed")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "앞말, 가나 다 뒷말"), (2, "앞가나다뒤"), (3, "<b>가나</b> 뒤"), (4, None), (5, "x " + "a long item with many words")], "doc_id long, text string")
    assert rows(leaks(docs, items)) == [(1, 1), (3, 1), (5, 2)]
    out = {r.doc_id: r for r in without_leaks(docs, items, most=0.9).collect()}
    assert "가나" not in out[1].text and "뒷말" in out[1].text and out[1].items == 1 and out[2].text == "앞가나다뒤" and out[4].text is None


def test_long_mark_up_and_less_than_signs(spark):
    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    half = item.split(" over ")
    docs = spark.createDataFrame([(1, f"{half[0]} <a title='{'x' * 3000}'>over {half[1]}"), (2, f"if n < 5 {item} > 3")], "doc_id long, text string")
    assert rows(leaks(docs, items)) == [(1, 1), (2, 1)]
