from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jangbu.llm import packing as P
from jangbu.llm.packing import fill_report, fingerprint, measured, pack_items, packed, tokenizer, VOCABULARY
from tests.conftest import rows


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", ""]), st.integers(0, 3), st.integers(1, 20)), max_size=40))
def test_bins_hold(items):
    full = [(i, s, c, n) for i, (s, c, n) in enumerate(items)]
    at = pack_items(full, 20)
    rooms = Counter()
    for (_, _, _, n), b in zip(full, at, strict=True):
        rooms[b] += n
    assert all(v <= 20 for v in rooms.values()) and len(at) == len(items)


def test_best_fit_takes_the_tightest():
    items = [(0, "", 0, 12), (1, "", 1, 15), (2, "", 2, 5), (3, "", 3, 8)]
    at = pack_items(items, 20)
    assert at[1] == at[2] and at[0] == at[3] and at[0] != at[1]


def test_copies_and_sources_stay_apart():
    rng = random.Random(2)
    items = [(i, rng.choice("abcdefgh"), i % 150, rng.randint(50, 900)) for i in range(400)]
    at = pack_items(items, 2048)
    of = defaultdict(list)
    for item, b in zip(items, at, strict=True):
        of[b].append(item)
    assert all(len({c for _, _, c, _ in v}) == len(v) for v in of.values())
    assert len(of) <= -(-sum(n for *_, n in items) // 2048) + 2


def test_a_third_copies_of_one_text():
    items = [(i, "s", 0 if i % 3 == 0 else i, 100) for i in range(900)]
    at = pack_items(items, 2048)
    assert len(set(at)) <= -(-900 * 100 // 2000) + 3


S = "doc_id long, text string, agency_code string, tokens string, source string"


def test_texts(spark):
    e = tokenizer(VOCABULARY)
    long = " ".join(f"word{i}" for i in range(3000))
    data = [(1, "짧은 글", "A", "x", "y"), (2, None, "A", "x", "y"), (3, "", None, "x", "y"), (4, long, "A", "x", "y"), (5, long, "B", "x", "y"), (5, "짧은  글", "B", "x", "y"), (6, "  ", None, None, None)]
    docs = spark.createDataFrame(data, S)
    sizes = measured(docs, "agency_code")
    assert sorted((r.doc_id, r.tokens) for r in sizes.collect())[:2] == [(1, len(e.encode_ordinary("짧은 글"))), (2, 0)]
    out = packed(sizes).collect()
    whole = defaultdict(list)
    for r in out:
        whole[r.doc_id, r.cluster].append(r)
    n = len(e.encode_ordinary(long))
    parts = sorted(whole[4, fingerprint(long)], key=lambda r: r.part)
    assert sum(r.tokens for r in parts) == n and [r.token_from for r in parts] == [2048 * i for i in range(len(parts))] and all(r.tokens == 2048 for r in parts[:-1])
    assert sum(r.container_id is None for r in out) == 2
    room = Counter()
    for r in out:
        if r.container_id:
            room[r.container_id] += r.tokens
    assert max(room.values()) <= 2048
    assert {r.doc_id for r in out} == {1, 2, 3, 4, 5, 6}
    report = fill_report(packed(sizes)).first()
    assert report.fullest <= 2048 and report.empty_texts == 2


def test_exactly_full_and_empty_tables(spark):
    sizes = spark.createDataFrame([(1, "", 1, 2048), (2, "", 2, 4096), (3, "", 3, 2049)], "doc_id long, source string, cluster long, tokens long")
    got = sorted((r.doc_id, r.part, r.tokens) for r in packed(sizes).collect())
    assert got == [(1, 0, 2048), (2, 0, 2048), (2, 1, 2048), (3, 0, 2048), (3, 1, 1)]
    assert packed(sizes.limit(0)).count() == 0
    assert fill_report(packed(sizes.limit(0))).first().containers == 0


def test_fingerprint():
    assert fingerprint("Ａ b\n가") == fingerprint("ab가") != fingerprint("ab나")


def test_shards_lose_nothing(spark):
    sizes = spark.range(500).selectExpr("id as doc_id", "'s' as source", "id as cluster", "id % 700 + 1 as tokens")
    out = packed(sizes, shard_items=100)
    assert out.count() == 500 and out.selectExpr("sum(tokens)").first()[0] == sizes.selectExpr("sum(tokens)").first()[0]


@pytest.mark.parametrize("text", ["가" * 50_000, "a" * 50_000, " " * 50_000])
def test_very_long_texts_are_measured(text):
    assert len(tokenizer(VOCABULARY).encode_ordinary(text)) > 0


def test_faults_are_seen(spark):
    placed = [("m-0-0", 1, 0, 0, 60, "a", 1), ("m-0-0", 2, 0, 0, 60, "a", 1), ("m-0-1", 3, 0, 0, 30, "a", 2), ("m-0-2", 3, 1, 30, 30, "a", 2), ("m-0-3", 4, 1, 90, 10, "b", 3), (None, 5, 0, 0, 0, "b", 4)]
    df = spark.createDataFrame(placed, P.PLACED)
    docs = spark.createDataFrame([(k,) for k in range(1, 7)], "doc_id long")
    assert rows(P.faults(df, docs, capacity=100)) == [("gap", "4"), ("lost", "6"), ("over capacity", "m-0-0"), ("split", "3")]
    r = P.fill_report(df, capacity=100).first()
    assert (r.containers, r.fullest, r.sources_met, r.copies_met, r.empty_texts) == (4, 120, 1, 1, 1)
