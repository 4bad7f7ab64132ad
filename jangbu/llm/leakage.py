"""Evaluation texts leaking into training text.

The held-out items are few and broadcast as a hash set of normalised character n-grams that belong to one item only; the
training windows are hashed and looked up batch by batch with array operations; documents with enough hits of an item
are verified by extending the hits letter by letter over mistyped ones, and a leak is a run of words of the item, in
order, of at least the asked share. Normalising drops mark-up, case, Unicode form, spacing and punctuation, so words
that are run together or broken apart match too.
"""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of an n-gram; mistyped places allowed per words of a run; letters that must agree after a mistyped place.
GRAM, WORDS_PER_TYPO, RESYNC = 10, 12, 4
#: Bytes of item text that one pass broadcasts; more items take more passes.
BLOCK_BYTES = 16_000_000
#: Characters that one array pass takes.
SLICE = 1_000_000

_TAG = re.compile(r"<(?=[A-Za-z/!?])[^<>]*>")
#: What html.unescape takes for a character reference.
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")
_MULT = np.uint64(0x9E3779B97F4A7C15)
_tables: dict[str, np.ndarray] = {}


def fold(text: str) -> str:
    """Text without mark-up, in one Unicode form and case; spacing and punctuation stay."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.casefold()


def _alnum() -> np.ndarray:
    if "alnum" not in _tables:
        _tables["alnum"] = np.fromiter((chr(i).isalnum() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)
    return _tables["alnum"]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def letters(text: str) -> str:
    """The folded text's letters and digits alone."""
    return "".join(c for c in fold(text) if c.isalnum())


def grams(c: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every window of ``size`` codes."""
    n = len(c) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = c.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * _MULT + wide[k : k + n]
    h ^= h >> np.uint64(31)
    return h * _MULT


@dataclass
class Items:
    """Items ready for the scan: texts as letters, word ends, and the hash set of the n-grams that tell them."""

    ids: list = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    words: list[list[tuple[int, int]]] = field(default_factory=list)
    needed: list[int] = field(default_factory=list)
    hits: list[int] = field(default_factory=list)
    hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    owner: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    place: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    bits: np.ndarray = field(default_factory=lambda: np.zeros(1 << 22, bool))
    short: dict[str, list[int]] = field(default_factory=dict)


def prepare(rows: list[tuple[object, str]], share: float, size: int = GRAM) -> Items:
    """``needed``: words of a leak. N-grams that one item alone has are enough to tell it, unless too few are left in some
    part of it. ``hits``: the n-gram hits that every leak of an item makes at least, whatever part of
    the item it is, with one mistyped place per ``WORDS_PER_TYPO`` words; so asking for them loses none. ``short``: runs of the
    needed words that have fewer letters than an n-gram; they are looked up whole, as words."""
    out = Items()
    every: list[tuple[np.ndarray, int]] = []
    for item, text in rows:
        words = [w for w in ("".join(c for c in x if c.isalnum()) for x in fold(text).split()) if w]
        if not words:
            continue
        ends = np.cumsum([len(w) for w in words])
        out.ids.append(item)
        out.texts.append("".join(words))
        out.words.append([(int(e) - len(w), int(e)) for w, e in zip(words, ends, strict=True)])
        out.needed.append(max(1, int(np.ceil(len(words) * share))))
        n = out.needed[-1]
        for k in range(len(words) - n + 1):
            if sum(map(len, words[k : k + n])) < size:
                out.short.setdefault(f" {' '.join(words[k : k + n])} ", []).append(len(out.ids) - 1)
        every.append((grams(codes(out.texts[-1]), size), len(out.ids) - 1))
    if not sum(len(e) for e, _ in every):
        out.hits = [1] * len(out.ids)
        return out
    h = np.concatenate([e for e, _ in every])
    owner = np.concatenate([np.full(len(e), i, np.int32) for e, i in every])
    place = np.concatenate([np.arange(len(e), dtype=np.int32) for e, _ in every])
    order = np.argsort(h, kind="stable")
    h, owner, place = h[order], owner[order], place[order]
    group = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1
    low, high = np.full(group[-1] + 1, 1 << 30), np.full(group[-1] + 1, -1)
    np.minimum.at(low, group, owner)
    np.maximum.at(high, group, owner)
    keep = (low == high)[group]
    least = [_least_hits(out, i, place[keep & (owner == i)], size) for i in range(len(out.ids))]
    # an item much of which stands in other items too is looked for by all of its n-grams
    common = np.array([n < 1 for n in least])
    keep |= common[owner]
    out.hashes, out.owner, out.place = h[keep], owner[keep], place[keep]
    out.bits[(out.hashes >> np.uint64(42)).astype(np.int64)] = True
    out.hits = [max(1, _least_hits(out, i, out.place[out.owner == i], size) if common[i] else n) for i, n in enumerate(least)]
    return out


def _least_hits(items: Items, i: int, places: np.ndarray, size: int) -> int:
    """The n-grams, of those at ``places``, that every part of item ``i`` long enough for a leak holds, less those that its
    mistyped places may spoil."""
    own = np.zeros(len(items.texts[i]) + 1, np.int64)
    own[places + 1] = 1
    before = np.cumsum(own)
    n, words = items.needed[i], items.words[i]
    spans = [(words[k][0], words[k + n - 1][1]) for k in range(len(words) - n + 1)]
    return min(int(before[max(a, b - size + 1)] - before[a]) for a, b in spans) - size * -(-n // WORDS_PER_TYPO)


def _extend(doc: str, text: str, i: int, j: int, step: int) -> tuple[int, int]:
    """Follow ``doc[i]`` and ``text[j]`` as they agree, over single mistyped places: a letter doubled, lost, changed or swapped."""
    n, m = len(doc), len(text)

    def same(a: int, b: int) -> bool:
        for k in range(RESYNC):
            x, y = a + k * step, b + k * step
            if not 0 <= y < m:
                return k > 0
            if not 0 <= x < n or doc[x] != text[y]:
                return False
        return True

    while 0 <= i < n and 0 <= j < m:
        if doc[i] == text[j]:
            i, j = i + step, j + step
            continue
        i2, j2 = i + step, j + step
        if 0 <= i2 < n and 0 <= j2 < m and doc[i] == text[j2] and doc[i2] == text[j] and same(i2 + step, j2 + step):
            i, j = i2 + step, j2 + step
        elif same(i, j2):
            j = j2
        elif same(i2, j):
            i = i2
        elif not doc[i].isdigit() and not text[j].isdigit() and same(i2, j2):
            i, j = i2, j2
        else:
            break
    return i, j


def longest_run(doc: str, text: str, words: list[tuple[int, int]], anchors: list[tuple[int, int]], size: int = GRAM) -> tuple[int, int, int]:
    """Most words of ``text`` in one run of ``doc``, and the run's ends in ``doc``; anchors are (doc, text) places that agree."""
    best, done = (0, 0, 0), {}
    for p, q in anchors:
        if p < done.get(p - q, -1):
            continue
        i1, j1 = _extend(doc, text, p + size, q + size, 1)
        i0, j0 = _extend(doc, text, p - 1, q - 1, -1)
        done[p - q] = i1
        covered = sum(1 for a, b in words if a > j0 and b <= j1)
        if covered > best[0]:
            best = (covered, i0 + 1, i1)
    return best


def scan(ids: list, texts: list[str], items: Items, size: int = GRAM) -> Iterator[tuple[object, int, int, int, str]]:
    """(doc id, item index, run start, run end, letters) for every leak in the texts; starts and ends count letters."""
    alnum = _alnum()
    folded = [fold(t) + "\n" for t in texts]
    brief: set[tuple[int, int]] = set()
    if items.short:
        for d, t in enumerate(folded):
            words = f" {' '.join(w for w in (''.join(c for c in x if c.isalnum()) for x in t.split()) if w)} "
            for run, of in items.short.items():
                at = words.find(run)
                while at >= 0:
                    a = len(words[:at].replace(" ", ""))
                    for i in of:
                        brief.add((d, i))
                        yield ids[d], i, a, a + len(run.replace(" ", "")), words.replace(" ", "")
                    at = words.find(run, at + 1)
    start = 0
    while start < len(folded):
        stop, chars = start, 0
        while stop < len(folded) and (stop == start or chars + len(folded[stop]) <= SLICE):
            chars += len(folded[stop])
            stop += 1
        c = codes("".join(folded[start:stop]))
        owner = np.repeat(np.arange(start, stop, dtype=np.int32), [len(x) for x in folded[start:stop]])
        keep = alnum[c]
        c, owner = c[keep], owner[keep]
        h = grams(c, size)
        near = np.flatnonzero(items.bits[(h >> np.uint64(42)).astype(np.int64)]) if len(h) else np.empty(0, np.int64)
        near = near[owner[near] == owner[near + size - 1]]
        first = np.searchsorted(items.hashes, h[near], "left")
        owners = np.searchsorted(items.hashes, h[near], "right") - first
        at = np.repeat(first - np.r_[0, np.cumsum(owners)[:-1]], owners) + np.arange(int(owners.sum())) if len(near) else first
        near = np.repeat(near, owners)
        if len(near):
            pair = owner[near].astype(np.int64) * len(items.ids) + items.owner[at]
            kinds, back, counts = np.unique(pair, return_inverse=True, return_counts=True)
            enough = counts >= np.array(items.hits)[kinds % len(items.ids)]
            chosen = defaultdict(list)
            for k in np.flatnonzero(enough[back]):
                chosen[int(pair[k])].append((int(near[k]), int(items.place[at[k]])))
            bounds = np.searchsorted(owner, np.arange(start, stop + 1))
            for code, anchors in chosen.items():
                d, i = divmod(code, len(items.ids))
                low, high = bounds[d - start], bounds[d - start + 1]
                doc = c[low:high].tobytes().decode("utf-32-le", "surrogatepass")
                covered, a, b = longest_run(doc, items.texts[i], items.words[i], [(p - low, q) for p, q in anchors], size)
                if covered >= items.needed[i] and (d, i) not in brief:
                    yield ids[d], i, a, b, doc
        start = stop


def _blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[tuple[int, ...], str]]]:
    """The items in blocks of bounded size, of which the driver holds one at a time; each text once, with all its ids."""
    texts = items.where(F.col(text_column).isNotNull()).groupBy(text_column).agg(F.array_sort(F.collect_set(id_column)).alias("ids"))
    block: list[tuple[tuple[int, ...], str]] = []
    held = 0
    for r in texts.toLocalIterator():
        bytes_ = 4 * len(r[0])
        if held and held + bytes_ > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append((tuple(r.ids), r[0]))
        held += bytes_
    if block:
        yield block


def leaks(docs: DataFrame, items: DataFrame, share: float = 0.5, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id`` for every document that holds a run of at least ``share`` of an item's words; each pair once per
    document row.

    Null and empty texts leak nothing; an item without letters matches nothing; items of the same text leak together. No
    shuffle of documents: they are scanned where they lie, once per block of items.
    """
    spark = docs.sparkSession
    parts = []
    for block in _blocks(items, item_id, text):
        shared = spark.sparkContext.broadcast(prepare(block, share))

        def find(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = pdf[pdf[text].notna()]
                found = list(dict.fromkeys((k, item) for k, i, *_ in scan(range(len(rows)), list(rows[text]), shared.value) for item in shared.value.ids[i]))
                own = list(rows[doc_id])
                found = [(own[k], item) for k, item in found]
                yield pd.DataFrame({"doc_id": [d for d, _ in found], "item_id": [i for _, i in found]}, dtype="int64")

        parts.append(docs.select(doc_id, text).mapInPandas(find, "doc_id long, item_id long"))
    if not parts:
        return spark.createDataFrame([], "doc_id long, item_id long")
    return reduce(DataFrame.unionByName, parts)


def _unescaped(text: str) -> tuple[str, list[int]]:
    """``html.unescape`` and the place in ``text`` of each character. A name without its semicolon may be resolved in part
    (&ampb is &b); what is left of it stands where it stood."""
    out, places, last = [], [], 0
    for m in _REFERENCE.finditer(text):
        new = html.unescape(m.group())
        same = 0
        while m.group()[1] != "#" and same < min(len(new), len(m.group())) and new[-1 - same] == m.group()[-1 - same]:
            same += 1
        out += [text[last : m.start()], new]
        places += [*range(last, m.start()), *[m.start()] * (len(new) - same), *range(m.end() - same, m.end())]
        last = m.end()
    return "".join([*out, text[last:]]), [*places, *range(last, len(text))]


def _letter_places(text: str) -> list[int]:
    return _placed_letters(text)[1]


def _placed_letters(text: str) -> tuple[str, list[int]]:
    """The letters of the folded text and, for each, the place in ``text`` it comes from (for the few texts that leak). The steps are
    those of ``fold``: references are resolved before tags are dropped, then characters that compose are taken together."""
    text, at = _unescaped(text)
    plain, source, last = [], [], 0
    for m in _TAG.finditer(text):
        plain += [text[last : m.start()], " "]
        source += at[last : m.start() + 1]
        last = m.end()
    plain, source = "".join([*plain, text[last:]]), source + at[last:]
    form = lambda x: unicodedata.normalize("NFKC", x)
    places: list[int] = []
    shown: list[str] = []
    i = 0
    while i < len(plain):
        j = i + 1
        while j < len(plain) and not plain[j].isascii() and not "가" <= plain[j] <= "힣" and (unicodedata.combining(form(plain[j])[0]) or form(plain[i : j + 1]) != form(plain[i:j]) + form(plain[j])):
            j += 1
        shown += [c for c in form(plain[i:j]).casefold() if c.isalnum()]
        places += [source[i]] * (len(shown) - len(places))
        i = j
    return "".join(shown), places


def _cut(text: str, total: int, spans: list[tuple[int, int]], most: float) -> tuple[str | None, float]:
    """``text`` without the union of the spans of its letters, and the share of letters gone."""
    covered = np.zeros(total, bool)
    for a, b in spans:
        covered[a:b] = True
    gone, (found, places) = float(covered.mean()), _placed_letters(text)
    if gone > most:
        return None, gone
    if len(places) != total:  # letters that compose in another order: the spans are looked up where they stand
        whole = letters(text)
        moved = [(found.find(whole[a:b]), b - a) for a, b in spans]
        if any(at < 0 or at + n > len(places) for at, n in moved):
            return None, gone
        return _cut(text, len(places), [(at, at + n) for at, n in moved], 1.0)[0], gone
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    out, last = [], 0
    for a, b in edges.reshape(-1, 2):
        out.append(text[last : places[a]])
        last = places[b] if b < total else len(text)
    return "".join([*out, text[last:]]), gone


def without_leaks(docs: DataFrame, items: DataFrame, share: float = 0.5, most: float = 0.5, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The corpus without its leaks: ``doc_id, text, items, removed``.

    Leaked spans are cut out; where they are more than ``most`` of a document's letters, the whole text goes and ``text``
    is null. ``items`` is how many items leaked, ``removed`` the share of letters gone. Every row stays a row; a text
    without leaks stays as it is. One block of items is cut in one pass without a shuffle; of more blocks each is a pass
    that finds spans, which come together by the text's hash, and their union is cut.
    """
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(prepare(b, share)) for b in _blocks(items, item_id, text)]
    if len(blocks) > 1:
        return _without_blocks(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), blocks, most)
    shared = blocks[0] if blocks else context.broadcast(prepare([], share))

    def cut_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = list(pdf[text])
            spans: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
            present = [k for k, t in enumerate(texts) if isinstance(t, str)]
            for k, i, a, b, letters_ in scan(present, [texts[k] for k in present], shared.value):
                spans[k].append((a, b, len(letters_), i))
            counts, gone = [0] * len(texts), [0.0] * len(texts)
            for k, found in spans.items():
                counts[k] = sum(len(shared.value.ids[i]) for i in {i for *_, i in found})
                texts[k], gone[k] = _cut(texts[k], found[0][2], [(a, b) for a, b, *_ in found], most)
            yield pd.DataFrame({"doc_id": pdf[doc_id], "text": pd.Series(texts, dtype=object, index=pdf.index), "items": np.array(counts, np.int64), "removed": gone})

    return docs.select(doc_id, text).mapInPandas(cut_spans, "doc_id long, text string, items long, removed double")


def _without_blocks(docs: DataFrame, blocks: list, most: float) -> DataFrame:
    """Spans depend on the text alone, so they are kept by its hash; a task holds one block at a time."""
    hashed = docs.withColumn("hash", F.sha2("text", 256))
    parts = []
    for k, block in enumerate(blocks):

        def find(batches: Iterator[pd.DataFrame], block=block, k=k) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = pdf[pdf["text"].notna()]
                found = [(h, i, a, b, len(letters_)) for h, i, a, b, letters_ in scan(list(rows["hash"]), list(rows["text"]), block.value)]
                yield pd.DataFrame({
                    "hash": pd.Series([h for h, *_ in found], dtype=object), "low": np.array([a for _, _, a, _, _ in found], np.int64), "high": np.array([b for _, _, _, b, _ in found], np.int64),
                    "total": np.array([n for *_, n in found], np.int64), "block": np.full(len(found), k, np.int64), "text_no": np.array([i for _, i, *_ in found], np.int64), "ids": np.array([len(block.value.ids[i]) for _, i, *_ in found], np.int64),
                })

        parts.append(hashed.select("hash", "text").mapInPandas(find, "hash string, low long, high long, total long, block long, text_no long, ids long"))
    spans = reduce(DataFrame.unionByName, parts).groupBy("hash").agg(
        F.collect_set(F.struct("low", "high")).alias("spans"), F.max("total").alias("total"), F.aggregate(F.collect_set(F.struct("block", "text_no", "ids")), F.lit(0).cast("long"), lambda n, x: n + x["ids"]).alias("items")
    )

    def cut_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cuts = [(t, 0.0) if s is None else _cut(t, int(n), [(x["low"], x["high"]) for x in s], most) for t, s, n in zip(pdf["text"], pdf["spans"], pdf["total"], strict=True)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": pd.Series([t for t, _ in cuts], dtype=object, index=pdf.index), "items": pdf["items"], "removed": [g for _, g in cuts]})

    rows = hashed.join(spans, "hash", "left").select("doc_id", "text", "spans", "total", F.coalesce("items", F.lit(0).cast("long")).alias("items"))
    return rows.mapInPandas(cut_spans, "doc_id long, text string, items long, removed double")
