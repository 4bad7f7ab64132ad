"""Filling fixed-capacity containers with texts.

Texts are measured in tokens of a public tokenizer where they lie; from then on only ids and sizes move. Items are spread
over shards by a hash of their id, and each shard packs by conflict-constrained best fit, largest first: bins are kept
ordered by the room they have left and carry bitmaps of the sources and duplicate clusters in them; a search goes up
from the item's size until the tightest bin that is compatible is found, and opens a new one if there is none.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path

import pandas as pd
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jangbu.session import cut

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
CAPACITY = 2048
#: Items that one shard packs; its unused room is at most a container or two whatever the size of the corpus.
SHARD_ITEMS = 8_000
#: Splits text before the merges (a fixed value that belongs to the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(vocabulary).read_bytes().splitlines())}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def fingerprint(text: str) -> int:
    """Equal for texts that differ in white space, case or Unicode form only."""
    return xxhash.xxh64_intdigest(re.sub(r"\s+", "", unicodedata.normalize("NFKC", text).casefold())) - (1 << 63)


def measured(docs: DataFrame, source: str, vocabulary: str = VOCABULARY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, source, cluster, tokens`` per row; a null or empty text has 0 tokens."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(vocabulary).encode_ordinary
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf[text]]
            yield pd.DataFrame({
                "doc_id": pdf[doc_id],
                "source": pdf[source].astype(object),
                "cluster": [fingerprint(t) if t else 0 for t in texts],
                "tokens": [len(encode(t)) if t else 0 for t in texts],
            })

    return docs.select(doc_id, F.coalesce(F.col(source).cast("string"), F.lit("")).alias(source), text).mapInPandas(count, "doc_id long, source string, cluster long, tokens long")


def quotas(counts: dict[object, int], bins: int) -> dict[object, int]:
    """How often a class may come per bin: once, or as often as it must for its members not to need more bins than the
    sizes do. So a class that holds a third of all items costs no room."""
    return {c: max(1, -(-n * 10 // (max(1, bins) * 9))) for c, n in counts.items()}


@dataclass
class Bins:
    """Open bins by room left. A bin's bitmaps are integers, one per level: bit b of level k says that the class with bit b
    is in the bin more than k times."""

    capacity: int
    least: int = 0
    levels: list[list[int]] = field(default_factory=list)
    rooms: list[int] = field(default_factory=list)
    by_room: list[list[int]] = field(default_factory=list)
    open_rooms: int = 0

    def __post_init__(self) -> None:
        self.by_room = [[] for _ in range(self.capacity + 1)]

    def _fits(self, b: int, marks: list[tuple[int, int]]) -> bool:
        levels = self.levels[b]
        return all(quota > len(levels) or not levels[quota - 1] & bit for bit, quota in marks)

    def _tightest(self, size: int, marks: list[tuple[int, int]]) -> int:
        """Take the compatible bin with the least room that is enough off the list; -1 if there is none."""
        rooms, room = self.open_rooms >> size, size
        while rooms:
            step = (rooms & -rooms).bit_length() - 1
            room += step
            bucket = self.by_room[room]
            for k in range(len(bucket) - 1, -1, -1):
                if self._fits(bucket[k], marks):
                    found = bucket.pop(k)
                    if not bucket:
                        self.open_rooms &= ~(1 << room)
                    return found
            rooms >>= step + 1
            room += 1
        return -1

    def place(self, size: int, source: tuple[int, int] | None, cluster: tuple[int, int] | None) -> int:
        """Put an item into the tightest compatible bin and tell its number. ``source`` and ``cluster``: (bit, quota).

        Once there are as many bins as the sizes need at least, sources may meet rather than open one more; copies of one
        text never do.
        """
        apart = [m for m in (source, cluster) if m]
        found = self._tightest(size, apart)
        if found < 0 and source and len(self.rooms) >= self.least:
            found = self._tightest(size, [cluster] if cluster else [])
        if found < 0:
            found = len(self.rooms)
            self.rooms.append(self.capacity)
            self.levels.append([])
        marks = apart
        levels = self.levels[found]
        for bit, _ in marks:
            for k in range(len(levels) + 1):
                if k == len(levels):
                    levels.append(bit)
                    break
                if not levels[k] & bit:
                    levels[k] |= bit
                    break
        left = self.rooms[found] - size
        self.rooms[found] = left
        if left:
            self.by_room[left].append(found)
            self.open_rooms |= 1 << left
        return found


def pack_items(items: list[tuple[int, str, int, int]], capacity: int) -> list[int]:
    """Bin numbers of (id, source, cluster, size) items, sizes from 1 to capacity, by best fit from the largest down."""
    least = -(-sum(s for *_, s in items) // capacity)
    source_counts: dict[object, int] = {}
    cluster_counts: dict[object, int] = {}
    for _, source, cluster, _ in items:
        source_counts[source] = source_counts.get(source, 0) + 1
        cluster_counts[cluster] = cluster_counts.get(cluster, 0) + 1
    source_quota, cluster_quota = quotas(source_counts, least), quotas(cluster_counts, least)
    source_bit = {c: 1 << k for k, c in enumerate(sorted(source_counts))}
    repeated = sorted(c for c, n in cluster_counts.items() if n > 1)
    cluster_bit = {c: 1 << (len(source_bit) + k) for k, c in enumerate(repeated)}
    bins = Bins(capacity, least)
    out = [0] * len(items)
    for k in sorted(range(len(items)), key=lambda k: (-items[k][3], items[k][0])):
        _, source, cluster, size = items[k]
        by_source = (source_bit[source], source_quota[source]) if source else None
        by_cluster = (cluster_bit[cluster], cluster_quota[cluster]) if cluster in cluster_bit else None
        out[k] = bins.place(size, by_source, by_cluster)
    return out


PLACED = "container_id string, doc_id long, part int, token_from long, tokens long, source string, cluster long"


def packed(sizes: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``container_id, doc_id, part, token_from, tokens, source, cluster``: where each text, or piece of one, goes.

    Only a text above ``capacity`` is split: into full containers of its own, and a rest that is packed like any text. In a
    container two copies of one text come together only if there are more of them than the containers that the sizes need
    (see ``quotas``), and two texts of one source only where that, or else one more container, would be the price. A text of 0 tokens needs no room: its container is null. Every row
    of ``sizes`` comes out, repeated ids too, which are then items of their own.
    """
    sizes = cut(sizes)
    full = F.floor((F.col("tokens") - 1) / capacity)  # pieces in front of the rest
    base = sizes.select("*", F.monotonically_increasing_id().alias("row"), F.when(F.col("tokens") > 0, full).otherwise(0).cast("int").alias("full"))
    rest = base.select("doc_id", "source", "cluster", F.col("full").alias("part"), (F.col("full").cast("long") * capacity).alias("token_from"), (F.col("tokens") - F.col("full") * capacity).alias("tokens"))
    shards = max(1, -(-sizes.count() // shard_items))
    sharded = rest.where("tokens > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "tokens", "cluster"], kind="stable")
        at = pack_items(list(zip(pdf.doc_id, pdf.source, pdf.cluster, pdf.tokens, strict=True)), capacity)
        shard = int(pdf.shard.iloc[0])
        return pdf.assign(container_id=[f"mixed-{shard}-{b}" for b in at])[["container_id", "doc_id", "part", "token_from", "tokens", "source", "cluster"]]

    whole = base.where("full > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("part"))
    own = F.concat_ws("-", F.lit("full"), "row", "part")
    pieces = whole.select(own.alias("container_id"), "doc_id", "part", (F.col("part").cast("long") * capacity).alias("token_from"), F.lit(capacity).cast("long").alias("tokens"), "source", "cluster")
    empty = rest.where("tokens = 0").select(F.lit(None).cast("string").alias("container_id"), "doc_id", "part", "token_from", "tokens", "source", "cluster")
    return sharded.groupBy("shard").applyInPandas(fill, PLACED).unionByName(pieces).unionByName(empty)


def fill_report(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, fewest that the sizes could need, share of room unused, fullest, and texts by kind; ``sources_met``
    and ``copies_met`` are the texts beyond the first of a source, or of a group of copies, in their containers."""
    placed = cut(placed)
    items = placed.where("container_id is not null")
    beyond = lambda key, name: items.where(F.col(key).isNotNull()).groupBy("container_id", key).agg((F.count_distinct("doc_id") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))
    bins = items.groupBy("container_id").agg(F.sum("tokens").alias("filled"), F.count(F.lit(1)).alias("items"))
    of_bins = bins.agg(
        F.count(F.lit(1)).alias("containers"),
        F.ceil(F.sum("filled") / capacity).alias("fewest_possible"),
        (1 - F.try_divide(F.sum("filled"), F.count(F.lit(1)) * capacity)).alias("unused_share"),
        F.max("filled").alias("fullest"),
        F.sum("items").alias("pieces"),
    )
    of_docs = placed.agg(F.count_if(F.col("container_id").isNull()).alias("empty_texts"), F.sum("tokens").alias("tokens"))
    return of_bins.join(F.broadcast(of_docs)).join(F.broadcast(beyond("source", "sources_met"))).join(F.broadcast(beyond("cluster", "copies_met")))  # one row each


def faults(placed: DataFrame, docs: DataFrame, capacity: int = CAPACITY, doc_id: str = "doc_id") -> DataFrame:
    """What a packing must not have, ``fault, name``: containers above capacity, texts within it that are split, texts whose
    pieces don't follow each other from the first token on, and texts that are lost. No rows if it is whole."""
    placed = cut(placed)
    over = placed.where("container_id is not null").groupBy("container_id").agg(F.sum("tokens").alias("n")).where(F.col("n") > capacity)
    per = placed.groupBy("doc_id").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("parts"), F.count_distinct("part").alias("different"), F.max(F.col("token_from") + F.col("tokens")).alias("reach"))
    one = per.where("parts = different")  # repeated ids are texts of their own
    split = one.where((F.col("parts") > 1) & (F.col("tokens") <= capacity))
    gaps = one.where("reach <> tokens")
    lost = docs.select(F.col(doc_id).alias("doc_id")).distinct().join(placed.select("doc_id").distinct(), "doc_id", "left_anti")
    name = lambda df, what, key: df.select(F.lit(what).alias("fault"), F.col(key).cast("string").alias("name"))
    return name(over, "over capacity", "container_id").unionByName(name(split, "split", "doc_id")).unionByName(name(gaps, "gap", "doc_id")).unionByName(name(lost, "lost", "doc_id"))
