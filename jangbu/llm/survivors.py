"""Best representative of each duplicate group, by token-level consensus.

Per group and column the values are aligned progressively, each against the profile of those before it, by tokens; every
aligned place is voted on by the weights of the tokens there, and the existing value closest to the voted text survives,
with the best record that carries it. Equal values are merged before they are gathered. A group of very many different
values is aligned in chunks, whose profiles, with all their weights, are aligned with each other in turn, so no vote is
lost and a group of any size fits.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jangbu.session import cut

#: Different values, or profiles, of a group and column that one task aligns at once.
CHUNK = 48
#: A token: a run of Latin letters, or any other character (a syllable, a digit, a sign) alone.
_TOKEN = re.compile(r"[A-Za-z]+|(?s:.)")

Profile = list[dict[str, float]]


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text)


def aligned(a: Profile, b: Profile, seen_a: float, seen_b: float) -> Profile:
    """Two profiles as one: places are paired so that the weight of agreeing tokens is greatest; a place that one side lacks
    is a gap, the empty token, with all of that side's weight."""
    n, m = len(a), len(b)
    agree = [[sum(min(w, y[t]) for t, w in x.items() if t and t in y) for y in b] for x in a]
    score = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        here, below = score[i], score[i + 1]
        for j in range(m - 1, -1, -1):
            here[j] = max(below[j + 1] + agree[i][j], below[j], here[j + 1])
    i = j = 0
    out: Profile = []
    while i < n or j < m:
        if i < n and j < m and score[i][j] == score[i + 1][j + 1] + agree[i][j]:
            x, y, i, j = a[i], b[j], i + 1, j + 1
        elif i < n and (j == m or score[i][j] == score[i + 1][j]):
            x, y, i = a[i], {"": seen_b}, i + 1
        else:
            x, y, j = {"": seen_a}, b[j], j + 1
        out.append({t: x.get(t, 0.0) + y.get(t, 0.0) for t in {**x, **y}})
    return out


def merged(profiles: Sequence[tuple[Profile, float]]) -> tuple[Profile, float]:
    """Profiles put together one by one, in the order given."""
    whole, seen = ([], 0.0) if not profiles else profiles[0]
    for p, w in profiles[1:]:
        whole, seen = aligned(whole, p, seen, w), seen + w
    return whole, seen


def voted(profile: Profile) -> str:
    """The heaviest token of each place; of equally heavy ones that which came first."""
    return "".join(max(cell.items(), key=lambda x: round(x[1], 9))[0] for cell in profile)


def consensus(values: Sequence[str], weights: Sequence[float]) -> str:
    """The voted text of weighted values, heaviest first into the profile; of equally heavy ones the first in the list."""
    order = sorted(range(len(values)), key=lambda i: -weights[i])
    return voted(merged([([{t: weights[i]} for t in tokens(values[i])], weights[i]) for i in order])[0])


def survivors(candidates: DataFrame, group: str, weight: Column, prefer: Sequence[Column], chunk: int = CHUNK) -> DataFrame:
    """One surviving value per group and column: ``group, field_name, norm, best`` with ``best`` the preferred record's struct.

    ``candidates`` has ``group``, ``field_name`` and ``norm``, the value to align; ``weight`` is a record's vote, and a
    value's is the sum of its records'. ``prefer``, smallest first the better and never null, picks the record of the surviving value and
    decides between values that are equally heavy. Groups or columns without candidates give no row; null
    and empty ``norm`` are no candidates; a null weight counts as none. Repeated records vote as often as they occur.
    """
    ranked = candidates.where(F.length("norm") > 0).select(F.col(group).alias("grp"), "field_name", "norm", F.coalesce(weight.cast("double"), F.lit(0.0)).alias("w"), F.struct(*prefer).alias("best"))
    values = cut(ranked.groupBy("grp", "field_name", "norm").agg(F.min("best").alias("best"), F.round(F.sum("w"), 9).alias("w")))
    key = ["grp", "field_name"]
    sizes = values.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
    several = values.join(sizes.where("size > 1"), key)
    salt = F.when(F.col("size") > chunk, F.pmod(F.xxhash64("norm"), F.ceil(F.col("size") / chunk * 2))).otherwise(F.lit(0))
    kind = "grp string, field_name string, profile array<map<string,double>>, w double, text string"

    def profiles(pdf: pd.DataFrame) -> pd.DataFrame:
        if "norm" in pdf.columns:
            ready = [([{t: w} for t in tokens(v)], w) for v, w, _ in sorted(zip(pdf.norm, pdf.w, pdf.best, strict=True), key=lambda x: (-x[1], tuple(x[2].values()), x[0]))]
        else:
            ready = sorted((([dict(cell) for cell in p], w) for p, w in zip(pdf.profile, pdf.w, strict=True)), key=lambda x: (-x[1], voted(x[0])))
        whole, seen = merged(ready)
        return pd.DataFrame({"grp": [pdf.grp.iloc[0]], "field_name": [pdf.field_name.iloc[0]], "profile": [whole], "w": [seen], "text": [voted(whole)]})

    spoke = cut(several.select(*key, "norm", "w", "best", salt.alias("salt")).groupBy(*key, "salt").applyInPandas(profiles, kind))
    while True:
        parts = spoke.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
        if (parts.agg(F.max("size")).first()[0] or 0) <= 1:
            break
        salted = spoke.join(parts, key).withColumn("salt", F.when(F.col("size") > chunk, F.pmod(F.xxhash64("text"), F.ceil(F.col("size") / chunk * 2))).otherwise(F.lit(0)))
        again = salted.where("size > 1").select(*key, "profile", "w", "salt").groupBy(*key, "salt").applyInPandas(profiles, kind)
        spoke = cut(salted.where("size = 1").select(spoke.columns).unionByName(again))
    near = values.join(spoke.select(*key, "text"), key, "left").select(*key, "norm", "best", "w", F.when(F.col("text").isNotNull(), F.levenshtein("norm", "text")).otherwise(0).alias("far"))
    won = near.groupBy(*key).agg(F.min(F.struct("far", (-F.col("w")).alias("light"), "best", "norm")).alias("x"))
    return won.select(F.col("grp").alias(group), "field_name", F.col("x.norm").alias("norm"), F.col("x.best").alias("best"))
