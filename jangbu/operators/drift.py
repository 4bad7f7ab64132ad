"""Schemas that drift between files.

Lines of JSON objects are exploded to (file, field) cells on the JVM. Each file's fields are profiled by type counts; the
fields that end and those that begin between neighbouring files of a stream are compared by value sketches (64-bit
fingerprints of each record's content in one notation), and a maximum-weight bipartite matching of the scores names the
renamings. What is left over was added or removed. The renamings, put together over all files, give each field one
consistent name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from jangbu.functions.text import WHITE_SPACE, blank_to_null, day
from jangbu.session import cut

#: Changed fields (a row of four short texts each) up to which they are sent to every task; records of a file's field whose
#: contents its sketch holds: those of the smallest hashes, so that two files' sketches hold the same records.
BROADCAST_ROWS, SKETCH = 100_000, 4096
TYPES = ("text", "integer", "decimal", "boolean", "object")


def json_type(kind: Column) -> Column:
    """One of ``TYPES`` for what ``schema_of_variant`` says; null for a JSON null. An array counts as object; 5.0 is a decimal."""
    return (
        F.when(kind.isin("STRING", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ"), "text")
        .when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "decimal")
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), "object")
    )


def with_content(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds ``{new column: text column}``: one notation for what a value says, so that ``1,200원``, ``1200.0`` and
    ``{"value": 1200}`` agree.

    Numbers lose separators, units and a zero fraction; days lose separators; yes and no become 1 and 0; other text loses
    white space and case. A value with no content gives null. The steps are projections of their own, as each uses the one
    before several times and none should be computed twice.
    """
    date = r"^(\d{4})[-./년](\d{1,2})[-./월](\d{1,2})일?$"
    # the value inside an object, then letters in one case and without white space, then without units and separators
    inner = {n: F.coalesce(F.when(F.col(c).startswith("{"), F.get_json_object(c, "$.value")), F.col(c)) for n, c in columns.items()}
    out = df.withColumns(inner).withColumns({n: F.lower(F.translate(n, WHITE_SPACE, "")) for n in columns})
    out = out.withColumns({f"_{n}": F.regexp_replace(n, r"^(?:[₩￦$]|krw)|(?:원|krw|₩)$|,|(?<=\d)\.0+$", "") for n in columns})

    def shown(n: str) -> Column:
        flat, bare = F.col(n), F.col(f"_{n}")
        padded = F.concat(F.regexp_extract(flat, date, 1), F.lpad(F.regexp_extract(flat, date, 2), 2, "0"), F.lpad(F.regexp_extract(flat, date, 3), 2, "0"))
        value = F.when(bare.rlike(r"^-?\d+(\.\d+)?$"), bare).when(flat.isin("y", "yes", "true", "예", "여"), "1").when(flat.isin("n", "no", "false", "아니오", "부"), "0").when(flat.rlike(date), padded).otherwise(flat)
        return F.nullif(value, F.lit(""))

    return out.withColumns({n: shown(n) for n in columns}).drop(*[f"_{n}" for n in columns])


def cells(lines: DataFrame, stream: str, file: str, order: str, payload: str, key_field: str | Sequence[str], line: str) -> DataFrame:
    """One row per non-null field of a line: ``stream, file, ord, line, rec, field, type, text``.

    ``rec`` is the trimmed value of ``key_field``, which names the record in every file, or of the first of several that the
    line has. A payload that is null, empty,
    not an object or repeats a field name gives no cells. Each line is parsed once, on the JVM. A whole number beyond 64
    bits counts as decimal.
    """
    parsed = lines.select(
        F.col(stream).alias("stream"),
        F.col(file).alias("file"),
        F.col(order).cast("string").alias("ord"),
        F.col(line).alias("line"),
        F.try_parse_json(F.col(payload)).alias("doc"),
    )
    keys = [key_field] if isinstance(key_field, str) else key_field
    keyed = parsed.withColumn("rec", F.coalesce(*[blank_to_null(F.try_variant_get("doc", f"$['{k}']", "string")) for k in keys]))
    exploded = keyed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("doc").outer())).where(F.col("key").isNotNull() & ~F.is_variant_null("value"))  # asks for no type, so that who needs none has none worked out
    kinds = exploded.select("stream", "file", "ord", "line", "rec", F.col("key").alias("field"), F.schema_of_variant("value").alias("kind"), F.col("value").cast("string").alias("text"))
    return kinds.select("stream", "file", "ord", "line", "rec", "field", json_type(F.col("kind")).alias("type"), "text")


def field_profile(found: DataFrame) -> DataFrame:
    """Per file and field: how often each type occurs, and ``type``, that of most values (a tie goes to the first of ``TYPES``)."""
    counts = [F.count_if(F.col("type") == t).alias(t) for t in TYPES]
    best = F.greatest(*[F.col(t) for t in TYPES])
    pick = F.coalesce(*[F.when(F.col(t) == best, F.lit(t)) for t in TYPES])
    return found.groupBy("stream", "file", "ord", "field").agg(F.count(F.lit(1)).alias("n"), *counts).withColumn("type", pick)


def neighbours(profile: DataFrame) -> DataFrame:
    """Each file but the first of its stream with the file before it, by ``ord`` (ties by name): ``stream, file, before``."""
    files = profile.select("stream", "file", "ord").distinct()
    w = W.partitionBy("stream").orderBy("ord", "file")
    return files.select("stream", "file", F.lag("file").over(w).alias("before")).where("before is not null")


def key_names(found: DataFrame, profile: DataFrame, key: str) -> list[str]:
    """The names that the key field goes by. Files without any known name are compared with the keyed file before or behind
    them: the field that shares most of its values with that file's keys, two at least and half of its own, is the key
    under another name. Only names come to the driver, one a round, as many as the key has."""
    names = [key]
    if profile.groupBy("stream", "file").agg(F.bool_or(F.col("field") == key).alias("keyed")).where("not keyed").isEmpty():
        return names
    files = profile.select("stream", "file", "ord").distinct()
    w = W.partitionBy("stream").orderBy("ord", "file")
    both = files.withColumns({"before": F.lag("file").over(w), "behind": F.lead("file").over(w)})
    beside = cut(both.select("stream", "file", F.explode(F.array("before", "behind")).alias("near")).where("near is not null"))
    while True:
        keyed = profile.where(F.col("field").isin(names)).select("stream", "file").distinct()
        bare = beside.join(keyed, ["stream", "file"], "left_anti").join(keyed.select("stream", F.col("file").alias("near")), ["stream", "near"], "left_semi")
        if bare.isEmpty():
            return names
        values = found.select("stream", "file", "field", F.trim("text").alias("text")).distinct()
        known = values.where(F.col("field").isin(names)).select("stream", F.col("file").alias("near"), "text", F.lit(1).alias("hit")).distinct()
        likely = bare.join(values, ["stream", "file"]).join(known, ["stream", "near", "text"], "left").groupBy("stream", "file", "near", "field").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("hits"))
        best = likely.where("hits >= 2 and hits * 2 >= n").groupBy("field").agg(F.sum("hits").alias("hits")).orderBy(F.desc("hits"), "field").first()
        if best is None:
            return names
        names.append(best.field)


def similarity(a: Column, b: Column) -> Column:
    """Name similarity from 0 to 1: one less the share of letters to change, case and underscores aside."""
    x, y = (F.regexp_replace(F.lower(c), "_", "") for c in (a, b))
    return 1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))


def presence(profile: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per neighbouring files, every field of either: ``stream, file, before, field, type, old_type`` (null where it lacks)."""
    new = pairs.join(profile.select("stream", "file", "field", "type"), ["stream", "file"])
    old = pairs.join(profile.select("stream", F.col("file").alias("before"), "field", F.col("type").alias("old_type")), ["stream", "before"])
    return new.join(old, ["stream", "file", "before", "field"], "full")


def sketches(found: DataFrame, of: DataFrame) -> DataFrame:
    """Fingerprints of the records' contents under the fields in ``of`` (stream, file, field and more): one row per row of
    ``of``, record and content, of the ``SKETCH`` records of the smallest hashes, which is bounded whatever a file holds.

    Where most contents of a file's field are numbers, or most are not, the others are strays and left out. Only cells of
    field names that changed somewhere go into the join; the names are as few as the schemas' vocabulary.
    """
    names = [r.field for r in of.select("field").distinct().collect()]
    few = of.count() <= BROADCAST_ROWS  # then no cell of another field is moved or read closely; else the join shuffles
    chosen = found.where(F.col("field").isin(names) & F.col("rec").isNotNull()).join(F.broadcast(of) if few else of, ["stream", "file", "field"]).select(*of.columns, "rec", "text")
    # written out, so that the filter on contents isn't pushed below the join and worked out for every cell of every file
    said = with_content(cut(chosen), {"says": "text"}).where("says is not null").select(*of.columns, "rec", F.xxhash64("says").alias("print"), F.col("says").rlike(r"^-?\d+(\.\d+)?$").alias("counts"))
    usual = said.groupBy(*of.columns).agg((F.avg(F.col("counts").cast("int")) >= 0.5).alias("numeric"))
    prints = said.join(usual, of.columns).where("counts = numeric").select(*of.columns, "rec", "print").distinct()
    place = F.dense_rank().over(W.partitionBy(*of.columns).orderBy(F.xxhash64("rec")))
    return prints.withColumn("_place", place).where(F.col("_place") <= SKETCH).drop("_place")


def rename_scores(found: DataFrame, changes: DataFrame) -> DataFrame:
    """For each field that ends and each that begins between two files: records in both, how many agree, likeness of names,
    whether the types are the same."""
    ended = changes.where("type is null").select("stream", "file", "before", "field")
    begun = changes.where("old_type is null").select("stream", "file", "before", "field")
    pair = ["stream", "file", "before"]
    old_of = ended.join(begun.select(*pair).distinct(), pair, "left_semi").select("stream", F.col("before").alias("file"), "field", F.col("file").alias("after"), F.lit(True).alias("old"))
    new_of = begun.join(ended.select(*pair).distinct(), pair, "left_semi").select("stream", "file", "field", F.col("file").alias("after"), F.lit(False).alias("old"))
    prints = cut(sketches(found, cut(old_of.unionByName(new_of))))
    o = prints.where("old").select("stream", F.col("after").alias("file"), F.col("field").alias("old_field"), "rec", F.col("print").alias("old_print"))
    n = prints.where("not old").select("stream", F.col("after").alias("file"), F.col("field").alias("new_field"), "rec", F.col("print").alias("new_print"))
    per_record = (
        o.join(n, ["stream", "file", "rec"])
        .groupBy("stream", "file", "old_field", "new_field", "rec")
        .agg(F.max((F.col("old_print") == F.col("new_print")).cast("int")).alias("agree"))
    )
    was = changes.where("type is null").select("stream", "file", F.col("field").alias("old_field"), "old_type")
    now = changes.where("old_type is null").select("stream", "file", F.col("field").alias("new_field"), "type")
    return (
        per_record.groupBy("stream", "file", "old_field", "new_field")
        .agg(F.count(F.lit(1)).alias("shared"), F.sum("agree").alias("agree"))
        .join(was, ["stream", "file", "old_field"])
        .join(now, ["stream", "file", "new_field"])
        .withColumns({"names": similarity(F.col("old_field"), F.col("new_field")), "types": (F.col("type") == F.col("old_type")).cast("double")})
    )


def assign(weights: list[list[float]]) -> list[int]:
    """Maximum-weight matching of rows to columns (shortest augmenting paths); -1 where a row stays alone, as with weight 0."""
    rows, cols = len(weights), max((len(r) for r in weights), default=0)
    n = max(rows, cols)
    top = max((x for r in weights for x in r), default=0.0)
    cost = [[top - (weights[i][j] if i < rows and j < len(weights[i]) else 0.0) for j in range(n)] for i in range(n)]
    u, v, owner = [0.0] * (n + 1), [0.0] * (n + 1), [n] * (n + 1)
    for i in range(n):
        owner[n], j0 = i, n
        least, back, used = [float("inf")] * n, [n] * n, [False] * (n + 1)
        while owner[j0] != n:
            used[j0] = True
            i0, delta, j1 = owner[j0], float("inf"), -1
            for j in range(n):
                if not used[j]:
                    reduced = cost[i0][j] - u[i0] - v[j]
                    if reduced < least[j]:
                        least[j], back[j] = reduced, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(n + 1):
                if used[j]:
                    u[owner[j]] += delta
                    v[j] -= delta
                elif j < n:
                    least[j] -= delta
            j0 = j1
        while j0 != n:
            owner[j0], j0 = owner[back[j0]], back[j0]
    match = [-1] * rows
    for j in range(n):
        i = owner[j]
        if i < rows and j < len(weights[i]) and weights[i][j] > 0:
            match[i] = j
    return match


RENAMES = T.StructType([T.StructField(n, T.StringType()) for n in ("stream", "file", "old_field", "new_field")])


def match_fields(scores: DataFrame, least_share: float, least_agree: int) -> DataFrame:
    """The matching of each pair of files. A pair of fields counts if at least ``least_agree`` shared records and
    ``least_share`` of them agree; more agreement weighs first, then the likeness of names, then the same type. One task holds the field pairs
    of two files, as many as the files have changed fields, and no values."""

    def match(group: pd.DataFrame) -> pd.DataFrame:
        old, new = sorted(set(group.old_field)), sorted(set(group.new_field))
        weights = [[0.0] * len(new) for _ in old]
        for r in group.itertuples():
            weights[old.index(r.old_field)][new.index(r.new_field)] = r.agree / r.shared + 0.001 * min(r.agree, 100) / 100 + 0.1 * r.names + 0.01 * r.types
        got = [(old[i], new[j]) for i, j in enumerate(assign(weights)) if j >= 0]
        return pd.DataFrame({"stream": group.stream.iloc[0], "file": group.file.iloc[0], "old_field": [a for a, _ in got], "new_field": [b for _, b in got]})

    likely = scores.where((F.col("agree") >= least_agree) & (F.col("agree") >= least_share * F.col("shared")))
    tasks = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = likely.select("stream", "file", "old_field", "new_field", "shared", "agree", "names", "types").repartition(tasks, "stream", "file")  # few bytes but much work a row, which sizes alone would put into one task
    return spread.groupBy("stream", "file").applyInPandas(match, RENAMES)


def drift(found: DataFrame, least_share: float = 0.7, least_agree: int = 2, key: str | None = None, again: Callable[[list[str]], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """All changes between neighbouring files of ``cells`` rows, and the renamings alone.

    With the ``key`` field and ``again``, which makes the cells for several key names, files that hold the key under
    another name are told by its values; without, such files show no renamings.

    Changes: ``stream, file_name, change_kind, field_name, old_name``; kinds ``renamed``, ``added``, ``removed`` and
    ``type_changed``; ``old_name`` is '' but for renamings. The first file of a stream shows none; an empty table gives none.
    """
    profile = cut(field_profile(found))
    if key and again and len(names := key_names(found, profile, key)) > 1:
        found = again(names)
    changes = cut(presence(profile, neighbours(profile)))
    renames = cut(match_fields(rename_scores(found, changes), least_share, least_agree))
    show = lambda df, kind, name, old=F.lit(""): df.select("stream", F.col("file").alias("file_name"), F.lit(kind).alias("change_kind"), name.alias("field_name"), old.alias("old_name"))
    gone = changes.where("type is null").join(renames, (changes.stream == renames.stream) & (changes.file == renames.file) & (changes.field == renames.old_field), "left_anti")
    come = changes.where("old_type is null").join(renames, (changes.stream == renames.stream) & (changes.file == renames.file) & (changes.field == renames.new_field), "left_anti")
    was = changes.select("stream", "file", F.col("field").alias("old_field"), F.col("old_type").alias("was"))
    now = changes.select("stream", "file", F.col("field").alias("new_field"), F.col("type").alias("now"))
    retyped = renames.join(was, ["stream", "file", "old_field"]).join(now, ["stream", "file", "new_field"]).where("was <> now")
    out = (
        show(renames, "renamed", F.col("new_field"), F.col("old_field"))
        .unionByName(show(gone, "removed", F.col("field")))
        .unionByName(show(come, "added", F.col("field")))
        .unionByName(show(changes.where("type <> old_type"), "type_changed", F.col("field")))
        .unionByName(show(retyped, "type_changed", F.col("new_field")))
    )
    return out, renames


def vocabulary(found: DataFrame, renames: DataFrame) -> dict[str, list[str]]:
    """The names of each concept over all files: ``{usual name: [its names]}``, single names left out.

    Renamings, strongest first, put names together, but never two names that one file has side by side. Only field names
    come to the driver, as many as the files' schemas hold, and never values.
    """
    links = renames.groupBy("old_field", "new_field").agg(F.count(F.lit(1)).alias("n")).collect()
    weight: dict[tuple[str, str], int] = {}
    for r in links:
        pair = tuple(sorted((r.old_field, r.new_field)))
        weight[pair] = weight.get(pair, 0) + r.n
    names = sorted({n for pair in weight for n in pair})
    if not names:
        return {}
    files = found.where(F.col("field").isin(names)).select("stream", "file", "field").distinct()
    sets = files.groupBy("stream", "file").agg(F.array_sort(F.collect_set("field")).alias("names")).groupBy("names").agg(F.count(F.lit(1)).alias("n")).collect()
    used = {n: sum(r.n for r in sets if n in r.names) for n in names}
    apart = {(a, b) for r in sets for a in r.names for b in r.names if a != b}
    group = {n: {n} for n in names}
    for (a, b), _ in sorted(weight.items(), key=lambda x: (-x[1], x[0])):
        if group[a] is not group[b] and not any((x, y) in apart for x in group[a] for y in group[b]):
            whole = group[a] | group[b]
            for n in whole:
                group[n] = whole
    out = {}
    for whole in {frozenset(g) for g in group.values() if len(g) > 1}:
        ordered = sorted(whole, key=lambda n: (-used[n], n))
        out[ordered[0]] = ordered
    return out


def unify(lines: DataFrame, payload: str, names: dict[str, list[str]], columns: dict[str, tuple[str, str]], keep: Sequence[str]) -> DataFrame:
    """One table of consistent columns from lines of any version: the columns ``keep`` and one per entry of ``columns``,
    ``{output column: (usual name, type)}`` with type text, number, day or flag, and ``other_fields``, the rest as a map.

    A value that doesn't fit its type (a stray text) becomes null; a line that isn't an object keeps its row with nulls.
    No shuffle: each line is rewritten where it stands.
    """
    fields = F.from_json(F.col(payload), T.MapType(T.StringType(), T.StringType()))
    base = lines.select(*keep, fields.alias("_m"))
    known = {name: names.get(usual, [usual]) for name, (usual, _) in columns.items()}
    texts = base.select("*", *[F.coalesce(*[F.col("_m")[n] for n in of]).alias(name) for name, of in known.items()])
    said = with_content(texts, {f"_said_{name}": name for name, (_, kind) in columns.items() if kind in {"number", "flag"}})

    def typed(name: str, kind: str) -> Column:
        text, says = F.col(name), F.col(f"_said_{name}")
        if kind == "text":
            return blank_to_null(text)
        if kind == "day":
            return day(text)
        if kind == "number":
            return F.when(says.rlike(r"^-?\d+(\.\d+)?$"), says.try_cast("double"))
        return F.when(says == "1", True).when(says == "0", False)

    taken = [n for of in known.values() for n in of]
    rest = F.map_filter("_m", lambda k, v: ~k.isin(taken) & v.isNotNull())
    return said.select(*keep, *[typed(name, kind).alias(name) for name, (_, kind) in columns.items()], rest.alias("other_fields"))
