"""Column-level data quality profile.

One shuffle brings a table's columns to distinct values with counts; all else is derived from that: standard aggregates,
the column expression (regular expressions chosen by minimum description length over all distinct values), rows that
don't conform, and how coverage, null rates and medians differ between loads.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from jangbu.operators.selection import exact_quantiles
from jangbu.session import cut

#: Bits to state one character of a class, one that is no letter or digit, one element of an expression, one length.
BITS = {"9": 3.32, "A": 4.70, "a": 4.70, "가": 13.45}
OTHER_BITS, ELEMENT_BITS, LENGTH_BITS = 6.57, 8.0, 4.0
#: Bits that mark a value as nonconforming: one in twenty. Runs of a shape whose least and greatest lengths are stated.
ESCAPE_BITS, SPANS = 4.32, 6
#: Bits that an alternative costs beside its elements, so that none pays for a single odd value; and the distinct values from
#: which on alternatives cost in proportion to the column's, so that an expression is as long for a large table as for a part of it.
ALTERNATIVE_BITS, PRICED_AT = 24.0, 500
#: Seven and more times the same digit: fewer bits than any number of that length, so no expression of numbers vouches for it.
ONE_DIGIT = r"^-?([0-9])\1{6,}$"


def numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _text(df: DataFrame, name: str) -> Column:
    """A value as text; floating numbers in plain notation where that is exact."""
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.cast("string")
    size = F.abs(c)
    plain = F.regexp_replace(F.when((size < 1e19) & ((size >= 1e-3) | (size == 0)), c).cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    return F.coalesce(F.when(size == 0, c.cast("string")), plain, c.cast("string"))


def value_counts(df: DataFrame, columns: list[str], load: str | None = None) -> DataFrame:
    """``column_name, load, value, n``: each column's distinct values as text, with row counts per load (null value: nulls)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _text(df, c).alias("value")) for c in columns]))
    tag = (F.col(load) if load else F.lit(None)).cast("string").alias("load")
    return df.select(tag, pairs.alias("p")).select("load", "p.*").groupBy("column_name", "load", "value").agg(F.count(F.lit(1)).alias("n"))


def aggregates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: ``rows, nulls, blanks, distinct_values, low_text, high_text, low, high``.

    ``low``/``high`` are of finite numbers and null for other columns, the texts of text columns and null for others. Blank
    is white space only. Distinct counts are exact; null is no value.
    """
    counts = value_counts(df, columns)
    kinds = {f.name: numeric(f) for f in df.schema.fields}
    number = F.col("column_name").isin([c for c in columns if kinds[c]]) if any(kinds[c] for c in columns) else F.lit(False)
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    text = F.col("column_name").isin(texts) if texts else F.lit(False)
    as_number = F.when(number, F.col("value").try_cast("double"))
    finite = F.when(~F.isnan(as_number) & (F.abs(as_number) < float("inf")), as_number)
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.col("value").rlike(r"^(?U)\s*$"), F.col("n")).otherwise(0)).alias("blanks"),
        F.count("value").alias("distinct_values"),
        F.min(F.when(text, F.col("value"))).alias("low_text"),
        F.max(F.when(text, F.col("value"))).alias("high_text"),
        F.min(finite).alias("low"),
        F.max(finite).alias("high"),
    )


def shape(value: Column) -> Column:
    """Each character by its class: 9 digits, A and a Latin letters, 가 Hangul; others stand for themselves."""
    latin = F.translate(value, digits + ascii_uppercase + ascii_lowercase, "9" * 10 + "A" * 26 + "a" * 26)
    return F.when(latin.rlike("[가-힣]"), F.regexp_replace(latin, "[가-힣]", "가")).otherwise(latin)


_NAMES = {"9": "[0-9]", "A": "[A-Z]", "a": "[a-z]", "가": "[가-힣]"}
_SPECIAL = r"([\\\^\$\.\|\?\*\+\(\)\[\]\{\}])"
_ANY = "0-9A-Za-z가-힣"
#: A value that begins and ends with something to be seen; the coarsest form.
_SEEN = r"(?U)^\S(?:(?s).*\S)?$"


def _escaped(c: Column) -> Column:
    return F.regexp_replace(c, _SPECIAL, r"\\$1")


def _levels(exact: Column) -> list[Column]:
    """A shape's ever coarser forms: as it is; runs of a class as one; letters of all scripts as words; which separators
    stand between letters and digits; whether it begins and ends with something to be seen."""
    runs = F.regexp_replace(exact, "(9|A|a|가)\\1+", "$1")
    words = F.regexp_replace(runs, "[Aa가]+", "w")
    marks = F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace(words, "[9w]", ""), ""))), "")
    seen = F.when(exact.rlike(r"(?U)^\S(?:(?s).*\S)?$"), "x").otherwise("")
    return [exact, runs, words, marks, seen]


def _regex(level: int, form: Column, low: Column | None = None, high: Column | None = None, spans: Column | None = None) -> Column:
    """A form as a regular expression. Of the finest the values that are all the same stand as they are."""
    if level == 4:
        return F.lit(_SEEN)
    if level == 3:
        inside = F.concat(F.lit(f"[{_ANY}"), F.regexp_replace(form, r"([\\\^\-\[\]&~])", r"\\$1"), F.lit("]+"))
        return F.when(F.col("f4") == "x", F.concat(F.lit(r"(?U)^(?=\S)"), inside, F.lit(r"(?<=\S)$"))).otherwise(F.concat(F.lit("^"), inside, F.lit("$")))
    runs = F.regexp_extract_all(form, F.lit("(9+|A+|a+|가+|w+|(?s).)"), F.lit(1))

    def one(run: Column, i: Column) -> Column:
        head = F.substring(run, 1, 1)
        if level == 0:
            count = F.when(F.length(run) == 1, "").otherwise(F.concat(F.lit("{"), F.length(run).cast("string"), F.lit("}")))
        else:
            count = F.coalesce(F.get(spans, i), F.lit("+")) if spans is not None else F.lit("+")
        out = _escaped(run)
        for c, name in (_NAMES | ({"w": "[A-Za-z가-힣]"} if level == 2 else {})).items():
            out = F.when(head == c, F.concat(F.lit(name), count)).otherwise(out)
        return out

    whole = F.concat_ws("", F.transform(runs, one))
    if level == 0:
        whole = F.coalesce(F.when(low == high, _escaped(low)), whole)
    return F.concat(F.lit("^"), whole, F.lit("$"))


def induce(counts: DataFrame) -> DataFrame:
    """The shapes that make each column's expression: ``column_name, exact, pattern, distinct_values, rows``, a row per shape
    with the alternative that covers it.

    Two-part description length over all distinct values. A shape lies in a tree of ever coarser forms (``_levels``). Under a
    form a value costs the bits that the form leaves open (characters within their classes, lengths of runs, classes of
    letters, separators) and those that tell the form among all; the form itself costs its elements once per ``PRICED_AT`` values. From the leaves up each
    form is taken, or split into the forms below it, or left out, whichever is shortest: left out, values are spelt out
    freely, by the classes' shares in the column, with a mark that they don't conform. So neighbouring shapes merge as
    soon as telling them apart costs more than what it saves, over the whole column. Every choice is a sum over a form, made
    by counts that shrink from level to level, so no column is gathered anywhere.
    """
    values = counts.where("value is not null").groupBy("column_name", "value").agg(F.sum("n").alias("n"))
    exact = values.groupBy("column_name", shape(F.col("value")).alias("exact")).agg(
        F.count(F.lit(1)).alias("d"), F.sum("n").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    length = lambda c: F.length(c).cast("double")
    of_class = {c: length(F.col("exact")) - length(F.replace(F.col("exact"), F.lit(c), F.lit(""))) for c in BITS}
    classes = [f"c{i}" for i in range(len(BITS))]
    exact = exact.withColumns({f"f{i}": f for i, f in enumerate(_levels(F.col("exact")))} | dict(zip(classes, of_class.values(), strict=True)))
    exact = cut(exact.withColumn("c4", length(F.col("exact")) - sum((F.col(c) for c in classes[1:]), F.col(classes[0]))))  # read by each level
    classes.append("c4")
    total = [F.sum(F.col(c) * F.col("d")) for c in classes]
    among = lambda ids: {i: F.log2(F.greatest(sum((total[j] for j in ids[1:]), total[ids[0]]) / F.greatest(total[i], F.lit(1.0)), F.lit(1.0))) for i in ids}
    naming = {"w": among([1, 2, 3]), "x": among([0, 1, 2, 3]), "y": among([0, 1, 2, 3, 4])}
    per_column = exact.groupBy("column_name").agg(F.sum("d").alias("dc"), *[b.alias(f"{k}{i}") for k, bits in naming.items() for i, b in bits.items()])  # a row per column of the table
    each = lambda k, ids: sum((F.col(f"c{i}") * F.col(f"{k}{i}") for i in ids[1:]), F.col(f"c{ids[0]}") * F.col(f"{k}{ids[0]}"))
    known = sum((F.col(f"c{i}") * b for i, b in enumerate(list(BITS.values())[1:], 1)), F.col("c0") * list(BITS.values())[0])
    runs = [length(F.regexp_replace(F.col(f"f{i}"), "[^9Aa가w]", "")) for i in (1, 2)]
    free = known + F.col("c4") * OTHER_BITS + each("y", [0, 1, 2, 3, 4]) + 2 * LENGTH_BITS
    one_of = length(F.col("f3"))  # separators to choose from
    #: bits of one value of the shape under its form of each level, and of what each form costs once
    under = [known, known + runs[0] * LENGTH_BITS, known + runs[1] * LENGTH_BITS + each("w", [1, 2, 3]), known + each("x", [0, 1, 2, 3]) + F.col("c4") * F.log2(F.greatest(one_of, F.lit(1.0))) + (F.col("c4") + 1) * LENGTH_BITS, free]
    marks = F.col("c4") * (ELEMENT_BITS + OTHER_BITS)
    once = [runs[0] * (ELEMENT_BITS + LENGTH_BITS) + marks, runs[0] * ELEMENT_BITS + marks, runs[1] * ELEMENT_BITS + marks, (one_of + 1) * (ELEMENT_BITS + OTHER_BITS), F.lit(2 * ELEMENT_BITS)]
    told = lambda d: d * F.log2(F.col("dc") / d)  # noqa: E731  which alternative each of d values is of
    arr = F.transform(F.regexp_extract_all(F.col("exact"), F.lit("(9+|A+|a+|가+|(?s).)"), F.lit(1)), lambda r: F.length(r))
    base = exact.join(F.broadcast(per_column), "column_name").withColumns({"lengths": F.when(runs[0] + F.col("c4") <= SPANS, arr), **{f"u{i}": u * F.col("d") for i, u in enumerate(under)}, **{f"o{i}": (o + ALTERNATIVE_BITS) * F.greatest(F.lit(1.0), F.col("dc") / PRICED_AT) for i, o in enumerate(once)}})
    left_out = F.col("u4") + F.col("d") * ESCAPE_BITS
    d = F.col("d").cast("double")
    own = F.col("u0") + F.col("o0") + told(d)
    low_level = base.withColumns({"best": F.least(own, left_out), "how": F.when(own < left_out, "own").otherwise("out")})
    tables = [low_level]
    for i in range(1, 5):
        forms = [f"f{j}" for j in range(i, 5)]
        sums = [F.sum(c).alias(c) for c in ["d", "best", *[f"u{j}" for j in range(i, 5)]]]
        tops = [F.max(f"o{j}").alias(f"o{j}") for j in range(i, 5)]
        spans = [F.array(*[F.min(F.get("lengths", F.lit(k))) for k in range(SPANS)]).alias("least"), F.array(*[F.max(F.get("lengths", F.lit(k))) for k in range(SPANS)]).alias("most")] if i == 1 else []
        up = tables[-1].groupBy("column_name", "dc", *forms).agg(*sums, *tops, *spans)
        own = F.col(f"u{i}") + F.col(f"o{i}") + told(F.col("d").cast("double"))
        may = F.col("f4") == "x" if i == 4 else F.lit(True)
        least = F.least(F.when(may, own), left_out, F.col("best"))
        tables.append(up.withColumn("how", F.when(may & (own <= least), "own").when(F.col("best") <= least, "split").otherwise("out")).withColumn("best", least))
    # from the top down, the first form that isn't split decides
    down = tables[4].select("column_name", "f4", F.when(F.col("how") == "own", _regex(4, F.col("f4"))).alias("pattern"), (F.col("how") != "split").alias("settled"))
    for i in range(3, -1, -1):
        span = F.transform(F.arrays_zip("least", "most"), lambda x: F.when(x["least"] == x["most"], F.when(x["least"] == 1, "").otherwise(F.concat(F.lit("{"), x["least"].cast("string"), F.lit("}")))).otherwise(F.concat(F.lit("{"), x["least"].cast("string"), F.lit(","), x["most"].cast("string"), F.lit("}")))) if i == 1 else None
        mine = _regex(i, F.col(f"f{i}"), F.col("low") if i == 0 else None, F.col("high") if i == 0 else None, span)
        here = tables[i].withColumn("mine", F.when(F.col("how") == "own", mine))
        extra = ["exact", F.col("d").alias("distinct_values"), "rows"] if i == 0 else []
        down = here.join(down, ["column_name", f"f{i + 1}"]).select("column_name", f"f{i}", *extra, F.when(F.col("settled"), F.col("pattern")).otherwise(F.col("mine")).alias("pattern"), (F.col("settled") | (F.col("how") != "split")).alias("settled"))
    return down.where("pattern is not null").select("column_name", "exact", "pattern", "distinct_values", "rows")


def patterns(induced: DataFrame) -> DataFrame:
    """The column expressions: one row per column and alternative."""
    return induced.groupBy("column_name", "pattern").agg(F.sum("distinct_values").alias("distinct_values"), F.sum("rows").alias("rows"))


def expressions(induced: DataFrame) -> dict[str, str]:
    """Each column's whole expression. Only alternatives come to the driver, as few as pay for themselves, and no values."""
    found = induced.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_set("pattern")), "|").alias("expression")).collect()
    return {r.column_name: r.expression for r in found}


def conforms(value: Column, column: Column, of: dict[str, str]) -> Column:
    """Whether a value matches its column's expression; a column without one has none that does. Null stays null."""
    out = F.when(value.isNull(), F.lit(None).cast("boolean"))
    for name, expression in of.items():
        out = out.when(column == name, value.rlike(expression))
    return out.otherwise(False)


def coverage(counts: DataFrame, of: dict[str, str]) -> DataFrame:
    """Per column and load: ``rows, nulls, conforming, nonconforming, coverage, null_rate`` and the change of the last two
    against the load before it, for the columns' ``expressions``.

    Coverage is the share of non-null rows that some alternative of the column's expression matches; null without rows.
    """
    fits = conforms(F.col("value"), F.col("column_name"), of)
    per_load = counts.groupBy("column_name", "load").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.when(fits, F.col("n")).otherwise(0)).alias("conforming"),
    )
    full = F.col("rows") - F.col("nulls")
    out = per_load.withColumns({"nonconforming": full - F.col("conforming"), "coverage": F.try_divide("conforming", full), "null_rate": F.col("nulls") / F.col("rows")})
    before = W.partitionBy("column_name").orderBy("load")
    return out.withColumns({"coverage_change": F.col("coverage") - F.lag("coverage").over(before), "null_change": F.col("null_rate") - F.lag("null_rate").over(before)})


@dataclass(frozen=True)
class Checked:
    """A numeric column under watch: its stated range ``low`` to ``high`` (``high`` itself, and with ``open_low`` also ``low``, is
    out), the rule for wrong values, and the name of a row.

    ``bad`` decides among suspects alone: values that aren't in the column's induced expression, are out of range, or repeat
    one digit. A value that is none of these passes, whatever the rule.
    """

    table: str
    column: str
    bad: Callable[[Column], Column]
    case_key: Column
    load: str
    low: float
    high: float
    open_low: bool = False

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}"

    def out_of_range(self, v: Column) -> Column:
        inside = (v > self.low if self.open_low else v >= self.low) & (v < self.high) & ~F.isnan(v)
        return ~F.coalesce(inside, F.lit(False))

    def wrong(self, text: Column, v: Column, of: dict[str, str]) -> Column:
        fits = text.rlike(of[self.name]) if self.name in of else F.lit(False)
        return (~fits | self.out_of_range(v) | text.rlike(ONE_DIGIT)) & F.coalesce(self.bad(v), F.lit(False))


def _decided(checks: Sequence[Checked], of: dict[str, str], text: Column, v: Column) -> Column:
    out = F.when(F.lit(False), F.lit(False))
    for c in checks:
        out = out.when(F.col("column_name") == c.name, c.wrong(text, v, of))
    return out.otherwise(False)


def _texts(tables: Mapping[str, DataFrame], checks: Sequence[Checked]) -> DataFrame:
    """``column_name, load, text, v, case_key`` of every row and column under watch."""
    parts = []
    for t in dict.fromkeys(c.table for c in checks):
        df, own = tables[t], [c for c in checks if c.table == t]
        each = [F.struct(F.lit(c.name).alias("column_name"), F.col(c.load).cast("string").alias("load"), _text(df, c.column).alias("text"), F.col(c.column).cast("double").alias("v"), c.case_key.cast("string").alias("case_key")) for c in own]
        parts.append(df.select(F.explode(F.array(*each)).alias("x")).select("x.*"))
    return reduce(DataFrame.unionByName, parts)


def suspects(tables: Mapping[str, DataFrame], checks: Sequence[Checked]) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """(rows with a wrong value and what gave them away: ``column_name, case_key, off_expression, off_range, one_digit``; the
    columns' distinct values per load; their expressions)."""
    rows = _texts(tables, checks)
    counts = cut(rows.groupBy("column_name", "load", F.col("text").alias("value")).agg(F.count(F.lit(1)).alias("n")))
    of = expressions(induce(counts))
    off = F.when(F.lit(False), F.lit(False))
    for c in checks:
        off = off.when(F.col("column_name") == c.name, c.out_of_range(F.col("v")))
    wrong = rows.where(F.col("text").isNotNull() & _decided(checks, of, F.col("text"), F.col("v")))
    return wrong.select("column_name", "case_key", (~conforms(F.col("text"), F.col("column_name"), of)).alias("off_expression"), off.alias("off_range"), F.col("text").rlike(ONE_DIGIT).alias("one_digit")), counts, of


def violations(tables: Mapping[str, DataFrame], checks: Sequence[Checked], most_nulls: float, most_shift: float) -> DataFrame:
    """``table_name, column_name, issue, case_key``: rows with a wrong value, loads with too many nulls, loads whose median is
    ``most_shift`` times off that of the whole column, wrong values and nulls left out. Each case once.

    One pass counts the distinct values of all columns per load, and all but the rows comes from these counts: the induced
    expressions, nulls and coverage per load, medians (exact, by refined histograms over the counts). A second pass reads
    the rows for values that don't fit their expression or range. Rows count as delivered, repeats too. A null load is
    none. A load without clean values has no median and doesn't shift. Empty tables have no cases.
    """
    wrong, counts, of = suspects(tables, checks)
    known = {c.name: (c.table, c.column) for c in checks}
    part = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in known.items() for x in (k, v[i])]), F.col("column_name"))
    say = lambda rows, issue, key: rows.select(part(0).alias("table_name"), part(1).alias("column_name"), F.lit(issue).alias("issue"), F.col(key).alias("case_key"))
    empty = coverage(counts, of).where(F.col("load").isNotNull() & (F.col("nulls") >= F.col("rows") * most_nulls))
    v = F.col("value").try_cast("double")
    clean = counts.where(F.col("value").isNotNull() & ~_decided(checks, of, F.col("value"), v)).select("column_name", "load", v.alias("v"), "n")
    both = clean.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("whole")).where("whole or load is not null").withColumn("load", F.when(~F.col("whole"), F.col("load")))
    medians = cut(exact_quantiles(both.withColumnRenamed("n", "_n"), ["column_name", "whole", "load"], "v", [0.5], weight="_n").select("column_name", "whole", "load", F.col("value").alias("median")))
    usual = medians.where("whole").select("column_name", F.col("median").alias("usual"))  # a row per column under watch
    shifted = medians.where("not whole").join(F.broadcast(usual), "column_name").where((F.col("median") * most_shift < F.col("usual")) | (F.col("median") > F.col("usual") * most_shift))
    return say(wrong, "bad_value", "case_key").distinct().unionByName(say(empty, "load_nulls", "load")).unionByName(say(shifted, "load_shift", "load"))
