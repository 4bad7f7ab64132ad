"""The records of each agency, and what survives of them (problem 4)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.functions.text import compact, trimmed
from jangbu.llm.survivors import survivors
from jangbu.session import cut

#: Texts that stand for a missing name (fixed values).
PLACEHOLDERS = ("", "-", "--", ".", "?", "N/A", "NA", "#N/A", "NAN", "NULL", "NONE", "미상", "미정", "불명", "없음", "해당없음", "알수없음")
WIDE, PLAIN = "０１２３４５６７８９Ｂ－．", "0123456789B-."


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility composition; the JVM's functions have none."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def code_key(code: Column) -> Column:
    """The agency that a code in any spelling means: seven characters; null where there is none.

    Wide digits, hyphens, white space, case and a zero fraction don't matter; lost leading zeros are put back.
    """
    plain = F.upper(F.translate(trimmed(code), WIDE, PLAIN))
    plain = F.regexp_replace(F.regexp_replace(plain, r"\.0+$", ""), r"[^0-9A-Z]", "")
    return F.when(F.length(plain) > 0, F.lpad(plain, F.greatest(F.length(plain), F.lit(7)), F.lit("0")))


def proper_code(code: Column) -> Column:
    """Seven characters with nothing around them: digits only, or B and six digits."""
    return code.rlike(r"\A([0-9]{7}|B[0-9]{6})\z")


def proper_name(name: Column) -> Column:
    """Neither blank nor a placeholder, nor cut off, nor garbled."""
    bare = compact(name)
    return bare.isNotNull() & ~F.upper(bare).isin(*PLACEHOLDERS) & ~bare.rlike(r"(…|\.\.+)$") & ~bare.contains("�")


def members(records: DataFrame) -> DataFrame:
    """Records with ``agency``, the agency each belongs to, and ``norm_name``. A record without a code belongs to the
    agency whose coded records bear its name; where none or several do, it belongs to none and falls away."""
    known = records.select("*", code_key(F.col("agency_code")).alias("key"), F.when(proper_name(F.col("agency_name_ko")), compact(nfkc(F.col("agency_name_ko")))).alias("norm_name"))
    named = known.where("key is not null and norm_name is not null").groupBy("norm_name").agg(F.min("key").alias("owner"), F.max("key").alias("other")).where("owner = other")
    coded = known.where("key is not null").withColumn("agency", F.col("key"))
    bare = known.where("key is null").join(named.select("norm_name", "owner"), "norm_name").withColumn("agency", F.col("owner"))
    return coded.unionByName(bare.select(*coded.columns))


#: A month's weight against the month before, and the weight of a record of the feed that counts least.
MONTHLY, LEAST_TRUST = 3.0, 1e-6


def agency_survivors(records: DataFrame, monthly: float = MONTHLY, least_trust: float = LEAST_TRUST) -> DataFrame:
    """``agency, field_name, norm, best`` for every agency with at least two records.

    Each record with a proper value votes. Its weight grows by ``monthly`` per month within its agency, so recent wordings
    lead, yet several records of the months before outvote one of the last, and a wording that nobody else shares in its
    places loses them. Records of bidder_report weigh ``least_trust`` of the others. Among the records that carry the
    surviving value those of other feeds come first, then later months, then smaller record ids.
    """
    rows = cut(members(records))
    month = F.regexp_replace(F.coalesce(trimmed("source_month"), F.lit("")), r"[^0-9]", "").try_cast("int")
    count = F.coalesce(F.floor(month / 100) * 12 + month % 100, F.lit(0))
    groups = rows.groupBy("agency").agg(F.count(F.lit(1)).alias("size"), F.max(count).alias("last")).where("size > 1").select("agency", "last")
    untrusted = F.coalesce(trimmed("source_feed"), F.lit("")) == "bidder_report"
    base = rows.join(groups, "agency").select(
        "agency",
        "agency_code",
        "agency_name_ko",
        "norm_name",
        untrusted.cast("int").alias("untrusted"),
        (-count).alias("age"),
        "record_id",
        (F.pow(F.lit(float(monthly)), F.greatest(count - F.col("last"), F.lit(-240))) * F.when(untrusted, least_trust).otherwise(1.0)).alias("weight"),
    )
    codes = base.where(proper_code(F.col("agency_code"))).withColumns({"field_name": F.lit("agency_code"), "norm": F.col("agency_code")})
    names = base.where("norm_name is not null").withColumns({"field_name": F.lit("agency_name_ko"), "norm": F.col("norm_name")})
    prefer = [F.col("untrusted"), F.col("age"), F.col("record_id")]
    return survivors(codes.unionByName(names), "agency", F.col("weight"), prefer)
