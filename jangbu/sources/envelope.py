"""Response envelopes in JSON and XML, parsed on the JVM: items, total, code, message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ITEM = "map<string,string>"


def _text(root: Column, path: str) -> Column:
    return F.get_json_object(root, path)


def from_json_envelope(df: DataFrame, payload: str) -> DataFrame:
    """Adds ``items`` (array of maps), ``total``, ``code``, ``message``, ``fault``.

    ``response`` around header and body is optional; ``items`` may be a list, one record, ``{item: list or record}`` or
    null; a total that isn't a whole number becomes the number of items. ``fault`` says what is wrong with the payload
    (not an object, neither response nor header, items of another shape), else null; such a row has no items.
    """
    doc = F.try_parse_json(F.col(payload))
    kind = F.schema_of_variant(doc)
    whole = F.col(payload)
    root = F.coalesce(_text(whole, "$.response"), whole)
    raw = F.trim(F.coalesce(_text(root, "$.body.items.item"), _text(root, "$.body.items"), F.lit("[]")))
    as_list = F.when(raw.startswith("["), raw).when(raw.startswith("{"), F.concat(F.lit("["), raw, F.lit("]"))).when(raw == "null", "[]")
    items = F.coalesce(F.from_json(as_list, f"array<{_ITEM}>"), F.array().cast(f"array<{_ITEM}>"))
    stated = _text(root, "$.body.totalCount").try_cast("long")
    fault = (
        F.when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), "not an object")
        .when(_text(whole, "$.response").isNull() & _text(whole, "$.header").isNull(), "neither response nor header")
        .when(as_list.isNull(), "items of another shape")
    )
    return df.withColumn("fault", fault).withColumns({
        "items": F.when(F.col("fault").isNull(), items).otherwise(F.array().cast(f"array<{_ITEM}>")),
        "code": F.coalesce(_text(root, "$.header.resultCode"), F.lit("")),
        "message": F.coalesce(_text(root, "$.header.resultMsg"), F.lit("")),
    }).withColumn("total", F.coalesce(stated, F.size("items").cast("long")))


_XML = T.StructType([
    T.StructField("cmmMsgHeader", T.StructType([T.StructField(n, T.StringType()) for n in ("errMsg", "returnAuthMsg", "returnReasonCode")])),
    T.StructField("header", T.StructType([T.StructField(n, T.StringType()) for n in ("resultCode", "resultMsg")])),
    T.StructField("body", T.StructType([T.StructField("totalCount", T.StringType()), T.StructField("items", T.StructType([T.StructField("item", T.ArrayType(T.MapType(T.StringType(), T.StringType())))]))])),
])


def from_xml_envelope(df: DataFrame, payload: str) -> DataFrame:
    """The same columns from XML: an error header gives its code and no items; a text that isn't XML is a fault."""
    x = F.from_xml(F.col(payload), _XML, {"mode": "PERMISSIVE"})
    error = F.col("_x.cmmMsgHeader")
    items = F.coalesce(F.col("_x.body.items.item"), F.array().cast(f"array<{_ITEM}>"))
    known = error.isNotNull() | F.col("_x.header").isNotNull() | F.col("_x.body").isNotNull()
    return df.withColumn("_x", x).withColumns({
        "fault": F.when(~F.coalesce(known, F.lit(False)), "not an envelope"),
        "items": items,
        "code": F.coalesce(F.trim(error["returnReasonCode"]), F.trim("_x.header.resultCode"), F.lit("")),
        "message": F.coalesce(F.trim(error["returnAuthMsg"]), F.trim(error["errMsg"]), F.trim("_x.header.resultMsg"), F.lit("")),
        "total": F.coalesce(F.nullif(F.col("_x.body.totalCount").try_cast("long"), F.lit(0)), F.size(items).cast("long")),
    }).drop("_x")
