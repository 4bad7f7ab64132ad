"""Deterministic keys: canonical records, surrogate ids, keyed pseudonyms, content hashes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jangbu.functions.cleaning import business_number, valid_business_number
from jangbu.functions.text import trimmed

NULL_MARK = "__NULL__"


def text_part(value: Column | str) -> Column:
    """Trimmed text; blank and null become the null mark."""
    return F.coalesce(F.nullif(trimmed(F.col(value).cast("string") if isinstance(value, str) else value), F.lit("")), F.lit(NULL_MARK))


def fixed_part(value: Column | str, places: int) -> Column:
    """A number with so many places, ties to even on its decimal text; null and NaN become the null mark."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.coalesce(F.bround(F.when(~F.isnan(v), v).cast(f"decimal(38,{places + 12})"), places).cast(f"decimal(38,{places})").cast("string"), F.lit(NULL_MARK))


def canonical_record(fields: Mapping[str, Column]) -> Column:
    """JSON with sorted keys and no spaces; nulls stay out of it, so pass parts that have a mark for them."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def record_id(prefix: str, fields: Mapping[str, Column]) -> Column:
    """``prefix`` and the first 32 hex digits of the canonical record's SHA-256."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(canonical_record(fields), 256), 1, 32))


def submission_id(supplier: Column) -> Column:
    """Key of a submitted bid, from what makes it one."""
    return record_id("BID_", {
        "entity": F.lit("bid_submission"), "version": F.lit(1),
        "bid_notice_no": text_part("bid_notice_no"), "bid_notice_round": text_part("bid_notice_round"), "bidder_supplier_id": text_part(supplier),
        "opening_rank": fixed_part("opening_rank", 0), "disqualification_reason": text_part("disqualification_reason_ko"),
        "bid_amount_krw": fixed_part("bid_amount_krw", 2), "bid_submission_time": text_part("bid_submission_time"),
    })


def outcome_id(supplier: Column) -> Column:
    """Key of a selected award."""
    return record_id("AWD_", {
        "entity": F.lit("award_outcome"), "version": F.lit(1),
        "bid_notice_no": text_part("bid_notice_no"), "bid_notice_round": text_part("bid_notice_round"), "winner_supplier_id": text_part(supplier),
        "award_amount_krw": fixed_part("award_amount_krw", 2), "bid_submission_time": text_part("bid_submission_time"),
    })


def pads(key: bytes) -> tuple[str, str]:
    """Inner and outer pad of an HMAC-SHA256 key, in hex."""
    if not isinstance(key, bytes):
        raise TypeError("the pseudonym key must be bytes")
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex()


def keyed_hash(value: Column, key: bytes) -> Column:
    """HMAC-SHA256 of a text, in hex, made of SHA-256 expressions, so it runs in generated code."""
    inner, outer = pads(key)
    first = F.sha2(F.concat(F.unhex(F.lit(inner)), F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)


def supplier_pseudonym(number: Column | str, key: bytes, prefix: str = "SUP_") -> Column:
    """A supplier's public id from its business number; an empty text for an invalid one."""
    return F.when(valid_business_number(number), F.concat(F.lit(prefix), F.substring(keyed_hash(business_number(number), key), 1, 32))).otherwise("")


def content_hash(df: DataFrame) -> DataFrame:
    """One row that tells tables with other rows or counts apart, whatever the order: ``rows, content``."""
    cells = F.struct(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(cells).cast("decimal(38,0)")).cast("string").alias("content"))


def page_receipt(items: list[dict]) -> dict[str, str | int | None]:
    """Hashes of a page's first, last and all records."""
    texts = [json.dumps(i, sort_keys=True, ensure_ascii=False, separators=(",", ":")) for i in items]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {"page_row_count": len(items), "first_record_hash": sha(texts[0]) if texts else None, "last_record_hash": sha(texts[-1]) if texts else None, "page_hash": sha("\n".join(texts)) if texts else None}
