"""Queries on the drift of contract files (problem 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.operators.drift import cells, drift, field_profile, unify, vocabulary
from jangbu.session import table

KEY = "untyCntrctNo"
#: Output column: the field's usual name in the files, and its type.
COLUMNS = {
    "unified_contract_no": (KEY, "text"),
    "contract_title_ko": ("cntrctNm", "text"),
    "contract_date": ("cntrctCnclsDate", "day"),
    "contract_method_ko": ("cntrctCnclsMthdNm", "text"),
    "contract_agency_code": ("cntrctInsttCd", "text"),
    "is_joint_contract": ("cmmnCntrctYn", "flag"),
    "contract_amount_krw": ("cntrctAmt", "number"),
    "total_contract_amount_krw": ("ttalCntrctAmt", "number"),
}


def contract_cells(spark: SparkSession, sf_dir: str, keys: str | list[str] = KEY) -> DataFrame:
    return cells(table(spark, sf_dir, "contract_files"), "stream_code", "file_name", "window_start", "payload", keys, "line_no")


def _drift(spark: SparkSession, sf_dir: str, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    return drift(found, key=KEY, again=lambda keys: contract_cells(spark, sf_dir, keys))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change once, between a file and the one before it in its stream."""
    changes, _ = _drift(spark, sf_dir, contract_cells(spark, sf_dir))
    return changes.drop("stream")


def p3_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as delivered, under one set of typed columns; the other fields as one JSON text."""
    found = contract_cells(spark, sf_dir)
    _, renames = _drift(spark, sf_dir, found)
    names = vocabulary(found, renames)
    lines = table(spark, sf_dir, "contract_files")
    out = unify(lines, "payload", names, COLUMNS, ["stream_code", "file_name", "line_no", "collected_at"])
    rest = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("other_fields"))))
    return out.withColumn("other_fields", rest)


def p3_field_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file's fields with the counts of their JSON types and the type of most values."""
    profile = field_profile(contract_cells(spark, sf_dir))
    return profile.select("stream", "file", "field", "n", "text", "integer", "decimal", "boolean", "object", "type")


QUERIES = {"p3_found": p3_found, "p3_unified": p3_unified, "p3_field_types": p3_field_types}
SQL = {
    "p3_field_types": """
with lines as (select stream_code, file_name, payload from contract_files where json_valid(payload) and json_type(payload) = 'OBJECT'),
fields as (select stream_code, file_name, payload, unnest(json_keys(payload)) as field from lines),
kinds as (
  select stream_code as stream, file_name as file, field,
    case json_type(payload, '$."' || field || '"')
      when 'VARCHAR' then 'text' when 'BIGINT' then 'integer' when 'UBIGINT' then 'integer' when 'DOUBLE' then 'decimal'
      when 'BOOLEAN' then 'boolean' when 'OBJECT' then 'object' when 'ARRAY' then 'object' end as kind
  from fields),
counts as (
  select stream, file, field, count(*) as n, count(*) filter (kind = 'text') as text, count(*) filter (kind = 'integer') as integer,
    count(*) filter (kind = 'decimal') as decimal, count(*) filter (kind = 'boolean') as boolean, count(*) filter (kind = 'object') as object
  from kinds where kind is not null group by all)
select *, case greatest(text, integer, decimal, boolean, object)
    when text then 'text' when integer then 'integer' when decimal then 'decimal' when boolean then 'boolean' else 'object' end as type
from counts
""",
}
