"""Writing results: partitioned and plain Parquet, one CSV, JSON reports, receipts, catalogue descriptions."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Sequence
from pathlib import Path
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.functions.identity import content_hash


#: Column of the source file in a partitioned table's folders.
SOURCE = "source"


def _folders(df_or_spark: DataFrame | SparkSession, path: str, depth: int) -> tuple[object, list[object]]:
    """The file system of ``path`` and its folders so many levels down; none if it isn't there."""
    spark = df_or_spark.sparkSession if isinstance(df_or_spark, DataFrame) else df_or_spark
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "/".join(["*=*"] * depth)))
    return fs, [s.getPath() for s in found or []]


def _values(folder: object, depth: int) -> tuple[str, ...]:
    return tuple(unquote(part.partition("=")[2]) for part in folder.toString().rstrip("/").split("/")[-depth:])


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("year", "month"), source: str = "_source_file", force: bool = False) -> int:
    """Hive partitions by ``by`` and, below, by the file a row came from; the number of partitions written.

    Each source file keeps or replaces its own rows alone: what it has in a partition already stays, unless ``force``, which
    replaces all its rows, also where they lie in months that it no longer has; other files' rows in the same month are
    never touched. Rows without a source file count as of one file of the empty name.
    """
    keys = [*by, SOURCE]
    named = df.withColumn(SOURCE, F.coalesce(F.col(source).cast("string"), F.lit("")))
    fs, folders = _folders(df, path, len(keys))
    there = {_values(f, len(keys)): f for f in folders}  # as many as files have months
    wanted = [tuple(r) for r in named.select(*[F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for c in keys]).distinct().collect()]
    empty = lambda t: tuple(v or "__HIVE_DEFAULT_PARTITION__" for v in t)
    new = [w for w in wanted if force or empty(w) not in there]
    if new:
        rows = named.withColumn("_p", F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for c in keys]))
        if len(new) < len(wanted):
            chosen = df.sparkSession.createDataFrame([(list(w),) for w in new], "_p array<string>")
            rows = rows.join(F.broadcast(chosen), "_p", "left_semi")  # as many as files have months
        write = rows.drop("_p").repartition(*keys).write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*keys)
        write.mode("overwrite" if force else "append").parquet(path)
    if force:
        kept, sources = {empty(w) for w in wanted}, {empty(w)[-1] for w in wanted}
        for values, folder in there.items():
            if values[-1] in sources and values not in kept:
                fs.delete(folder, True)
    return len(new)


def rows_of(spark: SparkSession, path: str, sources: list[str]) -> int:
    """Rows that a partitioned table holds of these source files; only folders are read, and the counts in their footers."""
    if not _folders(spark, path, 3)[1]:
        return 0
    return spark.read.option("mergeSchema", True).parquet(path).where(F.col(SOURCE).isin(sources)).count()


def write_windows(df: DataFrame, path: str, source: str = "_source_file") -> int:
    """One Parquet folder per window file, not cut by month: ``path/source=NAME``; the number of windows."""
    rows = df.withColumn(SOURCE, F.coalesce(F.col(source).cast("string"), F.lit("")))
    rows.repartition(SOURCE).write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(SOURCE).mode("overwrite").parquet(path)
    return rows.select(SOURCE).distinct().count()


def releases(spark: SparkSession, root: str, needed: Sequence[str]) -> list[str]:
    """Folders right below ``root`` that hold all the tables a release has, latest name first."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in (fs.listStatus(base) if fs.exists(base) else []) if s.isDirectory()]
    whole = [f for f in found if all(fs.exists(jvm.org.apache.hadoop.fs.Path(f, n)) for n in needed)]
    return sorted((f.toString() for f in whole), reverse=True)


def write_sorted(df: DataFrame, path: str, keys: list[str]) -> None:
    """Plain Parquet, each file sorted by the table's key so that its statistics prune."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("compression", "zstd").mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str | Path) -> None:
    """One UTF-8 file with a header, under its name when it is whole, on any file system. Parts are written by as many tasks
    as there are, in the order of the rows, and then joined; nothing goes through one task but the bytes' copy."""
    spark = df.sparkSession
    jvm, text = spark._jvm, str(path)
    target = jvm.org.apache.hadoop.fs.Path(text)
    conf = spark._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    folder = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".csv-{uuid4().hex}")
    try:
        df.write.option("header", False).option("lineSep", "\n").option("encoding", "UTF-8").option("emptyValue", "").csv(folder.toString())
        whole = jvm.org.apache.hadoop.fs.Path(folder, "_whole")
        out = fs.create(whole, True)
        try:
            out.write(bytearray(_csv_line(df.columns).encode()))
            for part in sorted((s.getPath() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "part-*"))), key=lambda p: p.getName()):
                data = fs.open(part)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, conf, False)
                data.close()
        finally:
            out.close()
        fs.delete(target, False)
        fs.rename(whole, target)
    finally:
        fs.delete(folder, True)


def _csv_line(names: Sequence[str]) -> str:
    return ",".join(f'"{n.replace(chr(34), chr(92) + chr(34))}"' if any(c in n for c in '",\n') else n for n in names) + "\n"


def write_json(path: str | Path, report: object) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(path.name + ".part")
    part.write_text(json.dumps(report, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
    os.replace(part, path)


def file_sha256(path: str | Path, chunk: int = 1 << 20) -> str:
    h = hashlib.sha256()
    with Path(path).open("rb") as f:
        while block := f.read(chunk):
            h.update(block)
    return h.hexdigest()


def table_receipt(df: DataFrame, path: str | Path | None = None) -> dict[str, object]:
    """Rows, columns and an order-free content hash; of a local path also its bytes and each file's SHA-256."""
    r = content_hash(df).first()
    out: dict[str, object] = {"rows": r.rows, "columns": len(df.columns), "content": r.content}
    if path is not None:
        files = sorted(p for p in ([Path(path)] if Path(path).is_file() else Path(path).rglob("*.parquet")))
        out |= {"bytes": sum(p.stat().st_size for p in files), "files": {p.name: file_sha256(p) for p in files}}
    return out


def folder_bytes(spark: SparkSession, path: str) -> int:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(root).getLength() if fs.exists(root) else 0


def sizes(files: Sequence[str], out: str, spark: SparkSession) -> dict[str, float]:
    """Bytes and MiB of raw files and of the table made of them, and their ratio (0 without raw bytes)."""
    raw, made = sum(folder_bytes(spark, f) for f in files), folder_bytes(spark, out)
    return {"raw_bytes": raw, "raw_mib": round(raw / 2**20, 2), "parquet_bytes": made, "parquet_mib": round(made / 2**20, 2), "parquet_to_raw": round(made / raw, 4) if raw else 0.0}


def catalogue_type(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(kind, T.NumericType):
        return "number"
    return "datetime" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "string"


def catalogue(tables: dict[str, DataFrame], owner: str, slug: str, describe: dict[str, str]) -> dict[str, object]:
    """Descriptions and types of every column of every table; an error for a column that nobody described."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9-]{2,49}", owner) or not re.fullmatch(r"[a-z0-9][a-z0-9-]{2,99}", slug):
        raise ValueError("owner or slug has characters that a catalogue won't take")
    resources = []
    for name, df in tables.items():
        unknown = [c for c in df.columns if c not in describe]
        if unknown:
            raise ValueError(f"{name}: no description of {', '.join(unknown)}")
        resources.append({"path": name, "schema": {"fields": [{"name": f.name, "description": describe[f.name], "type": catalogue_type(f.dataType)} for f in df.schema.fields]}})
    return {"id": f"{owner}/{slug}", "resources": resources}


def require_header(path: str | Path, columns: list[str]) -> None:
    with Path(path).open(encoding="utf-8") as f:
        header = f.readline().rstrip("\r\n").split(",")
    if header != columns:
        raise ValueError(f"{path}: the header differs from the expected columns")
