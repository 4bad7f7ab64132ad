"""Bidder report exports: CSV in one of several encodings, or a workbook, every cell as text."""

from __future__ import annotations

import codecs
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.operators.normalize import typed
from jangbu.sources.schemas import BIDDER_REPORT

#: Encodings in the order in which they are tried (fixed values).
ENCODINGS = ("utf-8-sig", "cp949", "euc-kr", "utf-8")


def detect_encoding(path: str | Path, block: int = 1 << 20) -> str:
    """The first encoding that decodes the whole file, read block by block; an error if none does."""
    for e in ENCODINGS:
        decoder = codecs.getincrementaldecoder(e)()
        try:
            with Path(path).open("rb") as f:
                while data := f.read(block):
                    decoder.decode(data)
            decoder.decode(b"", True)
            return e
        except UnicodeDecodeError:
            continue
    raise ValueError(f"{path}: none of {', '.join(ENCODINGS)} decodes it")


def read_report(spark: SparkSession, path: str | Path) -> DataFrame:
    """All columns as text under their cleaned headers."""
    suffix = Path(path).suffix.lower()
    if suffix == ".csv":
        encoding = detect_encoding(path)
        names = {"utf-8-sig": "UTF-8", "cp949": "x-windows-949", "euc-kr": "EUC-KR"}
        if encoding in {"cp949", "euc-kr"}:  # Spark takes these only where all of Java's charsets are allowed
            spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        df = spark.read.option("header", True).option("encoding", names.get(encoding, encoding)).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(str(path))
    elif suffix in {".xlsx", ".xls"}:
        import pandas as pd  # a workbook is one file of bounded size; there is no distributed reader for it

        pdf = pd.read_excel(path, dtype=str)
        df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"`{c}` string" for c in pdf.columns))
    else:
        raise ValueError(f"{path}: neither CSV nor a workbook")
    return df.toDF(*[c.replace("\r", "").replace("\n", "").lstrip("﻿").strip() for c in df.columns])


def normalized_report(raw: DataFrame) -> DataFrame:
    """Adds the own name of each known header, typed by name; source columns stay as they are."""
    known = [(s, o) for s, o in BIDDER_REPORT if s in raw.columns]
    return typed(raw.select("*", *[F.col(f"`{s}`").alias(o) for s, o in known if o not in raw.columns]))
