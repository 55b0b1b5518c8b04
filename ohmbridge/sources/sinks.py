"""Writers: JSON lines without nulls, CSV and JSON reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ohmbridge.storage import write_text


def without_empty(c: Column, dtype: T.DataType) -> Column:
    """A struct of which all fields are null becomes null, at any depth."""
    if not isinstance(dtype, T.StructType):
        return c
    parts = [without_empty(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
    any_set = F.lit(False)
    for f in dtype.fields:
        any_set = any_set | without_empty(c[f.name], f.dataType).isNotNull()
    return F.when(any_set, F.struct(*parts))


def as_json(df: DataFrame) -> DataFrame:
    """One column ``value``: each row as a JSON object; nulls and empty structs are left out."""
    fields = [without_empty(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("value"))


def write_jsonl(frames: list[tuple[DataFrame, list[str]]], path: str, limit: int | None = None) -> None:
    """All frames as JSON lines. With ``limit`` the first rows, frame by frame, each by its order columns; 0 means none."""
    rows = []
    for i, (df, order) in enumerate(frames):
        line = as_json(df) if limit is None else None
        if limit is not None:
            fields = [without_empty(F.col(x.name), x.dataType).alias(x.name) for x in df.schema.fields]
            line = df.orderBy(*order).limit(limit).select(F.lit(i).alias("__f"), *(F.col(c).alias(f"__o{k}") for k, c in enumerate(order)), F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("value"))
        rows.append(line)
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    if limit is not None:
        order = [c for c in out.columns if c.startswith("__")]
        out = out.orderBy(*order).limit(limit).select("value")
    out.write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report(report: dict, path: str) -> None:
    write_text(SparkSession.active(), path, json.dumps(report, indent=2, sort_keys=True, ensure_ascii=False))
