"""Schemas and column names for operators that add columns to any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def schema_with(df: DataFrame, names: list[str], added: str = "") -> StructType:
    """The named fields of ``df``, all nullable, followed by the fields of ``added`` (DDL)."""
    out = StructType()
    for name in names:
        out.add(name, df.schema[name].dataType, True)
    for extra in StructType.fromDDL(added).fields if added else []:
        out.add(extra)
    return out


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it so that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """``df`` with all its columns in the struct ``row``, beside the columns in ``own``: no name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[v.alias(k) for k, v in own.items()])


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns that ``packed`` put away, with those in ``changed`` computed anew."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in columns])
