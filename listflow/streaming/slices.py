"""Keyed state in hash slices.

A version of the state is a manifest: for each slice the version whose folder holds its rows. A batch
reads and rewrites only the slices that its keys fall into, and its manifest, one small file written
last, makes the new version visible. Folders are

    slices/version=N/slice=K    rows of the slices that version N rewrote
    changes/version=N           rows that version N found new or changed, if the merge tells
    manifest/version=N          where every slice of version N is

Folders of versions that the newest manifest doesn't name may be removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Slices of a state; a state keeps the number that it began with.
SLICES = 64

_MANIFEST = "slice int, held int, slices int, run string, batch long, fields string"


def slice_of(key: str, slices: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST + ", version int").parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that were written to the end."""
    found = _manifests(spark, path)
    return [] if found is None else sorted(r[0] for r in found.select("version").distinct().collect())


def _manifest(spark: SparkSession, path: str, before: int | None = None) -> list[Row]:
    """The newest manifest, or the newest one before a version: a row per slice, at least one."""
    found = _manifests(spark, path)
    if found is None:
        return []
    found = found if before is None else found.filter(F.col("version") < before)
    newest = found.agg(F.max("version")).first()[0]
    return [] if newest is None else found.filter(F.col("version") == newest).collect()


def _rows(spark: SparkSession, path: str, manifest: list[Row], only: set[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(manifest[0].fields))
    folders = [f"{path}/slices/version={r.held}/slice={r.slice}" for r in manifest
               if r.slice is not None and (only is None or r.slice in only)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest whole version, or the newest one before a version; nothing if there is none."""
    manifest = _manifest(spark, path, before)
    return _rows(spark, path, manifest) if manifest else None


def advance(path: str, initial: DataFrame, batch: DataFrame, keyed: DataFrame, key: str,
            merge: Callable[[DataFrame, DataFrame], DataFrame], run: str, batch_id: int, slices: int = SLICES) -> int:
    """Write the version after the newest one: ``merge(current, batch)`` over the slices that hold the keys of ``keyed``.

    ``run`` and ``batch_id`` name the batch; the batch that made the newest version, run again after a
    failure, makes the same version again from the one before. A run with a new name, as after a
    lost checkpoint, goes on from the newest version. The first version takes ``initial`` in whole.
    Rows in which the merge gives ``change`` as new or changed are appended to the changes.
    """
    spark = batch.sparkSession
    base = _manifest(spark, path)
    if base and (base[0].run, base[0].batch) == (run, batch_id):
        version = base[0].version
        base = _manifest(spark, path, version)
    else:
        version = base[0].version + 1 if base else 0
    slices = base[0].slices if base else slices
    touched = {r[0] for r in keyed.select(slice_of(key, slices)).distinct().collect()}
    current = _rows(spark, path, base, touched) if base else initial
    out = f"{path}/slices/version={version}"
    merged = merge(current, batch).withColumn("slice", slice_of(key, slices))
    merged.repartition("slice").write.mode("overwrite").partitionBy("slice").parquet(out)
    written = spark.read.schema(merged.schema).parquet(out)
    if "change" in merged.columns:
        written.filter("change in ('new', 'changed')").drop("slice").write.mode("overwrite").parquet(f"{path}/changes/version={version}")
    held = {r.slice: r.held for r in base if r.slice is not None and r.slice not in touched}
    held |= {r[0]: version for r in written.select("slice").distinct().collect()}
    same = (slices, run, batch_id, base[0].fields if base else json.dumps(initial.schema.jsonValue()))
    rows = [(k, v, *same) for k, v in sorted(held.items())] or [(None, None, *same)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
    return version
