"""Full ranks inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listflow.session import cut_lineage


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One whole row per key, whatever the order of the input: the one that is last as JSON text.

    A partial aggregate, so a key with many rows sends one per task. Rows whose key is null, which
    a lookup can never meet, go.
    """
    rows = df.dropna(subset=list(keys))
    row = F.struct(*[F.col(c) for c in df.columns])
    return rows.groupBy(*keys).agg(F.max_by(row, F.to_json(row)).alias("_row")).select("_row.*")


def rank_within(df: DataFrame, by: str, order: list[Column], into: str = "rank") -> DataFrame:
    """``row_number`` per ``by`` value without holding one value's rows in one task.

    Rows are range-partitioned on group and order, so a large group spans many slices; each
    slice is ranked on its own and moved up by the sizes of the group's earlier slices. Slices
    are written once, as a recomputed range split could differ.
    """
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    keys = df.withColumns({f"_o{i}": c for i, c in enumerate(order)})
    names = [f"_o{i}" for i in range(len(order))]
    sliced = cut_lineage(
        keys.repartitionByRange(int(n), by, *names).withColumn("_slice", F.spark_partition_id()), "slices")
    local = F.row_number().over(Window.partitionBy(by, "_slice").orderBy(*names))
    sizes = sliced.groupBy(by, "_slice").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return (sliced.withColumn("_local", local).join(offsets, [by, "_slice"])
            .withColumn(into, F.col("_local") + F.col("_before"))
            .drop("_slice", "_local", "_before", *names))
