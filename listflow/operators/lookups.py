"""Left joins to lookup tables when many rows have no key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places that rows without a key are dealt to.
SPREAD = 1024


def lookup(df: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """``df`` with the columns of ``table`` for its key; a left join in which rows with a null key meet nothing.

    Such rows would all be sent to the task that null hashes to, so they are dealt out by a salt
    that no row of the table has. A key that many rows share is left to AQE, which measures
    partitions and splits the large ones.
    """
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dealt = df.withColumn("_salt", F.when(no_key, 1 + F.floor(F.rand(7) * SPREAD)).otherwise(F.lit(0)).cast("int"))
    # zero for every row, but no constant: a constant would leave the join's keys and with it the deal
    none = F.hash(*keys).bitwiseAND(F.lit(0))
    return dealt.join(table.withColumn("_salt", none), [*keys, "_salt"], "left").drop("_salt")
