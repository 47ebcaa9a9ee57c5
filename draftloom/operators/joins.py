"""Joins that stand keys of very uneven weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of one key are spread over.
SALTS = 16


def lookup(rows: DataFrame, dim: DataFrame, key: Column, dim_key: str, how: str = "left", salts: int = SALTS) -> DataFrame:
    """Rows with the columns of their row in ``dim`` (at most one a key; ``dim_key`` itself is left out).

    Keys are compared null-safely. A key that a third of the rows share, null
    too, is spread over ``salts`` tasks: its row of ``dim`` is repeated, the
    rows are not. Columns of ``dim`` must not clash with those of ``rows``.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    a = rows.withColumn("_salt", salt).withColumn("_key", key)
    b = dim.withColumnRenamed(dim_key, "_dim_key").withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    j = a.join(b, F.col("_key").eqNullSafe(F.col("_dim_key")) & (F.col("_salt") == F.col("_dim_salt")), how)
    return j.drop("_salt", "_key", "_dim_key", "_dim_salt")
