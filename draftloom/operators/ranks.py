"""Ranks and shares of a whole table without a sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from draftloom.session import scratch

#: Bins that a hash is counted in: so many rows come to the driver at most, for each sample.
BINS = 4096


def ranked(df: DataFrame, group: str, order: list[str], by: str, total: str = "_total") -> DataFrame:
    """Adds ``by``, the 0-based rank of a row in its group, and ``total``, the group's rows, however few groups there are.

    Rows are sorted by ranges of (group, order), so a group of any size, or of
    one order value, lies in several ranges of like size; a row's rank is its
    place in its range less where the group begins there, plus the group's
    rows in the ranges before. The sorted rows are written once, since ranges
    are sampled anew at each run. A null group is a group.
    """
    rows, part = _ranges(df, group, order, F.count(F.lit(1)))
    part = part.withColumn(total, F.sum("_n").over(Window.partitionBy("_g")))  # one row a range: few
    out = rows.join(part, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return out.withColumn(by, F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_range", "_g", "_r", "_n", "_first", "_before")


def running(df: DataFrame, group: str, order: list[str], value: str, by: str) -> DataFrame:
    """Adds ``by``, the sum of ``value`` over the rows of the group up to this one, however few groups there are.

    As ``ranked``: sums within a range of rows, and what the ranges before add up to. Ties in the order are taken in some fixed order.
    """
    rows, part = _ranges(df, group, order, F.sum(value))
    own = F.sum(value).over(Window.partitionBy(group, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.withColumn("_own", own).join(part, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return out.withColumn(by, F.col("_before") + F.col("_own")).drop("_at", "_range", "_g", "_r", "_n", "_first", "_before", "_own")


def _ranges(df: DataFrame, group: str, order: list[str], measure: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with their range and place, a row a group and range: its measure ``_n``, that of the ranges before, its first place)."""
    keys = [group, *order]
    at = scratch(df.sparkSession, "ranges")
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).write.parquet(at)
    rows = df.sparkSession.read.parquet(at).withColumn("_range", F.shiftright("_at", 33))
    part = rows.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(measure.alias("_n"), F.min("_at").alias("_first"))
    return rows, part.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def hash60(seed: Column, key: Column) -> Column:
    """60 bits of sha-256 of seed and key, as a bigint."""
    return F.conv(F.substring(F.sha2(F.concat(seed, F.lit(":"), key), 256), 1, 15), 16, 10).cast("bigint")


def smallest_share(rows: DataFrame, sample: str, hashed: str, order: str, frac: float) -> DataFrame:
    """Of each ``sample`` the rows with the smallest hash, exactly ``frac`` of them (rounded half to even, one at least).

    The hash is counted in bins; whole bins are taken, and only the bin at the
    edge is ranked (ties by ``order``). Input: one row an element of a sample.
    """
    b = rows.withColumn("_bin", F.shiftright(F.col(hashed), 48).cast("int"))
    edges: dict = {}
    counts: dict = {}
    for r in b.groupBy(sample, "_bin").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r[sample], {})[r["_bin"]] = r["n"]
    for s, per in counts.items():
        left = max(1, round(sum(per.values()) * frac))
        for k in sorted(per):
            if left <= per[k]:
                edges[s] = (k, left)
                break
            left -= per[k]
    if not edges:
        return rows.filter("false")
    kind = rows.schema[sample].dataType.simpleString()
    bound = F.broadcast(rows.sparkSession.createDataFrame([(s, k, n) for s, (k, n) in edges.items()], f"_s {kind}, _edge int, _left bigint"))  # a row a sample
    j = b.join(bound, F.col(sample) == F.col("_s"))
    inner = j.filter("_bin < _edge").select(*rows.columns)
    edge = j.filter("_bin = _edge").withColumn("_k", F.row_number().over(Window.partitionBy(sample).orderBy(hashed, order))).filter("_k <= _left")
    return inner.unionByName(edge.select(*rows.columns))
