"""A reproducible sample that stays as data grows.

Method: permanent random numbers. Each identifier gets a uniform value at first
sight, kept in a stored table (anti-join insert), and the sample is every
identifier whose value is under its stratum's threshold. Thresholds are stored
too and never fall, so what was selected stays selected.

The store is durable: opened again, by another process too, it goes on with the
inserts that were committed. An insert is a new folder, and counts once its
marker is written; what a lost driver left unmarked is written anew.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.operators.joins import lookup
from draftloom.session import shared_dir
from draftloom.sources.jsonl import read_json, write_json

VALUES = "id bigint, stratum string, u double, first_batch int"
STRATA = "stratum string, threshold double, lowest array<double>"


def uniform(key: Column, seed: int) -> Column:
    """A value in [0, 1) fixed by the key and the seed: 52 bits of sha-256."""
    h = F.substring(F.sha2(F.concat_ws("\x00", F.lit(str(seed)), key.cast("string")), 256), 1, 13)
    return F.conv(h, 16, 10).cast("double") / F.lit(float(16**13))


class PermanentSample:
    """A durable store of values under ``path`` (a shared folder) and its growing sample.

    ``add`` takes rows (id, stratum): ids seen before keep their stored value
    and stratum, ids that repeat count once (smallest stratum), null ids are
    left out, a null stratum is a stratum. ``rate`` is the least threshold;
    ``least`` raises the threshold of a small stratum so that it has that many
    (0: the rate alone). A store is opened with the parameters it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, rate: float = 0.1, least: int = 1, seed: int = 42):
        if not 0 <= rate <= 1:
            raise ValueError("rate must be in [0, 1]")
        self.spark, self.path, self.rate, self.least, self.seed = spark, path.rstrip("/"), rate, least, seed
        made_with = {"schema_version": 1, "rate": rate, "least": least, "seed": seed}
        if self._exists("store.json"):
            if read_json(spark, f"{self.path}/store.json") != made_with:
                raise ValueError(f"{path} was made with other parameters")
        else:
            write_json(spark, f"{self.path}/store.json", made_with)
        self.batch = 0  # inserts committed so far
        while self._exists(f"committed/{self.batch}"):
            self.batch += 1

    def _exists(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _read(self, schema: str, *parts: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in parts]) if parts else self.spark.createDataFrame([], schema)

    def values(self) -> DataFrame:
        return self._read(VALUES, *[f"values/{k}" for k in range(self.batch)])

    def strata(self) -> DataFrame:
        """Of each stratum the threshold and the ``least`` lowest values."""
        return self._read(STRATA, *([f"strata/{self.batch - 1}"] if self.batch else []))

    def add(self, rows: DataFrame) -> None:
        self.add_ordered(rows.select("id", "stratum", F.lit(0).alias("nth")))

    def add_ordered(self, rows: DataFrame) -> None:
        """Several arrivals in one insert (id, stratum, nth): as if added one after another by ``nth``, with one pass over the rows."""
        new = rows.filter("id is not null").groupBy("id").agg(F.min(F.struct("nth", "stratum")).alias("x"))
        if self.batch:
            new = new.join(self.values().select("id"), "id", "left_anti")
        n = self.batch
        new = new.select("id", "x.stratum", uniform(F.col("id"), self.seed).alias("u"), (F.lit(n) + F.col("x.nth")).cast("int").alias("first_batch"))
        new.write.mode("overwrite").parquet(f"{self.path}/values/{n}")
        if n and not self._read(VALUES, f"values/{n}").take(1):
            return  # nothing new: no insert
        self._raised(self._read(VALUES, f"values/{n}")).write.mode("overwrite").parquet(f"{self.path}/strata/{n}")
        write_json(self.spark, f"{self.path}/committed/{n}", {"batch": n})
        self.batch += 1

    def _raised(self, new: DataFrame) -> DataFrame:
        """The strata after new values: a threshold rises to hold the ``least`` lowest values at each arrival, and never falls."""
        k = max(self.least, 1)
        if k == 1:
            low = new.groupBy("stratum", "first_batch").agg(F.array(F.min("u")).alias("low"))
        else:  # the k lowest of each part of a stratum, then of the stratum: no list grows with it
            part = new.groupBy("stratum", "first_batch", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part"))
            low = part.agg(F.slice(F.array_sort(F.collect_list("u")), 1, k).alias("low")).groupBy("stratum", "first_batch").agg(F.slice(F.array_sort(F.flatten(F.collect_list("low"))), 1, k).alias("low"))
        arrivals = low.groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("first_batch", "low"))).alias("a"))
        old = self.strata().withColumnRenamed("stratum", "s")
        both = arrivals.join(old, F.col("stratum").eqNullSafe(F.col("s")), "full")
        # a stratum without arrivals keeps its row; a null stratum is told from a missing side by the lists
        first = F.struct(F.coalesce("threshold", F.lit(0.0)).alias("t"), F.coalesce("lowest", F.array().cast("array<double>")).alias("low"))

        def arrive(s: Column, x: Column) -> Column:
            low = F.slice(F.array_sort(F.concat(s["low"], x["low"])), 1, k)
            due = F.least(F.lit(1.0), F.element_at(low, -1) + F.lit(2.0**-50)) if self.least else F.lit(0.0)
            return F.struct(F.greatest(s["t"], F.lit(float(self.rate)), due).alias("t"), low.alias("low"))

        folded = both.withColumn("f", F.aggregate(F.coalesce("a", F.array().cast(arrivals.schema["a"].dataType)), first, arrive))
        return folded.select(F.when(F.col("a").isNotNull(), F.col("stratum")).otherwise(F.col("s")).alias("stratum"), F.col("f.t").alias("threshold"), F.col("f.low").alias("lowest"))

    def sample(self) -> DataFrame:
        """(id, stratum, u, first_batch, threshold) of everything selected so far."""
        t = self.strata().select(F.col("stratum").alias("of"), "threshold")
        return lookup(self.values(), t, F.col("stratum"), "of", "inner").filter(F.col("u") < F.col("threshold"))


def sample_by_batches(rows: DataFrame, id_col: str, stratum: Column, batch_col: str, path: str, rate: float = 0.1, least: int = 1, seed: int = 42) -> DataFrame:
    """The sample of the rows, fed in the order of their batches into the store under ``path``.

    A null batch comes last. Ids that the store has from an earlier call keep
    their value, and what was selected then is selected still; ids that are no
    longer in the rows stay in the store and out of the result.
    """
    slim = rows.select(F.col(id_col).cast("bigint").alias("id"), stratum.alias("stratum"), F.coalesce(F.col(batch_col), F.lit(2**31 - 1)).cast("bigint").alias("nth"))
    store = PermanentSample(rows.sparkSession, path, rate, least, seed)
    earlier = store.batch > 0
    order = sorted(r[0] for r in slim.select("nth").distinct().collect())  # one row a batch
    numbers = F.array(*[F.lit(b) for b in order]) if order else F.array().cast("array<bigint>")
    store.add_ordered(slim.withColumn("nth", (F.array_position(numbers, F.col("nth")) - 1).cast("int")))
    out = store.sample()
    return out.join(slim.select("id").distinct(), "id", "left_semi") if earlier else out


def named_store(spark: SparkSession, name: str, of: str) -> str:
    """The path of the store of one table in the shared folder: the same at every call for the same table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{hashlib.sha256(json.dumps(of).encode()).hexdigest()[:16]}"
