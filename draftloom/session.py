"""Session helpers: a local session for tests, reliable checkpoints, table loading."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session; on a cluster the caller's session is used as it is."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("draftloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "6g")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost with its machine.
    """
    sc = spark.sparkContext
    set_to = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not set_to:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        set_to = os.environ.get("DRAFTLOOM_LOCAL_CHECKPOINTS")
        if not set_to:
            set_to = os.environ["DRAFTLOOM_LOCAL_CHECKPOINTS"] = tempfile.mkdtemp(prefix="draftloom-")
            atexit.register(shutil.rmtree, set_to, ignore_errors=True)  # of a local session only
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(set_to)
    return set_to


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a written table.

    What is returned lazily may read it, so it stays until ``clean`` is called
    or the driver's process ends.
    """
    if not _SCRATCH:
        atexit.register(clean)
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to a scratch table: what reads them runs none of their plan again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean() -> None:
    """Delete the scratch tables of this process; results that still read them must have been used before."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        if spark.sparkContext._jsc is None:  # stopped: its folder can no longer be reached
            continue
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes under which the file source makes no further split, as Spark's file open cost has it.
SPLIT = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, for CPU-heavy steps over an input of fewer splits than cores; others stay as they are.

    Decided from the plan alone: nothing is run. Plans that shuffle are left to
    adaptive execution.
    """
    plan, sc = df._jdf.queryExecution().optimizedPlan(), df.sparkSession.sparkContext
    leaves = plan.collectLeaves()
    if leaves.size() != 1 or " Aggregate [" in f" {plan.toString()}":
        return df
    stored, cores = int(leaves.apply(0).stats().sizeInBytes()), sc.defaultParallelism
    few = stored < SPLIT * cores and len(df.inputFiles()) < cores
    return df.repartition(cores) if few else df
