"""Cutting lineage through the shared folder that the cluster names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where none is named, one of our own, but only if driver and executors are one
    process; RuntimeError on a cluster, whose machines would not see it.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from the shared folder from now on.

    The files go with the session's ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    shared_folder(df.sparkSession)
    return _sized(df.checkpoint())


def _sized(kept: DataFrame) -> DataFrame:
    """A checkpoint without an estimate of its size that is beyond all bounds.

    A checkpoint inherits its plan's estimate, and a join's is the product of its
    sides', so in a loop that joins a table with itself the number's digits double
    with every round, until the driver does nothing but multiply.  An estimate that
    Spark itself writes as a power of ten (over 2**71 bytes) says no more than none
    does: without it the size is unknown, which Spark takes as 2**63 - 1 bytes.
    """
    plan = kept._jdf.queryExecution().logical()
    if "E+" not in plan.stats().simpleString():
        return kept
    jvm, session, none = kept.sparkSession._jvm, kept._jdf.sparkSession(), getattr(kept.sparkSession._jvm, "scala.None$").__getattr__("MODULE$")
    bare = jvm.org.apache.spark.sql.execution.LogicalRDD(plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), False, none, session, none, none)
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, bare), kept.sparkSession)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
