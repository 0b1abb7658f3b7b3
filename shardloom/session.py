"""Session helpers: settings the build relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the plans are written for.  AQE re-plans shuffles at run time:
# it coalesces small shuffle partitions and splits skewed ones, including
# those of a REBALANCE (used for the (index, shard) co-location).
BUILD_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # index names are text even when they look like numbers or dates
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a read through the manifest (active indices) prunes the index folders
    # of the documents scan even when the join plan offers no broadcast to
    # reuse: the manifest subquery is small and runs on its own
    "spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly": "false",
}

# A scan whose rows become many more rows (documents to postings) reads small
# splits, so that a task sorts the postings of a few MB of files.
SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": str(8 << 20), "spark.sql.files.openCostInBytes": str(1 << 20)}
ROW_GROUP_BYTES = 16 << 20     # of the documents' files: the least that one task reads


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shardloom") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no extra ports)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in BUILD_CONF.items():
        b = b.config(k, v)
    return b.getOrCreate()


@contextmanager
def build_conf(spark: SparkSession, conf: dict[str, str] = BUILD_CONF):
    """``conf`` for the jobs of a build; the caller's settings come back after."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the cluster and read here.  Only a local
    session (tests, benchmarks) without it gets a folder of our own; a
    cluster session without it fails, since a folder on the driver's disk is
    not shared with the executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(scratch tables and lineage cuts are written there)")
        d = tempfile.mkdtemp(prefix="shardloom-ckpt-")
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def table_exists(spark: SparkSession, path: str, schema: str = "build_id string") -> bool:
    """Whether there is a folder at ``path`` (the read is analysed only; with a
    schema, an empty table counts too)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.schema(schema).parquet(path).schema
    except AnalysisException:
        return False
    return True


__all__ = ["BUILD_CONF", "SMALL_SPLITS", "ROW_GROUP_BYTES", "local_session", "build_conf", "checkpoint_dir",
           "scratch_path", "table_exists"]
