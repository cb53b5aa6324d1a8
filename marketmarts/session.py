"""Session helpers: configuration, shared scratch location, table loading."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Settings that matter at scale; tests and the bench use the same ones.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "marketmarts",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster the setting must be present: job output and lineage cuts
    go there, never to a machine-local folder.  Only a local session (tests,
    the bench) gets a fresh private folder when the setting is missing.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        root = tempfile.mkdtemp(prefix="marketmarts-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd-checkpoints"))
    return root


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, kind: str, keep: bool = False) -> str:
    """A new, unique path under the shared root for one run's output.

    Inside a :func:`scratch_scope` it is removed with the scope, unless ``keep``.
    """
    path = os.path.join(shared_root(spark), kind, uuid.uuid4().hex)
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the scratch tables that were named inside.

    Frames built inside read from them: they have to be written or collected
    before the scope ends.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for p in paths:
            remove(spark, p)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` on any Hadoop file system (shared storage)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on shared storage."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """Counts of an observation after its write.

    Where adaptive planning finds the observed rows to be none, it drops the
    whole plan with the observation in it, which then has no row: all zeros.
    """
    try:
        got = seen.get
    except Py4JJavaError:
        got = {}
    return {k: int(got.get(k) or 0) for k in names}


SCAN_PARTITIONS = "marketmarts.scanPartitions"


def spread(df: DataFrame) -> DataFrame:
    """The scan as it is, or dealt over as many partitions as the session asks for.

    Unset (the default, and right for tables of many splits) nothing is
    shuffled.  A session over tables of one row group each, such as the
    bench's, sets ``marketmarts.scanPartitions`` so that the per-row work
    after the scan does not run in one task.
    """
    wanted = df.sparkSession.conf.get(SCAN_PARTITIONS, "")
    return df.repartition(int(wanted)) if wanted else df
