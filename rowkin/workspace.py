"""Shared-folder tables: where lineage is cut, and how small sides are proven small.

Every intermediate table is written below the folder that the cluster names in
``spark.checkpoint.dir`` so that any executor can be lost at any time; a private folder is made
only where that setting is absent (tests, laptops).
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where none is configured and everything runs in one process.

    On a cluster without ``spark.checkpoint.dir`` this raises: executors would write to folders of their own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        path = _own[sc.applicationId] = tempfile.mkdtemp(prefix="rowkin-")
        sc.setCheckpointDir(path)
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return _own[sc.applicationId]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it again: a reliable lineage cut.

    Each task writes one file, whatever the session says, so a file's number and its row index number its rows.  What is not
    dropped before goes when the application's file system is closed.
    """
    path = f"{shared_dir(df.sparkSession)}/rowkin-{label}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    hadoop, fs = _file_system(df.sparkSession, path)
    fs.deleteOnExit(hadoop)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._rowkin_path = path
    return out


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(sc._jsc.hadoopConfiguration())


def dropped(*tables: DataFrame | None) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_rowkin_path", None):
            hadoop, fs = _file_system(df.sparkSession, path)
            fs.delete(hadoop, True)


SMALL_BYTES = 64_000_000


def small(df: DataFrame, max_rows: int, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows and ``max_bytes`` bytes of text, else one that makes Spark shuffle."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))) if df.columns else F.lit(0)
    n, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if n <= max_rows and (total or 0) <= max_bytes else shuffled(df)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that Spark must not broadcast by its own estimate.

    That estimate leaves out the rows that Python or ``explode`` adds, and takes a file's compressed bytes for its size in memory.
    """
    return df.hint("merge")


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over as many tasks as there are cores, where a scan of few splits would leave cores idle in costly Python
    work; larger inputs are not moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(2 * cores, key)


HEAVY = 1000
LIGHT = 20_000  # a key of so few rows burdens no task


def heavy_keys(rows: DataFrame, key: str, total: int) -> list:
    """Keys with more than LIGHT and one in HEAVY of ``total`` rows: fewer than HEAVY of them, so they fit the driver."""
    if total <= LIGHT:
        return []
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return [r[0] for r in counts.where(F.col("_n") > max(LIGHT, total // HEAVY)).collect()]


def lookup(rows: DataFrame, key: str, side: DataFrame, side_key: str, how: str = "left", heavy: list | None = None) -> DataFrame:
    """Join ``rows`` to ``side``, which has one row per ``side_key``, without a hot key in one task.

    Rows of the ``heavy`` keys (see :func:`heavy_keys`) meet their side rows, fewer than HEAVY, in a broadcast join; all
    others take the join that Spark picks.  Null keys match nothing.  ``side`` must not share column names with ``rows``.
    """
    if not heavy:
        return rows.join(side, F.col(key) == F.col(side_key), how)
    hot = rows.where(F.col(key).isin(heavy)).join(F.broadcast(side.where(F.col(side_key).isin(heavy))), F.col(key) == F.col(side_key), how)
    cold = rows.where(F.col(key).isNull() | ~F.col(key).isin(heavy)).join(side, F.col(key) == F.col(side_key), how)
    return hot.unionByName(cold)
