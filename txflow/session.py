"""Session helpers: building a session for tests/bench and locating shared work space.

Nothing here holds global state. Library functions take a ``SparkSession`` or a
``DataFrame`` argument and never create sessions on their own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library relies on. The time zone matters for
# epoch <-> wall-clock conversions; the rest are Spark 4 defaults, stated so a
# cluster profile that turned them off gets them back.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "txflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster use the one spark-submit gives you."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # PySpark captures a Python stack trace on every DataFrame call, only to
        # decorate error messages: ~2.5 ms per call on the driver, read once per process
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1024 * 1024


def scale_settings(input_bytes: int, cores: int, partition_bytes: int = 256 * MB,
                   max_partitions: int = 100_000) -> dict[str, str]:
    """Session settings sized for ``input_bytes`` of input on ``cores`` executor cores.

    * Scan splits of ``partition_bytes`` (``spark.sql.files.maxPartitionBytes``):
      100 TB in 256 MB splits is about 400k scan tasks, each well inside a core's
      share of executor memory.
    * Initial shuffle width = input / ``partition_bytes``, at least 2 x cores, at
      most ``max_partitions`` (map x reduce shuffle blocks grow with its square; past
      the cap a partition grows and the sort spills instead). Shuffled bytes are
      rarely more than the input: the aggregates here shuffle partial rows.
      Adaptive execution then coalesces small partitions toward half a split and
      splits any partition over a full split (the hot-key case) for joins.
    """
    n = -(-max(int(input_bytes), 1) // partition_bytes)
    n = max(2 * cores, min(n, max_partitions))
    n = -(-n // cores) * cores   # whole waves of tasks
    if n > max_partitions:
        n = max(cores, max_partitions // cores * cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators assume (idempotent)."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates, stream checkpoints and sinks.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (or the one
    set with ``setCheckpointDir``), so every executor sees the same files and a
    lost executor cannot take them with it. Only when nothing is configured
    (local tests) do we create one and register it as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # a driver-local folder is invisible to executors and dies with a node
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or "
                               "an object store) before running txflow jobs on a cluster")
        root = tempfile.mkdtemp(prefix="txflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared root for one run of ``name``."""
    return f"{shared_root(spark)}/txflow/{name}-{uuid.uuid4().hex[:12]}"


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none where it is not there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(at) if s.isDirectory()] if store.exists(at) else []


def written_whole(spark: SparkSession, path: str) -> bool:
    """True when a job has committed its output at ``path``: its ``_SUCCESS`` is there, on whatever store."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme, for tests that inspect local files."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
