"""Session set-up and the shared folder used for materialised tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are written for. All can be changed on a live session.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Recording the Python call site of every expression is costly for long plans.
STATIC_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_local_dirs: dict[str, str] = {}


def build_session(
    app: str = "basketloom", master: str | None = None, shuffle_partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings above; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_DEFAULTS, **STATIC_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Input files are dealt over one shuffle partition for each so many bytes, before small ones are merged.
BYTES_PER_PARTITION = 2 << 20
MOST_PARTITIONS = 4096
# Shuffled ids compress about ten times: 64 MB of them are more than a task can sort in memory.
MERGED_SIZE = "16m"


def use_sql_defaults(spark: SparkSession, input_bytes: int = 0) -> None:
    """Apply the settings above to a session made elsewhere, unless its owner set them.

    With ``input_bytes``, exchanges start with a number of partitions that grows with them, and never with
    fewer than the session's own number, so that what a task sorts does not grow with the input.
    """
    given = spark.sparkContext.getConf()
    for key, value in SQL_DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    if not input_bytes:
        return
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_size = min(MOST_PARTITIONS, -(-input_bytes // BYTES_PER_PARTITION))
    sized = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(own, by_size)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": MERGED_SIZE,
    }
    for key, value in sized.items():
        if not given.contains(key):
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read and write.

    The cluster names it in ``spark.checkpoint.dir``; failing that, the folder that the caller has
    set for checkpoints counts. Only a local session that has none
    falls back to a temporary folder; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    given = context.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="basketloom-")
        context.setCheckpointDir(_local_dirs[context.applicationId])
    return _local_dirs[context.applicationId]


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage; nothing happens if it is gone."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(target, True)


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the tasks' own file functions know it; None on any other storage than local files."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getScheme() != "file":
        return None
    return system.makeQualified(target).toUri().getPath()


def written_once(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here.

    The folder is added to ``paths``, so that whoever is done with the table can remove it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)
