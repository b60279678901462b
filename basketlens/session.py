"""Session construction and the shared folder for materialised intermediates."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins and coalesces or
# splits shuffle partitions from runtime sizes; the session zone is pinned
# so DATE arithmetic never depends on the host.
#
# Broadcasts are decided by AQE from the measured size of a materialised
# shuffle, never from the planner's estimate: the static estimate starts from
# compressed parquet bytes and routinely calls a large aggregate "small",
# which turns a fact-to-fact join into a driver-built hash table. Explicit
# broadcasts (literal dimensions, size-bounded calendars) are unaffected.
#
# Tables stored by user are partitioned by fewer columns than they are joined
# on (user, against grain, period and user); such a join needs no exchange
# unless Spark is told to ask for all of its keys.
DEFAULT_CONF = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "basketlens",
                extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the
    cluster's own session and leave partition counts to its configuration."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # locally the shuffles are small: never let AQE merge them below one
    # partition per core, or an aggregate runs single-threaded
    conf["spark.sql.adaptive.coalescePartitions.minPartitionNum"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def is_connect(spark: SparkSession) -> bool:
    """True for a Spark Connect session (no SparkContext or JVM handle)."""
    return type(spark).__module__.startswith("pyspark.sql.connect")


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Starting settings for a cluster run over ``input_bytes`` of base data.

    Initial shuffle partitions are sized so the widest shuffle (the grain
    fan-out of the base, about 3 x its compressed size in rows) lands near
    ``target_partition_bytes`` per task, never fewer than two waves of the
    cluster's cores; AQE then coalesces small shuffles and splits skewed
    ones. Scan splits stay at the target size.
    """
    widest = 3 * input_bytes
    partitions = max(2 * total_cores, -(-widest // target_partition_bytes))
    return {
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests)
    is a fresh local folder created and registered with the SparkContext
    (the config itself cannot be changed at runtime). On a cluster an unset
    folder is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder every executor can reach "
                             "(a machine-local temporary folder does not survive on a cluster)")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="basketlens-ckpt-"))
        return sc.getCheckpointDir()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique location under the shared folder for one materialised table."""
    import uuid

    return os.path.join(shared_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works for any
    cluster storage scheme, not only local disks."""
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours, through Hadoop's FileSystem."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def file_signature(spark: SparkSession, path: str) -> str:
    """Name, size and modification time of every file of a table (a file, or
    all files below a folder), so that any rewrite changes it."""
    fs, p = _fs_path(spark, path)
    files = fs.listFiles(p, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join(sorted(found))


def a_data_file(spark: SparkSession, path: str) -> str | None:
    """One file of a table at ``path`` (hidden files and folders aside)."""
    fs, p = _fs_path(spark, path)
    root = fs.getFileStatus(p).getPath().toString().rstrip("/")
    files = fs.listFiles(p, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if not any(part[:1] in "_." for part in name[len(root):].strip("/").split("/")):
            return name
    return None


def swap_in(spark: SparkSession, new: str, target: str) -> None:
    """Put the finished folder ``new`` in the place of ``target``. The old
    content is moved aside first and removed last, so at every moment one of
    the two is whole; a rename that fails puts the old content back."""
    import uuid

    fs, src = _fs_path(spark, new)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    dst, aside = path(target), path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex}")
    had = bool(fs.exists(dst))
    if had and not fs.rename(dst, aside):
        raise RuntimeError(f"could not move {target} aside")
    if not publish(spark, new, target):
        if had:
            fs.rename(aside, dst)
        raise RuntimeError(f"could not move {new} to {target}")
    if had:
        fs.delete(aside, True)


def publish(spark: SparkSession, tmp: str, final: str) -> bool:
    """Atomically move a finished directory into place; False when another
    writer got there first (the caller then uses theirs)."""
    fs, src = _fs_path(spark, tmp)
    dst = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(final)
    parent = dst.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(src, dst))
