"""Session settings for large runs, and the shared scratch folder."""

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

from landfall.sources.paths import join_path

MB = 1024 * 1024
MAX_SCAN_TASKS = 100_000
MAX_SHUFFLE_PARTITIONS = 32_768


def scale_conf(input_bytes, cores):
    """Settings sized to the input.

    Scan and shuffle tasks take about 128 MB each. Beyond some 4 TB of shuffle and
    12 TB of scan the tasks grow instead of their number, because a shuffle moves
    (scan tasks x shuffle partitions) blocks; at 100 TB that is 1 GB a scan task and
    a few billion blocks of about 30 KB. Adaptive execution merges partitions that
    turn out small, and splits hot ones of joins and rebalanced writes; aggregates and
    windows stay unsplit, and are kept narrow by what runs before their shuffle.
    """
    shuffle_partitions = min(-(-input_bytes // (128 * MB)), MAX_SHUFFLE_PARTITIONS)
    split = min(max(128 * MB, input_bytes // MAX_SCAN_TASKS), 1024 * MB)
    return {
        "spark.sql.shuffle.partitions": str(max(cores, shuffle_partitions)),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def input_bytes(spark, paths):
    """Bytes of the files and folders ``paths``, as their file systems add them up."""
    total = 0
    for text in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        total += files.getContentSummary(path).getLength()
    return total


def build_session(app_name, conf=None, master=None):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def free_disk(spark):
    """Have Spark delete the shuffle files of finished queries now.

    By itself it does so when the driver's garbage collector finds their plans, which may be long after
    the last use. Files of running queries, and of frames still held, stay. The empty query takes the
    place of the last one as the newest that Spark's listeners have seen, which they hold on to.
    """
    gc.collect()
    spark.sql("SELECT 1").collect()
    spark._jvm.System.gc()


def scratch_dir(spark, name):
    """A new path for ``name`` that every executor can reach, removed when Spark ends.

    It lies under the cluster's ``spark.checkpoint.dir``. Only a local session that
    has no such setting falls back to the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="landfall-")
    folder = join_path(shared, f"landfall-{uuid.uuid4().hex}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return join_path(folder, name)
