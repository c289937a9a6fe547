"""Session helpers: size checks, scalar sub-queries and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from sitewarden.constants import BROADCAST_MAX_ROWS, PARTITION_ROWS

_local_dirs: dict[str, str] = {}


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True if `df` has at most `max_rows` rows. The limit bounds the work of the check."""
    return df.select().limit(max_rows + 1).count() <= max_rows


def resolve_strategy(df: DataFrame, strategy: str = "auto") -> str:
    """'broadcast' when `df` is proven small, otherwise 'shuffle'."""
    if strategy == "auto":
        return "broadcast" if fits(df) else "shuffle"
    if strategy not in ("broadcast", "shuffle"):
        raise ValueError(f"unknown join strategy: {strategy}")
    return strategy


def by_key(df: DataFrame, keys: Sequence[str], rows: int = PARTITION_ROWS) -> DataFrame:
    """`df` dealt by its keys over as many partitions as its count asks for, `rows` in each, so that a task's memory is bounded."""
    return df.repartition(max(1, -(-df.count() // rows)), *keys)


def scalar_of(df: DataFrame, value: Column) -> Column:
    """`value` aggregated over `df` as a scalar sub-query: no join and no driver round trip."""
    return df.agg(value.alias("v")).scalar()


_ONE_MACHINE = ("/tmp", "/var/tmp", "/dev/shm", "/run", "/private/tmp")


def _of_one_machine(spark: SparkSession, root: str) -> bool:
    """True for the temporary folders of the local file system, whether the scheme is named or the default one.

    Other local paths may be mounts that all machines share; that cannot be told from here.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return False
    name = os.path.normpath(path.toUri().getPath())
    return any(name == p or name.startswith(f"{p}/") for p in (*_ONE_MACHINE, tempfile.gettempdir()))


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables: spark.checkpoint.dir, a temporary one only on local[*]."""
    local = spark.sparkContext.master.startswith("local")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not local and _of_one_machine(spark, root):
            raise ValueError(f"{root} is a folder of one machine; spark.checkpoint.dir has to be shared")
        return root.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="sitewarden-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the work folder that nothing has been written to yet."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the work folder and read it back: ends the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sitewarden")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture costs about 2 ms per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
