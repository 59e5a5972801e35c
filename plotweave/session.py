"""Session settings and the shared folder for checkpoints and stage tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Small splits are dealt to tasks of about so many bytes.
TASK_BYTES = 1 << 24


def local_session(
    cpus: int | str = "*", app_name: str = "plotweave", checkpoint_dir: str = "/tmp/plotweave-checkpoints"
) -> SparkSession:
    """A session for tests and the bench, which name the folder; a cluster brings its own."""
    partitions = "8" if cpus == "*" else str(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config(CHECKPOINT_SETTING, checkpoint_dir)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this session, set on first use.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, as in tests, it is
    a folder beside the warehouse's tables. On a cluster that must be one all executors reach, not
    a path of one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or sc.getConf().get(CHECKPOINT_SETTING)
    if not configured and current is None:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
        if not sc.master.startswith("local") and configured.split(":")[0] in ("file", configured):
            raise ValueError(f"set {CHECKPOINT_SETTING}: {configured} is a folder of one machine")
    configured = configured or current
    if current is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; one application's stages share a parent."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/stages/{application}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder and read it back.

    For tables that several later steps read: they are computed once, later plans start
    from a columnar scan that reads only the columns it needs, and a lost executor costs
    no recomputation.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def stage_bucketed(df: DataFrame, keys: list[str], name: str, move: bool = True) -> DataFrame:
    """Store ``df`` in hash buckets of ``keys``: sums over and joins on them don't move it again.

    There are as many buckets as shuffle partitions. The files lie in the shared folder; the
    catalog entry is the session's own. Without ``move`` the rows stay with their tasks, each of
    which writes a file per bucket it has.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known_as, path = f"plotweave_{name}_{uuid.uuid4().hex}", stage_path(spark, name)
    rows = df.repartition(n, *keys) if move else df
    rows.write.bucketBy(n, *keys).option("path", path).format("parquet").saveAsTable(known_as)
    table = spark.table(known_as)
    table.stored_at, table.known_as = path, known_as
    return table


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@contextmanager
def split_size(spark: SparkSession, path: str, size: int) -> Iterator[None]:
    """Files are read in splits of ``size`` bytes inside; those of ``path`` in few tasks.

    Both are settings of the session. Without the second, Spark makes a task of every split that
    is smaller than the cost it reckons for opening a file.
    """
    files, where = file_system(spark, path)
    tasks = max(4 * spark.sparkContext.defaultParallelism, files.getContentSummary(where).getLength() // TASK_BYTES)
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.maxPartitionNum": str(tasks)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def drop_stage(table: DataFrame | None) -> None:
    """Delete what ``stage`` or ``stage_bucketed`` stored, once nothing reads it any more."""
    known = vars(table) if table is not None else {}
    if known.get("known_as"):
        table.sparkSession.sql(f"DROP TABLE IF EXISTS {known['known_as']}")
    if known.get("stored_at"):
        files, path = file_system(table.sparkSession, known["stored_at"])
        files.delete(path, True)


def stage_measured(df: DataFrame, name: str, *measures: Column) -> tuple[DataFrame, dict]:
    """``stage``, with aggregates over the rows taken while they are written."""
    observed = Observation()
    return stage(df.observe(observed, *measures), name), observed.get
