"""Session settings and the shared folder for checkpoints and scratch tables."""

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A UTC session with adaptive execution, for one machine; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vitalgrid")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture costs more than the plans it describes
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get(_CHECKPOINT_KEY, None) or context.getConf().get(_CHECKPOINT_KEY)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="vitalgrid-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive lost executors and the plan starts from them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_RUN_FOLDER: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in the folder of this run or of this application."""
    folder = _RUN_FOLDER.get() or f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A run whose written tables go when it ends; its results are to be read or stored before."""
    folder = scratch_path(spark, "run")
    outer = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a stage's result below the shared folder and go on from the files.

    Later passes read only the columns they need and never repeat the work before.
    `by` makes folders of these columns, so that a filter on them reads only its part.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
