"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Folders written inside each open scope, the innermost last.
_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessera")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: on a cluster an executor
    could not read what another one wrote there.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tessera-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def new_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new folder's name; with ``keep`` it outlives the innermost :func:`scratch` block."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    scopes = _scopes.get()[: -1 if keep else None]
    if scopes:
        scopes[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has written, wherever Spark keeps it."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Give a folder another name; whether there was one."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    files = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(there):
        return False
    if not files.rename(there, jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not move {path} to {to}")
    return True


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables written inside, once the block ends.

    Results that are still to be read are written with ``keep``: they go with the enclosing block, if
    there is one. Outside of any block nothing is removed.
    """
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in own:
            remove(spark, path)


def materialise(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage like a checkpoint does, survives lost executors, and unlike a
    checkpoint tells the optimizer the real size, so that it broadcasts only what is small.
    """
    spark = df.sparkSession
    path = new_path(spark, label, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
