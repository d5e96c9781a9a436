"""Session settings and the shared folder for staged files.

Staged files (a written table that cuts lineage, or a file handed to a
source) go under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that is unset on a local master (tests, a laptop) does the
library pick a folder of its own; on a cluster it refuses, because a
machine-local folder is not visible to other executors.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "chaintally",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "app")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when unset locally."""
    sc = _context(spark)
    root = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if sc is None or not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for staged files")
    root = tempfile.mkdtemp(prefix="chaintally-checkpoint-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


# Folders staged within the innermost ``staged_scope``.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def staging_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    """A fresh folder name under the checkpoint root (never reused); ``kept`` folders outlive a ``staged_scope``."""
    path = f"{checkpoint_root(spark).rstrip('/')}/staged-{name}-{uuid.uuid4().hex[:12]}"
    if not kept and _made.get() is not None:
        _made.get().append(path)
    return path


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders of any file system Spark reaches; one that isn't there is passed over."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        place = jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(conf).delete(place, True)


@contextmanager
def staged_scope(spark: SparkSession):
    """Delete at the end what is staged within, also after a failure.

    What is made from the staged folders must be written by then, to a path named outside:

        path = staging_path(spark, "result")
        with staged_scope(spark):
            operator(df).write.parquet(path)
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        delete_folders(spark, made)


def materialize(df):
    """Cut the lineage of an intermediate result that several branches read.

    A reliable checkpoint into the shared checkpoint folder: the upstream
    job runs once, the branches read the written rows, and a lost executor
    does not force the upstream job to run again.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
