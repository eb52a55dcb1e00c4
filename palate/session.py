"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

#: What the innermost ``scratch`` scope owns; threads started by a search inherit none and own nothing.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)
#: Applications and the local folders that were found to be shared in them.
_SHARED: set[tuple[str, str]] = set()
#: Tasks that try a folder, at least; more where there are more cores.
LEAST_TRIALS = 64


def local_session(app: str, cpus: int | str = "*", conf: dict[str, str] | None = None) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter supplies one."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    A machine-local folder is made up only where the setting is absent *and* the
    master is local; on a cluster a missing setting is an error. A ``file:`` folder
    named on a cluster is either mounted by all machines or each machine's own disk,
    where a checkpoint is lost with the machine: ``is_shared`` tells the two apart
    once an application, and the latter is an error. Where
    ``spark.palate.localFolderIsShared`` is true, nothing is tried.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured and not context.master.startswith("local") and is_machine_local(spark, configured):
        if spark.conf.get("spark.palate.localFolderIsShared", "false").lower() != "true":
            _require_shared(spark, configured)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="palate-"))
    return context.getCheckpointDir().rstrip("/")


def is_machine_local(spark: SparkSession, path: str) -> bool:
    """Whether a path says ``file:``, or says no scheme where the default file system is a local one."""
    scheme = urlsplit(path).scheme or urlsplit(spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///").scheme
    return scheme == "file"


def is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds in ``folder`` what the executors write there: a file of each of so many tasks that all take part.

    Executors that come later are not asked.
    """
    tasks = max(spark.sparkContext.defaultParallelism, LEAST_TRIALS)
    path = f"{folder.rstrip('/')}/palate/{spark.sparkContext.applicationId}/tried-{uuid.uuid4().hex}"
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        return sum(name.startswith("part-") for name in names_in(spark, path)) == tasks
    finally:
        delete(spark, path)


def _require_shared(spark: SparkSession, folder: str) -> None:
    try:
        trial = (spark.sparkContext.applicationId, folder)
        shared = trial in _SHARED or is_shared(spark, folder)
    except Exception as problem:
        raise RuntimeError(f"spark.checkpoint.dir names a local folder, {folder}, which could not be tried") from problem
    if not shared:
        raise RuntimeError(f"spark.checkpoint.dir names a local folder, {folder}, and the driver does not find what executors write there")
    _SHARED.add(trial)


def _on_disk(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _on_disk(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    files, where = _on_disk(spark, path)
    files.delete(where, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none where there is no folder."""
    files, where = _on_disk(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def application_dir(spark: SparkSession) -> str:
    """Where this application's written intermediates are."""
    return f"{shared_dir(spark)}/palate/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession, checkpoints: bool = True) -> None:
    """Delete this application's written intermediates and checkpoints; call it when all results are read.

    Spark keeps the checkpoints of an application in a folder of its own, and deletes them by itself only for
    frames that the driver has forgotten, or never. With ``checkpoints=False`` they stay.
    """
    delete(spark, application_dir(spark))
    made = spark.sparkContext.getCheckpointDir()
    if checkpoints and made:
        delete(spark, made)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is written in between, at the end of a ``with`` block: scratch paths and ``materialize``d frames.

    Results that read from those must be written or collected before the block ends. A block within
    another owns what is written in it.
    """
    owned: list[str] = []
    token = _SCOPE.set(owned)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in owned:
            delete(spark, path)


def _own(path: str) -> str:
    owned = _SCOPE.get()
    if owned is not None:
        owned.append(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, so no run overwrites another's files."""
    return _own(f"{application_dir(spark)}/{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written rows."""
    shared_dir(df.sparkSession)
    written = df.checkpoint(eager=True)
    if _SCOPE.get() is not None:
        _own(written._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
    return written


def settle(df: DataFrame) -> DataFrame:
    """``materialize``, after which the shuffle files that ``df`` left on the executors' disks are deleted.

    Spark does so only when the driver's garbage collector finds the plan unused. If ``df`` itself is executed again, or
    an RDD it was made of, that shuffles again; what is cached or was written stays.
    """
    written = materialize(df)
    df._jdf.queryExecution().toRdd().cleanShuffleDependencies(True)
    return written
