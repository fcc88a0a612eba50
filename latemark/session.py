"""Session helpers: shared folder, scratch paths, persistence that is released."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session.

    A local folder is made only where the setting is absent and the master is
    local, which is the case in tests.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="latemark-"))
    return context.getCheckpointDir()


#: Scratch paths made since the innermost run began; none outside a run.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_made() -> Iterator[list[str]]:
    """The scratch paths made in a block, for the caller to remove; an outer block knows them too."""
    outer, paths = _made.get(), []
    token = _made.set(paths)
    try:
        yield paths
    finally:
        _made.reset(token)
        if outer is not None:
            outer.extend(paths)


def owning_scratch(run: Callable) -> Callable:
    """A job whose result lists the scratch paths that its frames read, in ``scratch``."""

    @wraps(run)
    def owned(*args, **kwargs):
        with scratch_made() as paths:
            result = run(*args, **kwargs)
        result.scratch = list(paths)
        return result

    return owned


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders wherever Spark can reach them."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a reused frame in memory or on disk for the length of a block.

    Lost blocks are recomputed from the lineage, so losing an executor costs time
    and not the run.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` into the shared folder and cut its lineage there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
