"""Written intermediate tables and input spreading."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders made for local sessions, by application.
_own: dict[str, str] = {}

# Paths that ``stage`` has written inside the open ``StagedTables`` of a thread.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one behind ``spark.checkpoint.dir``.

    Only a local session where nothing is set, as in tests, gets a folder on this
    machine, which is deleted at exit. The session's settings are not touched.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return f"{folder}/staged-{context.applicationId}"
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="tablework-")
        atexit.register(shutil.rmtree, _own[context.applicationId], ignore_errors=True)
    return _own[context.applicationId]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete all staged tables of this application; results that still read them are lost."""
    _delete(spark, scratch_dir(spark))


class StagedTables:
    """The tables that ``stage`` writes inside the ``with`` block, in this thread, so that a
    chain of jobs holds on to its last result only. An inner block has its own tables."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> StagedTables:
        self._before = _noted.set(self.paths)
        return self

    def __exit__(self, *failure) -> None:
        _noted.reset(self._before)

    def drop(self, but: DataFrame) -> None:
        """Delete these tables except those that ``but`` reads; other results that read them are lost."""
        needed = {file.rsplit("/", 2)[-2] for file in but.inputFiles()}
        for path in [p for p in self.paths if p.rsplit("/", 1)[1] not in needed]:
            _delete(self.spark, path)
            self.paths.remove(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet and read it back.

    The table outlives lost executors, later reads take only the columns they
    need, and its size on disk tells the planner whether a join may broadcast
    it (``spark.sql.autoBroadcastJoinThreshold``) or has to shuffle. It stays until
    ``drop_staged`` or ``StagedTables.drop``.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if (paths := _noted.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unnest(df: DataFrame, array: str | Column, out: str) -> DataFrame:
    """One row per element of ``array`` as column ``out``; rows without elements drop out.

    A plain ``explode`` makes the planner add a filter on the array's size at the
    scan, which works out the whole array expression a second time; the outer
    form with a filter on the element does not.
    """
    keep = [c for c in df.columns if c != array]
    return df.select(*keep, F.explode_outer(array).alias(out)).filter(F.col(out).isNotNull())


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores one split per core, by a shuffle.

    For scans that feed heavy per-row work. A table of normal size has more
    splits than the cluster has cores and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
