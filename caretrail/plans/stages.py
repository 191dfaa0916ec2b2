"""Stage tables: intermediate results that several parts of a report read, written as Parquet in the shared folder.

A stage cuts the lineage (a lost executor costs at most one stage) and is read back with column pruning. Its folder is
named by a fingerprint of the report's inputs (their plans, files and sizes) and of the stage's name, below a folder
of the run. So two reports of one run that need the same stage write it once, and a run that is started again
after its driver was lost takes up the stages it had finished. :meth:`StageManager.drop` deletes what the run wrote;
the manager is a context manager that does so at the end of a run that succeeded, and keeps the finished stages of
one that failed.

Reports that are built without a manager use one of their application, whose stages go when the application ends,
since the returned DataFrame reads them until then.
"""

from __future__ import annotations

import atexit
import hashlib
import posixpath
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from caretrail.session import ensure_checkpoint_dir, stable_root

FOLDER = "caretrail-stages"


def _described(df: DataFrame) -> str | None:
    """The plan of a DataFrame that reads only files, with these files; None if it also reads data held in memory."""
    execution = df._jdf.queryExecution()
    leaves = execution.analyzed().collectLeaves()
    files = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            return None
        place = leaf.relation().location()
        if place.getClass().getSimpleName() == "InMemoryFileIndex":  # hashed where the list is; a writer never uses a file's name again
            names = place.allFiles().hashCode()
        else:
            names = list(place.inputFiles())
        files.append(f"{names} {place.sizeInBytes()} {place.rootPaths().mkString(',')}")
    conf, key = df.sparkSession.conf, "spark.sql.debug.maxToStringFields"
    before = conf.get(key)
    conf.set(key, "100000")
    try:
        plan = execution.analyzed().toString()
    finally:
        conf.set(key, before)
    return re.sub(r"#\d+L?", "", plan) + "\n".join(files)


def fingerprint(inputs: Mapping[str, DataFrame | None], options: str = "") -> str:
    """A name for what is computed from these inputs. Inputs held in memory get a name of their own each time."""
    said = [options]
    for name, df in sorted(inputs.items()):
        if df is not None:
            said.append(f"{name}: {_described(df) or uuid.uuid4()}")
    return hashlib.sha256("\n".join(said).encode()).hexdigest()[:24]


class StageManager:
    """The stages of one run. ``run`` names the run across restarts (its output folder, say); without it stages
    are found again within the application only."""

    def __init__(self, spark: SparkSession, run: str | None = None) -> None:
        self.spark = spark
        name = hashlib.sha256((run or spark.sparkContext.applicationId).encode()).hexdigest()[:16]
        base = ensure_checkpoint_dir(spark)
        self.top = posixpath.join(stable_root(spark) or base, FOLDER)
        self.root = posixpath.join(self.top, name)
        self.written = 0

    def _path(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str, of: str | None = None) -> DataFrame:
        """``df`` as a stage table; ``of`` is the fingerprint of what it is computed from (none: never found again)."""
        path = posixpath.join(self.root, f"{name}-{of or uuid.uuid4().hex[:24]}")
        done, fs = self._path(posixpath.join(path, "_SUCCESS"))
        if not (of and fs.exists(done)):
            df.write.mode("overwrite").parquet(path)
            self.written += 1
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete the run's stages, and the common folder if no other run has any."""
        root, fs = self._path(self.root)
        fs.delete(root, True)
        top, _ = self._path(self.top)
        if fs.exists(top) and not fs.listStatus(top):
            fs.delete(top, False)

    def __enter__(self) -> "StageManager":
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.drop()


_OWN: dict[str, StageManager] = {}


def of_application(spark: SparkSession) -> StageManager:
    """The manager of reports that are built without one; its stages are deleted when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = StageManager(spark)
        atexit.register(_drop_at_end, _OWN[app])
    return _OWN[app]


def _drop_at_end(manager: StageManager) -> None:
    try:
        manager.drop()
    except Exception:  # the JVM is gone already; the run's folder is found by its name
        pass
