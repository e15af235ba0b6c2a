"""The life of a run's intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_current: ContextVar[RunScope | None] = ContextVar("repseq_run_scope", default=None)


def current_scope() -> RunScope | None:
    return _current.get()


class RunScope:
    """Owns a folder under the shared one: what a run writes on its way goes there, and goes with it.

    ``with RunScope(spark, "run 7") as scope: pipeline.run(reads, config, scope=scope).write...`` — results are read
    lazily from the folder, so they are written before the scope ends. Ending removes the folder. A run that
    fails or is killed leaves it if it has a name; a run of the same name then takes up the stages
    that were finished. A stage counts as finished when all its files have been committed.
    """

    def __init__(self, spark: SparkSession, name: str | None = None):
        from repseq.operators.shared import checkpoint_dir

        self.spark, self.name = spark, name
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/run-{name or uuid.uuid4().hex}"
        self.skipped: list[str] = []

    def __enter__(self) -> RunScope:
        self._token = _current.set(self)
        return self

    def __exit__(self, kind, error, trace) -> None:
        _current.reset(self._token)
        if kind is None or self.name is None:
            self.remove()

    def _at(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists(self, path: str) -> bool:
        system, path = self._at(path)
        return system.exists(path)

    def remove(self) -> None:
        """Deletes the folder."""
        system, path = self._at(self.folder)
        system.delete(path, True)

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a stage: read if it was finished, else made and written."""
        path = f"{self.folder}/stage-{name}"
        if self.exists(f"{path}/_SUCCESS"):
            self.skipped.append(name)
        else:
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """A table without a name: written, and gone with the scope."""
        path = f"{self.folder}/table-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)
