"""Named stages whose results lie in a folder, so that a run can be resumed, or be run in part.

A stage writes Parquet tables below the run's folder and leaves a mark with a
digest of the settings that it and the stages it builds on read.  A stage that
runs again makes those that build on it out of date.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from kinlink.sources.store import removed


class StageError(RuntimeError):
    """A stage is unknown, or one that it builds on has not run."""


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    run: Callable[[Run], Any]
    reads: tuple[str, ...] = ()  # settings


class Run:
    """The folder of a run, its settings and its stages in order."""

    def __init__(self, spark: SparkSession, folder: str, settings: dict, stages: Iterable[Stage]):
        self.spark, self.folder, self.settings, self.stages = spark, folder.rstrip("/"), settings, {s.name: s for s in stages}

    def digest(self, name: str) -> str:
        stage = self.stages[name]
        read = {k: self.settings.get(k) for k in stage.reads} | {f"stage {n}": self.digest(n) for n in stage.needs}
        return hashlib.sha256(json.dumps(read, sort_keys=True, default=str).encode()).hexdigest()

    def _there(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{path}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        if not self._there(name):
            raise StageError(f"there is no table {name} in {self.folder}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def drop(self, name: str) -> None:
        removed(self.spark, f"{self.folder}/{name}")

    def done(self, name: str) -> bool:
        """Whether a stage has run with these settings."""
        mark = f"stages/{name}"
        return self._there(mark) and json.loads(self.spark.read.text(f"{self.folder}/{mark}").first()[0])["digest"] == self.digest(name)

    def result(self, name: str) -> Any:
        return json.loads(self.spark.read.text(f"{self.folder}/stages/{name}").first()[0])["result"]

    def builds_on(self, name: str) -> set[str]:
        """All stages that need a stage, directly or not."""
        out: set[str] = set()
        for s in self.stages.values():
            if name in s.needs or out & set(s.needs):
                out.add(s.name)
        return out

    def go(self, only: list[str] | None = None, resume: bool = False) -> dict[str, Any]:
        """Run the stages named (all, if none are); with ``resume`` those that are done are passed over."""
        if unknown := [n for n in only or () if n not in self.stages]:
            raise StageError(f"no stage {', '.join(unknown)}; there are {', '.join(self.stages)}")
        out = {}
        for stage in self.stages.values():
            if only and stage.name not in only:
                continue
            if resume and self.done(stage.name):
                out[stage.name] = self.result(stage.name)
                continue
            if lacking := [n for n in stage.needs if not self.done(n)]:
                raise StageError(f"stage {stage.name} needs {', '.join(lacking)}, which has not run with these settings")
            for later in (stage.name, *self.builds_on(stage.name)):
                self.drop(f"stages/{later}")
            out[stage.name] = stage.run(self)
            mark = json.dumps({"digest": self.digest(stage.name), "result": out[stage.name]}, default=str)
            self.spark.createDataFrame([(mark,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/stages/{stage.name}")
        return out
