"""Restartable runs: stages that write their result once, with a manifest that says from what.

A stage's fingerprint covers its name and version, the parameters it reads, the files of the sources it reads (path, length,
time of change) and the fingerprints of the stages it reads. Its result goes to a folder of its own; the manifest that names the folder
is written after the result is complete. So a run that broke starts again after the last finished stage, a stage whose
inputs changed is built anew with all that follow, and a half-written result is never read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Stage:
    """``build`` takes the frames of ``reads`` (sources and earlier stages, by name) and the run's parameters."""

    name: str
    reads: tuple[str, ...]
    build: Callable[[dict[str, DataFrame], dict], DataFrame]
    version: str = "1"


class _Folder:
    """The few file operations a manifest needs, on whatever store the folder lies."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._spark, self.folder = spark, folder

    def read(self, name: str) -> dict | None:
        path = self._path(self.folder, name)
        if not self._files.exists(path):
            return None
        stream = self._files.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        except (json.JSONDecodeError, Py4JJavaError):  # cut off while it was written, or damaged
            return None
        finally:
            stream.close()

    def write(self, name: str, content: dict) -> None:
        """Written beside and renamed, so a reader sees the old, no or the new manifest, never a part of one."""
        beside, path = self._path(self.folder, f".{name}.{uuid.uuid4().hex}"), self._path(self.folder, name)
        stream = self._files.create(beside)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()
        if self._files.exists(path):
            self._files.delete(path, False)
        if not self._files.rename(beside, path):
            raise OSError(f"cannot write {path}")

    def exists(self, name: str) -> bool:
        return self._files.exists(self._path(self.folder, name))

    def facts(self, path: str) -> tuple[str, int, int]:
        status = self._files_of(path).getFileStatus(self._path(path))
        return path, status.getLen(), status.getModificationTime()

    def _files_of(self, path: str):
        return self._path(path).getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        path = self._path(self.folder)
        return [s.getPath().getName() for s in self._files.listStatus(path)] if self._files.exists(path) else []

    def delete(self, name: str) -> None:
        self._files.delete(self._path(self.folder, name), True)


def _digest(parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def source_print(store: _Folder, df: DataFrame) -> str:
    """Fingerprint of the files a frame reads and of its columns."""
    return _digest([[store.facts(f) for f in sorted(df.inputFiles())], df.schema.json()])


def run_stages(spark: SparkSession, folder: str, stages: list[Stage], sources: dict[str, DataFrame], parameters: dict) -> dict[str, DataFrame]:
    """Every stage's result, read from its folder; only stages without a valid manifest are built."""
    store, frames, prints = _Folder(spark, folder), dict(sources), {}
    for stage in stages:
        unknown = [r for r in stage.reads if r not in frames]
        if unknown:
            raise KeyError(f"stage {stage.name} reads {unknown}, which nothing before it gives")
        for name in stage.reads:
            if name not in prints:
                prints[name] = source_print(store, frames[name])
        mark = _digest([stage.name, stage.version, parameters, {r: prints[r] for r in stage.reads}])
        manifest = store.read(f"{stage.name}.json")
        if not (manifest and manifest["fingerprint"] == mark and store.exists(f"{manifest['data']}/_SUCCESS")):
            data = f"{stage.name}-{uuid.uuid4().hex}"
            stage.build({r: frames[r] for r in stage.reads}, parameters).write.parquet(f"{folder}/{data}")
            manifest = {"fingerprint": mark, "data": data, "stage": stage.name, "version": stage.version, "reads": list(stage.reads)}
            store.write(f"{stage.name}.json", manifest)
        frames[stage.name], prints[stage.name] = spark.read.parquet(f"{folder}/{manifest['data']}"), manifest["fingerprint"]
    return {s.name: frames[s.name] for s in stages}


def sweep(spark: SparkSession, folder: str) -> list[str]:
    """Delete the results that no manifest names: those of broken and of replaced stages. Not while a run is on."""
    store = _Folder(spark, folder)
    names = store.names()
    kept = {(store.read(n) or {}).get("data") for n in names if n.endswith(".json") and not n.startswith(".")}
    gone = sorted(n for n in names if n not in kept and (n.startswith(".") or not n.endswith(".json")))
    for name in gone:
        store.delete(name)
    return gone
