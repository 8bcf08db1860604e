"""Model registry on the shared file system (ML-15).

A model is saved with MLlib writers under ``<root>/<name>/v<version>``.  Which
versions exist, and which one is current, is a log of small files that are
created once and never changed:

* ``<root>/<name>/_versions/<version>``: written before the model is saved, so
  that a version number is taken by one writer only;
* ``<root>/<name>/_pointer/<number>``: written after the model is saved; the
  last one names the current version.

Creating a file that must not exist yet is the compare-and-swap: a writer that
promotes reads the last number and creates the next one, and loses if another
was faster (it then tries again with the new last number).  A driver lost at
any step leaves the pointer it found: there is one current version, always.
"""

from __future__ import annotations

import json
import re
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

SCHEMA = "name string, version int, stage string, path string, registered_at timestamp"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _create(spark: SparkSession, path: str, content: dict) -> bool:
    """Creates a file that must not exist; False if it does."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - a Java error, told apart by its class
        if "FileAlreadyExists" in str(e):
            return False
        raise
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    return True


def _log(spark: SparkSession, folder: str) -> dict[int, dict | None]:
    """Entries by number; None for one whose writer was lost while it wrote."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return {}
    numbers = [int(f.getPath().getName()) for f in fs.listStatus(p) if re.fullmatch(r"[0-9]+", f.getPath().getName())]
    if not numbers:
        return {}
    found: dict[int, dict | None] = dict.fromkeys(numbers)
    for number, text in spark.sparkContext.wholeTextFiles(f"{folder}/[0-9]*").collect():  # one small file a version
        try:
            found[int(number.rsplit("/", 1)[1])] = json.loads(text)
        except ValueError:
            pass
    return found


def _reserve(spark: SparkSession, root: str, name: str) -> tuple[int, str]:
    version = max(_log(spark, f"{root}/{name}/_versions"), default=0) + 1
    while True:
        path = f"{root}/{name}/v{version}"
        entry = {"version": version, "path": path, "registered_at": datetime.now(timezone.utc).isoformat()}
        if _create(spark, f"{root}/{name}/_versions/{version:08d}", entry):
            return version, path
        version += 1  # another writer has it


def promote(spark: SparkSession, root: str, name: str, version: int, expected: int | None = None, swap: bool = False) -> bool:
    """Makes a saved version the current one.  With ``swap`` only if the
    current one is still ``expected``; returns whether it was done."""
    while True:
        log = _log(spark, f"{root}/{name}/_pointer")
        if swap and current_version(spark, root, name) != expected:
            return False
        if _create(spark, f"{root}/{name}/_pointer/{max(log, default=0) + 1:08d}", {"version": version}):
            return True


def current_version(spark: SparkSession, root: str, name: str) -> int | None:
    log = _log(spark, f"{root}/{name}/_pointer")
    return next((log[k]["version"] for k in sorted(log, reverse=True) if log[k]), None)


def register_model(spark: SparkSession, model, root: str, name: str, stage: str = "Production") -> int:
    """Takes the next version number, saves the model, and, for Production,
    makes it current; the one that was is archived by that."""
    version, path = _reserve(spark, root, name)
    model.write().overwrite().save(path)
    if stage == "Production":
        promote(spark, root, name, version)
    else:
        _create(spark, f"{root}/{name}/_stages/{version:08d}", {"stage": stage})
    return version


def versions(spark: SparkSession, root: str):
    """Every version of every model with its stage: Production (the current
    one), Archived (was current), a stage of its own, or None (never got that far)."""
    fs, p = _fs(spark, root)
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []
    rows = []
    for name in names:
        pointers = [e["version"] for e in _log(spark, f"{root}/{name}/_pointer").values() if e]
        current = current_version(spark, root, name)
        stages = {k: e["stage"] for k, e in _log(spark, f"{root}/{name}/_stages").items() if e}
        for k, e in _log(spark, f"{root}/{name}/_versions").items():
            stage = "Production" if k == current else "Archived" if k in pointers else stages.get(k, "None")
            rows.append((name, k, stage, e["path"] if e else None, datetime.fromisoformat(e["registered_at"]) if e else None))
    return spark.createDataFrame(rows, SCHEMA).orderBy("name", "version")


def load_model(spark: SparkSession, root: str, name: str, stage: str = "Production") -> PipelineModel:
    """The current version, or the newest one of another stage."""
    if stage == "Production":
        version = current_version(spark, root, name)
    else:
        found = [r.version for r in versions(spark, root).collect() if r.name == name and r.stage == stage]
        version = max(found, default=None)
    if version is None:
        raise LookupError(f"no {stage} version of {name!r}")
    return PipelineModel.load(f"{root}/{name}/v{version}")


__all__ = ["register_model", "promote", "current_version", "versions", "load_model"]
