"""Generations of a run's tables, published by one manifest.

A run writes all of its tables into a new folder `gen=<name>` below its output folder and then publishes
the generation by one small manifest file, `_manifests/<seq>.json`, which is written under a temporary
name and renamed into place. A reader takes the manifest with the highest number and reads the tables it
names, so it never sees a half-written run, and frames that a former run returned keep reading their own
generation while a new one is written. After publishing, the run's staged tables (`_staged` of its
generation) are removed, as are generations older than the last `retain`, with their manifests.
Generations that were never published (a run that failed) are removed once a later run publishes and
they are older than the retained ones.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

RETAIN = 2
MANIFESTS = "_manifests"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, root = _fs(spark, folder)
    if not fs.exists(root):
        return []
    return [status.getPath().getName() for status in fs.listStatus(root)]


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def manifests(spark: SparkSession, out: str) -> list[dict]:
    """Published manifests of an output folder, oldest first."""
    found = []
    for name in _names(spark, f"{out.rstrip('/')}/{MANIFESTS}"):
        if name.endswith(".json") and name[:-5].isdigit():
            fs, path = _fs(spark, f"{out.rstrip('/')}/{MANIFESTS}/{name}")
            stream = fs.open(path)
            try:
                data = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
            finally:
                stream.close()
            found.append(json.loads(data.decode("utf-8")))
    return sorted(found, key=lambda m: m["sequence"])


def latest(spark: SparkSession, out: str) -> dict | None:
    """The last published manifest, or None."""
    found = manifests(spark, out)
    return found[-1] if found else None


def table_path(spark: SparkSession, out: str, table: str) -> str:
    """Where the last published generation keeps a table."""
    manifest = latest(spark, out)
    if manifest is None or table not in manifest["tables"]:
        raise FileNotFoundError(f"no published table {table} below {out}")
    return manifest["tables"][table]["path"]


def read_latest(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The Parquet tables of the last published generation by name (text tables are left out)."""
    manifest = latest(spark, out)
    if manifest is None:
        return {}
    return {name: spark.read.parquet(t["path"]) for name, t in manifest["tables"].items() if t["format"] == "parquet"}


class Generation:
    """One run's tables: written below `gen=<name>`, visible only after `publish`."""

    def __init__(self, spark: SparkSession, out: str, retain: int = RETAIN):
        self.spark, self.out, self.retain = spark, out.rstrip("/"), retain
        self.name = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"
        self.root = f"{self.out}/gen={self.name}"
        self.tables: dict[str, dict] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def add(self, table: str, fmt: str = "parquet") -> str:
        """Records a table that the caller has written at `path(table)`."""
        self.tables[table] = {"path": self.path(table), "format": fmt}
        return self.path(table)

    def write(self, df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
        """Writes a Parquet table of this generation and reads it back."""
        df.write.partitionBy(*(partition_by or [])).parquet(self.path(table))
        self.add(table)
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def stage(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Writes an intermediate table of this run; it is removed when the run is published."""
        path = f"{self.root}/_staged/{name}-{uuid.uuid4().hex}"
        df.write.partitionBy(*(partition_by or [])).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self) -> dict:
        """Makes the generation the latest by one rename, then removes what is no longer kept."""
        done = manifests(self.spark, self.out)
        sequence = (done[-1]["sequence"] + 1) if done else 0
        manifest = {"sequence": sequence, "generation": self.name, "tables": self.tables}
        folder = f"{self.out}/{MANIFESTS}"
        fs, temp = _fs(self.spark, f"{folder}/.{self.name}.tmp")
        stream = fs.create(temp, True)
        try:
            stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode("utf-8")))
        finally:
            stream.close()
        _, final = _fs(self.spark, f"{folder}/{sequence:010d}.json")
        if fs.exists(final) or not fs.rename(temp, final):
            fs.delete(temp, False)
            raise RuntimeError(f"another run published generation {sequence} below {self.out} at the same time")
        _delete(self.spark, f"{self.root}/_staged")
        self._prune(done + [manifest])
        return manifest

    def _prune(self, published: list[dict]) -> None:
        kept = {m["generation"] for m in published[-self.retain:]}
        for m in published[:-self.retain]:
            _delete(self.spark, f"{self.out}/{MANIFESTS}/{m['sequence']:010d}.json")
        oldest_kept = min(kept)
        for name in _names(self.spark, self.out):
            if name.startswith("gen=") and name[4:] not in kept and name[4:] < oldest_kept:
                _delete(self.spark, f"{self.out}/{name}")
