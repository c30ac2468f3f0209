"""Versioned parquet tables, published all at once by one small pointer file."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

WHOLE = ""  # partition name of an unpartitioned table
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
CODEC = "zstd"  # every version of a table is written anew


class TableStore:
    """Named tables under one root folder.

    ``_published/<n>.json`` lists, per table, which folder holds each of its partitions; the highest
    number is current. Writers put data into new folders and then create the next pointer file
    without overwrite, so readers see either all of a run's tables or none, and two writers cannot
    both win. Files are reached through the Hadoop file system of the root, never a local path.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def current(self) -> tuple[int, dict[str, dict[str, str]]]:
        """Current version number and its manifest; (0, {}) when nothing is published."""
        fs, folder = self._fs(), self._path("_published")
        if not fs.exists(folder):
            return 0, {}
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return 0, {}
        return max(numbers), self.version(max(numbers))

    def tables(self) -> list[str]:
        return sorted(self.current()[1])

    def read(self, name: str) -> DataFrame:
        frame = self.read_manifest(self.current()[1], name)
        if frame is None:
            raise KeyError(f"{name} is not published under {self.root}")
        return frame

    def get(self, name: str) -> DataFrame | None:
        return self.read_manifest(self.current()[1], name)

    def read_manifest(self, manifest: Mapping, name: str,
                      partitions: set[str] | None = None) -> DataFrame | None:
        folders = manifest.get(name, {})
        paths = [p for k, p in folders.items() if partitions is None or k in partitions]
        return self.spark.read.parquet(*paths) if paths else None

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the newest ``keep`` versions refer to, and older pointers; the deleted paths.

        No run may be in progress: what it has written is not referred to yet.
        """
        fs, current = self._fs(), self.current()[0]
        if not current:
            return []
        kept, gone = set(), []
        for number in range(max(1, current - keep + 1), current + 1):
            kept |= {p for parts in self.version(number).values() for p in parts.values()}
        clean = lambda p: p.toString().split(":", 1)[-1].replace("//", "/")
        kept = {clean(self.spark._jvm.org.apache.hadoop.fs.Path(p)) for p in kept}
        for table in fs.listStatus(self._path()):
            if not table.isDirectory() or table.getPath().getName().startswith("_published"):
                continue
            for folder in fs.listStatus(table.getPath()):
                own = clean(folder.getPath())
                if folder.isDirectory() and not any(k == own or k.startswith(own + "/") for k in kept):
                    fs.delete(folder.getPath(), True)
                    gone.append(own)
        for pointer in fs.listStatus(self._path("_published")):
            digits = pointer.getPath().getName().removeprefix("claim-").removesuffix(".json")
            if digits.isdigit() and int(digits) <= current - keep or pointer.getPath().getName().startswith("draft-"):
                fs.delete(pointer.getPath(), False)
        return gone

    def version(self, number: int) -> dict[str, dict[str, str]]:
        """The manifest of one version; {} when it is not kept."""
        fs, path = self._fs(), self._path("_published", f"{number:012d}.json")
        if not fs.exists(path):
            return {}
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def begin(self) -> "Publication":
        return Publication(self)


class Publication:
    """Tables written by one run; invisible until :meth:`commit`."""

    def __init__(self, store: TableStore):
        self.store = store
        self.version, self.base = store.current()
        self.changes: dict[str, dict[str, str | None]] = {}
        self.rows: dict[str, int] = {}
        self.run = uuid.uuid4().hex[:12]

    def read(self, name: str, partitions: set[str] | None = None) -> DataFrame | None:
        """The table as this run sees it: its own writes over the published version."""
        return self.store.read_manifest(self.manifest(), name, partitions)

    def partitions(self, name: str) -> set[str]:
        return set(self.manifest().get(name, {}))

    def manifest(self) -> dict[str, dict[str, str]]:
        merged = {k: dict(v) for k, v in self.base.items()}
        for name, parts in self.changes.items():
            target = merged.setdefault(name, {})
            for part, path in parts.items():
                if path is None:
                    target.pop(part, None)
                else:
                    target[part] = path
        return merged

    def _folder(self, name: str) -> str:
        return f"{self.store.root}/{name}/{self.run}-{uuid.uuid4().hex[:6]}"

    def write(self, name: str, df: DataFrame, partition: str = WHOLE) -> DataFrame:
        """Replace one partition of the table (the whole table by default) and read it back."""
        folder, seen = self._folder(name), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", CODEC).parquet(folder)
        self.rows[name] = seen.get["n"]
        self.changes.setdefault(name, {})[partition] = folder
        if partition == WHOLE:
            for old in self.base.get(name, {}):
                self.changes[name].setdefault(old, None)
        return self.store.spark.read.parquet(folder)

    def write_partitions(self, name: str, df: DataFrame, by: str, replaced: set[str]) -> None:
        """Write ``df`` split by the column ``by``; partitions in ``replaced`` that get no rows go.

        The rebalance hint gathers a partition value into few files, and AQE splits a value that
        holds a third of the table over many tasks.
        """
        folder = self._folder(name)
        (df.withColumn("_part", F.col(by)).hint("rebalance", "_part")
         .write.option("compression", CODEC).partitionBy("_part").parquet(folder))
        fs = self.store._fs()
        found = {}
        for status in fs.listStatus(self.store.spark._jvm.org.apache.hadoop.fs.Path(folder)):
            label = status.getPath().getName()
            if label.startswith("_part="):
                found[label[len("_part="):]] = f"{folder}/{label}"
        changes = self.changes.setdefault(name, {})
        changes.update({part: None for part in replaced})
        changes.update(found)

    def discard(self, name: str) -> None:
        """Delete what this run has written of a table that is for the run alone."""
        fs = self.store._fs()
        for path in self.changes.pop(name, {}).values():
            if path is not None:
                fs.delete(self.store.spark._jvm.org.apache.hadoop.fs.Path(path), True)

    def drop(self, name: str) -> None:
        """Publish without this table from now on."""
        if name in self.manifest():
            self.changes[name] = {part: None for part in self.base.get(name, {})}

    def commit(self) -> int:
        """Publish. Fails when another run has published since this one began."""
        number = self.version + 1
        path = self.store._path("_published", f"{number:012d}.json")
        fs = self.store._fs()
        fs.mkdirs(self.store._path("_published"))
        draft = self.store._path("_published", f"draft-{self.run}")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(self.manifest(), sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        # The number is claimed by creating a file that must not exist; a reader only ever sees a finished pointer, for
        # it gets its number by a rename that nobody else may do any more.
        taken = RuntimeError(f"version {number} of {self.store.root} was published by another run")
        try:
            fs.create(self.store._path("_published", f"claim-{number:012d}"), False).close()
        except Exception as e:
            raise taken from e
        if fs.exists(path) or not fs.rename(draft, path):
            raise taken
        return number
