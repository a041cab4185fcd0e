"""Tables that change in one step: data folders under new names, and a pointer to those that count."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Snapshots whose folders stay, so that a reader of the last but one can finish.
KEPT_SNAPSHOTS = 2


class Files:
    """A shared folder, on any storage that Spark can reach, as the driver sees it."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self.folder = folder.rstrip("/")
        path = self._path("")
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str = "") -> list[str]:
        """Names in a folder; none where it does not exist."""
        path = self._path(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """A file that appears as a whole under its name; False if there is one already."""
        hidden = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._path(hidden), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        made = not self._fs.exists(self._path(name)) and self._fs.rename(self._path(hidden), self._path(name))
        if not made:
            self.delete(hidden)
        return made

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class Pointer:
    """The content of a table or warehouse: JSON documents numbered from 1, of which the last one counts.

    A commit adds the next document, so readers see the old content or the new
    one and a writer that dies leaves the old. There is one writer at a time; a
    second one that starts from the same document fails to commit.
    """

    FOLDER = "_snapshots"

    def __init__(self, spark: SparkSession, folder: str):
        self.files = Files(spark, folder)

    def _numbers(self) -> list[int]:
        names = self.files.names(self.FOLDER)
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _document(self, number: int) -> dict:
        return json.loads(self.files.read(f"{self.FOLDER}/{number:012d}.json"))

    def read(self) -> tuple[int, dict]:
        """Number and content; (0, {}) before the first commit."""
        numbers = self._numbers()
        return (numbers[-1], self._document(numbers[-1])) if numbers else (0, {})

    def commit(self, after: int, content: dict) -> int:
        """Make ``content`` the next document, if ``after`` is still the last one."""
        last, number = (self._numbers() or [0])[-1], after + 1
        if last != after or not self.files.create(f"{self.FOLDER}/{number:012d}.json", json.dumps(content)):
            raise RuntimeError(f"{self.files.folder} changed since snapshot {after}: another writer is at work")
        return number

    def clean(self, named: Callable[[dict], Iterable[str]], found: Iterable[str]) -> None:
        """Delete old documents, and those of the ``found`` folders that no kept document names."""
        numbers = self._numbers()
        kept = {f for n in numbers[-KEPT_SNAPSHOTS:] for f in named(self._document(n))}
        for folder in found:
            if folder not in kept:
                self.files.delete(folder)
        for number in numbers[:-KEPT_SNAPSHOTS]:
            self.files.delete(f"{self.FOLDER}/{number:012d}.json")


class BatchTable:
    """A table that grows by numbered batches, each of which counts once.

    A batch is a part of level 0. ``fan_in`` parts of a level are merged into
    one of the next, by ``merge`` where rows can be combined, so a row is
    rewritten once a level and after n batches there are fewer than ``fan_in``
    parts for each power of ``fan_in`` up to n. The batch and the merge it sets
    off are one commit. A batch that comes again, as after a crash between the
    commit and the stream's own checkpoint, changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, fan_in: int = 8):
        self.spark, self.folder, self.fan_in = spark, folder.rstrip("/"), fan_in
        self.pointer = Pointer(spark, folder)

    @property
    def parts(self) -> list[dict]:
        return self.pointer.read()[1].get("parts", [])

    def has(self, batch: int, stream: str) -> bool:
        """Whether the table has this batch; it takes batches of one stream only, as their numbers say when they come."""
        content = self.pointer.read()[1]
        if content and content["stream"] != stream:
            raise ValueError(f"{self.folder} holds batches of another stream: its checkpoint was lost or replaced")
        return bool(content) and content["batch"] >= batch

    def paths(self, parts: list[dict]) -> list[str]:
        return [f"{self.folder}/{p['folder']}" for p in parts]

    def read(self, parts: list[dict] | None = None) -> DataFrame:
        """Rows of all parts, or of some."""
        content = self.pointer.read()[1]
        if not content:
            raise FileNotFoundError(f"no batch in {self.folder}")
        chosen = content["parts"] if parts is None else parts
        reader = self.spark.read.schema(StructType.fromJson(content["schema"]))
        return reader.parquet(*self.paths(chosen))

    def _write(self, rows: DataFrame, level: int, partition_by: list[str]) -> dict:
        part = {"folder": f"part-{level}-{uuid.uuid4().hex}", "level": level}
        rows.write.partitionBy(*partition_by).parquet(f"{self.folder}/{part['folder']}")
        return part

    def append(
        self,
        rows: DataFrame,
        batch: int,
        stream: str,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        partition_by: tuple[str, ...] = (),
    ) -> bool:
        """Add a batch, if it is new, and merge full levels. Parts keep the columns of the first."""
        if self.has(batch, stream):
            return False
        number, content = self.pointer.read()
        schema = StructType.fromJson(content["schema"]) if content else rows.schema
        rows = rows.select(*schema.names)
        parts = [*content.get("parts", []), self._write(rows, 0, list(partition_by))]
        level = 0
        while len(full := [p for p in parts if p["level"] == level]) >= self.fan_in:
            whole = self.spark.read.schema(schema).parquet(*self.paths(full))
            # gathers the small files of batches; adaptive execution sizes the new ones
            whole = merge(whole).select(*schema.names) if merge else whole.hint("rebalance", *partition_by)
            merged = self._write(whole, level + 1, list(partition_by))
            parts = [*(p for p in parts if p["level"] != level), merged]
            level += 1
        changed = {"stream": stream, "batch": batch, "schema": schema.jsonValue(), "parts": parts}
        self.pointer.commit(number, changed)
        found = [n for n in self.pointer.files.names() if n.startswith("part-")]
        self.pointer.clean(lambda c: [p["folder"] for p in c["parts"]], found)
        return True
