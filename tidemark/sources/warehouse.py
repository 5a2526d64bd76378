"""Stored relations in versions: all of them change at once, parts that do not change stay.

    <root>/data/<relation>/<id>/_part=<value>/...   rows of one part, never changed
    <root>/_versions/000000007.json                 which parts make up every relation

A refresh writes the parts it changes to new folders and then puts down one version file; that
is the only step that readers can see.  A refresh that stops before leaves folders that no version
names.  Versions before the last one stay readable until ``remove_old`` takes them away after a
grace period, so a reader that has begun goes on undisturbed.

There is one writer at a time.  A second one that finishes in between is refused (``Superseded``).
The version file lists parts (months, buckets), so it grows with their number and not with rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

PART = "_part"
DATA, VERSIONS = "data", "_versions"


class Superseded(RuntimeError):
    """Another writer published a version in the meantime."""


@dataclass(frozen=True)
class StoredRelation:
    """Schema and folder of every part, relative to the root."""

    schema: str
    parts: dict[str, str]


@dataclass(frozen=True)
class Version:
    number: int = 0
    relations: dict[str, StoredRelation] = field(default_factory=dict)
    #: What the relations were built with, for the next refresh to compare.
    basis: dict[str, str] = field(default_factory=dict)

    def as_json(self) -> str:
        relations = {n: {"schema": r.schema, "parts": r.parts} for n, r in self.relations.items()}
        return json.dumps({"number": self.number, "relations": relations, "basis": self.basis}, indent=1)

    @staticmethod
    def from_json(text: str) -> Version:
        raw = json.loads(text)
        relations = {n: StoredRelation(r["schema"], r["parts"]) for n, r in raw["relations"].items()}
        return Version(raw["number"], relations, raw["basis"])


class Warehouse:
    """The versions below one root, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        path = self._path("")
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def _listed(self, below: str) -> list:
        path = self._path(below)
        return list(self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _version_files(self) -> dict[int, object]:
        names = {s.getPath().getName(): s for s in self._listed(VERSIONS)}
        return {int(n[:-5]): s for n, s in names.items() if n.endswith(".json") and n[:-5].isdigit()}

    def _read_text(self, path) -> str:
        stream = self._fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def current(self) -> Version:
        """The last version; number 0 without relations if nothing was published yet."""
        files = self._version_files()
        if not files:
            return Version()
        return Version.from_json(self._read_text(files[max(files)].getPath()))

    def read(
        self,
        version: Version,
        name: str,
        parts: Collection[str] | None = None,
        without: Collection[str] = (),
    ) -> DataFrame:
        """A relation, or some of its parts; folders of other parts are not even listed."""
        stored = version.relations[name]
        schema = T.StructType.fromJson(json.loads(stored.schema))
        wanted = [p for p in stored.parts if (parts is None or p in parts) and p not in without]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        # Each folder is read by its own path, so the part does not come back as a column.
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{stored.parts[p]}" for p in sorted(wanted)])

    def write(self, name: str, rows: DataFrame, part: Column) -> StoredRelation:
        """Rows in new folders, one for each part that has rows.

        The rebalance hint lets adaptive execution split a part that holds most rows.
        """
        folder = f"{DATA}/{name}/{uuid.uuid4().hex}"
        rows.withColumn(PART, part).hint("rebalance", PART).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        found = [s.getPath().getName() for s in self._listed(folder) if s.isDirectory()]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        return StoredRelation(
            json.dumps(json.loads(schema.json())), {n.partition("=")[2]: f"{folder}/{n}" for n in found if "=" in n}
        )

    def replaced(self, before: StoredRelation, parts: Collection[str], new: StoredRelation) -> StoredRelation:
        """The relation with some parts replaced; one of them without new rows disappears."""
        if set(new.parts) - set(parts):
            raise ValueError(f"rows outside the replaced parts: {sorted(set(new.parts) - set(parts))[:3]}")
        kept = {p: f for p, f in before.parts.items() if p not in parts}
        return StoredRelation(new.schema, {**kept, **new.parts})

    def publish(self, before: Version, relations: Mapping[str, StoredRelation], basis: Mapping[str, str]) -> Version:
        """Make these relations the current version, in one step."""
        version = Version(before.number + 1, dict(relations), dict(basis))
        target = self._path(f"{VERSIONS}/{version.number:09d}.json")
        draft = self._path(f"{VERSIONS}/.draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(version.as_json().encode()))
        finally:
            stream.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise Superseded(f"version {version.number} of {self.root} exists already")
        return version

    def remove_old(self, grace_seconds: float) -> list[str]:
        """Drop versions superseded longer ago than the grace period, and the folders that no
        version left names and that are older than that.  Returns what was removed."""
        files = self._version_files()
        if not files:
            return []
        before = (time.time() - grace_seconds) * 1000
        numbers = sorted(files)
        # A version is superseded when the next one was put down.
        old = [n for n, after in zip(numbers, numbers[1:], strict=False) if files[after].getModificationTime() < before]
        left = [Version.from_json(self._read_text(files[n].getPath())) for n in numbers if n not in old]
        named = {f.rpartition("/")[0] for v in left for r in v.relations.values() for f in r.parts.values()}
        removed = []
        for n in old:
            self._fs.delete(files[n].getPath(), False)
            removed.append(f"{VERSIONS}/{files[n].getPath().getName()}")
        for relation in self._listed(DATA):
            for status in self._listed(f"{DATA}/{relation.getPath().getName()}"):
                folder = f"{DATA}/{relation.getPath().getName()}/{status.getPath().getName()}"
                if folder not in named and status.getModificationTime() < before:
                    self._fs.delete(self._path(folder), True)
                    removed.append(folder)
        return removed
