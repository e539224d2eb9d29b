"""A stored table with versions: parquet files, one manifest per commit, and a pointer that moves in one step.

A commit writes its files to a folder of its own and then a manifest ``_versions/<number>.json`` that names, for every
partition, the folder that holds it. The manifest is created under a number that must not exist yet, which the file system
does for one writer only; until then nobody sees the new files, so a failed commit leaves the old version and two writers
can't both make the same one. Partitions that a commit does not touch keep their folders: nothing is copied.

Readers take the files of one manifest, so a version that was read stays the same whatever is committed later.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.changes import merge_upsert
from ledgerloom.operators.joins import require_unique
from ledgerloom.sources.writers import conform

_PART = "__part"


class CommitConflict(RuntimeError):
    """Another writer has committed the version this one was about to make."""


@dataclass(frozen=True)
class Manifest:
    """One version: where each partition lies, and the values it stands for as JSON."""

    version: int
    schema: T.StructType
    by: tuple[str, ...]
    folders: dict[str, str]
    values: dict[str, str]


class VersionedTable:
    """``root`` has to be on a file system that creates a file for one writer only (HDFS and local disks do)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- manifests ---

    def _path(self, where: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        path, fs = self._path(f"{self.root}/_versions")
        if not fs.exists(path):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def manifest(self, version: int | None = None) -> Manifest:
        version = version if version is not None else max(self.versions(), default=None)
        if version is None:
            raise FileNotFoundError(f"no version in {self.root}")
        path, fs = self._path(f"{self.root}/_versions/{version:012d}.json")
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        held = json.loads(text)
        return Manifest(version, T.StructType.fromJson(held["schema"]), tuple(held["by"]), held["folders"], held["values"])

    def _publish(self, manifest: Manifest) -> Manifest:
        """Make the version visible, or fail if somebody else was first."""
        held = {"schema": manifest.schema.jsonValue(), "by": manifest.by, "folders": manifest.folders, "values": manifest.values}
        # Written whole under another name first: a manifest is never seen half written.
        draft, fs = self._path(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(held), "utf-8"))
        stream.close()
        place, _ = self._path(f"{self.root}/_versions/{manifest.version:012d}.json")
        claim, _ = self._path(self._claim(manifest.version))
        if fs.exists(place) or not fs.createNewFile(claim):
            fs.delete(draft, False)
            raise CommitConflict(f"version {manifest.version} of {self.root} is made by another writer")
        # The claim stays once the version is there, so nobody can make it again.
        if not fs.rename(draft, place):
            fs.delete(claim, False)
            raise CommitConflict(f"version {manifest.version} of {self.root} could not be made")
        return manifest

    def _claim(self, version: int) -> str:
        return f"{self.root}/_versions/.claim-{version:012d}"

    def abandon(self, version: int) -> None:
        """Give a number free again that a writer claimed and died before its manifest was there."""
        place, fs = self._path(f"{self.root}/_versions/{version:012d}.json")
        if not fs.exists(place):
            fs.delete(self._path(self._claim(version))[0], False)

    # --- rows ---

    def _marked(self, df: DataFrame, by: Sequence[str]) -> DataFrame:
        """With the id of the row's partition. NULL is a value like any other."""
        values = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("{}")
        return df.withColumn(_PART, F.md5(values))

    def _written(self, df: DataFrame, by: Sequence[str]) -> tuple[dict[str, str], dict[str, str]]:
        """Folders and values of the partitions in ``df``, written to a folder of this commit."""
        commit = f"{self.root}/data/{uuid.uuid4().hex}"
        marked = self._marked(df, by)
        # Rebalanced by partition: a hot one is written by several tasks, small ones are merged.
        marked.hint("rebalance", _PART).write.partitionBy(_PART).parquet(commit)
        path, fs = self._path(commit)
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        folders = {n.split("=", 1)[1]: f"{commit}/{n}" for n in names if n.startswith(f"{_PART}=")}
        if not by:
            return folders, dict.fromkeys(folders, "{}")
        parts = self.spark.read.schema(df.schema).parquet(*folders.values()) if folders else df.limit(0)
        shown = self._marked(parts.select(*by).distinct(), by).select(_PART, F.to_json(F.struct(*by), {"ignoreNullFields": "false"}))
        return folders, {r[0]: r[1] for r in shown.collect()}

    def _rows(self, manifest: Manifest, parts: Sequence[str] | None = None) -> DataFrame:
        chosen = [manifest.folders[p] for p in (manifest.folders if parts is None else parts) if p in manifest.folders]
        reader = self.spark.read.schema(manifest.schema)
        return reader.parquet(*chosen) if chosen else self.spark.createDataFrame([], manifest.schema)

    def read(self, version: int | None = None, where: Column | None = None) -> DataFrame:
        """Rows of the newest version, or of a pinned one. ``where``, over the partition columns, leaves out whole partitions."""
        manifest = self.manifest(version)
        if where is None:
            return self._rows(manifest)
        shape = T.StructType([f for f in manifest.schema.fields if f.name in manifest.by])
        known = self.spark.createDataFrame(list(manifest.values.items()), f"{_PART} string, held string")
        hit = known.select(_PART, F.from_json("held", shape).alias("held")).select(_PART, "held.*").where(where)
        return self._rows(manifest, [r[0] for r in hit.select(_PART).collect()]).where(where)

    # --- commits ---

    def create(self, df: DataFrame, by: Sequence[str] = ()) -> Manifest:
        if self.versions():
            raise CommitConflict(f"{self.root} exists")
        folders, values = self._written(df, by)
        return self._publish(Manifest(1, df.schema, tuple(by), folders, values))

    def _commit(self, old: Manifest, df: DataFrame, touched: set[str]) -> Manifest:
        """Replace the ``touched`` partitions by the rows of ``df``, which lie in these partitions only."""
        folders, values = self._written(df, old.by)
        kept = {p: f for p, f in old.folders.items() if p not in touched}
        return self._publish(
            Manifest(old.version + 1, old.schema, old.by, kept | folders, {p: old.values[p] for p in kept} | values)
        )

    def _parts_of(self, df: DataFrame, by: Sequence[str]) -> set[str]:
        """Partitions of some rows: at most as many as a manifest names."""
        return {r[0] for r in self._marked(df.select(*by), by).select(_PART).distinct().collect()}

    def overwrite_partitions(self, df: DataFrame) -> Manifest:
        """Replace the partitions that occur in ``df``; the others stay."""
        old = self.manifest()
        df = conform(df, old.schema)
        return self._commit(old, df, self._parts_of(df, old.by) if old.by else set(old.folders))

    def append(self, df: DataFrame) -> Manifest:
        """Add rows. Partitions they fall into are rewritten with them."""
        old = self.manifest()
        df = conform(df, old.schema)
        touched = self._parts_of(df, old.by) if old.by else set(old.folders)
        return self._commit(old, self._rows(old, sorted(touched)).unionByName(df), touched)

    def merge(self, source: DataFrame, keys: Sequence[str]) -> Manifest:
        """Update rows by key, add the others (see ``merge_upsert``); only partitions that are hit are read and rewritten.

        Hit are the partitions of target rows with a key of ``source``, and those that new or moved rows go to. The keys
        are looked up in the key columns alone; if the partition columns are keys, in the source's partitions only.
        """
        old = self.manifest()
        if set(old.by) - set(source.columns):
            raise ValueError(f"the source of a merge needs the partition columns {list(old.by)}")
        source = require_unique(source, keys, "merge source")
        targets = self._parts_of(source, old.by) if old.by else set(old.folders)
        looked = targets & set(old.folders) if old.by and set(old.by) <= set(keys) else set(old.folders)
        narrow = self._rows(old, sorted(looked)).select(*dict.fromkeys([*keys, *old.by]))
        found = narrow.join(source.select(*keys), list(keys), "left_semi")
        touched = (self._parts_of(found, old.by) if old.by else set(old.folders)) | targets
        merged = merge_upsert(self._rows(old, sorted(touched)), source, keys)
        return self._commit(old, conform(merged, old.schema), touched)

    def delete(self, condition: Column) -> Manifest:
        """Delete rows for which ``condition`` is true; partitions without such a row stay as they are."""
        old = self.manifest()
        hit = self._rows(old).where(condition)
        touched = self._parts_of(hit, old.by) if old.by else set(old.folders)
        return self._commit(old, self._rows(old, sorted(touched)).where(~F.coalesce(condition, F.lit(False))), touched)
