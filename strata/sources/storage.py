"""Versioned Parquet tables under a layered folder convention.

``<root>/<layer>/<table>/v<n>``: every write creates the next version folder and
the current version is the highest committed one (with Spark's ``_SUCCESS`` marker), so a
failed or half-written job never becomes current. A model that reads its own
stored state (incremental facts, snapshots) reads version n and writes n+1: the
path being read is never overwritten. Reading a written version back also cuts
the lineage, so a lost executor recomputes from the stored files, not from the
whole upstream plan.

A bucketed table (keyed facts, the enrichment table) is a folder per key bucket; a version lists the folders it is made
of, so a merge writes the buckets it touches and refers to the others where they are. That list is written last and
commits the version: Spark's marker alone would make a version of nothing but the rewritten buckets current. After each write,
what only versions before the last ``keep_versions`` refer to is deleted.

File-system calls go through Hadoop's FileSystem API, so the root can be any
shared store the cluster can write (HDFS, object stores, a local folder in tests).
By default the root is a ``tables`` folder next to the session's checkpoint dir.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import storage_root

_VERSION = re.compile(r"^v(\d+)$")
_PROPERTIES = "_strata_properties.json"
_PARTS, _SCHEMA = "parts", "schema"
#: Column and folder name of the key bucket of a bucketed table.
BUCKET = "strata_bucket"


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame of ``schema`` that the optimizer knows is empty (a filtered
    one-row relation folds to an empty local relation), so joins against it are
    pruned instead of being planned as shuffles over an unknown-size input."""
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*cols).where(F.lit(False))


class UncommittedTableError(RuntimeError):
    """A table has version folders, but none was committed."""


class TableStore:
    """``keep_versions``: committed versions of a table that stay readable; older ones are deleted after a write."""

    def __init__(self, spark: SparkSession, root: str | None = None, default_layer: str = "main", keep_versions: int = 3):
        self.spark = spark
        self.keep_versions = keep_versions
        self.root = (root or storage_root(spark).rstrip("/") + "/tables").rstrip("/")
        self.default_layer = default_layer

    # -- file system helpers -------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def location(self, layer: str | None, name: str) -> str:
        """Layered naming: one folder per layer, one per table. A model's own layer
        name is used as it is; a model without one lands in the default layer."""
        return f"{self.root}/{layer or self.default_layer}/{name}"

    def _version_dirs(self, layer: str, name: str) -> list[int]:
        """Every version folder, committed or left behind by a failed write."""
        fs, p = self._fs(self.location(layer, name))
        if not fs.exists(p):
            return []
        out = []
        for status in fs.listStatus(p):
            m = _VERSION.match(status.getPath().getName())
            if m and status.isDirectory():
                out.append(int(m.group(1)))
        return sorted(out)

    def versions(self, layer: str, name: str) -> list[int]:
        """Committed versions, oldest first."""
        return [v for v in self._version_dirs(layer, name) if self._committed(layer, name, v)]

    def _committed(self, layer: str, name: str, version: int) -> bool:
        """Whether the version has a ``_SUCCESS`` marker and either lists its buckets' folders or holds unbucketed files."""
        fs, p = self._fs(f"{self.location(layer, name)}/v{version}")
        held = [s.getPath().getName() for s in fs.listStatus(p)]
        if "_SUCCESS" not in held:
            return False
        return any(not f.startswith(("_", ".", f"{BUCKET}=")) for f in held) or _PARTS in self.properties(layer, name, version)

    def current_version(self, layer: str, name: str) -> int | None:
        v = self.versions(layer, name)
        if not v and self._version_dirs(layer, name):
            # A first write that died, or a committer that leaves no marker: taking the table for absent would make
            # every run a silent first run.
            raise UncommittedTableError(f"{self.location(layer, name)} has version folders but none was committed")
        return v[-1] if v else None

    def exists(self, layer: str, name: str) -> bool:
        return self.current_version(layer, name) is not None

    # -- read / write ----------------------------------------------------------------
    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame | None:
        """The table's current (or given) version; None when nothing is stored."""
        v = self.current_version(layer, name) if version is None else version
        if v is None:
            return None
        props = self.properties(layer, name, v)
        if _PARTS in props:
            return self.read_parts(layer, name, props[_PARTS], StructType.fromJson(props[_SCHEMA]))
        return self.spark.read.parquet(f"{self.location(layer, name)}/v{v}")

    def read_parts(self, layer: str, name: str, parts: dict[str, list[str]], schema: StructType) -> DataFrame:
        """The rows of some buckets: ``parts`` maps a bucket to its folders."""
        folders = [f"{self.location(layer, name)}/{f}" for own in parts.values() for f in own]
        return self.spark.read.schema(schema).parquet(*folders) if folders else empty_frame(self.spark, schema)

    def parts(self, layer: str, name: str) -> dict[str, list[str]]:
        """Folders of each bucket of a bucketed table's current version; empty when nothing is stored."""
        return self.properties(layer, name).get(_PARTS, {})

    def read_or_empty(self, layer: str, name: str, schema: StructType) -> DataFrame:
        """Create-if-missing: the stored table, or an empty frame of ``schema``."""
        df = self.read(layer, name)
        return df if df is not None else empty_frame(self.spark, schema)

    def properties(self, layer: str, name: str, version: int | None = None) -> dict:
        """Small metadata stored beside a version (e.g. an incremental fact's
        high-water mark); empty when none was recorded."""
        v = self.current_version(layer, name) if version is None else version
        if v is None:
            return {}
        fs, p = self._fs(f"{self.location(layer, name)}/v{v}/{_PROPERTIES}")
        if not fs.exists(p):
            return {}
        stream = fs.open(p)
        try:
            data = bytearray()
            buf = self.spark._jvm.java.nio.ByteBuffer.allocate(65536)
            reader = self.spark._jvm.java.nio.channels.Channels.newChannel(stream)
            while reader.read(buf) > 0:
                buf.flip()
                data.extend(bytes(buf.array())[: buf.limit()])
                buf.clear()
        finally:
            stream.close()
        return json.loads(data.decode("utf-8"))

    def _write_properties(self, layer: str, name: str, version: int, props: dict) -> None:
        path = f"{self.location(layer, name)}/v{version}/{_PROPERTIES}"
        fs, p = self._fs(path)
        _, unnamed = self._fs(f"{path}.tmp")  # renamed when whole: a bucketed version is committed by this file
        out = fs.create(unnamed, True)
        try:
            out.write(bytearray(json.dumps(props, default=str).encode("utf-8")))
        finally:
            out.close()
        if not fs.rename(unnamed, p):
            raise OSError(f"{path} was not written")

    def write_buckets(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        replaced: Iterable[str] = (),
        properties: Callable[[], dict] | None = None,
    ) -> DataFrame:
        """Store rows with their ``BUCKET`` as the next version of a bucketed table and return it.

        The rows take the place of the ``replaced`` buckets' old ones and join those of the other buckets. Untouched buckets
        are not rewritten: the new version refers to their present folders. ``properties`` is called after the write."""
        parts = {b: f for b, f in self.parts(layer, name).items() if b not in set(replaced)}
        nxt, path = self._next_version(layer, name)
        df.write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
        fs, p = self._fs(path)
        for status in fs.listStatus(p):
            folder = status.getPath().getName()
            if folder.startswith(f"{BUCKET}="):
                bucket = folder.split("=", 1)[1]
                parts[bucket] = [*parts.get(bucket, []), f"v{nxt}/{folder}"]
        schema = StructType([f for f in df.schema.fields if f.name != BUCKET]).jsonValue()
        props = {**(properties() if properties else {}), _PARTS: parts, _SCHEMA: schema}
        self._write_properties(layer, name, nxt, props)
        self._retire(layer, name)
        return self.read(layer, name, nxt)

    def _retire(self, layer: str, name: str) -> None:
        """Delete what only versions before the last ``keep_versions`` refer to."""
        versions = self.versions(layer, name)
        if not versions:
            return
        kept = versions[-self.keep_versions :]
        base = self.location(layer, name)
        used = {f for v in kept for own in self.properties(layer, name, v).get(_PARTS, {}).values() for f in own}
        for v in self._version_dirs(layer, name):
            if v in kept or v > versions[-1]:
                continue
            fs, p = self._fs(f"{base}/v{v}")
            held = [s.getPath() for s in fs.listStatus(p)]
            for child in held:
                # The marker goes with the rest, so that a version without all its folders is no version.
                if f"v{v}/{child.getName()}" not in used:
                    fs.delete(child, True)
            if not any(f.startswith(f"v{v}/") for f in used):
                fs.delete(p, True)

    def _next_version(self, layer: str, name: str) -> tuple[int, str]:
        # Past every existing folder: a write that died before committing leaves a
        # folder without _SUCCESS, which readers ignore and a retry must not reuse.
        existing = self._version_dirs(layer, name)
        nxt = (existing[-1] + 1) if existing else 1
        return nxt, f"{self.location(layer, name)}/v{nxt}"

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition_by: Sequence[str] = (),
        repartition_by: Sequence[str] = (),
        properties: dict | None = None,
    ) -> DataFrame:
        """Store ``df`` as the next version and return the stored table.

        ``repartition_by`` clusters rows by key before writing (one hash exchange),
        so each output file holds a key range and later joins/aggregations on those
        keys read fewer, larger files; ``partition_by`` lays out folders for
        partition pruning (low-cardinality columns only).
        """
        nxt, path = self._next_version(layer, name)
        out = df.repartition(*repartition_by) if repartition_by else df
        writer = out.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        if properties:
            # Written after the data commit: a crash in between only loses the
            # metadata of this unbucketed version, and readers then fall back to computing it.
            self._write_properties(layer, name, nxt, properties)
        self._retire(layer, name)
        return self.read(layer, name, nxt)
