"""Tables that change by whole snapshots (W-1, W-6).

A store keeps named tables under one root.  A table is a set of partition folders;
each folder is written once, by one transaction, and never changed.  A version is a
small JSON file that names, for every table, the folder of each partition (a line
per partition, not per file).  A transaction writes new folders beside those in use
and becomes visible by one rename of its version file, which fails if that version
exists: a run that dies at any point leaves the last version as it was, and of two
writers that began from the same version one gets ``CommitConflict``.  A reader holds
one version and reads its folders whatever is committed meanwhile.

Row and null counts are taken by ``DataFrame.observe`` while a table is written.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = ""  #: the partition name of a table without partitions
#: Ids are digests: this codec halves them, Spark's usual one leaves them as they are.
CODEC = "zstd"


class CommitConflict(RuntimeError):
    """Another transaction has committed this version."""


class Files:
    """The few file operations that a commit needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a file whole or not at all; False if there is one of this name."""
        folder, base = name.rsplit("/", 1)
        draft = f"{folder}/.draft-{uuid.uuid4().hex}-{base}"
        out = self.fs.create(self.path(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        rename = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.NONE
        target = self.fs.makeQualified(self.path(name))
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf).rename(
                self.fs.makeQualified(self.path(draft)), target, options)
        except Py4JJavaError as e:
            self.delete(draft)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True


@dataclass(frozen=True)
class Snapshot:
    """One version: per table the folder of each partition, schemas, and values."""
    spark: SparkSession
    root: str
    version: int
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    values: dict[str, object] = field(default_factory=dict)

    def partitions(self, table: str) -> list[str]:
        """Names like ``received_day=2026-01-01``."""
        return sorted(self.tables.get(table, {}))

    def read(self, table: str, partitions: list[str] | None = None) -> DataFrame | None:
        """The table, or the given partitions of it; None if it was never written.
        Filters on the partition column skip folders."""
        if table not in self.schemas:
            return None
        schema = T.StructType.fromJson(json.loads(self.schemas[table]))
        folders = self.tables[table]
        chosen = folders.values() if partitions is None else [folders[p] for p in partitions if p in folders]
        paths = sorted(f"{self.root}/{f}" for f in chosen)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)
                .select(*schema.names))


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)
        self.log = f"{self.root}/_versions"

    def _versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self.files.names(self.log) if n.endswith(".json") and n[0] != ".")

    def latest(self) -> Snapshot:
        """The last committed version; version 0 has no tables."""
        versions = self._versions()
        return self.at(versions[-1]) if versions else Snapshot(self.spark, self.root, 0)

    def at(self, version: int) -> Snapshot:
        if version == 0:
            return Snapshot(self.spark, self.root, 0)
        return Snapshot(self.spark, self.root, version, **json.loads(self.files.read(f"{self.log}/{version:010d}.json")))

    def begin(self) -> "Transaction":
        return Transaction(self, self.latest())

    def vacuum(self, keep: int = 10) -> list[str]:
        """Forget all but the last ``keep`` versions and delete the folders that none
        of those names.  Not while a transaction runs: its folders are unnamed yet."""
        versions = self._versions()
        if not versions:
            return []
        named = {f for v in versions[-keep:] for t in self.at(v).tables.values() for f in t.values()}
        for v in versions[:-keep]:
            self.files.delete(f"{self.log}/{v:010d}.json")
        gone = []
        for table in sorted({t for t in self.files.names(self.root) if t[0] not in "._"}):
            for commit in self.files.names(f"{self.root}/{table}"):
                folder = f"{table}/{commit}"
                inner = [f"{folder}/{p}" for p in self.files.names(f"{self.root}/{folder}") if "=" in p]
                unnamed = [f for f in inner if f not in named]
                if folder not in named and len(unnamed) == len(inner):
                    unnamed = [folder]
                for f in unnamed:
                    self.files.delete(f"{self.root}/{f}")
                gone += unnamed
        return gone


class Transaction:
    """New folders, visible after ``commit`` only."""

    def __init__(self, store: SnapshotStore, base: Snapshot):
        self.store, self.base = store, base
        self.id, self.writes = uuid.uuid4().hex[:12], 0
        self.tables = {t: dict(p) for t, p in base.tables.items()}
        self.schemas, self.values = dict(base.schemas), dict(base.values)

    def write(self, table: str, df: DataFrame, by: str | None = None, whole: bool = False,
              metrics: dict[str, Column] | None = None) -> dict[str, object]:
        """Write ``df``; its partitions (by column ``by``) replace those of the same
        name, with ``whole`` all of the table.  Returns ``metrics`` (aggregates over
        the written rows, ``rows`` among them), computed while writing."""
        self.writes += 1
        folder = f"{table}/commit={self.id}-{self.writes}"
        seen = Observation()
        # in the writing stage itself, whose repeated tasks count once
        w = ((df.hint("rebalance", by) if by else df)
             .observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()]).write)
        (w.partitionBy(by) if by else w).option("compression", CODEC).parquet(f"{self.store.root}/{folder}")
        names = [n for n in self.store.files.names(f"{self.store.root}/{folder}") if "=" in n] if by else [WHOLE]
        old = {} if whole or not by else self.tables.get(table, {})
        self.tables[table] = old | {n: f"{folder}/{n}" if n else folder for n in names}
        self.schemas[table] = df.schema.json()
        return dict(seen.get)

    def drop(self, table: str, partitions: list[str]) -> None:
        for p in partitions:
            self.tables.get(table, {}).pop(p, None)

    def preview(self) -> Snapshot:
        """What a commit would publish, for checks and dependent models."""
        return Snapshot(self.store.spark, self.store.root, self.base.version + 1, self.tables, self.schemas, self.values)

    def commit(self) -> Snapshot:
        """Publish by one rename."""
        version = self.base.version + 1
        text = json.dumps({"tables": self.tables, "schemas": self.schemas, "values": self.values}, default=str)
        if not self.store.files.put_new(f"{self.store.log}/{version:010d}.json", text):
            raise CommitConflict(f"{self.store.root}: version {version} is there already")
        return self.store.at(version)


def partition_name(column: str, value) -> str:
    return f"{column}={value}"
