"""Versioned warehouse: several tables become visible together (K1–K3).

A commit writes every table into a folder of its own under ``data/<commit>/`` and then publishes one manifest that names
the folder and row count of every table of the new version. Publishing is a rename that fails if the version exists;
until then readers see the old version, afterwards the new one, never a mix, and no table is absent at any
moment. A manifest's tables that a commit does not write are carried over. ``recover`` removes what a crashed load
left behind: folders and half-written manifests that no published version names. (HDFS renames atomically; an
object store needs a committer or a connector that does.)

Readers resolve a version once (:func:`snapshot`) and keep reading its files while later versions are
published; :func:`expire` drops old versions. Two writers that commit at once publish the same version number:
one rename fails, and that writer raises :class:`CommitConflict` with nothing made visible.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from dwspark.sinks.tables import path_exists, remove, write_counted

MANIFESTS, DATA = "_manifests", "data"


class CommitConflict(RuntimeError):
    """Another writer has published this version."""


@dataclass(frozen=True)
class Snapshot:
    """The tables of one published version: name -> {"path", "rows"}."""

    base: str
    version: int
    tables: dict[str, dict] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.base}/{self.tables[name]['path']}")


class _Files:
    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.base = base
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[tuple[str, float]]:
        """Names and ages in seconds of a folder's entries."""
        p = self.path(folder)
        if not self.fs.exists(p):
            return []
        now = time.time() * 1000
        return [(s.getPath().getName(), (now - s.getModificationTime()) / 1000) for s in self.fs.listStatus(p)]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, text: str, name: str) -> None:
        """Make ``name`` appear with its whole content, or fail if it exists."""
        hidden = f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self.path(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(name).toUri(), self.conf)
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.fs.makeQualified(self.path(hidden)), self.fs.makeQualified(self.path(name)), none)
        except Exception as e:
            self.fs.delete(self.path(hidden), False)
            if self.fs.exists(self.path(name)):
                raise CommitConflict(name) from e
            raise


def _manifest(version: int) -> str:
    return f"{MANIFESTS}/{version:020d}.json"


def versions(spark: SparkSession, base: str) -> list[int]:
    """Published versions, oldest first."""
    names = [n for n, _ in _Files(spark, base.rstrip("/")).names(MANIFESTS)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))


def snapshot(spark: SparkSession, base: str, version: int | None = None) -> Snapshot:
    """The newest published version (version 0 without tables if there is none), or the given one."""
    base = base.rstrip("/")
    known = versions(spark, base)
    if version is None:
        if not known:
            return Snapshot(base, 0)
        version = known[-1]
    return Snapshot(base, version, json.loads(_Files(spark, base).read(_manifest(version)))["tables"])


class Commit:
    """A load in progress: :meth:`write` tables, then :meth:`publish` them together, or :meth:`abandon` it."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.before = snapshot(spark, self.base)
        self.id = uuid.uuid4().hex
        self.tables: dict[str, dict] = {}

    def write(self, name: str, df: DataFrame) -> int:
        """Write one table into this commit's folder; returns the rows that went in, counted on their way."""
        folder, rows = write_counted(df, f"{self.base}/{DATA}/{self.id}/{name}")
        self.tables[name] = {"path": folder[len(self.base) + 1:], "rows": rows}
        return rows

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{self.tables[name]['path']}")

    def verify(self) -> None:
        """K3: the files hold as many rows as went in, for every table written."""
        for name, table in self.tables.items():
            found = self.read(name).count()  # from the files' footers
            if found != table["rows"]:
                raise ValueError(f"row count mismatch: {name} {table['rows']}!={found}")

    def publish(self) -> Snapshot:
        version = self.before.version + 1
        tables = {**self.before.tables, **self.tables}
        text = json.dumps({"version": version, "commit": self.id, "tables": tables}, sort_keys=True)
        _Files(self.spark, self.base).publish(text, _manifest(version))
        return Snapshot(self.base, version, tables)

    def abandon(self) -> None:
        remove(self.spark, f"{self.base}/{DATA}/{self.id}")


def load(spark: SparkSession, base: str, tables: Mapping[str, DataFrame]) -> Snapshot:
    """Full refresh of all ``tables`` as one new version; on any error nothing becomes visible."""
    commit = Commit(spark, base)
    try:
        for name, df in tables.items():
            commit.write(name, df)
        commit.verify()
        return commit.publish()
    except Exception:
        commit.abandon()
        raise


def _named(spark: SparkSession, base: str) -> set[str]:
    return {t["path"] for v in versions(spark, base) for t in snapshot(spark, base, v).tables.values()}


def recover(spark: SparkSession, base: str, older_than: float = 86_400.0) -> list[str]:
    """Delete folders and hidden manifests that no published version names and that are older than
    ``older_than`` seconds (a load in progress is younger). Returns what was deleted."""
    base = base.rstrip("/")
    files, gone = _Files(spark, base), []
    named = {p.split("/")[1] for p in _named(spark, base)}
    for name, age in files.names(DATA):
        if name not in named and age >= older_than:
            gone.append(f"{DATA}/{name}")
    for name, age in files.names(MANIFESTS):
        if name.startswith(".") and age >= older_than:
            gone.append(f"{MANIFESTS}/{name}")
    for name in gone:
        remove(spark, f"{base}/{name}")
    return gone


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Drop all but the newest ``keep`` versions, then the tables that only they named."""
    base = base.rstrip("/")
    old = versions(spark, base)[:-max(keep, 1)]
    before = _named(spark, base)
    for v in old:  # manifests first: what a crash leaves then is an orphan that recover removes
        remove(spark, f"{base}/{_manifest(v)}")
    for path in before - _named(spark, base):
        if path_exists(spark, f"{base}/{path}"):
            remove(spark, f"{base}/{path}")
    return old
