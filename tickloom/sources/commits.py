"""Commits to a leaf of the canonical layout: staged, then listed at once, one writer at a time.

A leaf holds data files, ``_index`` with a folder of manifest lines for each
commit, ``_staging`` with what isn't committed, and ``_lock`` while a writer is
at work. A commit writes its files aside, digests them, moves them beside the
others and at last renames its manifest folder into the index; that one rename
lists all of them. Readers go by the index, so what a killed writer left is
never read, and the next writer sweeps it. All of it goes through Hadoop's
FileSystem; a store without atomic renames of folders needs a committer of its own.
"""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.sources import files

#: Seconds after which a lock counts as left behind by a writer that died.
LOCK_SECONDS = 3600.0


def scratch(spark: SparkSession) -> str:
    """A new folder's path where all executors can write: below spark.checkpoint.dir, or a temporary one of a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        there = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = there.get() if there.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        root = f"file://{tempfile.mkdtemp(prefix='tickloom-')}"
    return f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"


class Locked(RuntimeError):
    """Another writer holds the leaf."""


class Leaf:
    """One leaf, by any path that Hadoop's file systems open."""

    def __init__(self, spark: SparkSession, path: str, lock_seconds: float = LOCK_SECONDS):
        self.spark, self.root, self.lock_seconds = spark, path.rstrip("/"), lock_seconds
        self.jvm = spark.sparkContext._jvm
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """What lies in a folder of the leaf."""
        path = self.at(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    # ---- the lock

    def acquire(self, owner: str) -> None:
        """Create the lock file, which fails if it is there; one that is too old is broken once."""
        self.fs.mkdirs(self.at(""))
        for again in (False, True):
            try:
                stream = self.fs.create(self.at("_lock"), False)
            except Exception as refused:
                if again or not self.stale():
                    raise Locked(f"{self.root}: {self.holder() or 'unknown'}") from refused
                self.fs.delete(self.at("_lock"), False)
                continue
            stream.write(json.dumps({"owner": owner, "at": time.time()}).encode())
            stream.close()
            return

    def holder(self) -> str | None:
        """Who holds the lock."""
        return self._lock().get("owner")

    def stale(self) -> bool:
        taken = self._lock().get("at")
        if taken is None:
            # A lock without content: its writer died while it took it, or takes it now.
            path = self.at("_lock")
            taken = self.fs.getFileStatus(path).getModificationTime() / 1000 if self.fs.exists(path) else 0
        return time.time() - taken > self.lock_seconds

    def _lock(self) -> dict:
        if not self.fs.exists(self.at("_lock")):
            return {}
        stream = self.fs.open(self.at("_lock"))
        try:
            return json.loads(bytes(self.jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)) or b"{}")
        except ValueError:
            return {}
        finally:
            stream.close()

    @contextmanager
    def held(self, owner: str) -> Iterator[None]:
        self.acquire(owner)
        try:
            yield
        finally:
            self.fs.delete(self.at("_lock"), False)

    # ---- what is committed

    def commits(self) -> list[str]:
        return self.names("_index")

    def lines(self) -> DataFrame:
        """The manifest lines of all commits: heartbeats too."""
        found = self.commits()
        kind = schemas.LEAF_INDEX
        return self.spark.read.schema(kind).json([f"{self.root}/_index/{c}" for c in found]) if found else self.spark.createDataFrame([], kind)

    def listed(self) -> DataFrame:
        return self.lines().where("filename is not null")

    def read(self, datatype: str) -> DataFrame:
        """The rows of the listed files. Names pass through the driver, as a listing does."""
        paths = [f"{self.root}/{r.filename}" for r in self.listed().select("filename").toLocalIterator()]
        return files.scan(self.spark, paths, datatype) if paths else self.spark.createDataFrame([], schemas.struct(schemas.TABLES[datatype][0]))

    def verified(self) -> DataFrame:
        """(filename, sha256, intact): each listed file against its digest; a file that is gone isn't intact."""
        there = files.digests(self.spark, f"{self.root}/*.parquet") if any(n.endswith(".parquet") for n in self.names("")) else None
        listed = self.listed().select("filename", "sha256")
        if there is None:
            return listed.withColumn("intact", F.lit(False))
        return listed.join(there.select("filename", F.col("sha256").alias("now")), "filename", "left").select("filename", "sha256", F.coalesce(F.col("sha256") == F.col("now"), F.lit(False)).alias("intact"))

    # ---- writing

    def sweep(self) -> list[str]:
        """Remove what no commit lists: stages, and files that were moved before their commit died. Call it with the lock."""
        gone = [f"_staging/{n}" for n in self.names("_staging")]
        listed = {r.filename for r in self.listed().select("filename").toLocalIterator()}
        gone += [n for n in self.names("") if n.endswith(".parquet") and n not in listed]
        for name in gone:
            self.fs.delete(self.at(name), True)
        return gone

    def commit(self, rows: DataFrame, datatype: str, owner: str = "writer", beats: DataFrame | None = None) -> str:
        """Write ``rows`` and list them at once; the commit's id. Rows of an empty frame are no file, its ``beats`` are listed all the same."""
        with self.held(owner):
            self.sweep()
            name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
            self.stage(rows, datatype, name)
            self.describe(datatype, name, beats)
            self.move(name)
            self.publish(name)
            self.fs.delete(self.at(f"_staging/{name}"), True)
        return name

    def stage(self, rows: DataFrame, datatype: str, name: str) -> None:
        files.write(rows, f"{self.root}/_staging/{name}/data", datatype, partition=False, mode="overwrite")

    def describe(self, datatype: str, name: str, beats: DataFrame | None) -> None:
        """Manifest lines of the staged files, by the name that they will have in the leaf. A file without rows gets none, and goes with the stage."""
        stage = f"{self.root}/_staging/{name}"
        files.append_manifest(self.spark, f"{stage}/data", f"{stage}/index", datatype, beats)

    def move(self, name: str) -> None:
        told = self.spark.read.schema(schemas.LEAF_INDEX).json(f"{self.root}/_staging/{name}/index").where("filename is not null")
        for part in (r.filename for r in told.select("filename").toLocalIterator()):
            if not self.fs.rename(self.at(f"_staging/{name}/data/{part}"), self.at(part)):
                raise OSError(f"cannot move {part}")

    def publish(self, name: str) -> None:
        """The one step that lists the commit."""
        self.fs.mkdirs(self.at("_index"))
        if not self.fs.rename(self.at(f"_staging/{name}/index"), self.at(f"_index/{name}")):
            raise OSError(f"cannot publish {name}")
