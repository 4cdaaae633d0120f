"""Tables that change by whole versions: rows in buckets of a key, and a manifest that says which folders make up a version.

A write copies the buckets it touches into a new folder and then publishes a manifest; the manifest with the highest number is the
table. Until it is there, readers see the version before, and a write that fails leaves nothing but an unnamed folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "_bucket"


class VersionConflict(RuntimeError):
    """Another writer published the version first."""


class VersionedTable:
    """``root`` holds ``data/<id>/_bucket=<n>`` folders of parquet files and ``versions/<number>.json`` manifests.

    ``key`` is the column whose hash gives a row's bucket; rows without one share a bucket. Schema and number of buckets must stay the same.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, schema: T.StructType, buckets: int = 64):
        self.spark, self.root, self.key, self.schema, self.buckets = spark, root.rstrip("/"), key, schema, buckets

    # Files

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self, name: str):
        path = self._path(name)
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return system, path

    def _names(self, folder: str) -> list[str]:
        system, path = self._files(folder)
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def _publish(self, manifest: dict) -> None:
        system, draft = self._files(f"versions/_{uuid.uuid4().hex}")
        out = system.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm = self.spark._jvm
        final = self._path(f"versions/{manifest['version']:012d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), self.spark._jsc.hadoopConfiguration())
        # Renaming fails where the name is taken, so one of two writers of a version wins.
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, final, options)
        except Exception as failed:
            system.delete(draft, False)
            if system.exists(final):
                raise VersionConflict(f"version {manifest['version']} of {self.root} is there already") from failed
            raise

    # Versions

    def version(self) -> int:
        """The number of the newest version, -1 before the first."""
        return max((int(n.removesuffix(".json")) for n in self._names("versions") if n.endswith(".json") and n[0] != "_"), default=-1)

    def manifest(self, version: int | None = None) -> dict:
        number = self.version() if version is None else version
        if number < 0:
            return {"version": -1, "folders": {}, "writers": {}}
        system, path = self._files(f"versions/{number:012d}.json")
        stream = system.open(path)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _of(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        chosen = {b: folder for b, folder in manifest["folders"].items() if buckets is None or int(b) in buckets}
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/data/{folder}/{_BUCKET}={b}" for b, folder in sorted(chosen.items())))

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The newest version, or a given one; all rows, or those of some buckets."""
        return self._of(self.manifest(version), buckets)

    def bucket(self) -> F.Column:
        """The bucket of a row, by the key column."""
        return F.pmod(F.hash(F.coalesce(F.col(self.key).cast("string"), F.lit(""))), F.lit(self.buckets))

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of ``rows``: at most as many as the table has."""
        return [r[0] for r in rows.select(self.bucket().alias("b")).distinct().orderBy("b").collect()]

    def done(self, writer: tuple[str, int]) -> bool:
        """Whether this writer's batch, or a later one, is in the newest version."""
        return self.manifest()["writers"].get(writer[0], -1) >= writer[1]

    def apply(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], writer: tuple[str, int] | None = None, dealt: bool = False) -> bool:
        """Replaces the buckets that ``changes`` touch by ``merge(their rows, changes)``, as a new version.

        ``changes`` has the key column, and the merged rows stay in the touched buckets. ``writer`` is a name and a batch number: a
        batch that is done already changes nothing, and False comes back. With ``dealt`` the merge has brought the rows of a bucket
        together already, so they are not shuffled for that once more.
        """
        before = self.manifest()
        if writer is not None and before["writers"].get(writer[0], -1) >= writer[1]:
            return False
        touched = self.buckets_of(changes)
        folders = dict(before["folders"])
        if touched:
            folder = uuid.uuid4().hex
            merged = merge(self._of(before, touched), changes).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields))
            merged = merged.withColumn(_BUCKET, self.bucket())
            (merged if dealt else merged.hint("rebalance", _BUCKET)).write.partitionBy(_BUCKET).parquet(f"{self.root}/data/{folder}")
            written = {n.split("=")[1] for n in self._names(f"data/{folder}") if n.startswith(f"{_BUCKET}=")}
            if strange := written - {str(b) for b in touched}:
                raise ValueError(f"merged rows fall into other buckets: {sorted(strange)[:5]}")
            for b in map(str, touched):
                folders.pop(b, None)
            folders |= dict.fromkeys(written, folder)
        writers = before["writers"] | ({writer[0]: writer[1]} if writer is not None else {})
        self._publish({"version": before["version"] + 1, "folders": folders, "writers": writers})
        return True

    def create(self, rows: DataFrame) -> VersionedTable:
        """The first version."""
        if self.version() >= 0:
            raise VersionConflict(f"{self.root} has a version already")
        self.apply(rows, lambda _, new: new)
        return self

    def clean(self, keep: int = 2) -> None:
        """Removes the folders that none of the newest ``keep`` versions names, and the manifests of older ones.

        Not while a write runs, whose folder no version names yet.
        """
        newest = self.version()
        kept = [n for n in range(max(0, newest - keep + 1), newest + 1)]
        named = {folder for n in kept for folder in self.manifest(n)["folders"].values()}
        for folder, some in (("data", named), ("versions", {f"{n:012d}.json" for n in kept})):
            for name in self._names(folder):
                if name not in some:
                    system, path = self._files(f"{folder}/{name}")
                    system.delete(path, True)
