"""Keyed tables in parts, of which a merge writes only those that its rows fall in, and readers see one version whole.

A table is a folder: ``data`` has the files, a folder for each merge and part;
``versions`` has one small file for each version that says which folder each
part is in.  A merge reads and joins the parts it touches, writes them anew
beside the old ones, and then puts the next version's file in its place, by a
rename that fails if somebody else has been faster.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import merge_update

_PART = "__part"


class Conflict(Exception):
    """Another writer has made this version first; read again and merge again."""


class VersionedTable:
    """A table with one row per ``keys``.  ``part`` is a text that keys decide, such as the day of a window; its values in one merge are ``most_parts`` at most."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], part: Column, most_parts: int = 10_000, spread: int = 8):
        self.spark, self.path, self.keys, self.part = spark, path.rstrip("/"), list(keys), part.cast("string")
        self.most_parts, self.spread = most_parts, spread
        self._jvm = spark.sparkContext._jvm
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def version(self) -> int:
        """The newest version; 0 before the first write."""
        where = self._hadoop(f"{self.path}/versions")
        names = [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."), default=0)

    def _manifest(self, version: int) -> dict:
        if version == 0:
            return {"schema": None, "parts": {}}
        stream = self._fs.open(self._hadoop(f"{self.path}/versions/{version}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _rows(self, manifest: dict, parts: Sequence[str], schema: T.StructType) -> DataFrame:
        folders = [f"{self.path}/data/{manifest['parts'][p]}" for p in parts if p in manifest["parts"]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, by default the newest."""
        manifest = self._manifest(self.version() if version is None else version)
        if manifest["schema"] is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._rows(manifest, sorted(manifest["parts"]), T.StructType.fromJson(manifest["schema"]))

    def merge(self, rows: DataFrame, keep_old: Sequence[str] = (), fill: Sequence[str] = ()) -> int:
        """Upsert rows, one per key (see merge_update), and return the new version; no rows make none.

        Parts that no row falls in keep their files.  What is written by a merge
        that fails belongs to no version and goes with ``vacuum``.
        """
        before = self.version()
        manifest = self._manifest(before)
        touched = [r[0] for r in rows.select(self.part.alias(_PART)).distinct().limit(self.most_parts + 1).collect()]
        if not touched:
            return before
        if len(touched) > self.most_parts:
            raise ValueError(f"the rows fall in more than {self.most_parts} parts: make parts coarser, or merge in pieces")
        if None in touched:
            raise ValueError("a row's keys give no part")
        schema = T.StructType.fromJson(manifest["schema"]) if manifest["schema"] else rows.schema
        old = self._rows(manifest, touched, schema)
        merged = merge_update(old, rows.select(*schema.names), self.keys, keep_old, fill).withColumn(_PART, self.part)
        folder = uuid.uuid4().hex
        dealt = merged.repartition(_PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.spread)))
        dealt.write.partitionBy(_PART).parquet(f"{self.path}/data/{folder}")
        places = {p: f"{folder}/{_PART}={self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(p)}" for p in touched}
        self._publish(before + 1, {"schema": json.loads(schema.json()), "parts": manifest["parts"] | places})
        return before + 1

    def _publish(self, version: int, manifest: dict) -> None:
        folder = f"{self.path}/versions"
        draft, final = self._hadoop(f"{folder}/.{uuid.uuid4().hex}"), self._hadoop(f"{folder}/{version}.json")
        self._fs.mkdirs(self._hadoop(folder))
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        gateway = self.spark.sparkContext._gateway
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = gateway.new_array(rename, 1)
        how[0] = getattr(rename, "NONE")
        try:
            context.rename(draft, final, how)
        except Exception as problem:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(problem) or self._fs.exists(final):
                raise Conflict(f"version {version} of {self.path} is there already") from problem
            raise

    def vacuum(self, keep: int = 2) -> None:
        """Delete versions but the newest ones, and folders that none of these names."""
        newest = self.version()
        kept = range(max(1, newest - keep + 1), newest + 1)
        used = {place for v in kept for place in self._manifest(v)["parts"].values()}
        merges = {place.split("/")[0] for place in used}
        for status in self._fs.listStatus(self._hadoop(f"{self.path}/versions")):
            name = status.getPath().getName()
            if not name.endswith(".json") or int(name.removesuffix(".json")) not in kept:
                self._fs.delete(status.getPath(), False)
        for status in self._fs.listStatus(self._hadoop(f"{self.path}/data")):
            merge = status.getPath().getName()
            if merge not in merges:
                self._fs.delete(status.getPath(), True)
                continue
            for part in self._fs.listStatus(status.getPath()):
                if part.isDirectory() and f"{merge}/{part.getPath().getName()}" not in used:
                    self._fs.delete(part.getPath(), True)
