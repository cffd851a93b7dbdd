"""Tables in versions: atomic replace, touched-partition merge, one commit per load.

Parquet files are never changed in place. A write puts new folders beside the old ones; then one
row of a log names the folders that make the next version. Readers resolve the last row of the
log, so they see a whole version at any time, also while a writer runs or after it crashed. The
folders of a version lie under one base path, so their partition columns prune as usual:

    <root>/data/v=<write>/<column>=<value>/..     data
    <root>/beside/<write>                         frames kept with a version
    <root>/log/version=<n>/..                     a row: folders, applied loads, fingerprint

A row of the log also says which loads are in the version (a name and a number that grows), so a
load that is run again changes nothing. Two writers that commit the same version number find it
out when they read the log again: the one whose write comes first by name holds the version, the
other raises :class:`Conflict` and may run again. Log rows grow with the number of partitions (of
calendar columns), not with the data. Old folders stay until the shared folder is cleared.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "write string, body string"


class Conflict(RuntimeError):
    """Another writer committed this version first."""


class Version(NamedTuple):
    number: int
    paths: list[str]           # folders under data/, relative
    schema: T.StructType       # of the table, partition columns last
    applied: dict[str, int]    # last number of each load
    beside: dict[str, str]     # name -> folder
    fingerprint: str | None


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), tuple(partition_by)

    # -- reading ------------------------------------------------------------
    def current(self) -> Version | None:
        try:
            log = self.spark.read.schema(f"{_LOG}, version long").json(f"{self.root}/log")
            last = log.agg(F.max("version")).first()[0]
        except AnalysisException:  # no version yet
            return None
        if last is None:
            return None
        body = json.loads(log.where(F.col("version") == last).orderBy("write").first()["body"])
        return Version(last, body["paths"], T.StructType.fromJson(body["schema"]), body["applied"],
                       body["beside"], body["fingerprint"])

    def read(self, version: Version | None = None) -> DataFrame:
        """The table in its last (or the given) version."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"no version of {self.root}")
        return self.of_paths(version.paths, version.schema)

    def of_paths(self, paths: list[str], schema: T.StructType) -> DataFrame:
        """The rows in some folders of a version."""
        if not paths:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/data"
        whole = T.StructType([*schema.fields, T.StructField("v", T.StringType())])
        return self.spark.read.schema(whole).option("basePath", base) \
            .parquet(*[f"{base}/{p}" for p in paths]).drop("v")

    def beside(self, name: str, version: Version | None = None) -> DataFrame | None:
        """A frame that was committed with a version."""
        version = version or self.current()
        if version is None or name not in version.beside:
            return None
        return self.spark.read.parquet(f"{self.root}/beside/{version.beside[name]}")

    # -- writing ------------------------------------------------------------
    def replace(self, df: DataFrame, fingerprint: str | None = None) -> Version:
        """A new version that holds ``df`` alone."""
        old = self.current()
        schema, paths = self._written(df)
        return self._commit(old, paths, schema, old.applied if old else {}, {}, fingerprint)

    def append(self, df: DataFrame, load: tuple[str, int] | None = None,
               beside: Callable[[str], dict[str, DataFrame]] | None = None) -> Version:
        """A new version with the rows of ``df`` too; the last version if ``load`` is in it.
        ``beside`` makes the frames to keep with it from the name of the new folder."""
        old = self.current()
        if old and load and old.applied.get(load[0], -1) >= load[1]:
            return old
        schema, paths = self._written(df)
        beside = beside(paths[0].split("/")[0]) if beside and paths else None
        return self._commit(old, [*(old.paths if old else ()), *paths], schema,
                            _with(old.applied if old else {}, load), self._kept(old, beside), None)

    def merge(self, df: DataFrame, together: Callable[[DataFrame], DataFrame],
              load: tuple[str, int] | None = None, beside: dict[str, DataFrame] | None = None) -> Version:
        """A new version in which the partitions that ``df`` touches hold ``together`` of their
        rows and those of ``df``; other partitions keep their folders. The last version if
        ``load`` is in it."""
        old = self.current()
        if old and load and old.applied.get(load[0], -1) >= load[1]:
            return old
        df = self.staged(df)
        touched = {"/".join(f"{c}={r[c]}" for c in self.partition_by)
                   for r in df.select(*self.partition_by).distinct().collect()}
        paths = {_partition(p): p for p in old.paths} if old else {}
        held = [p for k, p in paths.items() if k in touched]
        if held:
            df = df.unionByName(self.of_paths(held, old.schema).select(*df.columns))
        schema, new = self._written(together(df).select(*df.columns))
        paths |= {_partition(p): p for p in new}
        return self._commit(old, list(paths.values()), schema, _with(old.applied if old else {}, load),
                            self._kept(old, beside), None)

    def staged(self, df: DataFrame) -> DataFrame:
        """``df``, written once beside the table: for frames that a commit reads several times."""
        path = f"{self.root}/staged/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _written(self, df: DataFrame) -> tuple[T.StructType, list[str]]:
        plain = [f for f in df.schema.fields if f.name not in self.partition_by]
        schema = T.StructType([*plain, *(df.schema[c] for c in self.partition_by)])
        write, base = uuid.uuid4().hex, f"{self.root}/data"
        rows = df.select(*schema.names)
        if not self.partition_by:
            rows.write.parquet(f"{base}/v={write}")
            return schema, [f"v={write}"]
        # one file for each small partition; large ones are split by adaptive execution
        rows.hint("rebalance", *self.partition_by).write.partitionBy(*self.partition_by).parquet(f"{base}/v={write}")
        files = self.spark.read.schema(schema).parquet(f"{base}/v={write}").inputFiles()
        return schema, sorted({f"v={write}/" + f.split(f"/v={write}/", 1)[1].rsplit("/", 1)[0] for f in files})

    def _kept(self, old: Version | None, beside: dict[str, DataFrame] | None) -> dict[str, str]:
        out = dict(old.beside) if old else {}
        for name, df in (beside or {}).items():
            out[name] = uuid.uuid4().hex
            df.write.parquet(f"{self.root}/beside/{out[name]}")
        return out

    def _commit(self, old: Version | None, paths, schema, applied, beside, fingerprint) -> Version:
        number, write = (old.number + 1 if old else 0), uuid.uuid4().hex
        body = json.dumps({"paths": paths, "schema": schema.jsonValue(), "applied": applied,
                           "beside": beside, "fingerprint": fingerprint})
        row = self.spark.createDataFrame([(write, body, number)], f"{_LOG}, version long").coalesce(1)
        row.write.mode("append").partitionBy("version").json(f"{self.root}/log")
        log = self.spark.read.schema(f"{_LOG}, version long").json(f"{self.root}/log")
        if log.where(F.col("version") == number).agg(F.min("write")).first()[0] != write:
            raise Conflict(f"version {number} of {self.root} is another writer's")
        return Version(number, paths, schema, applied, beside, fingerprint)


def _partition(path: str) -> str:
    """A folder without the write it comes from: its partition values."""
    return path.split("/", 1)[1] if "/" in path else ""


def _with(applied: dict[str, int], load: tuple[str, int] | None) -> dict[str, int]:
    return {**applied, load[0]: load[1]} if load else dict(applied)


def fingerprint(spark: SparkSession, paths: list[str], rules: str = "") -> str:
    """A digest of the names, sizes and times of all files under ``paths`` and of ``rules`` (what
    is made of them); the files are listed, not read."""
    frames = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
              .select("path", "length", "modificationTime") for p in paths]
    files = reduce(DataFrame.unionByName, frames)
    each = F.xxhash64("path", "length", F.col("modificationTime").cast("long"))
    n, total = files.agg(F.count(F.lit(1)), F.sum(each.cast("decimal(38,0)"))).first()
    return f"{rules}:{n}:{total}"
