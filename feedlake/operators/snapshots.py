"""Keyed tables on plain parquet, in versions.

  table/_commits/00000000000000000007.json   version 7: which folders hold each bucket
  table/_data/<name>/bucket=12/*.parquet     rows, written once and never changed

A table is divided into buckets by a hash of its key. A merge reads only the buckets that the batch touches, writes
their new rows to a folder of its own, and then commits: one small file, put in place by a rename that fails if
that version exists. Until then nothing has changed for a reader, so a merge that dies leaves the table as it
was, and a deleted key cannot come back. A reader is pinned to the version it opened.

Two merges at once: the later commit finds its version taken. If the other touched other buckets, it commits on
top of it as it is; if not, it merges again from the new version. `vacuum` removes what no kept version names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.operators import state as ST

COMMITS, DATA = "_commits", "_data"


class Conflict(Exception):
    """The version to be committed exists."""


@dataclass(frozen=True)
class Version:
    """number; the table's key, buckets and schema (JSON); the folders of each bucket; what made it."""

    number: int
    key: list[str]
    buckets: int
    schema: str
    folders: dict[str, list[str]]
    made_by: str


# ------------------------------------------------------------------ files, through the cluster file system


class _Files:
    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = path.rstrip("/")
        self.fs = self.at("").getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def listed(self, name: str) -> list[tuple[str, int]]:
        """(name, modification time in ms) of a folder's entries; none if there is no folder."""
        if not self.fs.exists(self.at(name)):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(self.at(name))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> None:
        """Write a file whole or not at all; Conflict if there is one of this name."""
        folder, last = name.rsplit("/", 1)
        draft = self.at(f"{folder}/.{last}-{uuid.uuid4().hex}")
        self.fs.mkdirs(self.at(folder))
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at("").toUri(), self.conf).rename(draft, self.at(name), how)
        except Exception as e:
            self.fs.delete(draft, False)
            if self.fs.exists(self.at(name)):
                raise Conflict(name) from e
            raise

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


# ------------------------------------------------------------------ versions


def _numbers(files: _Files) -> list[int]:
    return sorted(int(n[:-5]) for n, _ in files.listed(COMMITS) if n.endswith(".json") and not n.startswith("."))


def _load(files: _Files, number: int) -> Version:
    return Version(**json.loads(files.read(f"{COMMITS}/{number:020d}.json")))


def _commit(files: _Files, version: Version) -> None:
    files.put_new(f"{COMMITS}/{version.number:020d}.json", json.dumps(asdict(version)))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(_Files(spark, path)))


def current(spark: SparkSession, path: str) -> Version:
    files = _Files(spark, path)
    numbers = _numbers(files)
    if not numbers:
        raise FileNotFoundError(f"no table at {path}")
    return _load(files, numbers[-1])


def history(spark: SparkSession, path: str) -> list[Version]:
    """The versions that are kept, oldest first."""
    files = _Files(spark, path)
    return [_load(files, n) for n in _numbers(files)]


def _rows(spark: SparkSession, path: str, version: Version, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(version.schema))
    named = version.folders if buckets is None else {str(b): version.folders.get(str(b), []) for b in buckets}
    folders = [f"{path.rstrip('/')}/{f}" for fs in named.values() for f in fs]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version (the newest). Later commits don't change what this frame reads."""
    files = _Files(spark, path)
    return _rows(spark, path, current(spark, path) if version is None else _load(files, version))


# ------------------------------------------------------------------ writes


def bucket_of(key, n: int):
    return F.pmod(F.xxhash64(*([key] if isinstance(key, str) else list(key))), F.lit(n)).cast("int")


def _write(files: _Files, df: DataFrame, key: list[str], buckets: int) -> dict[str, list[str]]:
    """df in a new folder; the folder of each bucket that got rows (`buckets` names at most)."""
    name = f"{DATA}/{uuid.uuid4().hex}"
    (df.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", F.col("bucket"))  # a large bucket over several tasks
     .write.partitionBy("bucket").parquet(f"{files.root}/{name}"))
    return {n.split("=")[1]: [f"{name}/{n}"] for n, _ in files.listed(name) if n.startswith("bucket=")}


def create(spark: SparkSession, path: str, df: DataFrame, key, buckets: int = 64) -> Version:
    """A new table; Conflict if there is one."""
    files, keys = _Files(spark, path), [key] if isinstance(key, str) else list(key)
    first = Version(0, keys, buckets, df.schema.json(), _write(files, df, keys, buckets), "create")
    _commit(files, first)
    return first


def _land(files: _Files, base: Version, new: dict[str, list[str]], touched: set[str], made_by: str, adds: bool) -> Version | None:
    """Commit `new` for the touched buckets on top of base, or of a later version that left them alone; None if one has not."""
    while True:
        kept = {b: f for b, f in base.folders.items() if adds or b not in touched}
        folders = {**kept, **{b: kept.get(b, []) + f for b, f in new.items()}}
        version = replace(base, number=base.number + 1, folders=folders, made_by=made_by)
        try:
            _commit(files, version)
            return version
        except Conflict:
            late = _load(files, _numbers(files)[-1])
            if not adds and any(late.folders.get(b) != base.folders.get(b) for b in touched):
                return None
            base = late


def merge(spark: SparkSession, path: str, batch: DataFrame, order: Sequence[str] = (), mode: str = "keep_last", tries: int = 10) -> Version:
    """Merge a batch into the table: 'keep_first' (insert if absent), 'keep_last' (replace whole rows) or 'delete' (batch:
    keys). Of several batch rows of a key the first or last by `order` counts. Returns the version made."""
    files = _Files(spark, path)
    for _ in range(tries):
        base = current(spark, path)
        keys = base.key
        cols = T.StructType.fromJson(json.loads(base.schema)).names
        if mode == "keep_first":
            merged = lambda now: ST.insert_if_absent(now, batch.select(*cols), keys, order)
        elif mode == "keep_last":
            merged = lambda now: ST.upsert_keep_last(now, batch.select(*cols), keys, order)
        elif mode == "delete":
            merged = lambda now: now.join(batch.select(*keys).distinct(), keys, "left_anti").select(*cols)
        else:
            raise ValueError(mode)
        touched = [r[0] for r in batch.select(bucket_of(keys, base.buckets)).distinct().collect()]  # at most `buckets`
        new = _write(files, merged(_rows(spark, path, base, touched)), keys, base.buckets)
        done = _land(files, base, new, {str(b) for b in touched}, mode, adds=False)
        if done:
            return done
    raise Conflict(f"{path}: {tries} merges in turn found their buckets changed")


def append(spark: SparkSession, path: str, batch: DataFrame, made_by: str = "append") -> Version:
    """Add rows without reading the table (a table of facts, whose keys are new by construction)."""
    files, base = _Files(spark, path), current(spark, path)
    cols = T.StructType.fromJson(json.loads(base.schema)).names
    new = _write(files, batch.select(*cols), base.key, base.buckets)
    return _land(files, base, new, set(new), made_by, adds=True)


def vacuum(spark: SparkSession, path: str, keep: int = 2, older_than_s: float = 86_400) -> int:
    """Remove all versions but the last `keep`, and data folders that none of them names, if older than that (a merge under
    way has written data that no version names yet). Returns the number of data folders removed."""
    files = _Files(spark, path)
    numbers = _numbers(files)
    named = {f.split("/")[1] for n in numbers[-keep:] for fs in _load(files, n).folders.values() for f in fs}
    for n in numbers[:-keep]:
        files.remove(f"{COMMITS}/{n:020d}.json")
    before = (time.time() - older_than_s) * 1000
    gone = [n for n, at in files.listed(DATA) if n not in named and at <= before]
    for n in gone:
        files.remove(f"{DATA}/{n}")
    return len(gone)
