"""Stored tables as versions made of parts.

A table is a folder of versions ``v=<n>``. A version holds the folders of the
partitions that its run wrote, and a manifest that names every partition of the
table: those, and the ones carried over from earlier versions, which are neither
read nor copied. The manifest also holds the table's columns, so a carried
partition shows a changed schema (gone columns dropped, new ones NULL), and for
each partition the least and greatest values of a few columns, so a cutoff is read
without a job. A clustered table is sorted by a key within its
partitions, and the manifest holds the key range of each file, so a read of some
keys opens only files that may hold them. It is written last: a run that dies
leaves the version before it current. Manifests are one small record for each
file; rows never pass the driver.

Layout::

    <root>/v=<n>/<column>=<value>/...parquet     partitions written by run n
    <root>/v=<n>/_manifest.json                  all partitions of version n
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from practica.functions.keys import packed, unpacked
from practica.session import CODEC, free_shuffles

MANIFEST = "_manifest.json"
FILE_ROWS = 2_000_000       # of a file of a clustered table
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"     # fixed value: Spark's folder of a NULL partition


def file_system(spark: SparkSession, root: str):
    """(Hadoop file system, path) of a folder in any store that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _child(path, name: str):
    return path.suffix("/" + name)


def _read_text(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(fs, path, text: str) -> None:
    """Whole or not at all: written beside, then renamed."""
    beside = path.suffix("." + uuid.uuid4().hex)
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(beside, path):
        raise OSError(f"could not write {path}")


def version_numbers(spark: SparkSession, root: str, marker: str | None = None) -> list[int]:
    """Versions in the folder; with a marker, only those that hold it."""
    fs, path = file_system(spark, root)
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v=")]
    found = [p for p in found if p.getName()[2:].isdigit() and (marker is None or fs.exists(_child(p, marker)))]
    return sorted(int(p.getName()[2:]) for p in found)


def _value(text: str | None, kind: str):
    if text is None:
        return None
    if kind == "date":
        return dt.date.fromisoformat(text)
    if kind.startswith("timestamp"):
        return dt.datetime.fromisoformat(text)
    return int(text) if kind in ("int", "bigint", "smallint") else text


@dataclass
class Stored:
    """One version of a table. ``parts``: folder -> path below the root, least and
    greatest values as text, key ranges of files."""
    spark: SparkSession
    root: str
    version: int
    schema: StructType
    partition_by: list[str]
    parts: dict[str, dict] = field(default_factory=dict)

    @property
    def path(self) -> str:
        return f"{self.root}/v={self.version}"

    def folders(self, wanted: Callable[[dict], bool]) -> list[str]:
        """Partitions whose values (column -> value, None for NULL) are wanted."""
        return [f for f in self.parts if wanted(self.values(f))]

    def values(self, folder: str) -> dict:
        """The partition columns' values of a folder, typed."""
        out = {}
        for step in folder.split("/"):
            name, _, text = step.partition("=")
            out[name] = None if text == NULL_FOLDER else _value(text, self.schema[name].dataType.simpleString())
        return out

    def bounds(self, column: str, folders: Iterable[str] | None = None) -> tuple:
        """(least, greatest) value of a column, (None, None) without any; no job.
        A partition column needs no statistics."""
        found = []
        for f in self.parts if folders is None else folders:
            if column in self.partition_by:
                found.append(self.values(f)[column])
            elif column not in self.parts[f]["low"]:
                raise KeyError(f"no statistics of {column}")
            else:
                kind = self.schema[column].dataType.simpleString()
                found += [_value(self.parts[f][side].get(column), kind) for side in ("low", "high")]
        found = [v for v in found if v is not None]
        return (min(found), max(found)) if found else (None, None)

    def paths(self, folders: Iterable[str] | None = None, keys: Iterable[int] | None = None) -> list[str]:
        """What to read for these partitions: folders, or with ``keys`` the files
        of a clustered table whose range holds one of them."""
        chosen = list(self.parts if folders is None else folders)
        if keys is None:
            return [f"{self.root}/{self.parts[f]['path']}" for f in chosen]
        keys, out = sorted(keys), []
        for f in chosen:
            for name, low, high in self.parts[f]["files"]:
                at = bisect_left(keys, low) if low is not None else len(keys)
                if at < len(keys) and keys[at] <= high:
                    out.append(f"{self.root}/{self.parts[f]['path']}/{name}")
        return out

    def frame(self, folders: Iterable[str] | None = None, keys: Iterable[int] | None = None) -> DataFrame:
        """These partitions (all by default) in the table's columns; with
        ``keys``, a superset of their rows (see ``paths``)."""
        paths = self.paths(folders, keys)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        with_version = StructType([*self.schema.fields, StructField("v", IntegerType())])
        read = self.spark.read.schema(with_version).option("basePath", self.root).parquet(*paths)
        return read.select(*self.schema.names)


def open_table(spark: SparkSession, root: str) -> Stored | None:
    """The current version, None if there is none."""
    root = root.rstrip("/")
    found = version_numbers(spark, root, MANIFEST)
    return read_manifest(spark, root, found[-1]) if found else None


def read_manifest(spark: SparkSession, root: str, version: int) -> Stored:
    fs, path = file_system(spark, f"{root}/v={version}/{MANIFEST}")
    held = json.loads(_read_text(spark, fs, path))
    return Stored(spark, root, version, StructType.fromJson(held["schema"]), held["partition_by"], held["parts"])


def _leaf_folders(fs, path, below: str) -> list[str]:
    """Partition folders, relative to the version's."""
    found = []
    for s in fs.listStatus(path):
        name = s.getPath().getName()
        if s.isDirectory() and "=" in name:
            at = f"{below}/{name}" if below else name
            found += _leaf_folders(fs, s.getPath(), at) or [at]
    return found


def _statistics(spark: SparkSession, root: str, version: int, schema: StructType, columns: Iterable[str],
                cluster: str | None) -> dict[str, dict]:
    """What the manifest says of each partition written; with statistics from one
    small row for each file, else from the folders alone."""
    columns = list(dict.fromkeys([*columns, *([cluster] if cluster else [])]))
    fs, path = file_system(spark, f"{root}/v={version}")
    folders = _leaf_folders(fs, path, "")
    if not columns or not folders:
        return {f: {"path": f"v={version}/{f}", "low": {}, "high": {}} for f in folders}
    written = spark.read.schema(schema).parquet(f"{root}/v={version}")
    found = written.select(F.col("_metadata.file_path").alias("path"), *columns).groupBy("path").agg(
        *[f(c).cast("string").alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]).collect()
    parts: dict[str, dict] = {}
    for r in sorted(found, key=lambda r: r["path"]):
        # below the root: cut once for each file, not for each row
        folder, _, name = re.search(rf"/(v={version}/.+/[^/]+)$", r["path"])[1].rpartition("/")
        part = parts.setdefault(folder.partition("/")[2], {"path": folder, "low": {}, "high": {}})
        for c in columns:
            kind = schema[c].dataType.simpleString()
            for side, pick in (("low", min), ("high", max)):
                known = [x for x in (part[side].get(c), r[f"{side}_{c}"]) if x is not None]
                part[side][c] = pick(known, key=lambda x, kind=kind: _value(x, kind)) if known else None
        if cluster:
            part.setdefault("files", []).append([name, *(None if r[f"{s}_{cluster}"] is None else int(r[f"{s}_{cluster}"])
                                                         for s in ("low", "high"))])
    return parts


def dealt_by(rows: DataFrame, *partition_by: str) -> DataFrame:
    """Rows of a partition together, a large partition in several parts (rebalanced
    by size, so no task holds a hot partition)."""
    return rows.hint("rebalance", *[F.col(c) for c in partition_by])


def write_parts(rows: DataFrame, root: str, partition_by: list[str], carried: dict[str, dict] | None = None,
                statistics: Iterable[str] = (), cluster: str | None = None, file_rows: int = FILE_ROWS,
                dealt: bool = False) -> Stored:
    """The next version: ``rows`` as new partitions, ``carried`` as they are.

    Rows of a partition come together (``dealt_by``; ``dealt``: they do already),
    keys moved as bytes. With ``cluster``, a whole-number column, rows are
    range-sorted by it within their partition."""
    spark, root = rows.sparkSession, root.rstrip("/")
    if any(c.lower() == "v" for c in rows.columns):
        raise ValueError("the column name v is kept for the version")
    version = max(version_numbers(spark, root), default=0) + 1
    out = f"{root}/v={version}"
    if cluster:
        placed = rows.repartitionByRange(*partition_by, cluster).sortWithinPartitions(*partition_by, cluster)
    elif dealt:
        placed = rows
    else:
        keys = [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType)
                and f.name.lower().endswith("key") and f.name not in partition_by]
        placed = dealt_by(rows.withColumns({k: packed(k) for k in keys}), *partition_by).withColumns(
            {k: unpacked(k) for k in keys})
    writer = placed.write.mode("errorifexists").partitionBy(*partition_by)
    (writer.option("maxRecordsPerFile", file_rows) if cluster else writer).parquet(out, compression=CODEC)
    free_shuffles(spark)
    parts = {**(carried or {}), **_statistics(spark, root, version, rows.schema, statistics, cluster)}
    stored = Stored(spark, root, version, rows.schema, partition_by, parts)
    fs, path = file_system(spark, f"{out}/{MANIFEST}")
    _write_text(fs, path, json.dumps({"schema": json.loads(rows.schema.json()), "partition_by": partition_by,
                                      "parts": parts}))
    return stored


def folder_name(values: dict) -> str:
    return "/".join(f"{c}={NULL_FOLDER if v is None else v}" for c, v in values.items())


def same_types(stored: Stored, schema: StructType) -> bool:
    """Whether columns that both have are of one type, so parts can be carried."""
    old = {f.name: f.dataType for f in stored.schema.fields}
    return all(old.get(f.name, f.dataType) == f.dataType for f in schema.fields)


def merge_into(stored: Stored | None, updates: DataFrame, root: str, key: str, partition_by: list[str],
               statistics: Iterable[str] = ()) -> Stored:
    """Upsert by key into the partitions that the updates touch; all others are
    carried. Equal keys must lie in equal partitions (each fact's key is made of
    its month). ``updates`` is a stored batch of unique keys; it is read for its
    partitions, for the rows that it replaces, and to be written."""
    if stored is None:
        return write_parts(updates, root, partition_by, statistics=statistics)
    if stored.partition_by != partition_by or not same_types(stored, updates.schema):
        touched = set(stored.parts)
    else:
        touched = {folder_name(r.asDict()) for r in updates.select(*partition_by).distinct().collect()}
    carried = {f: p for f, p in stored.parts.items() if f not in touched}
    rewritten = [f for f in stored.parts if f in touched]
    from practica.operators.incremental import sync_columns
    kept = sync_columns(stored.frame(rewritten), updates).join(updates.select(key), key, "left_anti")
    return write_parts(kept.unionByName(updates), root, partition_by, carried, statistics)


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete what no manifest of the last ``keep`` versions refers to: partition
    folders of older versions, and versions left empty. A reader of a version
    older than those loses it. Returns the paths deleted."""
    root = root.rstrip("/")
    complete = version_numbers(spark, root, MANIFEST)
    kept = complete[-keep:]
    if not kept:
        return []
    used = {p["path"] for n in kept for p in read_manifest(spark, root, n).parts.values()}
    gone = []
    for n in version_numbers(spark, root):
        if n >= kept[0]:
            continue
        prefix = f"v={n}/"
        still = {p for p in used if p.startswith(prefix)}
        fs, path = file_system(spark, f"{root}/v={n}")
        if not still:
            fs.delete(path, True)
            gone.append(f"{root}/v={n}")
            continue
        if fs.exists(_child(path, MANIFEST)):      # no longer a version of its own
            fs.delete(_child(path, MANIFEST), False)
        gone += _prune_folder(fs, path, f"v={n}", still, root)
    return gone


def _prune_folder(fs, path, below: str, still: set[str], root: str) -> list[str]:
    gone = []
    for s in fs.listStatus(path):
        name = f"{below}/{s.getPath().getName()}"
        if not s.isDirectory() or name in still:
            continue
        if any(p.startswith(name + "/") for p in still):
            gone += _prune_folder(fs, s.getPath(), name, still, root)
        else:
            fs.delete(s.getPath(), True)
            gone.append(f"{root}/{name}")
    return gone


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the build wrote for itself."""
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def month_of(column: Column) -> Column:
    return F.trunc(column, "month")
