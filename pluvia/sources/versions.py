"""Data sets of which every change is a new version.

A version is a small file under ``_versions`` that names the folders of its rows, and it is written last. Rows are written
before, each time into a folder of their own under ``data``, so a change that fails or is never finished leaves readers at the version
before it. Old versions stay readable until ``vacuum``. Of two writers that start from one version, the second finds its number taken and
raises. Single files go out of use by name (``removed``), which is how rows are deleted without writing the rest anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.operators.joins import lookup_join
from pluvia.operators.keyfilter import passing
from pluvia.session import materialise
from pluvia.sources import folders
from pluvia.sources.sinks import counted

#: The column of ``with_files`` that holds the name of a row's file.
FILE = "_file"


class Conflict(RuntimeError):
    """Another writer has made this version."""


@dataclass(frozen=True)
class Version:
    """What one version consists of. ``meta`` is the writer's: row counts, key marks, fingerprints."""

    number: int
    kind: str
    schema: T.StructType
    folders: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()
    meta: Mapping[str, Any] = field(default_factory=dict)


def _file_of(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_versions/{number:012d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:12]) for n in folders.names(spark, f"{path.rstrip('/')}/_versions") if n.endswith(".json") and not n.startswith(".")]


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The given version, or the last; None where there is none."""
    if number is None:
        if not (known := numbers(spark, path)):
            return None
        number = known[-1]
    found = json.loads(folders.read_text(spark, _file_of(path, number)))
    schema = T.StructType.fromJson(found["schema"])
    return Version(number, found["kind"], schema, tuple(found["folders"]), tuple(found["removed"]), found["meta"])


def commit(spark: SparkSession, path: str, new: Version) -> Version:
    """Make ``new`` the last version. Its number must be free."""
    text = json.dumps(
        {"kind": new.kind, "schema": new.schema.jsonValue(), "folders": new.folders, "removed": new.removed, "meta": dict(new.meta)}, indent=1
    )
    try:
        folders.write_new(spark, _file_of(path, new.number), text)
    except FileExistsError as taken:
        raise Conflict(f"version {new.number} of {path} was made by another writer") from taken
    return new


def write_rows(df: DataFrame, path: str, kind: str = "parquet", **counts: Column) -> tuple[str, dict[str, int]]:
    """Write rows into a folder that no version names yet: (its name, ``rows`` and the named aggregates)."""
    name = uuid.uuid4().hex
    return name, counted(df, lambda out: out.write.format(kind).save(f"{path.rstrip('/')}/data/{name}"), **counts)


def publish(df: DataFrame, path: str, kind: str = "parquet", counts: Mapping[str, Column] | None = None, **meta: Any) -> Version:
    """A new version that holds just the rows of ``df``, which may come from the version before. Its ``meta`` has the counts."""
    last = version(df.sparkSession, path)
    name, seen = write_rows(df, path, kind, **(counts or {}))
    return commit(df.sparkSession, path, Version(last.number + 1 if last else 1, kind, df.schema, (name,), (), {**seen, **meta}))


def with_files(spark: SparkSession, path: str, of: Version) -> DataFrame:
    """The rows of a version with the name of the file each is in. Files that are filtered out are not opened."""
    if not of.folders:
        return spark.createDataFrame([], T.StructType([*of.schema.fields, T.StructField(FILE, T.StringType())]))
    reader = spark.read.schema(of.schema).format(of.kind)
    rows = reader.load([f"{path.rstrip('/')}/data/{name}" for name in of.folders])
    name = F.col("_metadata.file_name")
    if of.removed:
        rows = rows.where(~name.isin(list(of.removed)))
    return rows.select(*[F.col(f"`{c}`") for c in of.schema.names], name.alias(FILE))


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the last version, or of an older one."""
    of = version(spark, path, number)
    if of is None:
        raise FileNotFoundError(f"no version in {path}")
    return with_files(spark, path, of).drop(FILE)


def without_keys(spark: SparkSession, path: str, of: Version, keys: DataFrame, on: Iterable[str], kept: DataFrame | None = None) -> tuple[Version, int]:
    """A version (not committed) without the rows that have one of ``keys``: (version, rows that went).

    Files that hold such a row are written anew without it; all other files stay as they are, by name and byte. The keys are
    looked for with only the key columns read, through a filter of the keys where that is small enough to broadcast.
    ``keys`` are read several times, so they come from files. ``kept`` rows are added in the same new folder.
    """
    on = list(on)
    keys = keys.select(*on)
    narrow = with_files(spark, path, of).select(*on, FILE)
    hits = lookup_join(passing(narrow, keys, on), keys, on, "left_semi")
    per_file = {r[FILE]: r["n"] for r in hits.groupBy(FILE).agg(F.count("*").alias("n")).collect()}
    added = []
    if per_file:
        rows = with_files(spark, path, of).where(F.col(FILE).isin(list(per_file))).drop(FILE)
        added.append(lookup_join(rows, keys, on, "left_anti"))
    if kept is not None:
        added.append(kept.select(*of.schema.names))
    if not added:
        return replace(of, number=of.number + 1), 0
    name, _ = write_rows(added[0] if len(added) == 1 else added[0].unionByName(added[1]), path, of.kind)
    # A folder of which nothing is left is no longer named, nor are its files.
    gone, still = {*of.removed, *per_file}, []
    for folder in of.folders:
        files = {n for n in folders.names(spark, f"{path.rstrip('/')}/data/{folder}") if not n.startswith(("_", "."))}
        if files and files <= gone:
            gone -= files
        else:
            still.append(folder)
    return replace(of, number=of.number + 1, folders=(*still, name), removed=tuple(sorted(gone))), sum(per_file.values())


def delete_keys(spark: SparkSession, path: str, keys: DataFrame, on: Iterable[str]) -> int:
    """Delete the stored rows that have one of ``keys``; returns how many there were. Nothing to delete makes no version."""
    of, on = version(spark, path), list(on)
    new, rows = without_keys(spark, path, of, materialise(keys.select(*on).distinct(), "keys"), on)
    if rows:
        meta = {**of.meta, **({"rows": of.meta["rows"] - rows} if "rows" in of.meta else {})}
        commit(spark, path, replace(new, meta=meta))
    return rows


def delete_cascading(spark: SparkSession, parent: str, child: str, keys: DataFrame, on: Iterable[str]) -> tuple[int, int]:
    """Delete parents and, before them, the children that refer to them: (parents, children) deleted.

    A failure between the two leaves parents without children and never children without parents; a rerun ends it.
    """
    children = delete_keys(spark, child, keys, on)
    return delete_keys(spark, parent, keys, on), children


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete what only versions before the last ``keep`` need: their files, and folders that no kept version names. Returns the
    folders deleted. No writer may be at work: rows of an unfinished change count as unused."""
    known = numbers(spark, path)
    used = {f for n in known[-keep:] for f in version(spark, path, n).folders}
    for n in known[:-keep]:
        folders.delete(spark, _file_of(path, n))
    unused = [f for f in folders.names(spark, f"{path.rstrip('/')}/data") if f not in used]
    for f in unused:
        folders.delete(spark, f"{path.rstrip('/')}/data/{f}")
    return len(unused)
