"""Whole folders on any store that Spark writes to: what the driver does beside the writing of rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where there is no folder."""
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, place = _at(spark, path)
    if not fs.rename(place, _at(spark, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not be there yet, complete once it has its name."""
    fs, place = _at(spark, path)
    draft = _at(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")[1]
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(place) or not fs.rename(draft, place):
        fs.delete(draft, False)
        raise FileExistsError(path)


def replace(spark: SparkSession, path: str, save: Callable[[str], None]) -> None:
    """Let ``save`` write a folder beside ``path``, and put it there only once it is complete.

    A job that fails while it writes leaves the old folder as it was. Two renames make the change; a driver lost between
    them leaves both folders, named ``-old-`` and ``-next-``. Where a rename is a copy, ``versions`` is the better layout.
    """
    path = path.rstrip("/")
    mark = uuid.uuid4().hex
    following, old = f"{path}-next-{mark}", f"{path}-old-{mark}"
    try:
        save(following)
    except BaseException:
        delete(spark, following)
        raise
    before = exists(spark, path)
    if before:
        rename(spark, path, old)
    rename(spark, following, path)
    if before:
        delete(spark, old)
