"""What the text operators share: reading tables, words, maps over Arrow batches, and joins behind a size check."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pluvia.session import materialise

#: Documents in one Arrow batch. Texts can be long, so Spark's own 10,000 would need gigabytes.
BATCH_ROWS = 500

#: A side of a join is broadcast only when it is measured to be smaller than this.
BROADCAST_BYTES = 32 << 20

SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let no Arrow batch of this session hold more than ``rows`` rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), "pluvia.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "pluvia")):
            for name in names:
                if name.endswith(".py"):
                    out.write(path := os.path.join(folder, name), os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[dict | pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` for functions that yield columns (name -> array or list) or ready batches."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    types = _arrow_types(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in f(batches):
            if isinstance(out, dict):
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, t.type, from_pandas=False) for v, t in zip(out.values(), types, strict=True)]
                out = pa.RecordBatch.from_arrays(arrays, schema=types)
            yield out

    return df.mapInArrow(run, schema)


def _arrow_types(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts as UTF-8; a null is an empty text."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [t or b"" for t in column.to_pylist()]


def lower_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case. ``bytes`` methods touch no other letters."""
    return text.lower().split()


def hash64(data: bytes) -> int:
    """Spark's ``xxhash64`` of one text, as a signed long."""
    h = xxhash.xxh64_intdigest(data, SEED)
    return h - (1 << 64) if h >= 1 << 63 else h


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a fixed number of words."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def text_hash(column: str = "text") -> Column:
    """With doc_id this names a row even where a doc_id is used twice. A null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def bucket(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; a null id is empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all rows together measure at most ``limit`` bytes: text and binary by length, nested columns as JSON."""
    def width(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(name), F.lit(0)) + 16
        if kind.startswith(("array", "map", "struct")):
            return F.coalesce(F.octet_length(F.to_json(name)), F.lit(0)) + 16
        return F.lit(16)

    total = sum((width(n, k) for n, k in df.dtypes), F.lit(16)).cast("long")
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("n")).first()["n"] <= limit


def attach(rows: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left", *, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``rows`` with a side that has one row per key.

    The side is written once and measured. Up to ``limit`` bytes it is broadcast and the rows stay
    where they are; beyond that both are shuffled, and adaptive execution splits skewed keys.
    """
    side = materialise(side, "side")
    return rows.join(F.broadcast(side) if fits(side, limit) else side, list(on), how)
