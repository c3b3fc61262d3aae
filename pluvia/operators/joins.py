"""Lookup joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.operators.reshape import prefix_columns
from pluvia.session import materialise

BROADCAST_BYTES = 64 << 20

#: Parts into which a hot key is dealt when its part of the lookup is too large to broadcast.
SALTS = 16

#: Numbers into which rows are counted by a hash of their key, to find where heavy keys can be.
BUCKETS = 1 << 16


def fits(df: DataFrame, limit: int) -> bool:
    """Whether the rows measure at most ``limit`` bytes, from one pass: text and binary by length, nested columns by
    their JSON, every other column as 16."""

    def width(field: T.StructField) -> Column:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(name), F.lit(0)) + 8
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(name)), F.lit(0)) + 16
        return F.lit(16)

    total = sum(map(width, df.schema.fields), F.lit(16)).cast("long")
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("n")).first()["n"] <= limit


def _keyed(on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])


def hot_keys(df: DataFrame, on: Sequence[str], partitions: int | None = None) -> DataFrame | None:
    """Keys with more rows than an even shuffle partition would have, or None.

    Fewer keys than partitions can be that heavy, which bounds the result. Rows are counted by a hash of their key first, into BUCKETS
    numbers a task; only keys of a bucket that is that heavy are counted themselves.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*on), F.lit(max(BUCKETS, 8 * partitions))).alias("_bucket")
    buckets = materialise(df.groupBy(bucket).agg(F.count("*").alias("_n")), "buckets")
    even = (buckets.agg(F.sum("_n").alias("n")).first()["n"] or 0) / partitions
    heavy = buckets.where(F.col("_n") > even).select("_bucket")
    if heavy.isEmpty():
        return None
    among = df.select(*on, bucket).join(F.broadcast(heavy), "_bucket", "left_semi")
    hot = materialise(among.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > even).select(*on), "hot")
    return None if hot.isEmpty() else hot


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    costly_rows: bool = False,
) -> DataFrame:
    """Equi join of many rows with a lookup table (``inner``, ``left``, ``left_semi`` or ``left_anti``).

    A lookup side measured to fit is broadcast. Beyond that both sides are shuffled on the key, except for the rows
    with a hot key or none: these stay where they are and meet a broadcast of just their part of the
    lookup side. Where that part does not fit either, hot rows are dealt over SALTS parts of their key and
    the lookup rows go to each of them. The rows side is read once or twice for the counts and twice for
    the join, so ``costly_rows`` (parsed from text, say) are written once first.
    """
    on = list(on)
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select(*on)
    if fits(lookup, broadcast_bytes):
        return rows.join(F.broadcast(lookup), on, how)

    if costly_rows:
        rows = materialise(rows, "rows")
    hot = hot_keys(rows.where(_keyed(on)), on)
    if hot is None:
        joined = rows.where(_keyed(on)).join(lookup, on, how)
        if how in ("left", "left_anti"):
            # A null key matches nothing; shuffled on it, all such rows would meet in one task.
            joined = joined.unionByName(rows.where(~_keyed(on)), allowMissingColumns=True)
        return joined

    # Fewer hot keys than shuffle partitions exist; they are still broadcast only if their bytes allow it.
    small = F.broadcast if fits(hot, broadcast_bytes) else (lambda df: df)
    tagged = rows.join(small(hot.withColumn("_hot", F.lit(True))), on, "left")
    in_place = F.col("_hot").isNotNull() | ~_keyed(on)
    hot_lookup = lookup.join(small(hot), on, "left_semi")
    if how in ("left_semi", "left_anti"):
        hot_lookup = hot_lookup.distinct()
    near, far = tagged.where(in_place).drop("_hot"), tagged.where(~in_place).drop("_hot")
    if fits(hot_lookup, broadcast_bytes):
        met = near.join(F.broadcast(hot_lookup), on, how)
    else:
        salted = near.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        copies = hot_lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = salted.join(copies, [*on, "_salt"], how).drop("_salt")
    return far.join(lookup, on, how).unionByName(met)


def attach_stations(weather: DataFrame, stations: DataFrame, on: Sequence[str], **options) -> DataFrame:
    """Each weather row with the stations of its location.

    Colliding station columns get the ``station_`` prefix. With one location this is every weather
    row beside every station; with many, a location meets its own stations only, and one without
    stations keeps its rows with empty station columns.
    """
    return lookup_join(weather, prefix_columns(stations), on, "left", **options)


def join_parent(child: DataFrame, parent: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Child rows with the columns of their parent, along a declared reference."""
    return lookup_join(child, parent, on, how)
