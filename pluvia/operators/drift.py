"""How landed documents differ from the declared schema, found in one pass over them.

Documents are parsed to the variant type, which takes any JSON, so a field of another type is seen as what it is and not read as null.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIFT = "path string, change string, declared string, found string, documents long"

ADDED, LOST, RETYPED, UNPARSED = "added", "lost", "retyped", "unparsed"

# What the types of a variant are called.
_NUMBERS = r"(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+, ?\d+\))"


def leaves(schema: T.StructType, before: str = "") -> Iterator[tuple[str, T.DataType]]:
    """(path, type) of every field that is no struct."""
    for f in schema.fields:
        path = f"{before}.{f.name}" if before else f.name
        if isinstance(f.dataType, T.StructType):
            yield from leaves(f.dataType, path)
        else:
            yield path, f.dataType


def _pattern(kind: T.DataType) -> str:
    """Names of the variant types that a declared type can hold, as a regular expression."""
    if isinstance(kind, T.ArrayType):
        return rf"ARRAY<({_pattern(kind.elementType)}|VOID)>"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return _NUMBERS
    if isinstance(kind, T.IntegralType):
        return "BIGINT"
    if isinstance(kind, T.BooleanType):
        return "BOOLEAN"
    return "STRING"


def _place(path: str) -> str:
    return "$" + "".join(f"['{part}']" for part in path.split("."))


def _found(path: str) -> Column:
    """The variant type at a path, or null where the document does not have it."""
    return F.expr(f"schema_of_variant(variant_get(_v, {_quoted(_place(path))}, 'variant'))")


def _quoted(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


def drift(documents: DataFrame, declared: T.StructType, column: str = "value") -> DataFrame:
    """(path, change, declared, found, documents) for each field that some documents lack (``lost``) or have in another type
    (``retyped``), with their number; each field that is not declared (``added``); and texts that are no JSON (``unparsed``).

    A field with the JSON value null is there and fits any type. The result has a row per field that differs, so it is small.
    """
    fields = list(leaves(declared))
    parsed = documents.select(F.expr(f"try_parse_json(`{column}`)").alias("_v"), F.col(f"`{column}`").isNotNull().alias("_text"))
    typed = parsed.select("_v", "_text", *[_found(path).alias(f"_t{i}") for i, (path, _) in enumerate(fields)])
    there = F.col("_v").isNotNull()
    found = [F.expr("schema_of_variant_agg(_v)").alias("all"), F.count_if(F.col("_text") & ~there).alias("unparsed")]
    for i, (_, kind) in enumerate(fields):
        other = F.col(f"_t{i}").isNotNull() & ~F.col(f"_t{i}").rlike(f"^({_pattern(kind)}|VOID)$")
        found += [F.count_if(there & F.col(f"_t{i}").isNull()).alias(f"l{i}"), F.count_if(other).alias(f"r{i}"), F.max(F.when(other, F.col(f"_t{i}"))).alias(f"f{i}")]
    seen = typed.agg(*found).first()

    rows = [("$", UNPARSED, None, None, seen["unparsed"])] if seen["unparsed"] else []
    for i, (path, kind) in enumerate(fields):
        if seen[f"l{i}"]:
            rows.append((path, LOST, kind.simpleString(), None, seen[f"l{i}"]))
        if seen[f"r{i}"]:
            rows.append((path, RETYPED, kind.simpleString(), seen[f"f{i}"], seen[f"r{i}"]))
    known = {path for path, _ in fields}
    rows += [(path, ADDED, None, kind.simpleString(), None) for path, kind in _all_leaves(seen["all"]) if path not in known]
    return documents.sparkSession.createDataFrame(rows, DRIFT)


def _all_leaves(schema: str | None) -> list[tuple[str, T.DataType]]:
    """Fields of the schema that all documents together have."""
    if not schema or not schema.startswith("OBJECT<"):
        return []
    whole = T.DataType.fromDDL(schema.replace("OBJECT<", "STRUCT<"))
    return list(leaves(whole))
