"""Insert into a stored, versioned table under its declared rules.

Rows that break a rule are returned with the rule's name; all others become one new version of the table, or nothing does.
Rules are tested in the order in which ``Rules`` lists them, and a row that breaks one is not there for those after it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.operators.joins import hot_keys, lookup_join
from pluvia.operators.keyfilter import passing
from pluvia.operators.keys import continued_key
from pluvia.operators.quality import misfit
from pluvia.session import materialise
from pluvia.sources import versions

REJECT, KEEP, REPLACE = "reject", "keep", "replace"


@dataclass(frozen=True)
class Reference:
    """``columns`` must have their values in ``parent_columns`` of ``parent``, unless one of them is null."""

    columns: Sequence[str]
    parent: DataFrame
    parent_columns: Sequence[str] = ()


@dataclass(frozen=True)
class Rules:
    """The rules of a table: mandatory columns (not nullable in ``schema``, or of the primary key), declared types and text lengths,
    references, then keys. A key that holds a null is only a violation in the primary key. ``serial`` names a column that the table
    fills itself with numbers that go on from the last insert."""

    schema: T.StructType
    primary_key: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    references: Sequence[Reference] = ()
    serial: str | None = None

    @property
    def given(self) -> list[T.StructField]:
        """The fields that a row to insert has."""
        return [f for f in self.schema.fields if f.name != self.serial]

    @property
    def keys(self) -> list[tuple[str, ...]]:
        return [tuple(k) for k in (self.primary_key, *self.unique) if k and self.serial not in k]


@dataclass(frozen=True)
class Inserted:
    """What an insert did. ``rejects`` has the rows as they came, with ``rule`` naming the first rule that each breaks."""

    version: int
    inserted: int
    replaced: int
    kept: int
    rejected: int
    rejects: DataFrame


def named(rule: str, columns: Sequence[str]) -> str:
    return f"{rule} ({', '.join(columns)})"


def _of_row(rules: Rules, source: T.StructType) -> Column:
    """The first rule that a row breaks by itself, or null."""
    mandatory = [f.name for f in rules.given if not f.nullable or f.name in rules.primary_key]
    found = [F.when(F.col(f"`{c}`").isNull(), named("not null", [c])) for c in mandatory if not _defaulted(rules, c)]
    found += [F.when(misfit(f, source[f.name].dataType), named("type", [f.name])) for f in rules.given if f.name in source.names]
    return F.coalesce(*found, F.lit(None).cast("string"))


def _defaulted(rules: Rules, name: str) -> bool:
    return bool(rules.schema[name].metadata.get("default_now"))


def _kind(f: T.StructField) -> T.DataType:
    return T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType


def _value(f: T.StructField, source: T.StructType) -> Column:
    """A column of ``source`` as the table holds it, null where it does not fit. ``_now`` fills a default."""
    own = F.col(f"`{f.name}`") if source[f.name].dataType == _kind(f) else F.col(f"`{f.name}`").try_cast(_kind(f))
    return F.coalesce(own, F.col("_now").cast(_kind(f))) if f.metadata.get("default_now") else own


def _with_references(rows: DataFrame, rules: Rules) -> DataFrame:
    """Set ``_rule`` on rows whose parent is missing; a measured join for each reference."""
    for ref in rules.references:
        fields = [rules.schema[c] for c in ref.columns]
        own = [f"_own_{f.name}" for f in fields]
        parents = ref.parent.select(*[F.col(p).cast(_kind(f)).alias(o) for p, f, o in zip(ref.parent_columns or ref.columns, fields, own, strict=True)]).distinct()
        rows = rows.withColumns({o: _value(f, rows.schema) for o, f in zip(own, fields, strict=True)})
        met = lookup_join(rows, parents.withColumn("_parent", F.lit(True)), own, "left", costly_rows=True)
        orphan = _whole(own) & F.col("_parent").isNull()
        rows = met.withColumn("_rule", F.coalesce("_rule", F.when(orphan, named("foreign key", ref.columns)))).drop("_parent", *own)
    return rows


def _typed(sound: DataFrame, rules: Rules) -> DataFrame:
    """Rows that fit with the values that the table will hold. What a row came with stays as ``_came_<name>`` where it is something else."""
    given, source = rules.given, sound.schema
    changed = [f.name for f in given if source[f.name].dataType != _kind(f) or f.metadata.get("default_now")]
    values = [_value(f, source).alias(f.name, metadata=f.metadata) for f in given]
    return sound.select(*values, *[F.col(f"`{c}`").alias(f"_came_{c}") for c in changed], "_rule", F.lit(False).alias("_kept"))


def _as_they_came(state: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.col(f"`_came_{c}`").alias(c) if f"_came_{c}" in state.columns else F.col(f"`{c}`") for c in names]


def _whole(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])


def _standing() -> Column:
    """Rows that have neither broken a rule nor been kept out."""
    return F.col("_rule").isNull() & ~F.col("_kept")


def _losers(state: DataFrame, stored: DataFrame | None, key: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    """``state`` with ``_lost``: the row does not count, as its key is in ``stored`` or another of its rows comes before it.

    Rows and stored keys are shuffled once, and a row's place is found in one sorted pass over them. The rows of keys too heavy for a task
    stay where they are; which of them counts is combined before its shuffle. ``state`` must be read from files.
    """
    columns = state.columns
    data = [c for c in columns if c not in ("_rule", "_kept")]
    place = [*order, *[c for c in data if c not in {*key, *order}]]
    takes_part = _standing() & _whole(key)
    aside = state.where(~takes_part).withColumn("_lost", F.lit(False))
    rows = state.select("*", F.struct("_metadata.file_name", "_metadata.row_index").alias("_row")).where(takes_part)
    cold, near = rows, None
    if (hot := hot_keys(rows, key)) is not None:
        tagged = lookup_join(rows, hot.withColumn("_hot", F.lit(True)), key, "left")
        near, cold = tagged.where("_hot"), tagged.where("_hot IS NULL")
        end = F.max if last else F.min
        marks = near.groupBy(*key).agg(end(F.struct(*place, "_row")).alias("_place")).select(*key, F.col("_place._row").alias("_chosen"), F.lit(False).alias("_known"))
        if stored is not None:
            known = lookup_join(stored, hot, key, "left_semi").select(*key, F.lit(True).alias("_known"))
            marks = marks.unionByName(known, allowMissingColumns=True).groupBy(*key).agg(F.max("_chosen").alias("_chosen"), F.bool_or("_known").alias("_known"))
        marked = lookup_join(near, materialise(marks, "marks"), key, "left")
        near = marked.select(*columns, (F.col("_known") | (F.col("_chosen") != F.col("_row"))).alias("_lost"))

    cold = cold.select(*data, F.lit(False).alias("_known"))
    if stored is not None:
        cold = cold.unionByName(stored.select(*key, F.lit(True).alias("_known")), allowMissingColumns=True)
    ahead = Window.partitionBy(*key).orderBy(F.desc("_known"), *[F.desc(c) if last else F.asc(c) for c in place])
    placed = cold.withColumn("_lost", F.row_number().over(ahead) > 1).where("NOT _known").drop("_known")
    placed = placed.withColumns({"_rule": F.lit(None).cast("string"), "_kept": F.lit(False)})
    return reduce(DataFrame.unionByName, [placed, aside, *([near] if near is not None else [])])


def insert(
    spark: SparkSession, rows: DataFrame, path: str, rules: Rules, on_conflict: str = REJECT, order: Sequence[str] = (), **meta: Any
) -> Inserted:
    """Insert ``rows`` into the table at ``path``, which is made if it is not there.

    Of incoming rows with the same key the first in ``order`` counts (all other columns break ties). A row whose key is already stored is
    rejected (``reject``), dropped in favour of the stored one (``keep``), or takes its place (``replace``: of incoming rows with
    one primary key the last in ``order`` counts). ``keep`` and ``replace`` go by the first key; a conflict in another key is always
    rejected, except with a stored row that is itself replaced. Extra columns are left out. Stored keys are read alone, through a filter of the incoming ones.
    """
    if on_conflict not in (REJECT, KEEP, REPLACE):
        raise ValueError(f"on_conflict is one of {REJECT}, {KEEP}, {REPLACE}")
    given = T.StructType(rules.given)
    came = rows.select(*[F.col(f"`{f.name}`") for f in given if f.name in rows.columns])
    for f in given:
        if f.name not in came.columns:
            came = came.withColumn(f.name, F.lit(None).cast(_kind(f)))
    checked = came.select(*given.names, F.current_timestamp().alias("_now"), _of_row(rules, came.schema).alias("_rule"))
    came = materialise(_with_references(checked, rules), "incoming")

    # From here on values have their declared types, so that a key is compared as it is stored. Rows that do not fit are out already.
    state = _typed(came.where("_rule IS NULL"), rules)
    stored = versions.version(spark, path)
    for i, key in enumerate(rules.keys):
        mode = on_conflict if i == 0 else REJECT
        known = None
        if stored is not None and mode != REPLACE:  # (the first key of a replacement meets the stored rows when it is written)
            narrow = versions.with_files(spark, path, stored).select(*dict.fromkeys([*key, *rules.keys[0]])).where(_whole(key))
            known = passing(narrow, state.where(_standing() & _whole(key)), key)
            if on_conflict == REPLACE:  # a stored row that is replaced stands in no way
                known = lookup_join(known, state.where(_standing()), rules.keys[0], "left_anti")
        found = _losers(state, known, key, order, mode == REPLACE)
        state = materialise(_mark(found, F.col("_lost"), mode, key).drop("_lost"), "state")

    good = state.where(_standing()).select(*given.names)
    counts = state.agg(F.count_if(F.col("_kept")).alias("kept"), F.count_if(_standing()).alias("good"), F.count("_rule").alias("rejected")).first()
    number, replaced = _store(spark, path, rules, stored, good, counts["good"], on_conflict, meta)
    unsound, beaten = came.where("_rule IS NOT NULL"), state.where("_rule IS NOT NULL")
    rejects = unsound.select(*given.names, F.col("_rule").alias("rule")).unionByName(beaten.select(*_as_they_came(beaten, given.names), F.col("_rule").alias("rule")))
    return Inserted(number, counts["good"] - replaced, replaced, counts["kept"], counts["rejected"] + unsound.count(), rejects)


def _mark(state: DataFrame, hit: Column, mode: str, key: Sequence[str]) -> DataFrame:
    """Rows that lose to another of the same key: kept out silently, or rejected under the key's rule."""
    if mode == REJECT:
        return state.withColumn("_rule", F.coalesce("_rule", F.when(hit, named("unique", key))))
    return state.withColumn("_kept", F.col("_kept") | F.coalesce(hit, F.lit(False)))


def _store(spark, path, rules: Rules, stored, good: DataFrame, rows: int, on_conflict: str, meta: dict) -> tuple[int, int]:
    """Commit the good rows: (version, stored rows replaced)."""
    if stored is not None and not rows:
        return stored.number, 0
    marks = dict(stored.meta.get("serial", {})) if stored else {}
    if rules.serial:
        start = marks.get(rules.serial, 0) + 1
        good = continued_key(good, rules.serial, start)
        marks[rules.serial] = start + rows - 1
    schema = T.StructType([T.StructField(f.name, _kind(f), True, f.metadata) for f in rules.schema])
    good = good.select(*schema.names)
    before = stored.meta.get("rows", 0) if stored else 0
    base = stored or versions.Version(0, "parquet", schema)
    replaced = 0
    if on_conflict == REPLACE and stored is not None and rules.keys:
        new, replaced = versions.without_keys(spark, path, stored, good, rules.keys[0], kept=good)
    else:
        name, _ = versions.write_rows(good, path)
        new = replace(base, number=base.number + 1, folders=(*base.folders, name))
    versions.commit(spark, path, replace(new, meta={**meta, "rows": before + rows - replaced, "serial": marks}))
    return new.number, replaced
