"""Overwrites that fail, versions, and deletes that rewrite only the files they touch."""

from __future__ import annotations

import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from pluvia.operators import keyfilter
from pluvia.plans import jobs
from pluvia.sources import folders, sinks, versions
from tests.conftest import rows_of
from tests.test_jobs import DAYS, zones  # noqa: F401


def failing(df):
    """Fails in the task that comes to the last row."""
    return df.withColumn("v", F.when(F.col("id") == 9, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("v")))


@pytest.fixture
def ten(spark):
    return spark.range(10).withColumn("v", F.col("id") * 2).repartition(3)


@pytest.mark.parametrize("kind", ["parquet", "json", "csv"])
def test_a_failed_overwrite_leaves_the_old_rows(spark, ten, folder, kind):
    write = getattr(sinks, f"write_{kind}")
    write(ten.limit(4), folder)
    before = rows_of(spark.read.format(kind).load(folder))
    with pytest.raises(Exception, match="broken"):
        write(failing(ten), folder)
    assert rows_of(spark.read.format(kind).load(folder)) == before
    assert glob.glob(f"{folder}-*") == []
    assert write(ten, folder) == 10 and spark.read.format(kind).option("header", kind == "csv").load(folder).count() == 10


def test_an_overwrite_may_read_what_it_replaces(spark, ten, folder):
    sinks.write_parquet(ten, folder)
    assert sinks.write_parquet(spark.read.parquet(folder).where("id < 3"), folder) == 3
    assert spark.read.parquet(folder).count() == 3


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_a_version_counts_when_it_is_complete(spark, ten, folder, kind):
    first = versions.publish(ten.limit(4), folder, kind)
    old = rows_of(versions.read(spark, folder))
    with pytest.raises(Exception, match="broken"):
        versions.publish(failing(ten), folder, kind)
    assert rows_of(versions.read(spark, folder)) == old and versions.numbers(spark, folder) == [1]
    second = versions.publish(ten, folder, kind, note="all")
    assert (first.number, second.number, second.meta["rows"], versions.version(spark, folder).meta["note"]) == (1, 2, 10, "all")
    assert rows_of(versions.read(spark, folder, 1)) == old and rows_of(versions.read(spark, folder)) == rows_of(ten)
    assert versions.vacuum(spark, folder) == 2  # the first version's folder and that of the failed job
    assert versions.numbers(spark, folder) == [2] and rows_of(versions.read(spark, folder)) == rows_of(ten)


def test_of_two_writers_one_wins(spark, ten, folder):
    last = versions.publish(ten, folder)
    name, _ = versions.write_rows(ten, folder)
    new = versions.Version(last.number + 1, "parquet", last.schema, (*last.folders, name))
    versions.commit(spark, folder, new)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, folder, new)
    assert versions.read(spark, folder).count() == 20
    assert not [n for n in os.listdir(f"{folder}/_versions") if n.startswith(".draft")]


def test_no_version(spark, folder):
    assert versions.version(spark, folder) is None and folders.names(spark, folder) == []
    with pytest.raises(FileNotFoundError):
        versions.read(spark, folder)


def contents(folder):
    return {p: hashlib.md5(open(p, "rb").read()).hexdigest() for p in glob.glob(f"{folder}/data/*/*.parquet")}


def test_delete_rewrites_only_touched_files(spark, folder):
    rows = spark.range(0, 1000, 1, 10).withColumn("v", F.col("id") % 7)
    versions.publish(rows, folder)
    before = contents(folder)
    keys = spark.createDataFrame([(5,), (6,), (950,), (5,), (4000,), (None,)], "id long")
    assert versions.delete_keys(spark, folder, keys, ["id"]) == 3
    assert rows_of(versions.read(spark, folder)) == rows_of(rows.where("id not in (5, 6, 950)"))
    after = contents(folder)
    assert all(after[p] == h for p, h in before.items())
    last = versions.version(spark, folder)
    assert len(last.removed) == 2 and last.meta["rows"] == 997
    used = {r[0] for r in versions.with_files(spark, folder, last).select(versions.FILE).distinct().collect()}
    assert len(used & {os.path.basename(p) for p in before}) == 8
    assert versions.delete_keys(spark, folder, keys, ["id"]) == 0 and versions.version(spark, folder) == last
    # A folder of which every file was touched is no longer named.
    assert versions.delete_keys(spark, folder, rows.where("id % 50 = 1"), ["id"]) == 20
    last = versions.version(spark, folder)
    assert len(last.folders) == 1 and last.removed == ()
    assert rows_of(versions.read(spark, folder)) == rows_of(rows.where("id not in (5, 6, 950) and id % 50 <> 1"))
    assert versions.delete_keys(spark, folder, rows, ["id"]) == 977 and versions.read(spark, folder).count() == 0


def test_files_that_went_are_not_opened(spark, folder):
    versions.publish(spark.range(0, 100, 1, 4), folder)
    versions.delete_keys(spark, folder, spark.range(3), ["id"])
    gone = versions.version(spark, folder).removed
    (path,) = [p for p in glob.glob(f"{folder}/data/*/*.parquet") if os.path.basename(p) in gone]
    os.remove(path)
    assert versions.read(spark, folder).count() == 97


def test_cascade(spark, folder):
    parent, child = f"{folder}/p", f"{folder}/c"
    versions.publish(spark.createDataFrame([(1, "a"), (2, "b")], "k long, t string"), parent)
    versions.publish(spark.createDataFrame([(1, 10), (1, 11), (2, 12), (None, 13)], "k long, id long"), child)
    assert versions.delete_cascading(spark, parent, child, spark.createDataFrame([(1,)], "k long"), ["k"]) == (1, 2)
    assert {r.id for r in versions.read(spark, child).collect()} == {12, 13}


def test_key_filter_loses_no_row_and_lets_few_pass(spark):
    rows = spark.range(100_000).selectExpr("id AS a", "cast(id % 10 AS string) AS b")
    keys = rows.where("a % 100 = 0")
    met = keyfilter.passing(rows, keys, ["a", "b"])
    assert keys.join(met, ["a", "b"], "left_anti").isEmpty()
    assert 1000 <= met.count() < 4000 and met.columns == ["a", "b"]
    assert keyfilter.passing(rows, keys, ["a", "b"], max_words=64) is rows
    assert keyfilter.passing(rows, keys.limit(0), ["a", "b"]).isEmpty()
    text = met._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


def test_jobs_write_versions(spark, zones):  # noqa: F811
    for days in (DAYS, DAYS):
        log = jobs.raw_to_refined(spark, *zones, versioned=True)
        assert [r.status for r in log.collect()] == ["COMPLETED", "COMPLETED"]
    assert versions.numbers(spark, zones[2]) == versions.numbers(spark, zones[3]) == [1, 2]
    assert versions.read(spark, zones[3]).count() == 2 * (DAYS - 4)
    assert versions.version(spark, zones[2]).meta == {"rows": 2 * DAYS, "undated": 0}
