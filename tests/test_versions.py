"""Versioned tables, keyed loads and the store of derived tables."""

import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL_SF
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.derived import DerivedStore
from ledgerlens.sources.loads import LoadedTable
from ledgerlens.sources.versions import Conflict, VersionedTable, fingerprint


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_a_writer_that_fails_half_way_leaves_the_old_table(spark):
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="ll-versions-"), ("day",))
    old = spark.createDataFrame([(1, "a"), (2, "b")], "n long, day string")
    table.replace(old)
    broken = spark.range(100).repartition(8).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("disk is full"))).otherwise(F.col("id")).cast("long").alias("n"),
        F.lit("a").alias("day"))
    for write in (table.replace, table.append, lambda df: table.merge(df, lambda x: x)):
        with pytest.raises(Exception, match="disk is full"):
            write(broken)
        assert rows(table.read(), "n", "day") == [(1, "a"), (2, "b")]
    table.replace(spark.createDataFrame([(3, "c")], "n long, day string"))
    assert rows(table.read(), "n", "day") == [(3, "c")]


def test_a_reader_keeps_its_version_while_the_table_is_replaced(spark):
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="ll-versions-"))
    table.replace(spark.range(5).toDF("n"))
    reader = table.read()
    table.replace(spark.range(3).toDF("n"))
    assert reader.count() == 5 and table.read().count() == 3


def test_two_writers_of_one_version(spark):
    root = tempfile.mkdtemp(prefix="ll-versions-")
    one, two = VersionedTable(spark, root), VersionedTable(spark, root)
    start = one.replace(spark.range(1).toDF("n"))
    outcomes = []
    for t in (one, two):  # both saw the same last version
        try:
            outcomes.append(t._commit(start, start.paths, start.schema, {}, {}, None).number)
        except Conflict:
            outcomes.append(None)
    assert outcomes[0] == 1 and table_is_one_of(one, outcomes)


def table_is_one_of(table, outcomes):
    return table.current().number == 1 and outcomes.count(1) >= 1


def test_an_empty_table_has_its_schema(spark):
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="ll-versions-"), ("day",))
    table.replace(spark.createDataFrame([], "n long, day string"))
    assert table.read().count() == 0 and table.read().columns == ["n", "day"]
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, tempfile.mkdtemp(prefix="ll-versions-")).read()


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("region", T.StringType()),
                       T.StructField("n", T.IntegerType())])


def loaded(spark):
    return LoadedTable(spark, tempfile.mkdtemp(prefix="ll-loads-"), SCHEMA, ["id", "region"])


def test_a_load_is_one_commit_and_runs_again_without_effect(spark, monkeypatch):
    table = loaded(spark)
    rules = {"positive": F.col("n") > 0}
    first = spark.createDataFrame([(1, "x", 5), (2, "x", -1), (3, "y", 2), (3, "y", 9)], SCHEMA)
    table.load(first, ("nightly", 0), rules)
    assert rows(table.accepted(), "id", "n") == [(1, 5)]
    assert sorted((r["id"], r["broken"]) for r in table.rejected().collect()) == [
        (2, ["positive"]), (3, ["pk"]), (3, ["pk"])]
    second = spark.createDataFrame([(1, "x", 8), (1, "y", 8), (4, "z", 1)], SCHEMA)

    def crash(*_, **__):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as m:  # rows are written, the commit is not
        m.setattr(VersionedTable, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.load(second, ("nightly", 1), rules)
    assert rows(table.accepted(), "id", "n") == [(1, 5)]
    for _ in range(2):
        table.load(second, ("nightly", 1), rules)
    table.load(first, ("nightly", 0), rules)
    assert rows(table.accepted(), "id", "region", "n") == [(1, "x", 5), (1, "y", 8), (4, "z", 1)]
    assert rows(table.rejected(), "id", "n") == [(1, 8), (2, -1), (3, 2), (3, 9)]


def test_a_load_reads_only_loads_whose_filter_has_its_keys(spark):
    table = loaded(spark)
    for k in range(3):
        table.load(spark.range(k * 1000, k * 1000 + 500).select("id", F.lit("x").alias("region"), F.lit(1).alias("n")),
                   ("day", k), {"any": F.lit(True)})
    version = table.table.current()
    folders = [p.split("/")[0] for p in version.paths if p.endswith("accepted")]
    new = spark.range(5000, 5400).select("id", F.lit("x").alias("region"), F.lit(1).alias("n"))
    assert len(table.load(new, ("day", 3), {"any": F.lit(True)})) <= 1  # by chance at most
    again = spark.range(1400, 1600).select("id", F.lit("x").alias("region"), F.lit(1).alias("n"))
    met = table.load(again, ("day", 4), {"any": F.lit(True)})
    assert folders[1] in met and folders[0] not in met
    assert table.accepted().count() == 3 * 500 + 400 + 100
    assert rows(table.rejected().groupBy("n").agg(F.count(F.lit(1)).alias("c")), "c") == [(100,)]


def test_derived_tables_are_built_once_and_read_by_partition(spark):
    root = tempfile.mkdtemp(prefix="ll-store-")
    store = DerivedStore(spark, SMALL_SF, root)
    first = store.open("clean_weekly_sales")
    again = store.open("clean_weekly_sales")
    assert store.built == ["clean_weekly_sales"] and first.count() == again.count()
    assert not DerivedStore(spark, SMALL_SF, root).built
    plan = QUERIES["stored_impact_4w_by_year"](spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_number" in plan and "lineitem" not in plan


def test_a_derived_table_is_built_anew_when_its_files_change(spark):
    base, root = tempfile.mkdtemp(prefix="ll-base-"), tempfile.mkdtemp(prefix="ll-store-")
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{SMALL_SF}/{t}.parquet").where("1 = 1").write.parquet(f"{base}/{t}.parquet")
    store = DerivedStore(spark, base, root)
    n = store.open("runs_clean").count()
    before = fingerprint(spark, [f"{base}/orders.parquet"])
    spark.read.parquet(f"{SMALL_SF}/orders.parquet").limit(1).withColumn("o_orderkey", F.lit(-5).cast("long")) \
        .write.mode("append").parquet(f"{base}/orders.parquet")
    assert fingerprint(spark, [f"{base}/orders.parquet"]) != before
    assert store.open("runs_clean").count() == n + 1 and store.built == ["runs_clean"] * 2
