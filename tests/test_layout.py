"""Bucketed catalog tables, the Z-order layout and the silver contract inside the flow."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from ledgerflow.plans.bucketed import BucketedTable
from ledgerflow.plans.fixtures import landing_fixture
from ledgerflow.plans.medallion import run_pipeline
from ledgerflow.plans.zorder import file_ranges, range_bounds, range_number, z_value, zordered

from conftest import SF

SCHEMA = "k string, day string, seq long, v string"
names = itertools.count()


def table(spark, tmp_path, buckets=4, name=None, **kw):
    schema = spark.createDataFrame([], SCHEMA).schema
    return BucketedTable(spark, name or f"bucketed_{next(names)}", schema, ["k", "day"], ["seq"], str(tmp_path), buckets, **kw)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def held(t):
    return sorted(map(tuple, t.current().collect()))


def test_merge_takes_the_latest_and_the_later_of_ties(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(rows(spark, ("a", "1", 5, "a5"), ("a", "1", 4, "a4"), ("b", "1", 1, "b1")))
    assert held(t) == [("a", "1", 5, "a5"), ("b", "1", 1, "b1")]
    batch = rows(spark, ("a", "1", 3, "late"), ("b", "1", 1, "tie"), ("c", "2", None, "null"))
    t.merge(batch)
    after = [("a", "1", 5, "a5"), ("b", "1", 1, "tie"), ("c", "2", None, "null")]
    assert held(t) == after
    t.merge(batch)
    assert held(t) == after
    t.merge(rows(spark).limit(0))
    assert held(t) == after


def test_a_null_key_fails_and_leaves_the_table(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(rows(spark, ("a", "1", 1, "x")))
    with pytest.raises(Exception, match="NOT NULL"):
        t.merge(rows(spark, ("b", "1", 1, "y"), (None, "1", 2, "z")))
    assert held(t) == [("a", "1", 1, "x")]
    t.merge(rows(spark, ("b", "1", 1, "y")))  # writes over what the failed merge left
    assert held(t) == [("a", "1", 1, "x"), ("b", "1", 1, "y")]


def test_the_bucket_count_may_change(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    first = [(f"k{i}", "1", 1, "old") for i in range(200)]
    t.merge(rows(spark, *first))
    grown = table(spark, tmp_path, buckets=16, name=t.name)
    grown.merge(rows(spark, *[(k, d, 2, "new") for k, d, _, _ in first[::2]]))
    assert held(grown) == sorted((k, d, 2 - i % 2, "old" if i % 2 else "new") for i, (k, d, _, _) in enumerate(first))
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t.name}_g1").collect()}
    assert described["Num Buckets"] == "16"


def test_the_table_is_not_shuffled(spark, tmp_path):
    t = table(spark, tmp_path, buckets=4)
    t.merge(rows(spark, *[(f"k{i}", "1", 1, "x") for i in range(50)]))
    stored = str(tmp_path / "batch")
    rows(spark, ("k1", "1", 2, "y")).write.parquet(stored)
    plan = t.merged(spark.read.parquet(stored))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = [re.search(r"[A-Z]", line).start() for line in lines]
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    above, level = [], depth[scan]
    for i in range(scan - 1, -1, -1):
        if depth[i] < level:
            above.append(lines[i])
            level = depth[i]
    assert any("ShuffledHashJoin" in line for line in above)
    assert not any("Exchange" in line or "Sort " in line for line in above)
    assert "Python" not in plan and "Arrow" not in plan


def test_declared_in_the_catalog(spark, tmp_path):
    t = table(spark, tmp_path, comment="it's a table", properties=(("quality", "gold"),))
    t.merge(rows(spark, ("a", "1", 1, "x")))
    schema, comment, properties = t.declared()
    assert [(f.name, f.dataType) for f in schema] == [(f.name, f.dataType) for f in t.schema]
    assert comment == "it's a table" and properties["quality"] == "gold"


def test_the_flow_writes_the_contract(spark, spec, tmp_path):
    out = run_pipeline(spark, spec, landing_fixture(spark, SF), str(tmp_path / "flow"), buckets=4)
    got = {f.name: f.dataType for f in out["table"].current().schema}
    assert got == {f.name: f.dataType for f in spec.flow_schema()}
    # a column that the contract does not have never reaches silver; a wider type is cast to the declared one
    assert "item_pos" in got and "item_pos" not in spec.silver_columns


def test_range_number_and_curve(spark):
    bounds = [3, 5, 9]
    values = [None, 1, 3, 4, 5, 8, 9, 100]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = [r[0] for r in df.select(range_number(F.col("v"), bounds)).collect()]
    assert got == [0 if v is None else sum(b <= v for b in bounds) for v in values]
    assert [r[0] for r in df.select(range_number(F.col("v"), [])).distinct().collect()] == [0]

    pairs = [(x, y) for x in range(8) for y in range(8)]
    z = spark.createDataFrame(pairs, "x int, y int").select("x", "y", z_value([F.col("x"), F.col("y")], bits=3).alias("z")).collect()
    for r in z:
        assert r.z == sum((r.x >> b & 1) << (2 * b + 1) | (r.y >> b & 1) << (2 * b) for b in range(3))


def test_zorder_narrows_every_column(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), F.concat(F.lit("c"), F.lpad(F.col("id") * 104729 % 977, 4, "0")).alias("b"), "id")
    path = str(tmp_path / "z")
    zordered(df, ["a", "b"], partitions=64, spread=["id"]).write.parquet(path)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    ranges = file_ranges(back, ["a", "b"])
    files = ranges.count()
    for col, value in (("a", 500), ("b", "c0500")):
        assert ranges.where((F.col(f"{col}.min") <= value) & (F.col(f"{col}.max") >= value)).count() <= files / 4


def test_zorder_of_nulls_one_value_and_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, "x", i) for i in range(50)], "a int, b string, id int")
    path = str(tmp_path / "z")
    zordered(df, ["a", "b"], partitions=4, spread=["id"]).write.parquet(path)
    assert spark.read.parquet(path).count() == 50
    assert zordered(df.limit(0), ["a", "b"]).count() == 0


def test_the_range_sample_meets_in_a_shuffle(spark, monkeypatch):
    """A collected limit sends the sample's rows of every task to the driver; here it gets the drawn rows alone."""
    plans = []

    def seen(method):
        def call(self, *args):
            plans.append(self._jdf.queryExecution().executedPlan().toString())
            return method(self, *args)

        return call

    for name in ("collect", "first"):
        monkeypatch.setattr(type(spark.range(0)), name, seen(getattr(type(spark.range(0)), name)))
    df = spark.range(1000, numPartitions=20).select((F.col("id") % 100).alias("a"), F.lit(None).cast("string").alias("b"))
    bounds = range_bounds(df, ["a", "b"], sample=500, bits=2)
    assert len(bounds["a"]) == 3 and bounds["a"] == sorted(bounds["a"]) and bounds["b"] == []
    assert plans and all("Aggregate" in p.split("TakeOrderedAndProject")[0] for p in plans)


def test_a_publish_is_written_by_all_tasks(spark, tmp_path):
    """Eight buckets were written by eight tasks, whatever the rows; a bucket now has as many as the session's width gives."""
    t = table(spark, tmp_path, buckets=3)
    batch = rows(spark, *[(f"k{i}", "1", 1, "x") for i in range(200)])
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = t.merged(batch)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"hashpartitioning\(k#\d+.*, {-(-width // 3) * 3}\), REPARTITION_BY_NUM", plan)
    t.merge(batch)
    base = spark.table(t._table(0))
    assert base.count() == 200 and "Bucketed: true" in base.groupBy("k", "day").count()._jdf.queryExecution().executedPlan().toString()
    t.merge(rows(spark, *[(f"k{i}", "1", 2, "y") for i in range(100)]))
    assert held(t) == sorted((f"k{i}", "1", 2 if i < 100 else 1, "y" if i < 100 else "x") for i in range(200))
