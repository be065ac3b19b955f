"""Physical plan checks: map-only bronze, partial top-1 before the shuffle, pushdown, broadcast merge."""


from pyspark.sql import functions as F

from ledgerflow.operators.latest import latest_per_key
from ledgerflow.plans.medallion import bronze_batch
from ledgerflow.plans.upsert import UpsertTable
from payloads import write_goldens

from conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_is_map_only(spark, spec, tmp_path):
    write_goldens(str(tmp_path))
    p = plan(bronze_batch(spark, str(tmp_path), spec))
    assert "Exchange" not in p and "Generate" in p


def test_latest_has_partial_limit_before_shuffle(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    p = plan(latest_per_key(df, ["user_id", "event_type"], ["ts", "event_id"]))
    below = p[p.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_key_filter_reaches_scan(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    q = latest_per_key(df, ["user_id", "event_type"], ["ts", "event_id"]).where(F.col("user_id") == 5)
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,5)]" in p


def test_projection_is_pruned(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(latest_per_key(df, ["l_orderkey"], ["l_shipdate"]).select("l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_current_broadcasts_small_log(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    t = UpsertTable(spark, str(tmp_path / "t"), ["user_id", "event_type"], ["ts", "event_id"], buckets=4)
    t.append(ev.where("event_id % 2 = 0"), 0)
    t.compact()
    t.append(ev.where("event_id % 2 = 1"), 1)
    p = plan(t.current())
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    big = UpsertTable(spark, t.path, t.keys, t.sequence_by, buckets=4, broadcast_bytes=0)
    assert "BroadcastHashJoin" not in plan(big.current())
    n = latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"]).count()
    assert big.current().count() == t.current().count() == n


def test_rules_reach_the_scan(spark, tmp_path):
    from ledgerflow.operators.quality import expect_all_or_drop

    spark.createDataFrame([("a", 1), ("", 2), (None, 3)], "k string, v int").write.parquet(str(tmp_path / "t"))
    df = expect_all_or_drop(spark.read.parquet(str(tmp_path / "t")), {"key": "k <> ''", "key_known": "k IS NOT NULL", "value": "v < 3"})
    assert [r.v for r in df.collect()] == [1]
    pushed = [line for line in df._jdf.queryExecution().toString().splitlines() if "PushedFilters" in line]
    assert pushed and "IsNotNull(k)" in pushed[0] and "LessThan(v,3)" in pushed[0]
