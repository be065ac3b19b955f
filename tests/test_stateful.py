"""Stateful streaming upsert, replay filter and observed counts on small fixtures."""

from pyspark.sql import functions as F

from ledgerflow.operators.latest import latest_by_max
from ledgerflow.streaming import stateful

KEYS, SEQ = ["k"], ["seq"]
SCHEMA = "k string, seq long, v string"


def put(spark, source, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)


def run(spark, tmp_path, source):
    changes = stateful.read_files(spark, source, SCHEMA).drop(stateful.ARRIVED)
    q = stateful.start_upsert(changes, KEYS, SEQ, str(tmp_path / "log"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    return q


def state(spark, tmp_path):
    return {r.k: (r.seq, r.v) for r in stateful.current(spark, str(tmp_path / "log"), KEYS).collect()}


def test_upsert_late_rows_restart_and_snapshot(spark, tmp_path):
    source, log = str(tmp_path / "src"), str(tmp_path / "log")
    put(spark, source, [("a", 5, "a5"), ("b", 1, "b1"), (None, 1, "n1"), ("c", 1, "c1")])
    run(spark, tmp_path, source)
    assert state(spark, tmp_path) == {"a": (5, "a5"), "b": (1, "b1"), None: (1, "n1"), "c": (1, "c1")}
    assert stateful.snapshot(spark, log, KEYS) == 0
    put(spark, source, [("a", 3, "late"), ("b", 2, "b2"), ("d", 1, "d1")])
    run(spark, tmp_path, source)
    want = {"a": (5, "a5"), "b": (2, "b2"), None: (1, "n1"), "c": (1, "c1"), "d": (1, "d1")}
    assert state(spark, tmp_path) == want
    # a batch emits only the keys it touched
    assert {r.k for r in spark.read.parquet(log).where("batch_id = 1").collect()} == {"a", "b", "d"}
    assert stateful.snapshot(spark, log, KEYS) == 1 and state(spark, tmp_path) == want
    run(spark, tmp_path, source)  # nothing new: nothing changes
    assert state(spark, tmp_path) == want


def test_upsert_plan_has_no_python(spark, tmp_path):
    put(spark, str(tmp_path / "src"), [("a", 1, "x")])
    rows = spark.read.parquet(str(tmp_path / "src"))
    plan = latest_by_max(rows, KEYS, SEQ)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1


def test_replays_pass_once(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    for rows in ([("a", 1, "x"), ("b", 1, "y")], [("a", 1, "x"), ("c", 0, "late by its own time"), ("c", 0, "late by its own time")]):
        put(spark, source, rows)
        passed = stateful.once(stateful.read_files(spark, source, SCHEMA), ["k", "seq"])
        with stateful.state_in_rocksdb(spark):
            q = passed.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_observed_counts_per_batch_and_empty(spark, tmp_path):
    source = str(tmp_path / "src")
    put(spark, source, [("a", 1, "x"), (None, 1, "y"), ("", 2, "z")])
    put(spark, source, [("b", 1, "x")])
    rules = {"key": "k <> ''"}

    def start(observed):
        return observed.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()

    rows = stateful.read_files(spark, source, SCHEMA, max_files=1)
    counts = stateful.run_observed(rows, rules, "seen", start)
    assert sorted((c["n_input"], c["n_valid"], c["failed_key"]) for c in counts.values()) == [(1, 1, 0), (3, 1, 2)]
    again = stateful.run_observed(stateful.read_files(spark, source, SCHEMA), rules, "seen", start)
    assert sum(c["n_input"] for c in again.values()) == 0
    assert spark.read.parquet(source).where(F.col("k") == "b").count() == 1
