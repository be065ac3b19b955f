"""Operator semantics: safe casts, rules, quarantine JSON, latest-per-key, conform."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerflow.operators.casts import safe_casts, safe_date
from ledgerflow.operators.latest import latest_by_max, latest_per_key
from ledgerflow.operators.quality import (
    REASON,
    expect_all_or_drop,
    keep_rejected,
    keep_valid,
    rule_counts,
    split_counts,
    tag_failures,
    to_quarantine,
)
from ledgerflow.plans.sink import conform, duplicate_keys


def test_decimal_try_cast(spark):
    vals = ["42.255", "-42.255", "1e3", " 12 ", "1,000.04", "abc", "", "NaN", "1" * 30, None]
    df = spark.createDataFrame([(v,) for v in vals], "a string")
    out = [r["a"] for r in safe_casts(df, {"a": DecimalType(20, 2)}).collect()]
    assert out[:4] == [Decimal("42.26"), Decimal("-42.26"), Decimal("1000.00"), Decimal("12.00")]
    assert out[4:] == [None] * 6


def test_date_try_cast(spark):
    df = spark.createDataFrame([("2023-01-07",), ("2023-02-30",), ("07/01/2023",), ("",), (None,)], "d string")
    out = [r[0] for r in df.select(safe_date(F.col("d"))).collect()]
    assert str(out[0]) == "2023-01-07" and out[1:] == [None] * 4


RULES = {"key": "k IS NOT NULL AND k != ''", "positive": "v > 0"}


def test_rules_null_counts_as_failure(spark):
    df = spark.createDataFrame([("a", 1), ("", 1), (None, None), (" ", -1)], "k string, v int")
    t = tag_failures(df, RULES)
    reasons = {r["k"]: r[REASON] for r in t.collect()}
    assert reasons == {"a": "", "": "key", None: "key, positive", " ": "positive"}
    assert keep_valid(t).count() + keep_rejected(t).count() == df.count()
    assert expect_all_or_drop(df, RULES).count() == keep_valid(t).count() == 1
    counts = {r["rule"]: r["failed"] for r in rule_counts(df, RULES).collect()}
    assert counts == {"key": 2, "positive": 2}
    assert split_counts(df, RULES).first().asDict() == {"n_input": 4, "n_valid": 1, "n_rejected": 3}


def test_quarantine_json(spark):
    df = spark.createDataFrame([("", None, Decimal("5.00"), "x")], "k string, n string, amt decimal(20,2), ingestion_ts string")
    q = to_quarantine(keep_rejected(tag_failures(df, {"key": "k != ''"})), ("ingestion_ts",)).first()
    assert json.loads(q["data"]) == {"k": "", "amt": 5.0}
    assert '"amt":5.00' in q["data"]
    assert q["failure_reason"] == "key"
    assert q["rejected_at_month"].day == 1


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 10, 1, "a"), (1, 10, 2, "b"), (1, None, 9, "c"), (2, None, None, "d"), (None, 3, 1, "e"), (None, 4, 1, "f")],
        "k int, s1 int, s2 int, v string",
    )
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["s1", "s2"]).collect()}
    assert got == {1: "b", 2: "d", None: "f"}
    got2 = {r["k"]: r["v"] for r in latest_by_max(df, ["k"], ["s1", "s2"]).collect()}
    assert got2 == got


def test_conform_types_order_and_not_null(spark, spec):
    row = {c: "1" for c in spec.silver_columns}
    row["transaction_conversion_date"] = "2023-01-07"
    df = spark.createDataFrame([row])
    out = conform(df, spec.silver_schema(), spec.not_null)
    assert out.columns == spec.silver_columns
    assert out.schema["transaction_value_amount"].dataType == DecimalType(20, 2)
    out.collect()
    bad = dict(row, client_id=None)
    with pytest.raises(Exception, match="NOT NULL"):
        conform(spark.createDataFrame([bad], df.schema), spec.silver_schema(), spec.not_null).collect()


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, j string")
    assert [tuple(r) for r in duplicate_keys(df, ["k", "j"]).collect()] == [(1, "a", 2)]


def test_expect_all_keeps_rows_and_observes(spark):
    from ledgerflow.operators.quality import expect_all

    df = spark.createDataFrame([("a", 1), ("", 1), (None, None), (" ", -1)], "k string, v int")
    observed, obs = expect_all(df, RULES)
    assert observed.count() == 4
    assert obs.get == {"rows": 4, "failed_key": 2, "failed_positive": 2}


def test_latest_per_key_with_a_hot_key(spark):
    """One key holds a third of all rows: both forms still return the brute-force winners."""
    from conftest import SF

    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(-1)).otherwise(F.col("user_id")))
    pdf = hot.toPandas().sort_values(["ts", "event_id"]).groupby(["user_id", "event_type"]).tail(1)
    expected = sorted(pdf["event_id"].tolist())
    for fn in (latest_per_key, latest_by_max):
        got = sorted(r["event_id"] for r in fn(hot, ["user_id", "event_type"], ["ts", "event_id"]).collect())
        assert got == expected
