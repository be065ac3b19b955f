"""Golden documents through the real streams: bronze stream → silver foreachBatch stream."""

import json
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.plans.medallion import ingest_changed, process_silver_batch, silver_current, silver_table
from ledgerflow.streaming.bronze import run_bronze
from ledgerflow.streaming.silver import run_silver
from payloads import GOLDENS, doc, item, money, write_goldens


@pytest.fixture(scope="module")
def flow(spark, spec, tmp_path_factory):
    root = tmp_path_factory.mktemp("goldens")
    landing, bronze = str(root / "landing"), str(root / "bronze")
    write_goldens(landing)
    run_bronze(spark, landing, bronze, str(root / "ckpt_b"), spec)
    table = silver_table(spark, str(root / "silver"), spec, buckets=4)
    quarantine = str(root / "quarantine")
    run_silver(spark, bronze, table, quarantine, str(root / "ckpt_s"), spec, metrics_path=str(root / "metrics"))
    b = spark.read.parquet(bronze).withColumn("name", F.regexp_extract("source_file", r"([^/]+)\.json$", 1))
    return {
        "root": root,
        "bronze": b.collect(),
        "silver": silver_current(table, spec).collect(),
        "quarantine": spark.read.parquet(quarantine).collect(),
        "metrics": spark.read.parquet(str(root / "metrics")).collect(),
        "table": table,
        "landing": landing,
        "bronze_path": bronze,
    }


@pytest.mark.parametrize("name", list(GOLDENS))
def test_bronze_rows_per_file(flow, name):
    rows = [r for r in flow["bronze"] if r["name"] == name]
    assert len(rows) == GOLDENS[name][1]
    assert all(r["source_file"].endswith(f"{name}.json") for r in rows)


def test_bronze_total(flow):
    assert len(flow["bronze"]) == sum(g[1] for g in GOLDENS.values())


@pytest.mark.parametrize("name", ["malformed", "empty_data", "no_data", "null_key", "object_data"])
def test_trace_rows_are_all_null(flow, spec, name):
    (r,) = [r for r in flow["bronze"] if r["name"] == name]
    assert all(r[c] is None for c in spec.business_columns)
    assert r["transaction_conversion_month"] is None


def test_ok_typed_values(flow):
    (r,) = [r for r in flow["silver"] if r["transaction_id"] == "ok"]
    assert r["transaction_value_amount"] == Decimal("731.58")
    assert r["transaction_quota_quantity"] == Decimal("8.12")
    assert str(r["transaction_conversion_date"]) == "2024-09-17"
    assert r["transaction_conversion_month"] == "2024-09"
    assert "item_pos" not in r.asDict()


def test_silver_rows(flow):
    ids = sorted(r["transaction_id"] for r in flow["silver"])
    expected = sorted(
        ["ok", "scalar_money", "number_amount", "top_array_1", "top_array_2", "blank_key", "bad_date",
         "bad_amount", "dup_in_file", "same_key"]
    )
    assert ids == expected


def test_quarantine(flow):
    q = flow["quarantine"]
    assert len(q) == sum(g[3] for g in GOLDENS.values())
    assert {r["failure_reason"] for r in q} == {"valid_business_key"}
    empty = [json.loads(r["data"]) for r in q if "empty_key" in r["data"]]
    assert empty and empty[0]["client_id"] == "" and "ingestion_ts" not in empty[0]
    # a malformed document leaves only its file in the payload
    assert any(json.loads(r["data"]).keys() == {"source_file"} and "malformed" in r["data"] for r in q)
    assert all(r["rejected_at_month"] is not None for r in q)


def test_edge_values(flow):
    s = {r["transaction_id"]: r for r in flow["silver"]}
    assert s["bad_date"]["transaction_conversion_date"] is None and s["bad_date"]["transaction_conversion_month"] is None
    assert s["bad_amount"]["transaction_value_amount"] is None
    assert s["number_amount"]["transaction_value_amount"] == Decimal("731.58")
    assert s["scalar_money"]["transaction_exit_fee_amount"] is None
    assert s["scalar_money"]["transaction_value_amount"] == Decimal("731.58")
    assert s["blank_key"]["client_id"] == " "
    b = {r["transaction_id"]: r for r in flow["bronze"] if r["name"] == "bad_amount"}
    assert b["bad_amount"]["transaction_value_amount"] == "7,31.58"


def test_within_batch_ties(flow):
    s = {r["transaction_id"]: r for r in flow["silver"]}
    assert s["dup_in_file"]["transaction_value_amount"] == Decimal("2.00")  # last position wins
    assert s["same_key"]["transaction_value_amount"] == Decimal("20.00")  # greatest path wins


def test_metrics_partition_the_input(flow):
    m = flow["metrics"]
    n_in = sum(r["n_input"] for r in m)
    assert n_in == len(flow["bronze"])
    assert sum(r["n_valid"] for r in m) + len(flow["quarantine"]) == n_in


def test_keys_unique(flow):
    keys = [(r["client_id"], r["transaction_id"]) for r in flow["silver"]]
    assert len(keys) == len(set(keys))


def test_month_change_later_file_wins(spark, spec, tmp_path):
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    os.makedirs(landing)
    with open(f"{landing}/first.json", "w") as f:
        f.write(json.dumps(doc(item("mc", transactionConversionDate="2024-09-17"))))
    table = silver_table(spark, str(tmp_path / "silver"), spec, buckets=4)
    for run in range(2):
        if run == 1:
            with open(f"{landing}/second.json", "w") as f:
                f.write(json.dumps(doc(item("mc", transactionConversionDate="2023-03-09"))))
        run_bronze(spark, landing, bronze, str(tmp_path / "ckpt_b"), spec)
        run_silver(spark, bronze, table, str(tmp_path / "q"), str(tmp_path / "ckpt_s"), spec)
    rows = silver_current(table, spec).collect()
    assert len(rows) == 1 and rows[0]["transaction_conversion_month"] == "2023-03"
    assert spark.read.parquet(bronze).count() == 2


def test_overwritten_file_is_read_again(spark, spec, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    bronze, manifest = str(tmp_path / "bronze"), str(tmp_path / "manifest")
    (landing / "a.json").write_text(json.dumps(doc(item("ow", transactionValue=money("1.00")))))
    (landing / "b.json").write_text(json.dumps(doc(item("other"))))
    assert ingest_changed(spark, str(landing), bronze, manifest, spec) == 0
    assert ingest_changed(spark, str(landing), bronze, manifest, spec) is None
    time.sleep(1.1)
    (landing / "a.json").write_text(json.dumps(doc(item("ow", transactionValue=money("5.00")))))
    assert ingest_changed(spark, str(landing), bronze, manifest, spec) == 1
    assert ingest_changed(spark, str(landing), bronze, manifest, spec) is None
    assert spark.read.parquet(f"{bronze}/batch_id=1").count() == 1  # only the re-written file
    table = silver_table(spark, str(tmp_path / "silver"), spec, buckets=4)
    for b in (0, 1):
        process_silver_batch(spark.read.parquet(f"{bronze}/batch_id={b}"), b, spec, table, str(tmp_path / "q"))
    s = {r["transaction_id"]: r for r in silver_current(table, spec).collect()}
    assert s["ow"]["transaction_value_amount"] == Decimal("5.00") and "other" in s


def test_rescue_keeps_unknown_fields(spark, spec, tmp_path):
    from ledgerflow.plans.medallion import bronze_batch

    write_goldens(str(tmp_path), names={"ok", "malformed", "top_array"})
    extra = doc(item("extra", settlementDays=3, transactionValue={"amount": "1.00", "currency": "EUR", "fx": "1.2"}))
    (tmp_path / "extra.json").write_text(json.dumps(extra))
    rows = {r["transaction_id"]: r for r in bronze_batch(spark, str(tmp_path), spec, rescue=True).collect()}
    r = json.loads(rows["extra"]["_rescued_data"])
    assert r["settlementDays"] == "3" and r["transactionValue.fx"] == "1.2" and "links" in r and r["_file_path"].endswith("extra.json")
    assert json.loads(rows["ok"]["_rescued_data"]).keys() == {"links", "_file_path"}
    assert rows[None]["_rescued_data"].startswith("{")  # malformed document keeps its raw text
    assert "top_array_1" in rows and "top_array_2" in rows
    assert rows["extra"]["transaction_value_amount"] == "1.00"


def test_rescue_stream_matches_batch(spark, spec, tmp_path):
    write_goldens(str(tmp_path / "landing"))
    bronze = str(tmp_path / "bronze")
    run_bronze(spark, str(tmp_path / "landing"), bronze, str(tmp_path / "ckpt"), spec, rescue=True)
    assert spark.read.parquet(bronze).count() == sum(g[1] for g in GOLDENS.values())


def test_rate_limited_stream_makes_batches(spark, spec, tmp_path):
    write_goldens(str(tmp_path / "landing"))
    progress = run_bronze(spark, str(tmp_path / "landing"), str(tmp_path / "b"), str(tmp_path / "c"), spec, max_files=3)
    assert len([p for p in progress if p["numInputRows"]]) >= 5
    assert spark.read.parquet(str(tmp_path / "b")).count() == sum(g[1] for g in GOLDENS.values())


def test_bytes_admission_and_clustered_stream(spark, spec, tmp_path):
    write_goldens(str(tmp_path / "landing"))
    total = sum(g[1] for g in GOLDENS.values())
    prog = run_bronze(spark, str(tmp_path / "landing"), str(tmp_path / "b1"), str(tmp_path / "c1"), spec, max_bytes="1k")
    assert len([p for p in prog if p["numInputRows"]]) >= 3
    assert spark.read.parquet(str(tmp_path / "b1")).count() == total
    run_bronze(spark, str(tmp_path / "landing"), str(tmp_path / "b2"), str(tmp_path / "c2"), spec, clustered=True)
    b2 = spark.read.parquet(str(tmp_path / "b2"))
    assert b2.count() == total and "batch_id" in b2.columns


def test_cast_check_rule_and_month_text(spark, spec, tmp_path):
    from ledgerflow.operators.quality import keep_rejected, to_quarantine
    from ledgerflow.plans.medallion import bronze_batch, silver_view

    write_goldens(str(tmp_path), names={"ok", "bad_amount"})
    v = silver_view(bronze_batch(spark, str(tmp_path), spec), spec, cast_check=True)
    reasons = {r["transaction_id"]: r["_failure_reason"] for r in v.collect()}
    assert reasons == {"ok": "", "bad_amount": "cast_ok_transaction_value_amount"}
    q = to_quarantine(keep_rejected(v), spec.quarantine_exclude, month_as_text=True).first()
    assert len(q["rejected_at_month"]) == 7 and q["rejected_at_month"][4] == "-"


def test_run_pipeline_twice_picks_up_new_files(spark, spec, tmp_path):
    from ledgerflow.plans.medallion import run_pipeline

    landing = tmp_path / "landing"
    write_goldens(str(landing), names={"ok", "empty_key"})
    out = run_pipeline(spark, spec, str(landing), str(tmp_path / "flow"), buckets=4)
    assert silver_current(out["table"], spec).count() == 1
    (landing / "more.json").write_text(json.dumps(doc(item("more"))))
    out = run_pipeline(spark, spec, str(landing), str(tmp_path / "flow"), buckets=4)
    assert sorted(r["transaction_id"] for r in silver_current(out["table"], spec).collect()) == ["more", "ok"]
    assert spark.read.parquet(out["quarantine"]).count() == 1


def test_spread_items_keeps_rows(spark, spec, tmp_path):
    write_goldens(str(tmp_path / "landing"))
    run_bronze(spark, str(tmp_path / "landing"), str(tmp_path / "b"), str(tmp_path / "c"), spec, spread_items=4)
    assert spark.read.parquet(str(tmp_path / "b")).count() == sum(g[1] for g in GOLDENS.values())


def test_new_silver_checkpoint_is_a_new_writer(spark, spec, tmp_path):
    """Batch ids restart at 0 with a new checkpoint; its rows must not be taken for replays."""
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(doc(item("a"))))
    run_bronze(spark, str(landing), bronze, str(tmp_path / "cb"), spec)
    table = silver_table(spark, str(tmp_path / "silver"), spec, buckets=2)
    run_silver(spark, bronze, table, str(tmp_path / "q"), str(tmp_path / "cs1"), spec, compact_every=1)
    (landing / "b.json").write_text(json.dumps(doc(item("b"))))
    run_bronze(spark, str(landing), bronze, str(tmp_path / "cb"), spec)
    run_silver(spark, bronze, table, str(tmp_path / "q"), str(tmp_path / "cs2"), spec, compact_every=1)
    assert sorted(r["transaction_id"] for r in silver_current(table, spec).collect()) == ["a", "b"]


def test_clustered_bronze_feeds_silver(spark, spec, tmp_path):
    write_goldens(str(tmp_path / "landing"))
    bronze = str(tmp_path / "bronze")
    run_bronze(spark, str(tmp_path / "landing"), bronze, str(tmp_path / "cb"), spec, clustered=True)
    table = silver_table(spark, str(tmp_path / "silver"), spec, buckets=2)
    run_silver(spark, bronze, table, str(tmp_path / "q"), str(tmp_path / "cs"), spec)
    assert silver_current(table, spec).count() == sum(g[2] for g in GOLDENS.values())


def test_changed_files_drain_in_bounded_batches(spark, spec, tmp_path):
    write_goldens(str(tmp_path / "landing"))
    bronze, manifest = str(tmp_path / "bronze"), str(tmp_path / "manifest")
    last = ingest_changed(spark, str(tmp_path / "landing"), bronze, manifest, spec, max_files=5)
    assert last == (len(GOLDENS) + 4) // 5 - 1  # ceil(files / 5) batches, ids from 0
    assert spark.read.parquet(bronze).count() == sum(g[1] for g in GOLDENS.values())
    assert ingest_changed(spark, str(tmp_path / "landing"), bronze, manifest, spec, max_files=5) is None


def test_run_pipeline_with_rescue(spark, spec, tmp_path):
    from ledgerflow.plans.medallion import run_pipeline

    landing = tmp_path / "landing"
    write_goldens(str(landing))
    out = run_pipeline(spark, spec, str(landing), str(tmp_path / "flow"), rescue=True, buckets=2)
    silver = {r["transaction_id"]: r for r in silver_current(out["table"], spec).collect()}
    assert len(silver) == sum(g[2] for g in GOLDENS.values())
    assert json.loads(silver["ok"]["_rescued_data"]).keys() == {"links", "_file_path"}
    assert spark.read.parquet(out["quarantine"]).count() == sum(g[3] for g in GOLDENS.values())


def test_late_file_with_an_old_time_is_read(spark, spec, tmp_path):
    landing, bronze, ckpt = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    landing.mkdir()

    def put(name, days):
        f = landing / f"{name}.json"
        f.write_text(json.dumps(doc(item(name))))
        at = time.time() - days * 86400
        os.utime(f, (at, at))

    put("first", 0)
    run_bronze(spark, str(landing), bronze, ckpt, spec)
    put("late", 30)
    put("new", 0)
    run_bronze(spark, str(landing), bronze, ckpt, spec)
    assert sorted(r.transaction_id for r in spark.read.parquet(bronze).collect()) == ["first", "late", "new"]


def test_one_admission_bound(spark, spec, tmp_path):
    from ledgerflow.sources.landing import read_landing

    with pytest.raises(ValueError):
        read_landing(spark, str(tmp_path), spec, max_files=1, max_bytes="1m")


def test_rewritten_file_with_equal_time_is_read_again(spark, spec, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    f = landing / "a.json"
    f.write_text(json.dumps(doc(item("a"))))
    os.utime(f, (10**9, 10**9))
    args = (spark, str(landing), str(tmp_path / "bronze"), str(tmp_path / "manifest"), spec)
    assert ingest_changed(*args) == 0
    f.write_text(json.dumps(doc(item("a"), item("b"))))
    os.utime(f, (10**9, 10**9))
    assert ingest_changed(*args) == 1 and ingest_changed(*args) is None


def test_null_key_never_reaches_silver(spark, spec, tmp_path):
    write_goldens(str(tmp_path / "landing"), names={"no_data"})
    from ledgerflow.plans.medallion import bronze_batch

    loose = spec.with_rules({})
    table = silver_table(spark, str(tmp_path / "silver"), loose, buckets=4)
    with pytest.raises(Exception, match="NOT NULL"):
        process_silver_batch(bronze_batch(spark, str(tmp_path / "landing"), loose), 0, loose, table, str(tmp_path / "q"))


def test_rescue_reads_the_same_documents(spark, spec, tmp_path):
    from ledgerflow.plans.medallion import bronze_batch

    (tmp_path / "lead.json").write_text("\n\t" + json.dumps([doc(item("x")), doc(item("y"))]))
    (tmp_path / "none.json").write_text("[]")
    got = [sorted(r.transaction_id for r in bronze_batch(spark, str(tmp_path), spec, rescue=r).collect()) for r in (False, True)]
    assert got[0] == got[1] == ["x", "y"]


def test_rescue_odd_names_and_kinds(spark, spec, tmp_path):
    """Repeated names, a field named like the file's, equal names in item and document, other kinds of value."""
    from ledgerflow.plans.medallion import bronze_batch

    one = json.dumps(item("odd", _file_path="own", note="item", transactionExitFee="12.5"))[:-1] + ',"foo":1,"foo":2}'
    tail = '"note":"document","meta":"none","big":"' + "x" * 5000 + '"'
    (tmp_path / "odd.json").write_text('{"data":[' + one + "," + json.dumps(item("plain")) + "]," + tail + "}")
    (tmp_path / "cut.json").write_text('{"data":[' + "7" * 5000)
    (tmp_path / "blank.json").write_text(" \n")
    rows = {r["transaction_id"]: r for r in bronze_batch(spark, str(tmp_path), spec, rescue=True).collect()}
    assert rows.keys() == {"odd", "plain", None}
    odd = json.loads(rows["odd"]["_rescued_data"])
    assert odd["foo"] == "2" and odd["note"] == "item" and odd["$.note"] == "document"
    assert odd["$._file_path"] == "own" and odd["_file_path"].endswith("odd.json")
    assert odd["transactionExitFee"] == "12.5" and odd["meta"] == "none"
    assert rows["odd"]["transaction_exit_fee_amount"] is None and rows["odd"]["transaction_value_amount"] == "731.58"
    assert json.loads(rows["plain"]["_rescued_data"]).keys() == {"note", "meta", "big", "_file_path"}
    assert rows[None]["_rescued_data"] == '{"data":[' + "7" * 5000


def test_run_pipeline_reads_overwritten_files(spark, spec, tmp_path):
    from ledgerflow.plans.medallion import run_pipeline

    landing, root = tmp_path / "landing", str(tmp_path / "flow")
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(doc(item("ow", transactionValue=money("1.00")))))
    run_pipeline(spark, spec, str(landing), root, buckets=4, bronze_max_bytes="1k")
    (landing / "a.json").write_text(json.dumps(doc(item("ow", transactionValue=money("15.00")), item("more"))))
    out = run_pipeline(spark, spec, str(landing), root, buckets=4, bronze_max_bytes="1k")
    s = {r["transaction_id"]: r["transaction_value_amount"] for r in silver_current(out["table"], spec).collect()}
    assert s == {"ow": Decimal("15.00"), "more": Decimal("731.58")}
    with pytest.raises(ValueError, match="overwrites"):
        run_pipeline(spark, spec, str(landing), root, buckets=4, overwrites=False)


def test_bytes_bound_cuts_a_list(spark, spec, tmp_path):
    write_goldens(str(tmp_path / "landing"))
    last = ingest_changed(spark, str(tmp_path / "landing"), str(tmp_path / "b"), str(tmp_path / "m"), spec, max_bytes="2k")
    assert last > 1 and spark.read.parquet(str(tmp_path / "b")).count() == sum(g[1] for g in GOLDENS.values())


def test_clustered_write_spreads_a_hot_value(spark, tmp_path):
    from ledgerflow.plans.sink import clustered

    hot = F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 50))
    df = clustered(spark.range(40_000).select(hot.alias("month"), F.col("id").cast("string").alias("key")), ["month"], 8, spread=["key"])
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 40_000 / 8


def test_rescue_keeps_numbers_as_written(spark, spec, tmp_path):
    """Trailing zeros, exponents, 40 digits; names and strings that look like members with numbers stay as they are."""
    from ledgerflow.plans.medallion import bronze_batch

    numbers = ["1.50", "1000.00", "1E+3", "-0.0", "12345678901234567890.12345678901234567890123", "7"]
    items = []
    for i, n in enumerate(numbers):
        one = item(f"n{i}", type='a":5,"b', transactionType=':5, x', transactionTypeAdditionalInfo='{"k":1.50}')
        text = json.dumps(one)
        for field in ("transactionValue", "incomeTax"):
            text = text.replace(json.dumps(one[field]), '{"amount" : ' + n + ', "currency":"EUR"}')
        items.append(text[:-1] + f',"quota,":":5,","note\\"":{n},"deep":{{"x":{n}}}}}')
    (tmp_path / "a.json").write_text('{"data":[' + ",".join(items) + '],"version":1.10}')
    fast = {r.transaction_id: r for r in bronze_batch(spark, str(tmp_path), spec).collect()}
    slow = {r.transaction_id: r for r in bronze_batch(spark, str(tmp_path), spec, rescue=True).collect()}
    assert len(fast) == len(slow) == len(numbers)
    for i, n in enumerate(numbers):
        for rows in (fast, slow):
            r = rows[f"n{i}"]
            assert (r.transaction_value_amount, r.income_tax_amount) == (n, n)
            assert (r.type, r.transaction_type, r.transaction_type_additional_info) == ('a":5,"b', ":5, x", '{"k":1.50}')
        rescued = json.loads(slow[f"n{i}"]["_rescued_data"])
        assert rescued["quota,"] == ":5," and rescued["version"] == "1.10" and json.loads(rescued["deep"]) == {"x": n}


def test_rescue_keeps_elements_that_are_no_objects(spark, spec, tmp_path):
    from ledgerflow.plans.medallion import bronze_batch

    (tmp_path / "a.json").write_text('{"data":[' + json.dumps(item("one")) + ',7,"x"]}')
    (tmp_path / "b.json").write_text('{"data":"none"}')
    rows = bronze_batch(spark, str(tmp_path), spec, rescue=True).collect()
    found = sorted((r.transaction_id or "", (json.loads(r["_rescued_data"]) if r["_rescued_data"] else {}).get("$item") or "") for r in rows if r.source_file.endswith("a.json"))
    assert found == [("", "7"), ("", "x"), ("one", "")]
    assert [json.loads(r["_rescued_data"])["data"] for r in rows if r.source_file.endswith("b.json")] == ["none"]
