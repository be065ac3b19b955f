"""What the landing copy, the bronze files, the folds and the arrivals cost as their input grows."""

from __future__ import annotations

import datetime as dt
import os
import threading

from pyspark.sql import functions as F

from ledgerflow.plans import catalog, fixtures, medallion
from ledgerflow.plans.fixtures import documents, landing_fixture
from ledgerflow.plans.medallion import bronze_batch, process_silver_batch, silver_table
from ledgerflow.plans.sink import write_clustered
from ledgerflow.session import Fs
from ledgerflow.streaming.bronze import run_bronze


def lineitem(spark, n: int):
    i = F.col("id")
    return spark.range(n, numPartitions=2).select(
        (i % 997).alias("l_orderkey"), (i * 31 % 2003).alias("l_partkey"), (i % 101).alias("l_suppkey"), (i % 7).cast("int").alias("l_linenumber"),
        (i % 50).cast("double").alias("l_quantity"), (i * 7919 % 100_003 / 100).alias("l_extendedprice"), (i % 11 / 100).alias("l_discount"),
        (i % 9 / 100).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.timestamp_seconds(694_224_000 + i * 3600).alias("l_shipdate"),
    )


def size(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.startswith(("part-", "0")))


def local(path: str) -> str:
    return path.removeprefix("file:")


def test_documents_land_packed(spark, spec, tmp_path):
    lineitem(spark, 20_000).write.parquet(str(tmp_path / "lineitem.parquet"))
    landing = landing_fixture(spark, str(tmp_path))
    assert size(local(landing)) < 20_000 * 100  # some 600 bytes an item as plain text
    for rescue in (False, True):
        rows = bronze_batch(spark, landing, spec, rescue=rescue)
        assert rows.agg(F.count("transaction_id"), F.count_distinct("source_file")).first()[0] == 20_000


def test_items_are_made_after_the_shuffle(spark):
    plan = documents(lineitem(spark, 100))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression", 1)
    assert "item_json" in above and "struct(" not in below


def test_small_documents_make_few_bronze_files(spark, spec, tmp_path):
    landing, bronze = tmp_path / "landing", tmp_path / "bronze"
    landing.mkdir()
    tasks = spark.sparkContext.defaultParallelism
    for i in range(30 * (tasks + 4)):  # Spark's own packing makes a task of thirty
        (landing / f"{i:06d}.json").write_text('{"data":[{"transactionId":"%d"}]}' % i)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    run_bronze(spark, str(landing), str(bronze), str(tmp_path / "ckpt"), spec)
    assert len([f for f in os.listdir(bronze) if f.startswith("part-")]) <= tasks + 1
    assert spark.read.parquet(str(bronze)).select("transaction_id").distinct().count() == 30 * (tasks + 4)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_folds_rewrite_twice_the_table_at_most(spark, spec, tmp_path):
    """Twelve equal batches of new keys, a fold due after each: the log is folded when it has caught up with the base."""
    lineitem(spark, 1200).write.parquet(str(tmp_path / "lineitem.parquet"))
    path = str(tmp_path / "bronze")
    bronze_batch(spark, landing_fixture(spark, str(tmp_path)), spec).write.parquet(path)
    bronze = spark.read.schema(spec.bronze_schema()).parquet(path)
    table = silver_table(spark, str(tmp_path / "silver"), spec, buckets=2)
    for b in range(12):
        part = bronze.where(F.pmod(F.xxhash64(*spec.keys), F.lit(12)) == b)
        process_silver_batch(part, b, spec, table, str(tmp_path / "quarantine"), compact_every=1)
    folds = [d for d in os.listdir(tmp_path / "silver" / "base") if d.startswith("lf_version=")]
    assert 2 <= len(folds) <= 6  # twelve before
    valid = bronze.where(spec.rule_map["valid_business_key"])
    assert table.current().count() == valid.select(*spec.keys).distinct().count()


def test_an_arrival_is_cut_by_its_size(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1), i % 3, "view", 1.0, "{}") for i in range(600)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.repartition(24).write.parquet(str(tmp_path / "events.parquet"))
    catalog._arrives(spark, str(tmp_path), str(tmp_path / "source"), [0])
    (arrival,) = os.listdir(tmp_path / "source")
    assert len([f for f in os.listdir(tmp_path / "source" / arrival) if f.startswith("part-")]) == 1
    assert spark.read.parquet(str(tmp_path / "source" / arrival)).count() == 120


def test_bare_numbers_keep_their_text_on_both_paths(spark, spec, tmp_path):
    lineitem(spark, 600).write.parquet(str(tmp_path / "lineitem.parquet"))
    landing = landing_fixture(spark, str(tmp_path), bare=True)
    fast, rescue = (sorted(map(tuple, bronze_batch(spark, landing, spec, rescue=r).select("transaction_id", *catalog.AMOUNTS).collect())) for r in (False, True))
    assert fast == rescue and any(row[1].endswith("0E+2") for row in fast)


def shuffle_files(spark) -> int:
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return sum(f.startswith("shuffle_") for folder in folders for _, _, files in os.walk(folder) for f in files)


def test_the_landing_copy_is_shuffled_in_turns(spark, spec, tmp_path, monkeypatch):
    """A turn has all rows of its keys, under numbers of its own; no turn's shuffle files stay."""
    lineitem(spark, 9000).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = spark.read.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(fixtures, "TURN_BYTES", size(str(tmp_path / "lineitem.parquet")) // 3 + 1)
    assert fixtures.turns_of(rows) == 3
    before = shuffle_files(spark)
    landing = landing_fixture(spark, str(tmp_path), fresh=True)
    assert shuffle_files(spark) <= before
    bronze = bronze_batch(spark, landing, spec)
    turn = F.shiftright(F.regexp_extract("source_file", r"(\d+)\.json", 1).cast("long"), fixtures.TURN_SHIFT)
    per_key = bronze.groupBy("transaction_id").agg(F.count_distinct(turn).alias("turns"), F.min(turn).alias("turn"))
    assert {(r.turns, r.turn) for r in per_key.select("turns", "turn").distinct().collect()} == {(1, 0), (1, 1), (1, 2)}
    cols = ["client_id", "transaction_id", "transaction_value_amount"]
    whole = spark.read.parquet(str(tmp_path / "lineitem.parquet"))
    item = fixtures.transaction_items(whole).select("item.clientId", "item.transactionId", "item.transactionValue.amount")
    assert sorted(map(tuple, bronze.select(*cols).collect())) == sorted(map(tuple, item.collect()))


def test_a_clustered_write_leaves_no_shuffle_files(spark, spec, tmp_path):
    lineitem(spark, 2000).write.parquet(str(tmp_path / "lineitem.parquet"))
    bronze = bronze_batch(spark, landing_fixture(spark, str(tmp_path)), spec)
    before = shuffle_files(spark)
    write_clustered(bronze, str(tmp_path / "clustered"), spec.cluster_by, spread=spec.keys)
    assert shuffle_files(spark) <= before
    assert all(f.endswith(".zstd.parquet") for f in os.listdir(tmp_path / "clustered") if f.startswith("part-"))


def test_the_table_is_read_a_bounded_number_of_times(spark, tmp_path, monkeypatch):
    """A turn reads the whole table, so with turns of a fixed size a landing copy cost the square of its table."""
    path = str(tmp_path / "lineitem.parquet")
    lineitem(spark, 2000).write.parquet(path)
    monkeypatch.setattr(fixtures, "TURN_BYTES", 64)
    rows = spark.read.parquet(path)
    assert size(path) > 64 * fixtures.MOST_TURNS and fixtures.turns_of(rows) == fixtures.MOST_TURNS
    landing = str(tmp_path / "landing")
    assert fixtures.land(rows, landing) == len([f for f in os.listdir(landing) if f.endswith(".json.gz")])


def test_the_next_batch_is_planned_while_one_is_written(spark, spec, monkeypatch):
    """Batches come in order, and the one after is made ready before it is asked for; without ``ahead`` it is not."""
    begun = {k: threading.Event() for k in "abc"}

    def planned(spark, paths, spec, rescue):
        begun[paths[0]].set()
        return f"rows of {paths[0]}"

    monkeypatch.setattr(medallion, "bronze_batch", planned)
    parts = [[{"path": k}] for k in begun]
    batches = medallion._read_ahead(spark, iter(parts), spec, True)
    assert next(batches) == (parts[0], "rows of a")
    assert begun["b"].wait(20)
    assert list(batches) == [(parts[1], "rows of b"), (parts[2], "rows of c")]
    for e in begun.values():
        e.clear()
    batches = medallion._read_ahead(spark, iter(parts), spec, True, ahead=False)
    assert next(batches)[1] == "rows of a" and not begun["b"].is_set()


def test_changed_files_come_in_bounded_batches_once(spark, spec, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(7):
        (landing / f"{i}.json").write_text('{"data":[{"transactionId":"%d"}]}' % i)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    args = (spark, str(landing), str(tmp_path / "bronze"), str(tmp_path / "manifest"), spec)
    assert medallion.ingest_changed(*args, max_files=3, rescue=True) == 2
    rows = spark.read.parquet(str(tmp_path / "bronze"))
    assert sorted(map(tuple, rows.groupBy("batch_id").count().collect())) == [(0, 3), (1, 3), (2, 1)]
    assert {r[0] for r in rows.select("transaction_id").collect()} == {str(i) for i in range(7)}
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


class Waiting:
    """A store whose calls return only when another one is under way."""

    def __init__(self):
        self.meet, self.times = threading.Barrier(2, timeout=20), {}

    def listStatus(self, path):
        return [Status(k) for k in range(8)]

    def setTimes(self, path, time, access):
        self.meet.wait()
        self.times[path] = time


class Status:
    def __init__(self, k):
        self.k = k

    def getPath(self):
        return self.k

    def getModificationTime(self):
        return 10**12 + self.k


def test_files_are_backdated_side_by_side(spark, monkeypatch):
    store = Waiting()
    monkeypatch.setattr(Fs, "_fs", lambda self, p: store)
    Fs(spark).backdate("/late", days=30)
    assert store.times == {k: 10**12 + k - 30 * 86_400_000 for k in range(8)}


def test_documents_grow_before_their_number_does(spark, spec, tmp_path, monkeypatch):
    """Twice the table, documents of twice the rows, up to a bound; a part of the table is cut as the whole is."""
    path = str(tmp_path / "lineitem.parquet")
    lineitem(spark, 9000).write.parquet(path)
    rows = spark.read.parquet(path)
    assert fixtures.items_of(rows) == fixtures.FEWEST_ITEMS == 256
    fixtures.land(rows, str(tmp_path / "small"))
    monkeypatch.setattr(fixtures, "DOC_TABLE_BYTES", size(path) / 3)
    assert fixtures.items_of(rows) == fixtures.items_of(rows.where("l_orderkey % 2 = 0")) == 1024
    fixtures.land(rows, str(tmp_path / "large"))
    few, many = (bronze_batch(spark, str(tmp_path / n), spec, rescue=True).drop("source_file", "ingestion_ts", "item_pos", "_rescued_data") for n in ("large", "small"))
    assert few.exceptAll(many).isEmpty() and few.count() == many.count() == 9000
    n = {k: len([f for f in os.listdir(tmp_path / k) if f.endswith(".json.gz")]) for k in ("small", "large")}
    assert 9000 / 1024 <= n["large"] < n["small"] / 3
    monkeypatch.setattr(fixtures, "DOC_TABLE_BYTES", 1)
    assert fixtures.items_of(rows) == fixtures.MOST_ITEMS


def test_packed_bare_numbers_keep_their_text_without_rescue(spark, spec, tmp_path):
    """The JSON source opens a file anew for the text of each number, and has none in a packed file."""
    lineitem(spark, 600).write.parquet(str(tmp_path / "lineitem.parquet"))
    landing = landing_fixture(spark, str(tmp_path), bare=True)
    assert all(f.endswith(".json.gz") for f in os.listdir(local(landing)) if f.startswith("0"))
    rows = bronze_batch(spark, landing, spec)
    assert "FileScan text" in rows._jdf.queryExecution().executedPlan().toString()
    texts = {r[0] for r in rows.select("transaction_value_amount").collect()}
    assert any(t.endswith("0E+2") for t in texts) and any(t.startswith(fixtures.LONG_DIGITS) for t in texts)


def test_documents_of_every_form_without_rescue(spark, spec, tmp_path):
    item = '{"data":[{"clientId":"%s"}]}'
    forms = {
        "one": item % "a", "list": f'\n [{item % "b"},{item % "c"}]', "mark": "﻿" + item % "d", "empty": "[]", "blank": " \n",
        "cut": '{"data":[{"clientId":"e"', "cut_list": f"[{item % 'f'}", "scalar": "7", "null_list": '{"data":null}',
    }
    for name, text in forms.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = bronze_batch(spark, str(tmp_path), spec).select(F.regexp_extract("source_file", r"(\w+)\.json", 1), "client_id").collect()
    assert sorted((n, c or "") for n, c in found) == [
        ("cut", ""), ("cut_list", ""), ("list", "b"), ("list", "c"), ("mark", "d"), ("null_list", ""), ("one", "a"), ("scalar", ""),
    ]
