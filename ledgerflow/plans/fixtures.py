"""Landing documents derived from the driver tables, written by Spark.

``lineitem`` rows become transaction items; documents are blocks of at most
``items_per_doc`` (:func:`items_of` the table's size) adjacent rows of one partition (``monotonically_increasing_id >> k``
never crosses a partition, so the bound is exact and holds however skewed any
column is). One document per file ``<doc>.json.gz`` in one folder, as a producer
drops API responses into a landing area; readers unpack it by its name.

Derivation rules (the oracle SQL repeats them):

* clientId ``''`` when ``l_orderkey % 17 = 0`` else ``l_suppkey`` as text
* transactionId ``concat_ws('-', l_orderkey, l_linenumber, l_partkey)``
* transactionConversionDate ``'not-a-date'`` when ``l_orderkey % 13 = 0``
* amounts as ``decimal(20,3)`` text; ``bump`` adds 1 to the value amounts of
  even order keys (the re-written version of a file)
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import SHUFFLE_CLEANUP, Fs, settings, work_dir


# Value order of the fixture rows (file, then position inside the file).
LINEITEM_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
    "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def _dec3(c: Column) -> Column:
    return c.cast("decimal(20,3)")


def _money(amount: Column, *more: Column) -> Column:
    return F.struct(amount.cast("string").alias("amount"), F.lit("BRL").alias("currency"), *more)


def transaction_items(lineitem: DataFrame, bump: bool = False, extra_field: bool = False, keep=()) -> DataFrame:
    """One transaction item per ``lineitem`` row (column ``item``) plus the columns ``keep``."""
    ok = F.col("l_orderkey")
    value = _dec3(F.col("l_extendedprice"))
    if bump:
        value = F.when(F.pmod(ok, F.lit(2)) == 0, value + F.lit(1)).otherwise(value)
    # an unknown field inside a known struct, on some items only
    fx = [F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")).alias("fx")] if extra_field else []
    fields = [
        F.when(F.pmod(ok, F.lit(17)) == 0, F.lit("")).otherwise(F.col("l_suppkey").cast("string")).alias("clientId"),
        F.col("l_partkey").cast("string").alias("investimentId"),
        F.concat_ws("-", ok, F.col("l_linenumber"), F.col("l_partkey")).alias("transactionId"),
        F.col("l_returnflag").alias("type"),
        F.col("l_linestatus").alias("transactionType"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string")).otherwise(F.lit("line")).alias(
            "transactionTypeAdditionalInfo"
        ),
        F.when(F.pmod(ok, F.lit(13)) == 0, F.lit("not-a-date"))
        .otherwise(F.date_format(F.col("l_shipdate"), "yyyy-MM-dd"))
        .alias("transactionConversionDate"),
        _money(_dec3(F.col("l_extendedprice"))).alias("transactionQuotaPrice"),
        _dec3(F.col("l_quantity")).cast("string").alias("transactionQuotaQuantity"),
        _money(value, *fx).alias("transactionValue"),
        _money(value).alias("transactionGrossValue"),
        _money(_dec3(F.col("l_tax"))).alias("incomeTax"),
        _money(_dec3(F.col("l_discount"))).alias("financialTransactionTax"),
        _money(_dec3(F.col("l_discount"))).alias("transactionExitFee"),
        _money(value - _dec3(F.col("l_discount"))).alias("transactionNetValue"),
    ]
    if extra_field:
        fields.append(F.col("l_linenumber").alias("settlementDays"))
    return lineitem.select(*keep, F.struct(*fields).alias("item"))


#: first digits of the long numbers of :func:`bare_numbers`
LONG_DIGITS = "98765432109876543210987654321"


def bare_numbers(docs: DataFrame) -> DataFrame:
    """Amounts as JSON numbers instead of text: with trailing zeros, with an exponent, or of some 35 digits."""
    amount = r'(?<name>"amount":)"(?<n>[^"]*)"'
    kind = F.pmod(F.get_json_object("item_json", "$.investimentId").cast("long"), F.lit(3))
    ways = ["${name}${n}", "${name}${n}E+2", "${name}" + LONG_DIGITS + "${n}"]
    text = [F.regexp_replace("item_json", amount, w) for w in ways]
    return docs.select("doc", F.when(kind == 1, text[1]).when(kind == 2, text[2]).otherwise(text[0]).alias("item_json"))


#: bytes of the table's files whose rows are shuffled at once
TURN_BYTES = 32 << 20
#: a turn's documents are numbered from here on (a partition's from ``index << 33 - shift`` on)
TURN_SHIFT = 52


#: each turn reads the table anew, so their number stays; beyond it turns grow with the table
MOST_TURNS = 16


def turns_of(lineitem: DataFrame) -> int:
    """Turns in which the rows are shuffled, so that the shuffle files of one turn, not of the table, lie on disk."""
    fs = Fs(lineitem.sparkSession)
    return min(MOST_TURNS, max(1, -(-sum(fs.size(f) for f in lineitem.inputFiles()) // TURN_BYTES)))


#: rows of a document of a table of up to ``DOC_TABLE_BYTES``; a larger table's documents hold more, up to ``MOST_ITEMS``
FEWEST_ITEMS, MOST_ITEMS = 256, 4096
DOC_TABLE_BYTES = 16 << 20


def items_of(lineitem: DataFrame) -> int:
    """Rows a document holds at most: with the table's size they grow first, and from ``MOST_ITEMS`` on the number of
    documents does, since every reader of a folder lists and opens each file, and its driver holds the list. It depends
    on the table's files alone, so the parts of a table, and a part written again, are cut alike."""
    fs = Fs(lineitem.sparkSession)
    tables = sum(fs.size(f) for f in lineitem.inputFiles()) / DOC_TABLE_BYTES
    return min(MOST_ITEMS, FEWEST_ITEMS << max(0, math.ceil(math.log2(tables)) if tables > 1 else 0))


def documents(
    lineitem: DataFrame, items_per_doc: int = 256, bump: bool = False, extra_field: bool = False, turn: int = 0, turns: int = 1
) -> DataFrame:
    """Items with their document: ``(doc, item_json)``, in ``LINEITEM_ORDER`` inside each partition.

    Rows are hash-partitioned on the business key (so every set of
    duplicates of a key lives in one partition, and a hot order key still spreads
    over partitions), sorted inside the partition, and cut into blocks of
    ≤ ``items_per_doc`` adjacent rows (``monotonically_increasing_id >> k`` never
    crosses a partition). Among duplicates of a key, the later in order gets
    the greater zero-padded file name or the later position, which is "last in
    order" — reproducible by SQL. The table's own columns are shuffled and sorted;
    items, some ten times as wide, are made after that. Partitioning is by hash with a count fixed
    by the input, so the layout (every file name) does not depend on item content:
    a re-written version replaces the same files in place. Of several ``turns`` each holds the keys of
    one remainder of another hash, under numbers of its own.
    """
    shift = max(0, int(math.log2(items_per_doc)))
    n = max(1, lineitem.rdd.getNumPartitions())
    rows = lineitem.select(*LINEITEM_ORDER)
    if turns > 1:
        rows = rows.where(F.pmod(F.xxhash64(*LINEITEM_ORDER[:4]), F.lit(turns)) == turn)
    ordered = rows.repartition(n, *LINEITEM_ORDER[:4]).sortWithinPartitions(*LINEITEM_ORDER)
    number = F.shiftright(F.monotonically_increasing_id(), shift) + F.lit(turn << TURN_SHIFT).cast("long")
    doc = F.lpad(number.cast("string"), 20, "0")
    items = transaction_items(ordered.withColumn("doc", doc), bump, extra_field, keep=["doc"])
    return items.select("doc", F.to_json("item").alias("item_json"))


LINK_BASE = "https://landing.example/transactions?page="
#: gzip level of a document: level 9 takes 3.5 times the time of 6 and saves 4% of its bytes
PACKING = 6
META = {"requestDateTime": "2024-01-01T00:00:00Z", "trace": "trace-1"}


def write_documents(docs: DataFrame, path: str, packed: bool = True) -> int:
    """One JSON document per file ``<path>/<doc>.json.gz`` (``.json`` if not ``packed``), written by the executors.

    Items arrive in order; a document is closed when the ``doc`` value changes. Files are packed
    (with no time stamp, so equal documents are equal bytes): names and amounts repeat in every item.
    Each file is written under a hidden temp name and renamed, so a reader never
    sees a partial document, and a retried task rewrites the same names
    (idempotent). Writing an existing name again replaces that file in place.
    Everything the task runs is defined here, so it ships by value (executors do
    not need this package installed).
    """
    target = path.rstrip("/")
    link_base, meta_json, level = LINK_BASE, json.dumps(META), PACKING
    suffix = ".json.gz" if packed else ".json"

    def write_part(batches):
        import gzip
        import json as _json

        import pandas as pd
        import pyarrow.fs as pafs

        def fs_root(p: str):
            # Arrow filesystem + root for a Spark-style path (file:/…, hdfs://…, s3a://…)
            if p.startswith("file:"):
                p = "/" + p[len("file:"):].lstrip("/")
            if "://" not in p:
                return pafs.LocalFileSystem(), p
            if p.startswith("s3a://"):
                p = "s3://" + p[len("s3a://"):]
            return pafs.FileSystem.from_uri(p)

        def document_text(doc: str, item_jsons: list) -> bytes:
            page = _json.dumps(link_base + str(int(doc)))
            links = "{" + ",".join(f'"{k}":{page}' for k in ("self", "first", "prev", "next")) + "}"
            return ('{"data":[\n' + ",\n".join(item_jsons) + '\n],"links":' + links + ',"meta":' + meta_json + "}").encode()

        fs, root = fs_root(target)
        fs.create_dir(root, recursive=True)
        names, sizes = [], []
        cur, buf = None, []

        def flush():
            data = document_text(cur, buf)
            if packed:
                data = gzip.compress(data, compresslevel=level, mtime=0)
            tmp = f"{root}/.{cur}.json.tmp"
            with fs.open_output_stream(tmp) as out:
                out.write(data)
            fs.move(tmp, f"{root}/{cur}{suffix}")
            names.append(cur)
            sizes.append(len(data))

        for pdf in batches:
            for d, js in zip(pdf["doc"], pdf["item_json"]):
                if d != cur:
                    if buf:
                        flush()
                    cur, buf = d, []
                buf.append(js)
        if buf:
            flush()
        yield pd.DataFrame({"name": pd.Series(names, dtype="object"), "bytes": pd.Series(sizes, dtype="int64")})

    with settings(docs.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        return int(docs.mapInPandas(write_part, "name string, bytes long").agg(F.count(F.lit(1))).first()[0])


def land(
    lineitem: DataFrame, path: str, items_per_doc: int | None = None, bump: bool = False, extra_field: bool = False, bare: bool = False
) -> int:
    """All documents of the rows, turn by turn; returns how many."""
    n, turns = 0, turns_of(lineitem)
    items_per_doc = items_per_doc or items_of(lineitem)
    for turn in range(turns):
        docs = documents(lineitem, items_per_doc, bump, extra_field, turn, turns)
        n += write_documents(bare_numbers(docs) if bare else docs, path)
    return n


def _fingerprint(spark: SparkSession, path: str, *params) -> str:
    """Of the source's files as its store lists them, so a changed table never finds an older landing folder."""
    files = Fs(spark).stamps(path)
    return hashlib.sha1(f"{path}|{files}|{params}".encode()).hexdigest()[:16]


def landing_fixture(
    spark: SparkSession,
    sf_dir: str,
    *,
    items_per_doc: int | None = None,
    bump: bool = False,
    extra_field: bool = False,
    where: str | None = None,
    fresh: bool = False,
    bare: bool = False,
) -> str:
    """Write (once per session and input) the landing folder derived from ``lineitem``."""
    src = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    key = _fingerprint(spark, src, items_per_doc, bump, extra_field, where, bare)
    path = work_dir(spark, f"landing-{key}", unique=fresh)
    fs = Fs(spark)
    if not fresh and fs.exists(f"{path}/_SUCCESS"):
        return path
    lineitem = spark.read.parquet(src)
    if where:
        lineitem = lineitem.where(where)
    land(lineitem, path, items_per_doc, bump, extra_field, bare)
    fs.write_text(f"{path}/notes.txt", "no document", overwrite=True)  # the source must pass over it
    fs.write_text(f"{path}/_SUCCESS", "", overwrite=True)
    return path
