"""Landing source: JSON documents in files, read incrementally.

Two paths lead to the same bronze rows:

* fast path — whole files as text, parsed once with the explicit schema; nothing is rescued. (Spark's JSON source, which
  reads documents of a line each, opens a file anew for the text of each bare number, and has none in a packed one;)
* rescue path — whole files as text. A document is parsed into text-typed structs (the values) and maps (the keys
  it holds); what the schema does not take is found by the difference of key sets, level by level, and entries are
  built only for objects whose set differs: frame ``(source_file, _doc_unknown, _doc_json, _raw_items)``. Only a
  document that does not parse keeps its raw text (one row).

The parser would turn a bare JSON number into a double before it becomes text, so numbers of members are
put in quotes first (:func:`quoted_numbers`): ``1.50``, ``1E+3`` and 40 digits read as they stand in the file, on both paths.

Overwritten files are handled by :func:`changed_files`: a distributed listing
(``binaryFile`` without the content column) anti-joined to a manifest of
(path, modification time, length) already ingested.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ledgerflow.session import settings
from ledgerflow.spec import SOURCE_FILE, TableSpec

#: documents as they are, or packed (unpacked by their name)
DOCUMENTS = "{*.json,*.json.gz}"
#: what opening one of many small files is counted as (Spark's 4 MB would make a task of 30 files, however small they are)
OPEN_COST = 64 << 10
#: the file stream's own default drops files a week older than the newest one seen; late files must count
NO_AGE_LIMIT = "36500d"


def parse_size(value: str | int | None) -> int | None:
    """``512m`` → bytes (k, m, g, t suffixes, binary multiples)."""
    if value is None or isinstance(value, int):
        return value
    v = value.strip().lower().rstrip("b")
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if v and v[-1] in mult:
        return int(float(v[:-1]) * mult[v[-1]])
    return int(v)


@contextmanager
def small_files(spark: SparkSession):
    """Settings under which thousands of small files are listed and read by few tasks."""
    listing = max(8, 4 * spark.sparkContext.defaultParallelism)
    with settings(spark, {"spark.sql.files.openCostInBytes": OPEN_COST, "spark.sql.sources.parallelPartitionDiscovery.parallelism": listing}):
        yield


def _reader(spark: SparkSession, fmt: str, stream: bool, glob: str, max_files, max_bytes):
    r = (spark.readStream if stream else spark.read).format(fmt)
    r = r.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if stream:
        if max_files is not None and max_bytes is not None:
            raise ValueError("the file source honours one bound per batch: give max_files or max_bytes")
        r = r.option("maxFileAge", NO_AGE_LIMIT)
        if max_files is not None:
            r = r.option("maxFilesPerTrigger", int(max_files))
        elif max_bytes is not None:
            r = r.option("maxBytesPerTrigger", parse_size(max_bytes))
    return r


def read_landing(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    *,
    stream: bool = True,
    rescue: bool = False,
    multi_line: bool = True,
    glob: str = DOCUMENTS,
    max_files: int | None = None,
    max_bytes: str | int | None = None,
) -> DataFrame:
    """Documents under ``path`` (a folder, or a list of files in batch mode)."""
    paths = [path] if isinstance(path, str) else list(path)
    if rescue:
        return _read_rescue(spark, paths, spec, stream, glob, max_files, max_bytes)
    if multi_line:
        return _read_typed(spark, paths, spec, stream, glob, max_files, max_bytes)
    r = _reader(spark, "json", stream, glob, max_files, max_bytes)
    r = r.schema(spec.read_schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    df = r.load(paths[0]) if stream else r.load(paths)
    return df.select(*[F.col(f.name) for f in spec.read_schema.fields], F.col("_metadata.file_path").alias(SOURCE_FILE))


_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][-+]?[0-9]++)?+"
#: the quote that closes a member's name, and its number; an opening quote stands after one of the characters ruled out
_MEMBER = rf'"(\s{{0,20}}+:\s{{0,20}}+)(?=-?[0-9])(?<![\s:,\[{{\\]"\s{{0,20}}:\s{{0,20}})({_NUMBER})(?=\s*+[,}}])'
TEXTS = "map<string,string>"
ENTRIES = "array<struct<key:string,value:string>>"
#: key under which an element of the item list that is no object keeps its text
NO_OBJECT = "$item"


def quoted_numbers(text: Column) -> Column:
    """JSON text with every number that is the value of a member in quotes, as it is written.

    Numbers inside arrays stay (they are text of unknown fields only), and so do those of members whose name ends in
    white space or one of ``: , [ { \\``. A quote inside a string is escaped, so nothing inside one is touched.
    """
    return F.regexp_replace(text, _MEMBER, '"$1"$2"')


def text_map(text: Column) -> Column:
    """JSON object → its members as text (NULL if it is none)."""
    return F.from_json(text, TEXTS)


def last_wins(m: Column) -> Column:
    """Of a repeated name the last member counts."""
    keys = F.map_keys(m)
    names = F.array_distinct(keys)
    values = F.transform(names, lambda k: F.element_at(F.filter(F.map_entries(m), lambda e: e["key"] == k), -1)["value"])
    return F.when(F.size(keys) > F.size(names), F.map_from_arrays(names, values)).otherwise(m)


def item_shape(schema: StructType) -> StructType:
    """Text for every field; an object keeps all its members, named by the schema or not."""
    return StructType([StructField(f.name, MapType(StringType(), StringType()) if isinstance(f.dataType, StructType) else StringType()) for f in schema.fields])


def no_entries() -> Column:
    return F.array().cast(ENTRIES)


def entry(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def as_declared(m: Column, known) -> Column:
    """The map holds just the known names, once each and in order (the usual case, seen at once)."""
    return F.coalesce(F.map_keys(m) == F.array(*[F.lit(k) for k in known]), F.lit(True))


def unknown_keys(keys: Column, known) -> Column:
    return F.array_except(keys, F.array(*[F.lit(k) for k in known]))


def differs_from(m: Column, known) -> Column:
    """Whether the map holds a key that ``known`` does not name."""
    return F.when(as_declared(m, known), F.lit(False)).otherwise(F.size(unknown_keys(F.map_keys(m), known)) > 0)


def unknown_members(m: Column, known, prefix: str = "") -> Column:
    """Entries of the members of ``m`` that ``known`` does not name (NULL if the key sets agree)."""
    others = F.filter(F.map_entries(last_wins(m)), lambda e: ~e["key"].isin(list(known)))
    found = F.transform(others, lambda e: entry(F.concat(F.lit(prefix), e["key"]), e["value"]))
    return F.when(differs_from(m, known), found)


def let(value: Column, body) -> Column:
    """``body`` over a value that is computed once, however often ``body`` reads it and whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def json_text(entries: Column) -> Column:
    """Entries as one JSON object; where a name repeats they are written one by one, as a map cannot hold them."""

    def one_by_one(e: Column) -> Column:
        bodies = F.transform(e, lambda x: F.regexp_replace(F.to_json(F.create_map(x["key"], x["value"])), r"^\{|\}$", ""))
        return F.concat(F.lit("{"), F.array_join(bodies, ","), F.lit("}"))

    def written(e: Column) -> Column:
        names = F.transform(e, lambda x: x["key"])
        return F.when(F.size(F.array_distinct(names)) == F.size(names), F.to_json(F.map_from_entries(e))).otherwise(one_by_one(e))

    return let(entries, written)


def _member(doc: Column, key: Column) -> Column:
    """Text of one member of a JSON object; names that a path cannot hold are looked up in the whole map."""
    plain = F.call_function("get_json_object", doc, F.concat(F.lit("$['"), key, F.lit("']")))
    return F.when(key.rlike(r"^[^'\[\]*?]+$"), plain).otherwise(F.element_at(last_wins(text_map(doc)), key))


def _whole_files(spark, paths, stream, glob, max_files, max_bytes) -> DataFrame:
    """File, its text as it is and with the numbers of members in quotes."""
    r = _reader(spark, "text", stream, glob, max_files, max_bytes).option("wholetext", "true")
    raw = (r.load(paths[0]) if stream else r.load(paths)).select(F.col("value"), F.col("_metadata.file_path").alias(SOURCE_FILE))
    raw = raw.where(F.col("value").rlike(r"\S"))  # a blank file holds no document
    return raw.select(SOURCE_FILE, "value", quoted_numbers(F.col("value")).alias("_text"))


IS_LIST, BOM = r"^\s*\[", "\ufeff"


def _read_typed(spark, paths, spec: TableSpec, stream, glob, max_files, max_bytes) -> DataFrame:
    raw = _whole_files(spark, paths, stream, glob, max_files, max_bytes)
    text, schema = F.col("_text"), spec.read_schema
    raw = raw.select(SOURCE_FILE, F.when(text.startswith(BOM), F.substring(text, 2, 1 << 30)).otherwise(text).alias("_text"))
    # what does not parse is one document without values, an empty list none
    listed = F.coalesce(F.from_json(text, ArrayType(schema)), F.array(F.lit(None).cast(schema)))
    docs = raw.select(SOURCE_FILE, F.explode(F.when(text.rlike(IS_LIST), listed).otherwise(F.array(F.from_json(text, schema)))).alias("_doc"))
    return docs.select(*[F.col("_doc").getField(f.name).alias(f.name) for f in schema.fields], SOURCE_FILE)


def _read_rescue(spark, paths, spec: TableSpec, stream, glob, max_files, max_bytes) -> DataFrame:
    raw = _whole_files(spark, paths, stream, glob, max_files, max_bytes)
    listed = F.when(F.col("_text").rlike(IS_LIST), F.from_json("_text", "array<string>"))
    raw = raw.select(SOURCE_FILE, "value", F.coalesce(listed, F.array("_text")).alias("_docs"))
    docs = raw.select(SOURCE_FILE, "value", F.explode_outer("_docs").alias("_doc")).where(F.col("_doc").isNotNull())  # an empty list has no rows

    doc, items, fields = F.col("_doc"), spec.items, spec.read_schema.fields
    shape = item_shape(spec.read_schema[items].dataType.elementType)
    nested = [f.name for f in fields if isinstance(f.dataType, StructType)]
    typed = StructType([StructField(items, ArrayType(shape)), *[StructField(n, MapType(StringType(), StringType())) for n in nested]])
    docs = docs.select(
        SOURCE_FILE, "value", "_doc", F.json_object_keys(doc).alias("_keys"), F.from_json(doc, typed).alias("_typed"),
        F.from_json(doc, f"`{items}` array<{TEXTS}>").alias("_maps"),
    )
    keys, typed_items, maps = F.col("_keys"), F.col("_typed").getField(items), F.col("_maps").getField(items)
    zipped = F.arrays_zip(typed_items.alias("typed"), maps.alias("all"))
    # NULL keys: no readable object. Its text is kept once; a list's element that is no object by itself.
    whole = F.when(doc.rlike(r"^\s*[\[{]"), F.col("value")).otherwise(doc)
    missed = F.array_contains(keys, items) & (typed_items.isNull() | maps.isNull())
    docs = docs.select(
        SOURCE_FILE, "_doc", "_keys", F.when(~F.coalesce(missed, F.lit(False)), zipped).alias("_items"), F.when(keys.isNull(), whole).alias("_doc_rescue"),
        F.when(missed, _member(doc, F.lit(items))).alias("_list"),
        *[F.col("_typed").getField(n).alias(f"_in_{i}") for i, n in enumerate(nested)],
        *[
            F.when(F.array_contains(keys, n) & F.col("_typed").getField(n).isNull(), _member(doc, F.lit(n))).alias(f"_misfit_{i}")
            for i, n in enumerate(nested)
        ],
    )
    # a list in which an element (or a field of one) is of another kind: every element is read by itself
    docs = docs.withColumn("_loose", F.from_json("_list", "array<string>"))
    each = F.transform("_loose", lambda x: F.struct(F.from_json(x, shape).alias("typed"), F.coalesce(text_map(x), F.create_map(F.lit(NO_OBJECT), x)).alias("all")))
    known = [f.name for f in fields] + list(spec.ignore_unknown)
    parts = [F.transform(unknown_keys(keys, known), lambda k: entry(k, _member(doc, k)))]
    parts += [F.when(F.col("_list").isNotNull() & F.col("_loose").isNull(), F.array(entry(F.lit(items), F.col("_list"))))]
    for i, n in enumerate(nested):
        parts.append(F.when(F.col(f"_misfit_{i}").isNotNull(), F.array(entry(F.lit(n), F.col(f"_misfit_{i}")))))
        parts.append(unknown_members(F.col(f"_in_{i}"), [f.name for f in spec.read_schema[n].dataType.fields], f"{n}."))
    docs = docs.select(
        SOURCE_FILE, "_doc_rescue", F.concat(*[F.coalesce(p, no_entries()) for p in parts]).alias("_doc_unknown"),
        F.coalesce("_items", each).alias("_raw_items"),
    )
    own_file = F.array(entry(F.lit("_file_path"), F.col(SOURCE_FILE)))
    clash_free = F.transform("_doc_unknown", lambda e: entry(F.when(e["key"] == "_file_path", F.lit("$._file_path")).otherwise(e["key"]), e["value"]))
    docs = docs.withColumn("_entries", F.concat(clash_free, own_file))
    as_json = F.when(F.size("_doc_unknown") > 0, json_text(F.col("_entries")))
    return docs.select(SOURCE_FILE, "_doc_unknown", F.coalesce("_doc_rescue", as_json).alias("_doc_json"), "_raw_items")


def list_files(spark: SparkSession, path: str, glob: str = DOCUMENTS) -> DataFrame:
    """Distributed listing ``(path, mtime, length)``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path"), F.col("modificationTime").alias("mtime"), F.col("length"))
    )


def changed_files(spark: SparkSession, listing: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Files never seen, or seen with another modification time or length (re-written in place)."""
    if manifest is None:
        return listing
    return listing.join(manifest.select("path", "mtime", "length"), ["path", "mtime", "length"], "left_anti")
