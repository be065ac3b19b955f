"""Document → bronze rows: audit columns, outer explode of the item array, flat projection.

The plan is map-only (no shuffle): one input document yields one row per item,
and a document whose item array is NULL, empty or unreadable still yields one
all-NULL trace row that carries its ``source_file``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.functions.dates import month_text
from ledgerflow.operators.casts import safe_date
from ledgerflow.sources.landing import as_declared, differs_from, entry, json_text, last_wins, let, no_entries, text_map, unknown_members
from ledgerflow.spec import INGESTION_DATE, INGESTION_TS, ITEM_POS, RESCUED, SOURCE_FILE, TableSpec


def with_audit(docs: DataFrame) -> DataFrame:
    """``ingestion_ts`` (one value per micro-batch) and ``ingestion_date`` derived from it."""
    return docs.withColumns({INGESTION_TS: F.current_timestamp()}).withColumns(
        {INGESTION_DATE: F.to_date(F.col(INGESTION_TS))}
    )


def explode_items(df: DataFrame, array_col: str, item: str = "_item", pos: str = ITEM_POS) -> DataFrame:
    """``posexplode_outer``: one row per element with its position; NULL/empty keeps one NULL row."""
    others = [c for c in df.columns if c != array_col]
    return df.select(*others, F.posexplode_outer(array_col).alias(pos, item))


def item_path(item: Column, path: str) -> Column:
    """Dotted path inside a typed item."""
    for part in path.split("."):
        item = item.getField(part)
    return item


def project_paths(item: Column, fields: list[tuple[str, str]] | tuple, get=item_path) -> list[Column]:
    """Dotted item paths → flat aliased columns."""
    return [get(item, path).alias(name) for path, name in fields]


def bronze_frame(docs: DataFrame, spec: TableSpec, audit: bool = True) -> DataFrame:
    """Per-document frame from :mod:`ledgerflow.sources.landing` → bronze rows in spec order.

    Dates are cast with ``try_cast`` so a bad value becomes NULL (and its month
    with it) instead of failing the batch; amounts stay text.
    """
    if audit:
        docs = with_audit(docs)
    if "_raw_items" not in docs.columns:
        # fast path: explode the typed array directly (stays in whole-stage codegen)
        exploded = docs.select(
            SOURCE_FILE, INGESTION_TS, INGESTION_DATE, F.posexplode_outer(spec.items).alias(ITEM_POS, "_item")
        )
        item = F.col("_item")
        rescued, get = F.lit(None).cast("string"), item_path
    else:
        exploded, item, rescued, get = _explode_rescued(docs, spec)
    cols = project_paths(item, spec.fields, get)
    path_of = {c: p for p, c in spec.fields}
    by_name = {c: col for c, col in zip(spec.business_columns, cols)}
    for d in spec.date_columns:
        by_name[d] = safe_date(get(item, path_of[d])).alias(d)
    select = [by_name[c] for c in spec.business_columns]
    select += [F.col(SOURCE_FILE), F.col(INGESTION_TS), F.col(INGESTION_DATE), rescued.alias(RESCUED)]
    for month_col, date_col in spec.month_columns:
        select.append(month_text(safe_date(get(item, path_of[date_col]))).alias(month_col))
    select.append(F.col(ITEM_POS))
    return exploded.select(*select)


def _explode_rescued(docs: DataFrame, spec: TableSpec):
    """Rescue path: explode the items (maps of texts) and build ``_rescued_data``.

    Unknown item fields come first, then those of the document (repeated on each of its rows), then the
    file. A name taken by an earlier one of these is written ``$.name``, so nothing is lost to a clash. An item
    whose key sets agree with the schema's takes the document's text as it is.
    """
    rows = docs.select(
        SOURCE_FILE, INGESTION_TS, INGESTION_DATE, "_doc_unknown", "_doc_json", F.posexplode_outer("_raw_items").alias(ITEM_POS, "_one")
    ).select(SOURCE_FILE, INGESTION_TS, INGESTION_DATE, "_doc_unknown", "_doc_json", ITEM_POS, F.col("_one.typed").alias("_item"), F.col("_one.all").alias("_m0"))
    # one map per object of the item schema, outer ones first: path → column
    maps, levels, known = {"": "_m0"}, [("", spec.read_schema[spec.items].dataType.elementType)], {}
    for path, schema in levels:
        known[path] = [f.name for f in schema.fields]
        subs = {f"{path}.{f.name}" if path else f.name: f for f in schema.fields if isinstance(f.dataType, StructType)}
        for inner, f in subs.items():
            maps[inner] = f"_m{len(maps)}"
            levels.append((inner, f.dataType))
        # objects inside the item come typed with it, deeper ones are text of the object around them
        rows = rows.withColumns({maps[inner]: text_map(F.col(maps[path])[f.name]) if path else F.col("_item").getField(f.name) for inner, f in subs.items()})

    read: dict[str, tuple[Column, Column]] = {}  # of each map, made once: whether its keys are as declared, its last members

    def get(_: Column, path: str) -> Column:
        outer, _, name = path.rpartition(".")
        if not outer:
            return F.col("_item").getField(name)
        m = F.col(maps[outer])
        if outer not in read:
            read[outer] = as_declared(m, known[outer]), last_wins(m)
        declared, winners = read[outer]
        return F.when(declared, m[name]).otherwise(winners[name])

    differs, own = F.lit(False), []
    for path, schema in levels:
        m, prefix = F.col(maps[path]), f"{path}." if path else ""
        names = known[path] + (list(spec.ignore_unknown) if not path else [])
        differs = differs | differs_from(m, names)
        own.append(unknown_members(m, names, prefix))
        for f in schema.fields:
            if isinstance(f.dataType, StructType):  # another kind of value than the object it should be
                misfit = F.col(maps[f"{prefix}{f.name}"]).isNull() & m[f.name].isNotNull()
                differs = differs | F.coalesce(misfit, F.lit(False))
                own.append(F.when(misfit, F.array(entry(F.lit(f"{prefix}{f.name}"), m[f.name]))))
    found = F.when(differs, F.concat(*[F.coalesce(p, no_entries()) for p in own]))
    file_path = F.lit("_file_path")

    def renamed(e, clash):
        return entry(F.when(clash, F.concat(F.lit("$."), e["key"])).otherwise(e["key"]), e["value"])

    def merged(own: Column) -> Column:
        names = F.array_append(F.transform(own, lambda e: e["key"]), file_path)
        return F.concat(
            F.transform(own, lambda e: renamed(e, e["key"] == file_path)),
            F.transform("_doc_unknown", lambda e: renamed(e, F.array_contains(names, e["key"]))),
            F.array(entry(file_path, F.col(SOURCE_FILE))),
        )

    rescued = let(found, lambda own: F.when(own.isNull(), F.col("_doc_json")).otherwise(json_text(merged(own))))
    return rows, F.col("_item"), rescued, get
