"""Keyed table in the session catalog: bucketed Parquet, declared columns, comment and properties.

A merge joins a batch with the table on its key. Batch and table meet bucket by bucket, so only the batch is
shuffled; the table is scanned where it lies. Every merge writes a new generation and then points the view
``name`` at it, so a reader sees one generation whole, and a merge that was cut short is written over by the next.
A merge rewrites the table: it is meant for large batches (a day, a drained log), not for each micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.operators.latest import latest_per_key
from ledgerflow.plans.sink import conform
from ledgerflow.session import SHUFFLE_CLEANUP, Fs, settings

GENERATION, BUCKETS = "ledgerflow.generation", "ledgerflow.buckets"
HIT = "_lf_hit"


def _text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _options(pairs: Iterable[tuple[str, object]]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in pairs)


class BucketedTable:
    """SCD-1 table ``name``, one row per ``keys``: the greatest ``sequence_by``, of ties the later merge.

    ``schema`` is the contract: each batch is conformed to it (columns, order, types), and a NULL key fails the
    merge. ``buckets`` may change from one merge to the next; the merge that changes it shuffles the result once.
    The tables lie under ``root``, a shared folder; the last generation but one stays for readers of it.
    """

    def __init__(
        self, spark: SparkSession, name: str, schema: StructType, keys, sequence_by, root: str,
        buckets: int = 64, comment: str = "", properties: Iterable[tuple[str, str]] = (),
    ):
        self.spark, self.name, self.schema, self.root = spark, name, schema, root.rstrip("/")
        self.keys, self.sequence_by = list(keys), list(sequence_by)
        self.buckets, self.comment, self.properties = int(buckets), comment, tuple(properties)

    def _state(self) -> tuple[int, int] | None:
        """(generation, buckets) of the published table."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        held = dict(self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect())
        return int(held[GENERATION]), int(held[BUCKETS])

    def _table(self, generation: int) -> str:
        return f"{self.name}_g{generation}"

    def _path(self, generation: int) -> str:
        return f"{self.root}/g={generation}"

    def current(self) -> DataFrame:
        return self.spark.table(self.name)

    def merged(self, batch: DataFrame) -> DataFrame:
        """The rows of the table after a merge of ``batch``, lazily; nothing is written."""
        cols = self.schema.names
        rows = latest_per_key(conform(batch, self.schema, self.keys), self.keys, self.sequence_by).select(*cols)
        state = self._state()
        if state is None:
            return self._dealt(rows)
        generation, buckets = state
        base = self.spark.table(self._table(generation))
        # dealt as the buckets are, so the table needs no exchange; hashed per bucket, so it needs no sort either
        new = rows.repartition(buckets, *self.keys).select(*[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias(HIT))
        on = reduce(lambda a, b: a & b, [base[k] == new[f"_n_{k}"] for k in self.keys])
        both = base.join(new.hint("shuffle_hash"), on, "full_outer")
        newer = F.struct(*[F.col(f"_n_{c}") for c in self.sequence_by]) >= F.struct(*[base[c] for c in self.sequence_by])
        take = F.col(HIT).isNotNull() & (base[self.keys[0]].isNull() | newer)
        out = both.select(*[F.when(take, F.col(f"_n_{c}")).otherwise(base[c]).alias(c) for c in cols])
        return out if buckets == self.buckets else self._dealt(out)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Dealt by key to a multiple of the buckets that is at least the session's width: a task's keys have one
        bucket, and a bucket has as many files as tasks."""
        width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(self.buckets * max(1, -(-width // self.buckets)), *self.keys)

    def merge(self, batch: DataFrame) -> int:
        """Merge a batch and publish the result; returns its generation. Merging a batch again changes nothing."""
        state = self._state()
        generation = state[0] + 1 if state else 0
        out, table = self.merged(batch), self._table(generation)
        self._drop(generation)
        self.spark.sql(self._declaration(generation))
        with settings(self.spark, {SHUFFLE_CLEANUP: "true"}):
            out.write.insertInto(table, overwrite=True)
        described = _options([*self.properties, (GENERATION, generation), (BUCKETS, self.buckets)])
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} COMMENT {_text(self.comment)} TBLPROPERTIES ({described}) AS SELECT * FROM {table}"
        )
        self._drop(generation - 2)
        return generation

    def _declaration(self, generation: int) -> str:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        by = ", ".join(f"`{k}`" for k in self.keys)
        described = f" TBLPROPERTIES ({_options(self.properties)})" if self.properties else ""
        return (
            f"CREATE TABLE {self._table(generation)} ({columns}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS "
            f"LOCATION {_text(self._path(generation))} COMMENT {_text(self.comment)}{described}"
        )

    def _drop(self, generation: int) -> None:
        if generation >= 0:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(generation)}")
            Fs(self.spark).delete(self._path(generation))

    def declared(self) -> tuple[StructType, str, dict[str, str]]:
        """Columns, comment and properties of the published generation, as the catalog holds them."""
        table = self._table(self._state()[0])
        comment = self.spark.catalog.getTable(table).description or ""
        return self.spark.table(table).schema, comment, dict(self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect())
