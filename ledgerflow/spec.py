"""Table specifications: the whole contract of one landing → bronze → silver flow.

A :class:`TableSpec` is plain data. Every operator takes the pieces it needs from
it (paths to flatten, casts, rules, key, sequence), so the same functions run any
document-shaped feed, not only the transactions one defined here.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

ITEM_POS = "item_pos"
SOURCE_FILE = "source_file"
INGESTION_TS = "ingestion_ts"
INGESTION_DATE = "ingestion_date"
RESCUED = "_rescued_data"


@dataclass(frozen=True)
class TableSpec:
    """Contract of one feed.

    ``fields`` maps a dotted path inside one array item to a bronze column, in
    bronze column order. ``date_columns`` are cast to DATE in bronze (NULL when
    unparsable) and ``month_columns`` derive ``yyyy-MM`` text from such a date.
    ``casts`` are applied in silver with ``try_cast``. ``rules`` are named SQL
    predicates; a row fails a rule when the predicate is false *or NULL*.
    """

    name: str
    read_schema: StructType
    items: str
    fields: tuple[tuple[str, str], ...]
    date_columns: tuple[str, ...] = ()
    month_columns: tuple[tuple[str, str], ...] = ()
    casts: tuple[tuple[str, DataType], ...] = ()
    rules: tuple[tuple[str, str], ...] = ()
    keys: tuple[str, ...] = ()
    sequence_by: tuple[str, ...] = (INGESTION_TS, SOURCE_FILE, ITEM_POS)
    quarantine_exclude: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    silver_cluster_by: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    comment: str = ""
    properties: tuple[tuple[str, str], ...] = ()
    ignore_unknown: tuple[str, ...] = ()

    @property
    def business_columns(self) -> list[str]:
        return [c for _, c in self.fields]

    @property
    def bronze_columns(self) -> list[str]:
        return (
            self.business_columns
            + [SOURCE_FILE, INGESTION_TS, INGESTION_DATE, RESCUED]
            + [m for m, _ in self.month_columns]
            + [ITEM_POS]
        )

    @property
    def silver_columns(self) -> list[str]:
        """Silver keeps the bronze columns except the internal item position."""
        return [c for c in self.bronze_columns if c != ITEM_POS]

    @property
    def rule_map(self) -> dict[str, str]:
        return dict(self.rules)

    @property
    def cast_map(self) -> dict[str, DataType]:
        return dict(self.casts)

    def with_rules(self, rules: dict[str, str]) -> "TableSpec":
        return replace(self, rules=tuple(rules.items()))

    def with_(self, **changes) -> "TableSpec":
        return replace(self, **changes)

    def bronze_schema(self) -> StructType:
        """Types of the bronze table in column order."""
        out = []
        for c in self.bronze_columns:
            if c in self.date_columns or c == INGESTION_DATE:
                t = DateType()
            elif c == INGESTION_TS:
                t = TimestampType()
            elif c == ITEM_POS:
                t = IntegerType()
            else:
                t = StringType()
            out.append(StructField(c, t, True))
        return StructType(out)

    def silver_schema(self) -> StructType:
        casts = self.cast_map
        out = []
        for f in self.bronze_schema().fields:
            if f.name == ITEM_POS:
                continue
            out.append(StructField(f.name, casts.get(f.name, f.dataType), f.name not in self.not_null))
        return StructType(out)

    def flow_schema(self) -> StructType:
        """The silver contract plus the sequence columns that silver itself does not keep (the item position)."""
        silver = self.silver_schema()
        extra = [f for f in self.bronze_schema().fields if f.name in self.sequence_by and f.name not in silver.names]
        return StructType([*silver.fields, *extra])


def _money() -> StructType:
    return StructType([StructField("amount", StringType()), StructField("currency", StringType())])


# The transactions payload and its bronze/silver contract.
# Item fields of the landing document, in payload order, with their types.
TRANSACTION_ITEM_FIELDS = [
    ("clientId", "string"),
    ("investimentId", "string"),
    ("transactionId", "string"),
    ("type", "string"),
    ("transactionType", "string"),
    ("transactionTypeAdditionalInfo", "string"),
    ("transactionConversionDate", "string"),
    ("transactionQuotaPrice", "money"),
    ("transactionQuotaQuantity", "string"),
    ("transactionValue", "money"),
    ("transactionGrossValue", "money"),
    ("incomeTax", "money"),
    ("financialTransactionTax", "money"),
    ("transactionExitFee", "money"),
    ("transactionNetValue", "money"),
]
# Payload path → bronze column, in bronze column order.
TRANSACTION_COLUMNS = [
    ("clientId", "client_id"),
    ("investimentId", "investiment_id"),
    ("transactionId", "transaction_id"),
    ("type", "type"),
    ("transactionType", "transaction_type"),
    ("transactionTypeAdditionalInfo", "transaction_type_additional_info"),
    ("transactionConversionDate", "transaction_conversion_date"),
    ("transactionQuotaPrice.amount", "transaction_quota_price_amount"),
    ("transactionQuotaPrice.currency", "transaction_quota_price_currency"),
    ("transactionQuotaQuantity", "transaction_quota_quantity"),
    ("transactionValue.amount", "transaction_value_amount"),
    ("transactionValue.currency", "transaction_value_currency"),
    ("transactionGrossValue.amount", "transaction_gross_value_amount"),
    ("transactionGrossValue.currency", "transaction_gross_value_currency"),
    ("incomeTax.amount", "income_tax_amount"),
    ("incomeTax.currency", "income_tax_currency"),
    ("financialTransactionTax.amount", "financial_transaction_tax_amount"),
    ("financialTransactionTax.currency", "financial_transaction_tax_currency"),
    ("transactionExitFee.amount", "transaction_exit_fee_amount"),
    ("transactionExitFee.currency", "transaction_exit_fee_currency"),
    ("transactionNetValue.amount", "transaction_net_value_amount"),
    ("transactionNetValue.currency", "transaction_net_value_currency"),
]
TRANSACTION_DECIMAL_COLUMNS = [
    "transaction_quota_price_amount",
    "transaction_quota_quantity",
    "transaction_value_amount",
    "transaction_gross_value_amount",
    "income_tax_amount",
    "financial_transaction_tax_amount",
    "transaction_exit_fee_amount",
    "transaction_net_value_amount",
]
TRANSACTION_RULES = {
    "valid_business_key": (
        "transaction_id IS NOT NULL AND transaction_id != '' "
        "AND client_id IS NOT NULL AND client_id != ''"
    )
}
TRANSACTION_KEYS = ("client_id", "transaction_id")
TRANSACTION_QUARANTINE_EXCLUDE = ("ingestion_ts", "ingestion_date", "_rescued_data", "transaction_conversion_month")
TRANSACTION_META_FIELDS = ["requestDateTime"]


def transaction_item_schema() -> StructType:
    return StructType(
        [StructField(n, _money() if t == "money" else StringType(), True) for n, t in TRANSACTION_ITEM_FIELDS]
    )


def transactions_read_schema() -> StructType:
    """Schema-on-read of one landing document (only ``data`` and ``meta`` are known)."""
    return StructType(
        [
            StructField("data", ArrayType(transaction_item_schema()), True),
            StructField("meta", StructType([StructField(f, StringType()) for f in TRANSACTION_META_FIELDS]), True),
        ]
    )


def transactions_spec(decimal: DecimalType = DecimalType(20, 2)) -> TableSpec:
    return TableSpec(
        name="transactions_current",
        read_schema=transactions_read_schema(),
        items="data",
        fields=tuple(TRANSACTION_COLUMNS),
        date_columns=("transaction_conversion_date",),
        month_columns=(("transaction_conversion_month", "transaction_conversion_date"),),
        casts=tuple((c, decimal) for c in TRANSACTION_DECIMAL_COLUMNS),
        rules=tuple(TRANSACTION_RULES.items()),
        keys=TRANSACTION_KEYS,
        sequence_by=(INGESTION_TS, SOURCE_FILE, ITEM_POS),
        quarantine_exclude=TRANSACTION_QUARANTINE_EXCLUDE + (ITEM_POS,),
        cluster_by=("transaction_conversion_month", "client_id"),
        silver_cluster_by=("transaction_conversion_month",),
        not_null=TRANSACTION_KEYS,
        comment="transactions current",
        properties=(("quality", "bronze"),),
    )
