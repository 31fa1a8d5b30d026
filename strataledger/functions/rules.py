"""Quality rules as data: an ordered list of (reason, predicate); the first match names the reason."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from strataledger.schemas import SOURCE_ACCOUNTS, SOURCE_TRANSACTIONS

# Rejection reasons, channels and account states of the data contract.
NULL_REQUIRED_FIELD = "NULL_REQUIRED_FIELD"
INVALID_AMOUNT = "INVALID_AMOUNT"
DUPLICATE_TRANSACTION_ID = "DUPLICATE_TRANSACTION_ID"
INVALID_TRANSACTION_CODE = "INVALID_TRANSACTION_CODE"
INVALID_CHANNEL = "INVALID_CHANNEL"
INVALID_ACCOUNT_STATUS = "INVALID_ACCOUNT_STATUS"
TRANSACTION_REASONS = (
    NULL_REQUIRED_FIELD,
    INVALID_AMOUNT,
    DUPLICATE_TRANSACTION_ID,
    INVALID_TRANSACTION_CODE,
    INVALID_CHANNEL,
)
ACCOUNT_REASONS = (NULL_REQUIRED_FIELD, INVALID_ACCOUNT_STATUS)
CHANNELS = ("ONLINE", "IN_STORE")
ACCOUNT_STATUSES = ("ACTIVE", "SUSPENDED", "CLOSED")

OPTIONAL_TRANSACTION_FIELDS = ("merchant_name",)
OPTIONAL_ACCOUNT_FIELDS = ("customer_name",)


def missing(name: str, schema: StructType) -> Column:
    """Null, or for text also the empty string."""
    value = F.col(name)
    if isinstance(schema[name].dataType, StringType):
        return value.isNull() | (value == "")
    return value.isNull()


def any_missing(schema: StructType, optional: Iterable[str] = ()) -> Column:
    skipped = set(optional)
    found = F.lit(False)
    for name in schema.fieldNames():
        if name not in skipped:
            found = found | missing(name, schema)
    return found


def outside(name: str, domain: Iterable[str]) -> Column:
    return ~F.col(name).isin(*domain)


def first_reason(rules: Iterable[tuple[str, Column]]) -> Column:
    """Reason of the first rule that holds, or null when the row passes all of them."""
    return F.coalesce(*[F.when(holds, F.lit(reason)) for reason, holds in rules])


def transaction_missing() -> Column:
    return any_missing(SOURCE_TRANSACTIONS, OPTIONAL_TRANSACTION_FIELDS)


def account_reason() -> Column:
    return first_reason(
        [
            (NULL_REQUIRED_FIELD, any_missing(SOURCE_ACCOUNTS, OPTIONAL_ACCOUNT_FIELDS)),
            (INVALID_ACCOUNT_STATUS, outside("account_status", ACCOUNT_STATUSES)),
        ]
    )
