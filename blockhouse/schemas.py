"""Declared schemas (§1): raw 26/23-column transaction rows, typed historical
rows, warehouse projections, holders, manifests."""
from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DecimalType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


ACCESS_LIST = ArrayType(StructType([
    StructField("address", StringType()), StructField("storageKeys", ArrayType(StringType()))]))

LOG_23 = StructType([
    StructField("contractAddress", StringType()), StructField("transactionHash", StringType()),
    StructField("transactionIndex", LongType()), StructField("blockHash", StringType()),
    StructField("blockNumber", LongType()), StructField("data", StringType()),
    StructField("logIndex", LongType()), StructField("removed", BooleanType()),
    StructField("topics", ArrayType(StringType())),
])

DECODED_LOG = StructType([
    *_s("name", "eventFragment", "signature", "eventHash"),
    StructField("args", ArrayType(StructType(_s("name", "type", "value")))),
])
LOG_26 = StructType([*LOG_23.fields, StructField("decodedLog", DECODED_LOG)])

AUTH_LIST = ArrayType(StructType(_s("chainId", "nonce", "address", "yParity", "r", "s")))

# The columns of a raw transaction in wire order (FIXTURES 1.2, 1.1).
COLUMNS_23 = [
    "transactionHash", "transactionIndex", "blockHash", "blockNumber", "from", "to", "value", "input", "nonce", "gas",
    "gasPrice", "maxFeePerGas", "maxPriorityFeePerGas", "gasUsed", "cumulativeGasUsed", "effectGasPrice", "contractAddress",
    "type", "status", "logsBloom", "timestamp", "accessList", "logs",
]
COLUMNS_26 = [
    "transactionHash", "transactionIndex", "blockHash", "blockNumber", "from", "to", "value", "input", "functionSelector",
    "nonce", "gas", "gasPrice", "maxFeePerGas", "maxPriorityFeePerGas", "gasUsed", "cumulativeGasUsed", "effectGasPrice",
    "contractAddress", "type", "status", "logsBloom", "timestamp", "decodedInput", "accessList", "authorizationList", "logs",
]


def _raw(columns: list[str], **types) -> StructType:
    """Text columns but for those given a type."""
    return StructType([StructField(c, types.get(c, StringType())) for c in columns])


# blockNumber is text in the 23-column form and bigint in the 26-column form.
RAW_23 = _raw(COLUMNS_23, accessList=ACCESS_LIST, logs=ArrayType(LOG_23))
RAW_26 = _raw(COLUMNS_26, blockNumber=LongType(), accessList=ACCESS_LIST, authorizationList=AUTH_LIST, logs=ArrayType(LOG_26))
# An item of a landed page: the 26 columns with the time in epoch seconds and
# decodedInput as whatever JSON value was sent (kept as its text).
PAGE_ITEM = _raw(COLUMNS_26, blockNumber=LongType(), timestamp=LongType(), accessList=ACCESS_LIST, authorizationList=AUTH_LIST,
                 logs=ArrayType(LOG_26))
PAGE = StructType([StructField("items", ArrayType(PAGE_ITEM)), StructField("count", LongType()), *_s("cursor", "nextCursor")])

# PRJ-4 casts: column -> type applied on the 23-column rows.
TYPED_CASTS = {
    "transactionIndex": "int", "blockNumber": "bigint", "nonce": "int", "gas": "bigint",
    "gasPrice": "bigint", "gasUsed": "bigint", "cumulativeGasUsed": "bigint",
}
# PRJ-5: cast only when the file version has the column.
OPTIONAL_CASTS = {"maxFeePerGas": "bigint", "maxPriorityFeePerGas": "bigint", "effectGasPrice": "bigint"}

HOLDERS = StructType([
    *_s("address", "eth_balance", "percentage"), StructField("inserted_at", TimestampNTZType()),
])

# PRJ-1 and PRJ-1c without their hour keys.
WAREHOUSE = StructType([
    StructField("transactionhash", StringType()), StructField("blocknumber", LongType()), *_s("transaction_from", "transaction_to"),
    StructField("value", DecimalType(38, 0)), *_s("transaction_status"), StructField("transaction_timestamp", TimestampNTZType()),
])
REALTIME = StructType([
    StructField("timestamp", TimestampNTZType()), StructField("value", DecimalType(38, 0)), *_s("from", "to"),
    StructField("blockNumber", LongType()), *_s("status"),
])

# Flat text rows of the gzip JSON-lines chunks (SRC-5).
JSONL_TX = StructType(_s("transactionHash", "blockNumber", "transactionIndex", "from", "to",
                         "value", "status", "timestamp"))
