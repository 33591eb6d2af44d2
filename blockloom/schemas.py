"""Column types of landed API payloads and of the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# ``result`` is a list on success and a plain text on error, so it stays text.
ENVELOPE = T.StructType(
    _strings("status", "message", "result")
    + [
        T.StructField("address", T.StringType()),
        T.StructField("chain", T.StringType()),
        T.StructField("from_block", T.LongType()),
        T.StructField("to_block", T.LongType()),
        T.StructField("page", T.LongType()),
        T.StructField("page_rows", T.LongType()),
    ]
)

RAW_LOG = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        *_strings(
            "data",
            "blockNumber",
            "blockHash",
            "timeStamp",
            "gasPrice",
            "gasUsed",
            "logIndex",
            "transactionHash",
            "transactionIndex",
        ),
    ]
)

RAW_TRANSACTION = T.StructType(
    _strings(
        "blockNumber",
        "timeStamp",
        "hash",
        "nonce",
        "blockHash",
        "transactionIndex",
        "from",
        "to",
        "value",
        "gas",
        "gasPrice",
        "gasUsed",
        "cumulativeGasUsed",
        "confirmations",
        "contractAddress",
        "input",
        "methodId",
        "functionName",
        "isError",
        "txreceipt_status",
    )
)

RECEIPT_LOG = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        *_strings(
            "data",
            "blockNumber",
            "blockHash",
            "transactionHash",
            "transactionIndex",
            "logIndex",
        ),
        T.StructField("removed", T.BooleanType()),
    ]
)

RECEIPT = T.StructType(
    _strings(
        "transactionHash",
        "transactionIndex",
        "blockHash",
        "blockNumber",
        "from",
        "to",
        "contractAddress",
        "cumulativeGasUsed",
        "gasUsed",
        "effectiveGasPrice",
        "status",
        "type",
    )
    + [T.StructField("logs", T.ArrayType(RECEIPT_LOG))]
)

CREATION = T.StructType(
    _strings("contractAddress", "contractCreator", "txHash", "blockNumber", "timestamp")
)

SOURCE_CODE = T.StructType(_strings("ContractName", "Proxy", "Implementation"))

# camelCase landing name -> table name.
SNAKE_CASE = {
    "blockNumber": "block_number",
    "blockHash": "block_hash",
    "timeStamp": "time_stamp",
    "gasPrice": "gas_price",
    "gasUsed": "gas_used",
    "logIndex": "log_index",
    "transactionHash": "transaction_hash",
    "transactionIndex": "transaction_index",
    "cumulativeGasUsed": "cumulative_gas_used",
    "contractAddress": "created_address",
    "methodId": "method_id",
    "functionName": "function_name",
    "isError": "is_error",
    "from": "from_address",
    "to": "to_address",
}

LOG_KEY = ("chainid", "transaction_hash", "log_index")
TRANSACTION_KEY = ("chainid", "hash")

# Table column lists, in order.
LOG_COLUMNS = (
    "chainid",
    "address",
    "topics",
    "data",
    "block_number",
    "block_hash",
    "time_stamp",
    "gas_price",
    "gas_used",
    "log_index",
    "transaction_hash",
    "transaction_index",
)
TRANSACTION_COLUMNS = (
    "chainid",
    "hash",
    "block_number",
    "from_address",
    "to_address",
    "value",
    "gas_price",
    "gas_used",
    "input",
    "time_stamp",
)

# Columns each table declares to its readers, and those that must be filled.
DECLARED = {
    "logs": LOG_COLUMNS,
    "transactions": TRANSACTION_COLUMNS,
    "decoded_logs": (
        "chainid",
        "address",
        "block_number",
        "transaction_hash",
        "log_index",
        "event_name",
        "event_signature",
        "decoded_data",
    ),
    "erc20_transfer": (
        "chainid",
        "token_address",
        "from_address",
        "to_address",
        "amount_hex",
        "block_number",
        "datetime",
        "transaction_hash",
        "log_index",
    ),
}
REQUIRED = {
    "logs": ("chainid", "address", "topics", "block_number", "transaction_hash"),
    "decoded_logs": ("chainid", "address", "block_number", "transaction_hash"),
    "erc20_transfer": (
        "chainid",
        "token_address",
        "from_address",
        "to_address",
        "block_number",
        "datetime",
        "transaction_hash",
    ),
}


def abi_entry(depth: int) -> T.StructType:
    """One ABI entry; tuple members nest ``depth`` levels, deeper ones stay text."""
    members: T.DataType = T.StringType()
    for _ in range(depth):
        members = T.ArrayType(
            T.StructType(
                _strings("name", "type")
                + [T.StructField("indexed", T.BooleanType()), T.StructField("components", members)]
            )
        )
    return T.StructType(
        _strings("type", "name") + [T.StructField("anonymous", T.BooleanType()), T.StructField("inputs", members)]
    )
