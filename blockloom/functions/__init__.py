"""Column functions: text to number, address, time, JSON, event hashing."""

from .addresses import is_zero_address, lower_address, uint256_to_address, with_0x
from .hashing import keccak256_hex
from .nested import (
    first_value,
    json_array,
    json_map,
    json_objects,
    json_objects_by_key,
    lookup,
    once,
    topic_at,
    whole_number,
    without_keys,
)
from .numbers import (
    extract_hex_data,
    hex_to_bigint,
    hex_to_decimal,
    hex_to_numeric,
    parse_number,
    parse_wide_number,
    uint256_to_double,
)
from .registry import register
from .times import as_datetime, epoch_datetime

__all__ = [
    "as_datetime",
    "epoch_datetime",
    "extract_hex_data",
    "first_value",
    "hex_to_bigint",
    "hex_to_decimal",
    "hex_to_numeric",
    "is_zero_address",
    "json_array",
    "json_map",
    "json_objects",
    "json_objects_by_key",
    "keccak256_hex",
    "lookup",
    "lower_address",
    "once",
    "parse_number",
    "parse_wide_number",
    "register",
    "topic_at",
    "uint256_to_address",
    "uint256_to_double",
    "whole_number",
    "with_0x",
    "without_keys",
]
