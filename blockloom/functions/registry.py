"""The functions by name, for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..constants import ZERO_ADDRESS
from .hashing import _keccak_text
from .numbers import _DECIMAL_TEXT, _HEX64_TEXT, _SEPARATED_TEXT, _word_to_double, _word_to_text

_TRIMMED = "trim(BOTH ' \\t\\n\\r\\u000c\\u000b' FROM x)"


def _number_sql(t: str) -> str:
    def plain(t: str) -> str:
        return (
            f"try_cast(case when startswith({t}, '0x') then "
            f"case when {t} rlike '{_HEX64_TEXT}' then conv(substr({t}, 3), 16, 10) end "
            f"when {t} rlike '{_DECIMAL_TEXT}' then {t} end as bigint)"
        )

    separated = f"case when {t} like '%\\_%' and {t} rlike '{_SEPARATED_TEXT}' then translate({t}, '_', '') end"
    return f"coalesce({plain(t)}, {plain(separated)})"


_BARE = "case when startswith(x, '0x') then substr(x, 3) else x end"

# Inlined by the optimizer, so they cost the same as the Column forms.
SQL_FUNCTIONS = {
    "parse_num": ("BIGINT", _number_sql(_TRIMMED)),
    "uint256_to_address": ("STRING", "concat('0x', substr(x, 27))"),
    "from_uint256_to_address": ("STRING", "concat('0x', substr(x, 27))"),
    "extract_hex_data": ("STRING", _BARE),
    "hex_to_bigint": ("BIGINT", _number_sql(f"concat('0x', {_BARE})")),
    "is_zero_address": ("BOOLEAN", f"lower(x) = '{ZERO_ADDRESS}'"),
}

ARROW_FUNCTIONS = {
    "uint256_to_numeric": _word_to_double,
    "hex_to_numeric": _word_to_text,
    "keccak256_hex": _keccak_text,
}


def register(spark: SparkSession) -> list[str]:
    """Make every function callable from ``spark.sql``; returns their names."""
    for name, (result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {result} RETURN {body}")
    for name, function in ARROW_FUNCTIONS.items():
        spark.udf.register(name, function)
    return sorted([*SQL_FUNCTIONS, *ARROW_FUNCTIONS])
