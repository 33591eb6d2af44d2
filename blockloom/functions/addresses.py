"""Addresses and hashes as lowercase ``0x`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ZERO_ADDRESS


def uint256_to_address(word: Column) -> Column:
    """Last 20 bytes of a 32-byte word; short input leaves just ``0x``."""
    return F.concat(F.lit("0x"), F.substr(word, F.lit(27)))


def is_zero_address(address: Column) -> Column:
    """True for the address tokens are minted from and burned to."""
    return F.lower(address) == F.lit(ZERO_ADDRESS)


def lower_address(address: Column) -> Column:
    return F.lower(address)


def with_0x(text: Column) -> Column:
    """Hash with its ``0x`` prefix, added only if missing."""
    return F.when(text.startswith("0x"), text).otherwise(F.concat(F.lit("0x"), text))
