"""Keccak-256 of event signatures.

Spark has SHA-3 but not the earlier Keccak padding that chains use. The
permutation below follows the published specification and runs on whole
Arrow batches, one lane of all messages at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RATE = 136


def _round_constants() -> list[np.uint64]:
    """The specification's 8-bit shift register, seven steps per round."""
    register, constants = 1, []
    for _ in range(24):
        constant = 0
        for power in range(7):
            if register & 1:
                constant |= 1 << ((1 << power) - 1)
            register <<= 1
            if register & 0x100:
                register ^= 0x171
        constants.append(np.uint64(constant))
    return constants


def _rotations() -> dict[tuple[int, int], int]:
    """Lane rotations: triangular numbers along the (x, y) -> (y, 2x+3y) walk."""
    offsets, x, y = {(0, 0): 0}, 1, 0
    for step in range(24):
        offsets[x, y] = (step + 1) * (step + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    return offsets


_CONSTANTS = _round_constants()
_ROTATIONS = _rotations()


def _rotate(lane: np.ndarray, bits: int) -> np.ndarray:
    if bits == 0:
        return lane
    return (lane << np.uint64(bits)) | (lane >> np.uint64(64 - bits))


def _permute(state: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], np.ndarray]:
    for constant in _CONSTANTS:
        parity = [np.bitwise_xor.reduce([state[x, y] for y in range(5)]) for x in range(5)]
        moved = {}
        for (x, y), lane in state.items():
            mixed = lane ^ parity[(x - 1) % 5] ^ _rotate(parity[(x + 1) % 5], 1)
            moved[y, (2 * x + 3 * y) % 5] = _rotate(mixed, _ROTATIONS[x, y])
        state = {
            (x, y): moved[x, y] ^ (~moved[(x + 1) % 5, y] & moved[(x + 2) % 5, y]) for x, y in moved
        }
        state[0, 0] = state[0, 0] ^ constant
    return state


def keccak256(messages: list[bytes]) -> list[str]:
    """Hex digests of a batch, messages of equal block count together."""
    by_blocks: dict[int, list[int]] = {}
    for position, message in enumerate(messages):
        by_blocks.setdefault(len(message) // _RATE + 1, []).append(position)
    digests = [""] * len(messages)
    for blocks, positions in by_blocks.items():
        padded = np.zeros((len(positions), blocks * _RATE), dtype=np.uint8)
        for row, position in enumerate(positions):
            message = messages[position]
            padded[row, : len(message)] = np.frombuffer(message, dtype=np.uint8)
            padded[row, len(message)] ^= 0x01
        padded[:, -1] ^= 0x80
        words = padded.view("<u8")
        zero = np.zeros(len(positions), dtype=np.uint64)
        state = {(x, y): zero for x in range(5) for y in range(5)}
        for block in range(blocks):
            for lane in range(_RATE // 8):
                at = lane % 5, lane // 5
                state[at] = state[at] ^ words[:, block * (_RATE // 8) + lane]
            state = _permute(state)
        out = np.stack([state[x, 0] for x in range(4)], axis=1).astype("<u8")
        for row, position in enumerate(positions):
            digests[position] = "0x" + out[row].tobytes().hex()
    return digests


@F.arrow_udf(T.StringType())
def _keccak_text(texts: pa.Array) -> pa.Array:
    coded = texts.dictionary_encode()
    digests = keccak256([text.encode() for text in coded.dictionary.to_pylist()])
    return pa.array(digests, type=pa.string()).take(coded.indices)


def keccak256_hex(text: Column) -> Column:
    """``0x`` hex Keccak-256 of UTF-8 text, once per distinct text of a batch."""
    return _keccak_text(text)
