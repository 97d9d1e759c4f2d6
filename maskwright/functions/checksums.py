"""CRC-32C of a whole Arrow batch at once, as NumPy array arithmetic.

A CRC register is linear over XOR. So each message is cut into blocks counted
from its end, every block gets its own remainder by table look-up, and
neighbouring remainders are then merged pairwise: the earlier one is moved past
the bytes that follow it and XORed in. A pass covers all blocks of all messages,
and the number of passes grows with the logarithm of the longest message.
"""

from __future__ import annotations

import numpy as np

# Fixed value: the Castagnoli polynomial, bit-reflected.
POLYNOMIAL = 0x82F63B78

# Bytes of a block, and about how many bytes to work on at a time: little enough
# to stay in the processor's cache.
BLOCK = 32
PORTION = 1 << 20


class Crc32c:
    """Checksums of batches. Look-up tables are made when first needed and kept."""

    def __init__(self) -> None:
        register = np.left_shift(np.uint32(1), np.arange(32, dtype=np.uint32))
        for _ in range(8):
            odd = register & np.uint32(1)
            register = (register >> np.uint32(1)) ^ odd * np.uint32(POLYNOMIAL)
        # _bits[k] and _tables[k] move a register past 2**k zero bytes.
        self._bits = [register]
        self._tables: list[tuple[np.ndarray, np.ndarray]] = []

    def _table(self, power: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self._tables) <= power:
            self._tables.append(_half_tables(self._bits[-1]))
            self._bits.append(_look_up(self._tables[-1], self._bits[-1]))
        return self._tables[power]

    def _advance(self, register: np.ndarray, power: int) -> np.ndarray:
        return _look_up(self._table(power), register)

    def __call__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Checksums of ``data[start:start + size]``; every size is at least 4."""
        found = []
        for first, end in _portions(start):
            begin, stop = start[first], start[end - 1] + size[end - 1]
            found.append(
                self._together(data[begin:stop], start[first:end] - begin, size[first:end])
            )
        return np.concatenate(found) if found else np.zeros(0, np.uint32)

    def _together(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        # A block of zeros in front keeps the first block of the first message in range.
        padded = np.concatenate([np.zeros(BLOCK, np.uint8), data])
        start = start + BLOCK
        # A register that begins as all ones equals one that begins as zero
        # over a message whose first four bytes are inverted.
        padded[start[:, None] + np.arange(4)] ^= np.uint8(0xFF)

        count = (size + BLOCK - 1) // BLOCK
        rank = _ranks(count)
        at = np.repeat(start + size, count) - BLOCK * (rank + 1)
        words = np.ndarray((len(padded) - BLOCK + 1, 4), "<u8", padded, strides=(1, 8))[at]
        first = np.cumsum(count) - 1
        words[first] &= _own_bytes(start - at[first])

        halves = words.view("<u2").reshape(-1, 4, 4)
        tables = [*self._table(3), *self._table(2)]
        part = tables[0][halves[..., 0]]
        for place in (1, 2, 3):
            part ^= tables[place][halves[..., place]]
        part = self._advance(part[:, 0::2], 3) ^ part[:, 1::2]
        part = self._advance(part[:, 0], 4) ^ part[:, 1]
        power = 5
        while len(part) > len(size):
            even = rank % 2 == 0
            place = np.cumsum(even) - 1
            merged = part[even]
            merged[place[~even]] ^= self._advance(part[~even], power)
            part, count, power = merged, (count + 1) // 2, power + 1
            rank = _ranks(count)
        return part ^ np.uint32(0xFFFFFFFF)


def _portions(start: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of messages that begin in the same portion of the data."""
    begins = np.flatnonzero(np.diff(start // PORTION, prepend=-1))
    return list(zip(begins.tolist(), [*begins[1:].tolist(), len(start)]))


def _own_bytes(foreign: np.ndarray) -> np.ndarray:
    """Masks for the four words of a block that begins ``foreign`` bytes too early."""
    bits = 8 * np.clip(foreign[:, None] - np.arange(0, BLOCK, 8), 0, 8).astype(np.uint64)
    whole = ~np.uint64(0)
    return np.where(bits < 64, whole << np.minimum(bits, np.uint64(63)), np.uint64(0))


def _half_tables(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Images of every 16-bit lower and upper half, from the images of single bits."""
    halves = []
    for half in (bits[:16], bits[16:]):
        table = np.zeros(1, np.uint32)
        for bit in half:
            table = np.concatenate([table, table ^ bit])
        halves.append(table)
    return halves[0], halves[1]


def _look_up(tables: tuple[np.ndarray, np.ndarray], register: np.ndarray) -> np.ndarray:
    lower, upper = tables
    halves = np.ascontiguousarray(register).view("<u2").reshape(*register.shape, 2)
    return lower[halves[..., 0]] ^ upper[halves[..., 1]]


def _ranks(count: np.ndarray) -> np.ndarray:
    """0..count-1 for each message, one after the other."""
    total = np.cumsum(count)
    return np.arange(total[-1]) - np.repeat(total - count, count)
