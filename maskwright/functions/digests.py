"""One column expression for each digest of a message, as lower-case hex.

SHA-2 and CRC-32 are built into Spark and stay inside whole-stage codegen. The
other three have no built-in, so they run as Arrow UDFs over whole batches.
The 32- and 64-bit digests are printed least significant byte first.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions import checksums, farmhash

# The UDFs travel to the executors as code, so a cluster needs nothing but
# NumPy and pyarrow on its Python workers.
for _module in (__name__, checksums.__name__, farmhash.__name__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

# The lower hex digit of each of four bytes.
LOW_DIGITS = 0x0F0F0F0F

# Digests of the messages data[start:start + size], as one array of integers.
Digests = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def sha256(message: Column) -> Column:
    return F.sha2(message, 256)


def sha384(message: Column) -> Column:
    return F.sha2(message, 384)


def sha512(message: Column) -> Column:
    return F.sha2(message, 512)


def crc32(message: Column) -> Column:
    value = F.crc32(message)
    # Swapping the two digits of each byte and then the order of all digits
    # reverses the bytes.
    swapped = F.shiftleft(value.bitwiseAND(LOW_DIGITS), 4).bitwiseOR(
        F.shiftright(value, 4).bitwiseAND(LOW_DIGITS)
    )
    return F.lower(F.reverse(F.lpad(F.hex(swapped), 8, "0")))


def adler32_udf(depth: int = 0):
    return _in_batches(_adler32, "<u4", depth)


def crc32c_udf(depth: int = 0):
    return _in_batches(checksums.Crc32c(), "<u4", depth)


def farm_fingerprint64_udf(depth: int = 0):
    return _in_batches(farmhash.fingerprint64, "<u8", depth)


def _in_batches(digests: Digests, word: str, depth: int):
    """An Arrow UDF for messages inside ``depth`` layers of arrays; null for null.

    It takes one array at a time, not an iterator of them: Spark runs all such
    UDFs of a projection in one pass through Python.
    """

    def digest(batch: pa.Array) -> pa.Array:
        return _hex(batch, digests, word)

    return F.arrow_udf(digest, "array<" * depth + "string" + ">" * depth)


_ADLER_PRIME = np.uint64(65521)
# Bytes whose running sums are held at once, and the mean size of messages from which on
# a call for each costs less than running sums.
_ADLER_PORTION, _ADLER_LONG = 1 << 18, 400


def _adler32(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """With running sums of bytes and of bytes times place, any message is two differences."""
    out = np.empty(len(start), np.uint32)
    first, ends = 0, start + size
    while first < len(start):
        last = int(np.searchsorted(ends, start[first] + _ADLER_PORTION, side="right"))
        last = max(last, first + 1)
        if ends[last - 1] - start[first] > _ADLER_LONG * (last - first):
            for i in range(first, last):
                out[i] = zlib.adler32(memoryview(data)[start[i] : ends[i]])
            first = last
            continue
        part = data[start[first] : ends[last - 1]].astype(np.uint64)
        plain = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)])
        placed = part * np.arange(len(part), dtype=np.uint64)
        placed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(placed)])
        a = (start[first:last] - start[first]).astype(np.int64)
        b = (ends[first:last] - start[first]).astype(np.int64)
        total = plain[b] - plain[a]
        # Each byte counts once for itself and once for every byte behind it.
        weighted = b.astype(np.uint64) * total - (placed[b] - placed[a])
        low = (total + np.uint64(1)) % _ADLER_PRIME
        high = (weighted + size[first:last].astype(np.uint64)) % _ADLER_PRIME
        out[first:last] = (high << np.uint64(16) | low).astype(np.uint32)
        first = last
    return out


#: The digests that Spark lacks, for whole arrays of messages, by algorithm.
BATCH_DIGESTS: dict[str, Callable[[pa.Array], pa.Array]] = {
    "hash-adler32": lambda messages: _hex(messages, _adler32, "<u4"),
    "hash-crc32c": lambda messages: _hex(messages, checksums.Crc32c(), "<u4"),
    "hash-farmHashFingerprint64": lambda messages: _hex(messages, farmhash.fingerprint64, "<u8"),
}


def _hex(messages: pa.Array, digests: Digests, word: str) -> pa.Array:
    if pa.types.is_list(messages.type) or pa.types.is_large_list(messages.type):
        sizes = messages.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        inner = _hex(messages.flatten(), digests, word)
        return pa.ListArray.from_arrays(pa.array(bounds), inner, mask=messages.is_null())

    present = messages.drop_null().cast(pa.large_binary())
    if not len(present):
        return pa.nulls(len(messages), pa.string())
    _, offsets, content = present.buffers()
    bounds = np.frombuffer(offsets, "<i8")[present.offset : present.offset + len(present) + 1]
    data = np.frombuffer(content, np.uint8)[bounds[0] : bounds[-1]]
    found = digests(data, bounds[:-1] - bounds[0], np.diff(bounds)).astype(word)

    ends = np.arange(len(found) + 1, dtype=np.int32) * (2 * found.itemsize)
    out = pa.StringArray.from_buffers(
        len(found), pa.py_buffer(ends), pa.py_buffer(found.tobytes().hex().encode())
    )
    if not messages.null_count:
        return out
    valid = messages.is_valid().to_numpy(zero_copy_only=False)
    return out.take(pa.array(np.cumsum(valid) - 1, mask=~valid))
