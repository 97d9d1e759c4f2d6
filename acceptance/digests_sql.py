"""SHA-2 with 64-bit words and FarmHash Fingerprint64 in DuckDB SQL.

DuckDB has neither, so both are spelled out over 128-bit integers, straight from
their published definitions. For the short values of the test tables only: one
SHA block holds messages of up to 111 bytes, and the fingerprint is written for
messages of 17 to 128 bytes.
"""

from __future__ import annotations

from math import isqrt

TWO_64 = "18446744073709551616::UHUGEINT"


def big(value: int) -> str:
    return f"{value}::UHUGEINT"


def wrap(expression: str) -> str:
    return f"(({expression}) % {TWO_64})"


def rotate(value: str, n: int) -> str:
    """Rotated right, within 64 bits."""
    return wrap(f"(({value}) >> {n}) | (({value}) << {64 - n})")


def xor(*values: str) -> str:
    result = values[0]
    for value in values[1:]:
        result = f"xor({result}, {value})"
    return result


def steps(base: str, *assignments: tuple[str, str]) -> str:
    """A query that adds one named column after the other."""
    for name, expression in assignments:
        base = f"SELECT *, {expression} AS {name} FROM ({base})"
    return base


# SHA-384 and SHA-512.


def primes(count: int) -> list[int]:
    found: list[int] = []
    number = 2
    while len(found) < count:
        if all(number % p for p in found):
            found.append(number)
        number += 1
    return found


def cube_root(number: int) -> int:
    low, high = 0, 1 << (number.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= number else (low, middle - 1)
    return low


ROUNDS = [cube_root(p << 192) % 2**64 for p in primes(80)]
ROOTS = [isqrt(p << 128) % 2**64 for p in primes(16)]


def listed(numbers: list[int]) -> str:
    return "[" + ", ".join(big(n) for n in numbers) + "]"


def sha_of_two_word_kind(source: str, words: int, start: list[int]) -> str:
    """Adds ``digest`` to a query with a binary column ``m``."""
    padded = (
        "hex(m) || '80' || repeat('00', 111 - octet_length(m)::INT) || "
        "printf('%032x', 8 * octet_length(m))"
    )
    word = "('0x' || substr(padded, 16 * i - 15, 16))::UHUGEINT"
    small_0 = xor(rotate("w[t - 15]", 1), rotate("w[t - 15]", 8), "w[t - 15] >> 7")
    small_1 = xor(rotate("w[t - 2]", 19), rotate("w[t - 2]", 61), "w[t - 2] >> 6")
    scheduled = wrap(f"{small_1} + w[t - 7] + {small_0} + w[t - 16]")
    large_0 = xor(rotate("s[1]", 28), rotate("s[1]", 34), rotate("s[1]", 39))
    large_1 = xor(rotate("s[5]", 14), rotate("s[5]", 18), rotate("s[5]", 41))
    choice = xor("(s[5] & s[6])", f"(xor(s[5], {big(2**64 - 1)}) & s[7])")
    majority = xor("(s[1] & s[2])", "(s[1] & s[3])", "(s[2] & s[3])")
    first = f"s[8] + {large_1} + {choice} + k[t] + w[t]"
    after = (
        f"[{wrap(f'u + {large_0} + {majority}')}, s[1], s[2], s[3], "
        f"{wrap('s[4] + u')}, s[5], s[6], s[7]]"
    )
    one_round = f"list_transform([{first}], lambda u: {after})[1]"
    digits = " || ".join(
        f"printf('%016x', {wrap(f'final[{i}] + {big(start[i - 1])}')}::UBIGINT)"
        for i in range(1, words + 1)
    )
    return steps(
        source,
        ("padded", padded),
        ("block", f"list_transform(range(1, 17), lambda i: {word})"),
        ("w", f"list_reduce(range(17, 81), lambda w, t: list_append(w, {scheduled}), block)"),
        ("k", listed(ROUNDS)),
        ("final", f"list_reduce(range(1, 81), lambda s, t: {one_round}, {listed(start)})"),
        ("digest", digits),
    )


def sha512(source: str) -> str:
    return sha_of_two_word_kind(source, 8, ROOTS[:8])


def sha384(source: str) -> str:
    return sha_of_two_word_kind(source, 6, ROOTS[8:])


# FarmHash Fingerprint64.

# The multipliers of the published function.
K0 = 0xC3A5C85C97CB3127
K1 = 0xB492B66FBE98F273
K2 = 0x9AE16A3B2F90404F


def load(at: str) -> str:
    """The 64-bit little-endian number at a byte position."""
    digits = " || ".join(f"substr(h, 2 * ({at} + {i}) + 1, 2)" for i in range(7, -1, -1))
    return f"('0x' || {digits})::UHUGEINT"


def add(*values: str) -> str:
    return wrap(" + ".join(f"({v})" for v in values))


def times(left: str, right: str) -> str:
    return wrap(f"({left}) * ({right})")


def shift_mix(value: str) -> str:
    return f"xor({value}, ({value}) >> 47)"


def fold(prefix: str, u: str, v: str) -> list[tuple[str, str]]:
    """Steps that fold two numbers into the column named by the prefix."""
    return [
        (f"{prefix}_v", v),
        (f"{prefix}_p", times(f"xor({u}, {prefix}_v)", "mul")),
        (f"{prefix}_a", shift_mix(f"{prefix}_p")),
        (f"{prefix}_q", times(f"xor({prefix}_v, {prefix}_a)", "mul")),
        (f"{prefix}_b", shift_mix(f"{prefix}_q")),
        (prefix, times(f"{prefix}_b", "mul")),
    ]


def little_endian(value: str) -> str:
    digits = f"printf('%016x', {value}::UBIGINT)"
    return " || ".join(f"substr({digits}, {place}, 2)" for place in range(15, 0, -2))


def fingerprint64_to_32_bytes(source: str) -> str:
    """Adds ``digest`` to a query with a binary column ``m`` of 17 to 32 bytes."""
    return steps(
        source,
        ("h", "hex(m)"),
        ("n", "octet_length(m)"),
        ("mul", add(big(K2), "2 * n::UHUGEINT")),
        ("a", times(load("0"), big(K1))),
        ("b", load("8")),
        ("c", times(load("n - 8"), "mul")),
        ("d", times(load("n - 16"), big(K2))),
        ("u", add(rotate(add("a", "b"), 43), rotate("c", 30), "d")),
        *fold("r", "u", add("a", rotate(add("b", big(K2)), 18), "c")),
        ("digest", little_endian("r")),
    )


def fingerprint64_to_64_bytes(source: str) -> str:
    """Adds ``digest`` to a query with a binary column ``m`` of 33 to 64 bytes."""
    return steps(
        source,
        ("h", "hex(m)"),
        ("n", "octet_length(m)"),
        ("mul", add(big(K2), "2 * n::UHUGEINT")),
        ("a", times(load("0"), big(K2))),
        ("b", load("8")),
        ("c", times(load("n - 8"), "mul")),
        ("d", times(load("n - 16"), big(K2))),
        ("y", add(rotate(add("a", "b"), 43), rotate("c", 30), "d")),
        *fold("z", "y", add("a", rotate(add("b", big(K2)), 18), "c")),
        ("e", times(load("16"), "mul")),
        ("f", load("24")),
        ("g", times(add("y", load("n - 32")), "mul")),
        ("i", times(add("z", load("n - 24")), "mul")),
        ("u", add(rotate(add("e", "f"), 43), rotate("g", 30), "i")),
        *fold("r", "u", add("e", rotate(add("f", "a"), 18), "g")),
        ("digest", little_endian("r")),
    )


def weak(name: str, at: str, a: str, b: str) -> list[tuple[str, str]]:
    """Steps for the columns ``{name}0`` and ``{name}1``."""
    return [
        (f"{name}_a", add(load(at), a)),
        (f"{name}_b", rotate(add(b, f"{name}_a", load(f"{at} + 24")), 21)),
        (f"{name}_c", add(f"{name}_a", load(f"{at} + 8"), load(f"{at} + 16"))),
        (f"{name}0", add(f"{name}_c", load(f"{at} + 24"))),
        (f"{name}1", add(f"{name}_b", rotate(f"{name}_c", 44), f"{name}_a")),
    ]


def fingerprint64_to_128_bytes(source: str) -> str:
    """Adds ``digest`` to a query with a binary column ``m`` of 65 to 128 bytes:
    one block, and the last 64 bytes."""
    seed_y = (81 * K1 + 113) % 2**64
    mixed = (seed_y * K2 + 113) % 2**64
    seed_z = (mixed ^ mixed >> 47) * K2 % 2**64
    return steps(
        source,
        ("h", "hex(m)"),
        ("n", "octet_length(m)"),
        ("x0", add(big(81 * K2 % 2**64), load("0"))),
        ("x1", times(rotate(add("x0", big(seed_y), load("8")), 37), big(K1))),
        ("y1", add(times(rotate(add(big(seed_y), load("48")), 42), big(K1)), load("40"))),
        ("z1", times(rotate(big(seed_z), 33), big(K1))),
        *weak("v", "0", big(0), "x1"),
        *weak("w", "32", "z1", add("y1", load("16"))),
        # x and z change places after each block.
        ("mul", add(big(K1), "(x1 & 255::UHUGEINT) << 1")),
        ("p", "n - 64"),
        ("w2", add("w0", "((n - 1) & 63)::UHUGEINT")),
        ("v2", add("v0", "w2")),
        ("w3", add("w2", "v2")),
        ("x2", times(rotate(add("z1", "y1", "v2", load("p + 8")), 37), "mul")),
        ("x3", f"xor(x2, {times('w1', big(9))})"),
        ("y2", times(rotate(add("y1", "v1", load("p + 48")), 42), "mul")),
        ("y3", add("y2", times("v2", big(9)), load("p + 40"))),
        ("z2", times(rotate(add("x1", "w3"), 33), "mul")),
        *weak("vv", "p", times("v1", "mul"), add("x3", "w3")),
        *weak("ww", "p + 32", add("z2", "w1"), add("y3", load("p + 16"))),
        *fold("f", "vv0", "ww0"),
        *fold("g", "vv1", "ww1"),
        ("left_side", add("f", times(shift_mix("y3"), big(K0)), "x3")),
        *fold("r", "left_side", add("g", "z2")),
        ("digest", little_endian("r")),
    )
