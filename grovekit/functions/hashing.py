"""Repeatable draws from md5.

``rand()`` depends on partition layout, so a retried task can draw other
numbers.  These draws depend only on their key and are the same on any
cluster, after any retry, and in any SQL engine with md5.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 12  # 48 bits: exact in a double and in a bigint


def digest(seed: int | str, *parts: Column) -> Column:
    """md5 hex of ``seed|part|part…``; its order is a seeded shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def digest_of(seed: int | str, *parts: int | str) -> str:
    """The same digest of values at the driver."""
    return hashlib.md5("|".join(map(str, (seed, *parts))).encode()).hexdigest()


def draw(seed: int | str, *parts: Column) -> Column:
    """Uniform integer in [0, 16**12)."""
    return F.conv(F.substring(digest(seed, *parts), 1, HEX_DIGITS), 16, 10).cast("bigint")


def uniform(seed: int | str, *parts: Column) -> Column:
    """Uniform double in [0, 1)."""
    return draw(seed, *parts) / F.lit(float(16**HEX_DIGITS))


def gaussian(seed: int | str, *parts: Column) -> Column:
    """Standard normal by the Box-Muller transform of two uniform draws."""
    u1 = (draw(f"{seed}a", *parts) + 1) / F.lit(float(16**HEX_DIGITS))
    u2 = uniform(f"{seed}b", *parts)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def md5_modulo(text: Column, modulo: int) -> Column:
    """The 128-bit value of md5(text) modulo 2 or 5, without big integers.

    16**8 leaves remainder 1 for 5 and 0 for 2, so four 32-bit chunks suffice
    for 5 and the last chunk for 2.
    """
    h = F.md5(text)
    chunk = [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    if modulo == 2:
        return chunk[3] % 2
    if modulo == 5:
        return (chunk[0] + chunk[1] + chunk[2] + chunk[3]) % 5
    raise ValueError("modulo must be 2 or 5")


def spread_keys(n: int) -> list[int]:
    """``n`` integers that Spark's hash partitioning into ``n`` partitions deals out one to each, in order."""
    found: dict[int, int] = {}
    key = 0
    while len(found) < n:
        found.setdefault(_murmur(key) % n, key)
        key += 1
    return [found[i] for i in range(n)]


def _murmur(key: int) -> int:
    """Spark's hash of one integer."""
    def turned(x: int, by: int) -> int:
        return (x << by | x >> 32 - by) & 0xFFFFFFFF

    h = turned(42 ^ turned(key * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF, 13)
    h = (h * 5 + 0xE6546B64 & 0xFFFFFFFF) ^ 4
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


_TURNS = np.repeat([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], 4, axis=0).ravel().tolist()
_SINES = [int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def md5_heads(prefix: bytes, numbers: np.ndarray) -> np.ndarray:
    """The first eight bytes, as whole numbers, of the md5 of ``prefix`` and each number, not negative and written out.

    All numbers of as many digits are hashed together, round by round; texts that fill more than a block one by one.
    """
    out = np.empty(len(numbers), np.uint64)
    done, digits = np.zeros(len(numbers), bool), 1
    while not done.all():
        at = np.flatnonzero(~done & (numbers < 10**digits)) if digits < 19 else np.flatnonzero(~done)
        done[at] = True
        if digits < 19 and len(prefix) + digits <= 55:
            if len(at):
                out[at] = _block_heads(prefix, numbers[at].astype(np.uint64), digits)
        else:
            heads = [hashlib.md5(prefix + b"%d" % i, usedforsecurity=False).digest()[:8] for i in numbers[at].tolist()]
            out[at] = np.frombuffer(b"".join(heads), ">u8")
        digits += 1
    return out


def _block_heads(prefix: bytes, numbers: np.ndarray, digits: int) -> np.ndarray:
    """``md5_heads`` of numbers of one length, in texts of one block."""
    size, u = len(prefix) + digits, np.uint32
    fixed = prefix + bytes(digits) + b"\x80" + bytes(55 - size) + (8 * size).to_bytes(8, "little")
    words: list = [int.from_bytes(fixed[i : i + 4], "little") for i in range(0, 64, 4)]
    if digits < 10:
        numbers = numbers.astype(u)
    for place in range(digits):
        at = len(prefix) + place
        digit = (numbers // numbers.dtype.type(10 ** (digits - 1 - place)) % numbers.dtype.type(10)).astype(u) + u(48)
        words[at // 4] = (digit << u(8 * (at % 4))) + (words[at // 4] if isinstance(words[at // 4], np.ndarray) else u(words[at // 4]))
    a, b, c, d = (np.full(len(numbers), v, u) for v in _START)
    f, low = np.empty_like(a), np.empty_like(a)
    for i, (turn, sine) in enumerate(zip(_TURNS, _SINES)):
        if i < 16:
            word = words[i]
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            word = words[(5 * i + 1) % 16]
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            word = words[(3 * i + 5) % 16]
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            word = words[7 * i % 16]
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        if isinstance(word, np.ndarray):
            f += word
            f += u(sine)
        else:
            f += u((word + sine) & 0xFFFFFFFF)
        np.right_shift(f, u(32 - turn), out=low)
        f <<= u(turn)
        f |= low
        f += b
        a, d, c, b, f = d, c, b, f, a
    a += u(_START[0])
    b += u(_START[1])
    return a.byteswap().astype(np.uint64) << np.uint64(32) | b.byteswap()
