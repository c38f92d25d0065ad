"""MD5 of many short texts at once, as in `hash_text`, for work inside tasks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_SHIFTS = np.repeat([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], 4, axis=0).ravel().astype(np.uint32)
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint64).astype(np.uint32)
_START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)


def _block(state: list[np.ndarray], words: np.ndarray) -> list[np.ndarray]:
    """One 64-byte block (16 x texts) mixed into the state; nothing is allocated inside the rounds."""
    a, b, c, d, mixed = (np.empty_like(state[0]) for _ in range(5))
    for own, given in zip((a, b, c, d), state):
        own[:] = given
    xor, both, add = np.bitwise_xor, np.bitwise_and, np.add
    for i in range(64):
        if i < 16:  # d ^ (b & (c ^ d))
            g = i
            xor(c, d, out=mixed)
            both(mixed, b, out=mixed)
            xor(mixed, d, out=mixed)
        elif i < 32:  # c ^ (d & (b ^ c))
            g = (5 * i + 1) % 16
            xor(b, c, out=mixed)
            both(mixed, d, out=mixed)
            xor(mixed, c, out=mixed)
        elif i < 48:
            g = (3 * i + 5) % 16
            xor(b, c, out=mixed)
            xor(mixed, d, out=mixed)
        else:  # c ^ (b | ~d)
            g = (7 * i) % 16
            np.invert(d, out=mixed)
            np.bitwise_or(mixed, b, out=mixed)
            xor(mixed, c, out=mixed)
        add(a, mixed, out=a)
        add(a, words[g], out=a)
        add(a, _SINES[i], out=a)
        np.left_shift(a, _SHIFTS[i], out=mixed)
        np.right_shift(a, np.uint32(32) - _SHIFTS[i], out=a)
        np.bitwise_or(a, mixed, out=a)
        add(a, b, out=a)
        a, b, c, d = d, a, b, c
    return [x + y for x, y in zip(state, (a, b, c, d))]


def leading_bits(heads: np.ndarray, tails: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of md5(head + tail): hex digits 1 to 8 and 9 to 16 as numbers (heads x tails).

    `heads` are equally long texts as rows of bytes.
    """
    n, start = heads.shape
    first, second = np.empty((2, n, len(tails)), np.uint32)
    alike: dict[int, list[int]] = {}  # tails by the number of blocks of their texts
    for i, tail in enumerate(tails):
        alike.setdefault((start + len(tail) + 8) // 64 + 1, []).append(i)
    for blocks, own in alike.items():
        size = blocks * 64
        ends = np.zeros((len(own), size), np.uint8)
        for row, i in zip(ends, own):
            length = start + len(tails[i])
            row[start:length] = np.frombuffer(tails[i], np.uint8)
            row[length] = 0x80
            row[-8:] = np.frombuffer((8 * length).to_bytes(8, "little"), np.uint8)
        texts = np.repeat(ends[None], n, axis=0)
        texts[:, :, :start] = heads[:, None]
        words = np.ascontiguousarray(texts.reshape(-1, size).view("<u4").T)
        state = [np.full(words.shape[1], s) for s in _START]
        for k in range(blocks):
            state = _block(state, words[16 * k : 16 * (k + 1)])
        first[:, own] = state[0].byteswap().reshape(n, -1)
        second[:, own] = state[1].byteswap().reshape(n, -1)
    return first, second
