"""Words and word hashes of Arrow batches, without a Python loop over words.

Used inside ``mapInArrow`` functions. Memory is bounded by the block size plus
eight bytes per word of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 (public constants): spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(n, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed + 1))


BYTE_VALUES = seeded(256, 11)


def normal(text) -> bytes:
    """UTF-8 of a text with one space between words; a null text is empty.
    ``bytes.split`` cuts at exactly the six ASCII spaces of the contracts."""
    return b"" if text is None else b" ".join(text.encode("utf-8", "replace").split())


def word_starts(buf: bytes) -> np.ndarray:
    """Start offsets of the words of a normal text, plus the end sentinel."""
    if not buf:
        return np.zeros(1, np.int64)
    cuts = np.flatnonzero(np.frombuffer(buf, np.uint8) == 0x20)
    return np.concatenate(([0], cuts + 1, [len(buf) + 1]))


def word_hashes(buf: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a normal text (or several joined by a
    space), worked off in blocks cut at spaces."""
    out, at = [], 0
    while at < len(buf):
        end = len(buf)
        if end - at > BLOCK_BYTES:
            cut = buf.rfind(b" ", at, at + BLOCK_BYTES)
            cut = cut if cut > at else buf.find(b" ", at + BLOCK_BYTES)
            end = cut if cut > at else len(buf)
        block = buf[at:end]
        starts = word_starts(block)
        data = np.frombuffer(block + b" ", np.uint8)
        lens = np.diff(starts)
        place = np.arange(len(data), dtype=np.int64) - np.repeat(starts[:-1], lens)
        with np.errstate(over="ignore"):
            weight = seeded(int(lens.max()), 29)[place] | U64(1)
            out.append(mix(np.add.reduceat(BYTE_VALUES[data] * weight, starts[:-1])))
        at = end + 1
    return np.concatenate(out) if out else np.zeros(0, U64)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (order matters)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    acc = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        for i in range(k):
            acc = mix(acc * U64(0x9E3779B97F4A7C15) + hashes[i:i + n])
    return acc


def blocks(sizes: list[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about ``limit`` bytes; a longer single
    row is a range of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
