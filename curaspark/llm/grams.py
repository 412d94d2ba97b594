"""Hashed character n-grams of whole text columns, a few array operations for each document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from curaspark.llm import common


def _letters() -> np.ndarray:
    """Code point to its lower-case letter, other characters to a space (basic plane)."""
    table = np.full(1 << 16, 32, np.uint32)
    for point in range(1 << 16):
        character = chr(point)
        if character.isalpha():
            low = character.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


_TABLES: dict[str, np.ndarray] = {}


def letters() -> np.ndarray:
    if "letters" not in _TABLES:
        _TABLES["letters"] = _letters()
    return _TABLES["letters"]


def code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the offsets of the texts in them."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    if len(points) == len(raw):
        return points, offsets
    leading = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=leading[1:])
    return points, leading[offsets]


def fold_letters(points: np.ndarray) -> np.ndarray:
    table = letters()
    low = table[np.minimum(points, 0xFFFF)]
    beyond = points > 0xFFFF
    if beyond.any():
        for point in np.unique(points[beyond]):
            low[points == point] = ord(chr(point).lower()) if chr(point).isalpha() else 32
    return low


def gram_hashes(points: np.ndarray, sizes: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each n the hash, below 2**bits, of the n-gram that starts at each position."""
    found = []
    with np.errstate(over="ignore"):
        rolling = np.zeros(len(points), np.uint32)
        for n in range(1, max(sizes) + 1):
            if len(points) < n:
                found.append(np.zeros(0, np.uint32))
                continue
            rolling = rolling[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] + np.uint32(1)
            if n in sizes:
                found.append((rolling * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits))
    return found


def each_text(texts: pa.Array, prepare=None, size: int = 1 << 20) -> Iterator[np.ndarray]:
    """Code points of each text in turn, in runs so that memory stays small."""
    raw, offsets = common.text_buffer(texts)
    for _, _, part, own in common.chunks(raw, offsets, size):
        points, at = code_points(part, own)
        if prepare is not None:
            points = prepare(points)
        for a, b in zip(at[:-1], at[1:]):
            yield points[a:b]


def distinct(points: np.ndarray, sizes: tuple[int, ...], bits: int, seen: np.ndarray) -> np.ndarray:
    """Sorted distinct gram hashes; ``seen`` is an all-False scratch table of 2**bits."""
    hashes = gram_hashes(points, sizes, bits)
    for h in hashes:
        seen[h] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def counts(points: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    hashes = gram_hashes(points, sizes, bits)
    return np.bincount(np.concatenate(hashes) if hashes else np.zeros(0, np.int64), minlength=1 << bits)
